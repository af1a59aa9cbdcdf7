"""Token ids on disk: bit- or byte-plane blocks with a chunk index.

The ids of all documents, in ascending doc_id order, form one stream, cut into
shards (one per range of doc_ids) and chunks (whole documents, about
``CHUNK_IDS`` ids). A chunk's payload holds fixed-size blocks of ids; each
block's 32-bit ids are transposed into 4 byte planes or 32 bit planes and each
plane is compressed with zstandard, so the high planes, nearly constant, cost
almost nothing. The chunk index (shard, chunk, place in the shard, ids,
documents and their lengths) stands beside the payload; the container is
Parquet, so Spark's committer keeps the files whole when executors are lost.

Payload: ``PLN1``, then as little-endian 32-bit integers planes per block, ids
per block, ids, then for each block and plane the compressed length; then the
planes.

Defined results: null and empty texts have the end id alone; equal doc_ids stand
side by side, null ones first; an empty table gives an empty store.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playgrid.llm.byte_bpe import MEMO_WORDS, Splitter, UncutSpace, byte_letters
from playgrid.llm.common import Memo, shared_dir

MAGIC = b"PLN1"
BLOCK_IDS = 1 << 14
CHUNK_IDS = 1 << 18


def pack(ids: np.ndarray, planes: int = 4, block: int = BLOCK_IDS, level: int = 3) -> bytes:
    """Ids as a payload of byte planes (4) or bit planes (32)."""
    z = zstandard.ZstdCompressor(level=level)
    ids = np.ascontiguousarray(ids, "<u4")
    out = []
    for at in range(0, len(ids), block):
        as_bytes = ids[at:at + block].view(np.uint8).reshape(-1, 4).T
        for plane in as_bytes:
            if planes == 4:
                out.append(z.compress(np.ascontiguousarray(plane).tobytes()))
            else:
                bits = np.unpackbits(np.ascontiguousarray(plane)[:, None], axis=1, bitorder="little")
                out += [z.compress(np.packbits(b, bitorder="little").tobytes()) for b in bits.T]
    head = np.array([planes, block, len(ids), *map(len, out)], "<u4").tobytes()
    return b"".join([MAGIC, head, *out])


def unpack(payload: bytes) -> np.ndarray:
    """The ids of a payload."""
    if payload[:4] != MAGIC:
        raise ValueError("not a plane payload")
    planes, block, n = (int(x) for x in np.frombuffer(payload, "<u4", 3, 4))
    blocks = -(-n // block)
    lens = np.frombuffer(payload, "<u4", blocks * planes, 16)
    z, at, out, k = zstandard.ZstdDecompressor(), 16 + 4 * len(lens), [], 0
    for b in range(blocks):
        size = min(block, n - b * block)
        raw = np.zeros((size, 4), np.uint8)
        for p in range(planes):
            plane = z.decompress(payload[at:at + int(lens[k])])
            at += int(lens[k])
            k += 1
            if planes == 4:
                raw[:, p] = np.frombuffer(plane, np.uint8)
            else:
                bits = np.unpackbits(np.frombuffer(plane, np.uint8), bitorder="little")[:size]
                raw[:, p // 8] |= bits << np.uint8(p % 8)
        out.append(raw.reshape(-1).view("<u4"))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


class WordEncoder:
    """Ids of texts: the library's BPE model on pre-tokens, memoised by word."""

    made: dict[str, "WordEncoder"] = {}

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.split = Splitter(tokenizer_json)
        self.model = Tokenizer.from_file(tokenizer_json).model
        self.letters = dict(enumerate(byte_letters()))
        self.pretoken = Memo(self._pretoken, MEMO_WORDS)
        self.word = Memo(lambda w: b"".join(map(self.pretoken.__getitem__, self.split.pieces(w))), MEMO_WORDS)

    @classmethod
    def of(cls, tokenizer_json: str) -> "WordEncoder":
        if tokenizer_json not in cls.made:
            cls.made[tokenizer_json] = cls(tokenizer_json)
        return cls.made[tokenizer_json]

    def _pretoken(self, p: str) -> bytes:
        mapped = p.encode().decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.model.tokenize(mapped)], "<u4").tobytes()

    def _fragment(self, s: str) -> bytes:
        return b"".join(map(self.pretoken.__getitem__, self.split.pretokens(s)))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        out = []
        for segment, special in self.split.segments(text):
            first, *rest = segment.split(" ")
            try:
                more = b"".join(map(self.word.__getitem__, rest))
            except UncutSpace:
                first, *rest = self.split.words(segment)
                more = b"".join(self._fragment(" " + w) for w in rest)
            out += [self._fragment(first), more]
            if special is not None:
                out.append(np.array([special], "<u4").tobytes())
        return b"".join(out)


_CHUNK = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int64()),
                    ("doc_ids", pa.list_(pa.int64())), ("doc_lens", pa.list_(pa.int64())), ("payload", pa.binary())])
_CHUNK_SQL = ("shard int, chunk int, first_id bigint, n_ids bigint, doc_ids array<bigint>, doc_lens array<bigint>, "
              "payload binary")


def write_store(docs: DataFrame, tokenizer_json: str, path: str, end_id: int = 2, planes: int = 4) -> None:
    """Encodes every text, appends ``end_id`` and writes the chunks under ``path``.

    One range shuffle by doc_id puts the stream in order; each task then encodes
    its range and holds one chunk at a time.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = WordEncoder.of(tokenizer_json), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        held, ids, n, number, first = [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            payload = pack(np.frombuffer(b"".join(ids), "<u4"), planes)
            return pa.RecordBatch.from_pylist([{
                "shard": shard, "chunk": number, "first_id": first, "n_ids": n, "doc_ids": [d for d, _ in held],
                "doc_lens": [k for _, k in held], "payload": payload}], _CHUNK)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    got = (encoder.encode(text) if text else b"") + end
                    held.append((doc_id, len(got) // 4))
                    ids.append(got)
                    n += len(got) // 4
                    if n >= CHUNK_IDS:
                        yield close()
                        held, ids, first, n, number = [], [], first + n, 0, number + 1
        if held:
            yield close()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(chunks, _CHUNK_SQL).write.option("compression", "uncompressed").parquet(path)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """shard and the ids before it; one row per shard, so as many as the write had tasks."""
    ends = (spark.read.schema(_CHUNK_SQL).parquet(path).groupBy("shard")
            .agg(F.max(F.col("first_id") + F.col("n_ids")).alias("n")).orderBy("shard").collect())
    starts, at = [], 0
    for r in ends:
        starts.append((r["shard"], at))
        at += r["n"]
    return spark.createDataFrame(starts, "shard int, shard_start bigint")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, shard, offset in the shard and ids of every document of a store."""
    return _read(spark, path, False)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start in the whole stream, n_tokens and crc32 of the ids of every document, read from the files."""
    got = _read(spark, path, True).join(shard_starts(spark, path), "shard")
    return got.select("doc_id", (F.col("shard_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def _read(spark: SparkSession, path: str, digest: bool) -> DataFrame:
    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                r = batch.slice(at, 1).to_pylist()[0]
                ids = unpack(r["payload"])
                lens = np.array(r["doc_lens"], np.int64)
                ends = np.cumsum(lens)
                cut = [ids[e - n:e] for e, n in zip(ends, lens)]
                last = (pa.array([zlib.crc32(x.tobytes()) for x in cut], pa.int64()) if digest
                        else pa.array([x.astype(np.int32) for x in cut], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array([r["shard"]] * len(cut), pa.int32()),
                     pa.array(r["first_id"] + ends - lens, pa.int64()), pa.array(lens, pa.int64()), last],
                    ["doc_id", "shard", "offset", "n_tokens", "ids_crc32" if digest else "ids"])

    kind = "ids_crc32 bigint" if digest else "ids array<int>"
    chunks = spark.read.schema(_CHUNK_SQL).parquet(path)
    return chunks.mapInArrow(documents, f"doc_id bigint, shard int, offset bigint, n_tokens bigint, {kind}")


def store_and_read(docs: DataFrame, tokenizer_json: str, end_id: int = 2) -> DataFrame:
    """Writes a store into the shared folder and returns its index, read back from the files."""
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/llm/ids-{uuid.uuid4().hex}"
    write_store(docs, tokenizer_json, path, end_id)
    return read_index(spark, path)
