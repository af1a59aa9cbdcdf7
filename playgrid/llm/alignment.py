"""Alignment of two tokenizers over a corpus by inverted pair bitmaps.

Every text is encoded whole by both libraries. Where a token of A and one of B
end at the same byte, a group ends and the two tokens are linked. A task numbers
its documents in blocks of at most ``BLOCK`` and inverts the links of a block:
for each id pair one bitmap of the documents that hold it (equal links of a
document are OR-merged into one bit) and, for the repetitions, one bitmap for
each binary digit of "links beyond the first" (multiplicity planes). Bitmaps are
compressed: below 512 documents the sorted 16-bit numbers, else the 8192 bits.

Counts come of the bitmaps alone: the popcounts of a pair's document bitmaps sum
to its document count, and adding the planes' popcounts times their digit's
weight gives its link count. To score, each posting gets its pair's count,
returns to its block and adds it to the documents that it names. So what is
shuffled has a row for each pair and block, not one for each link; a pair that
every text holds has a row or a few in each block, its counts are summed before
the shuffle, and no task holds more than one block.

Defined results: null and empty texts, and texts whose joined token bytes are
not a space and the text for both tokenizers, have no tokens; repeated rows
count each; an empty table has no rows; a text of any length is encoded whole
(its block ends with it); further columns are ignored. Blocks follow the input's
partitions, so the input must read the same again after a loss, as a table does.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playgrid.llm.common import held, slices, tidy, written
from playgrid.llm.library_bpe import ByteBPE
from playgrid.llm.sentencepiece_bpe import MARK

BLOCK_BITS = 13
BLOCK = 1 << BLOCK_BITS
BLOCK_LINKS = 1 << 21
BATCH_BYTES = 1 << 20
_DENSE = BLOCK // 16  # from so many documents on, a bitmap is no longer than the list
_PRESENCE = -1


class Aligner:
    """Both encoders with the byte lengths and decimal spellings of their tokens."""

    made: dict[tuple[str, str], "Aligner"] = held(__name__)

    def __init__(self, a_json: str, b_model: str):
        import sentencepiece

        self.a = ByteBPE.of(a_json, specials=False)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_model)
        self.size_b = self.b.get_piece_size()
        self.bytes_a = [self.a.bytes_of.get(i, b"") for i in range(self.a.size)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.size_b)))]
        self.lens = [np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b)]
        # a token's number, then what follows it: inside a group and at its end
        self.spelt = [b"%d%s" % (i, c) for n, end in ((self.a.size, b"|"), (self.size_b, b";"))
                      for i in range(n) for c in (b",", end)]

    @classmethod
    def of(cls, a_json: str, b_model: str) -> "Aligner":
        if (a_json, b_model) not in cls.made:
            cls.made[a_json, b_model] = cls(a_json, b_model)
        return cls.made[a_json, b_model]

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both tokenizers, none where their bytes are not a space and the text."""
        none, out = np.empty(0, np.int64), []
        for text, b in zip(texts, self.b.encode([t or "" for t in texts], num_threads=1)):
            if text:
                want, a = (" " + text).encode(), self.a.encode(" " + text).astype(np.int64)
                if b"".join(map(self.bytes_b.__getitem__, b)) == want == b"".join(map(self.bytes_a.__getitem__, a.tolist())):
                    out.append((a, np.array(b, np.int64)))
                    continue
            out.append((none, none))
        return out

    def align(self, texts: list[str | None]) -> "Alignment":
        return Alignment(self, self.encode(texts))


class Alignment:
    """Groups and links of some texts, end to end."""

    def __init__(self, aligner: Aligner, encoded: list[tuple[np.ndarray, np.ndarray]]):
        self.aligner, docs = aligner, np.arange(len(encoded))
        none = [np.empty(0, np.int64)]
        self.ids = a, b = [np.concatenate(none + [e[k] for e in encoded]) for k in (0, 1)]
        self.n = n_a, n_b = [np.array([len(e[k]) for e in encoded], np.int64) for k in (0, 1)]
        ends = [np.cumsum(aligner.lens[k][self.ids[k]]) for k in (0, 1)]
        cut = [np.zeros((int(ends[0][-1]) if len(a) else 0) + 1, bool) for _ in ends]
        for c, e in zip(cut, ends):
            c[e] = True
        self.last = last_a, last_b = [cut[1 - k][ends[k]] for k in (0, 1)]  # tokens at a group's end
        self.doc = np.repeat(docs, n_a)[last_a]
        self.pair = a[last_a] * aligner.size_b + b[last_b]
        self.n_groups = np.bincount(self.doc, minlength=len(encoded))

    def spellings(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        (a, b), (last_a, last_b) = self.ids, self.last
        at_a, at_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.concatenate(([0], at_b))[group_a]] = 2 * a + last_a
        order[np.arange(len(b)) + np.concatenate((at_a, [0]))[group_b]] = 2 * (b + self.aligner.a.size) + last_b
        ends = np.cumsum(self.n[0] + self.n[1])
        spelt = self.aligner.spelt.__getitem__
        return [b"".join(map(spelt, order[e - n:e].tolist()))[:-1] for e, n in zip(ends, self.n[0] + self.n[1])]

    def groups(self) -> list[list[tuple[list[int], list[int]]]]:
        """For each text, its groups of A ids and B ids."""
        return [[tuple([int(i) for i in side.split(b",")] for side in g.split(b"|")) for g in s.split(b";") if g]
                for s in self.spellings()]


def _compressed(row: np.ndarray, doc: np.ndarray, rows: int) -> tuple[np.ndarray, pa.Array]:
    """Popcounts and compressed bitmaps of ``rows`` sets, from their members sorted by (row, doc)."""
    card = np.bincount(row, minlength=rows)
    size = np.where(card < _DENSE, card, _DENSE)  # in 16-bit words
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if rows else 0, "<u2")
    first = np.cumsum(card) - card
    sparse = card[row] < _DENSE
    out[(ends - size)[row[sparse]] + (np.arange(len(row)) - first[row])[sparse]] = doc[sparse]
    for r in np.flatnonzero(card >= _DENSE):
        bits = np.zeros(BLOCK, np.uint8)
        bits[doc[first[r]:first[r] + card[r]]] = 1
        out[ends[r] - _DENSE:ends[r]] = np.packbits(bits, bitorder="little").view("<u2")
    offsets = np.concatenate(([0], 2 * ends)).astype(np.int32)
    return card, pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(out)])


def members(bitmaps: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, document) of every set bit of the compressed bitmaps."""
    offsets = np.frombuffer(bitmaps.buffers()[1], np.int32, len(bitmaps) + 1, 4 * bitmaps.offset).astype(np.int64) // 2
    words = np.frombuffer(bitmaps.buffers()[2] or b"", "<u2", int(offsets[-1]) if len(bitmaps) else 0)
    size = np.diff(offsets)
    row = np.repeat(np.arange(len(size)), size)
    dense = size == _DENSE
    plain = ~dense[row]
    rows, docs = [row[plain]], [words[offsets[0]:][plain]]
    for r in np.flatnonzero(dense):
        docs.append(np.flatnonzero(np.unpackbits(words[offsets[r]:offsets[r + 1]].view(np.uint8), bitorder="little")))
        rows.append(np.full(len(docs[-1]), r))
    return np.concatenate(rows), np.concatenate(docs).astype(np.int64)


def inverted(pair: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Array]]:
    """(plane, pairs, popcounts, bitmaps) of a block's links: presence, then the digits of the repetitions."""
    key, times = np.unique(pair << BLOCK_BITS | doc, return_counts=True)
    more = times - 1
    planes = range(int(more.max(initial=0)).bit_length())
    for plane, held in [(_PRESENCE, key), *((j, key[more >> j & 1 == 1]) for j in planes)]:
        pairs, row = np.unique(held >> BLOCK_BITS, return_inverse=True)
        yield plane, pairs, *_compressed(row, held & (BLOCK - 1), len(pairs))


_DOC = ("doc_id", "doc", "n_a", "n_b", "n_groups", "groups")
_ROWS = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("doc_id", pa.int64()), ("doc", pa.int32()),
                   ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups", pa.string()),
                   ("pair", pa.int64()), ("plane", pa.int32()), ("documents", pa.int32()), ("bitmap", pa.binary())])
_ROWS_SQL = ("kind string, block bigint, doc_id bigint, doc int, n_a bigint, n_b bigint, n_groups bigint, groups string, "
             "pair bigint, plane int, documents int, bitmap binary")


def _rows(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.nulls(n, f.type) if (c := columns.get(f.name)) is None else
        pa.array([c] * n, f.type) if isinstance(c, (str, int)) else c if isinstance(c, pa.Array) else pa.array(c, f.type)
        for f in _ROWS], schema=_ROWS)


class Postings:
    """The written blocks of a corpus: a row per document and a row per pair, plane and block."""

    def __init__(self, docs: DataFrame, a_json: str, b_model: str, digest: bool = False):
        """``groups`` of a document is its spelling ``a1,a2|b1;a3|b2,b3``, with ``digest`` the SHA-256 of it."""

        @tidy
        def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            aligner, blocks = Aligner.of(a_json, b_model), TaskContext.get().partitionId() << 32
            links, held, n_links = [], 0, 0

            def closed() -> Iterator[pa.RecordBatch]:
                for plane, pairs, card, bitmaps in inverted(*(np.concatenate(x) for x in zip(*links))):
                    yield _rows(len(pairs), kind="pair", block=blocks, pair=pairs, plane=plane, documents=card, bitmap=bitmaps)

            for batch in batches:
                for part in slices([batch], "text", BATCH_BYTES):
                    for at in range(0, part.num_rows, 256):
                        rows = part.slice(at, 256)
                        if held and (held + rows.num_rows > BLOCK or n_links > BLOCK_LINKS):
                            yield from closed()
                            links, held, n_links, blocks = [], 0, 0, blocks + 1
                        got = aligner.align(rows.column("text").to_pylist())
                        spelt = got.spellings()
                        yield _rows(rows.num_rows, kind="doc", block=blocks, doc_id=rows.column("doc_id"),
                                    doc=np.arange(held, held + rows.num_rows), n_a=got.n[0], n_b=got.n[1],
                                    n_groups=got.n_groups,
                                    groups=[(hashlib.sha256(s).hexdigest() if digest else s.decode()) if s else "" for s in spelt])
                        links.append((got.pair, got.doc + held))
                        held, n_links = held + rows.num_rows, n_links + len(got.pair)
            if held:
                yield from closed()

        import sentencepiece

        self.size_b = sentencepiece.SentencePieceProcessor(model_file=b_model).get_piece_size()
        rows = docs.select("doc_id", "text").mapInArrow(invert, _ROWS_SQL)
        self.rows = written(rows, "alignment", partition_by=("kind",))

    def documents(self) -> DataFrame:
        return self.rows.filter("kind = 'doc'").select("block", *_DOC)

    def bitmaps(self) -> DataFrame:
        return self.rows.filter("kind = 'pair'").select("block", "pair", "plane", "documents", "bitmap")

    def pairs(self) -> DataFrame:
        """pair, a_id, b_id, documents, links and is_best (the most links of the B id, ties included) of every id pair."""
        first = F.col("plane") == _PRESENCE
        weight = F.when(first, 1).otherwise(F.expr("shiftleft(1L, plane)"))
        counts = self.bitmaps().groupBy("pair").agg(
            F.sum(F.when(first, F.col("documents"))).alias("documents"), F.sum(F.col("documents") * weight).alias("links"))
        counts = counts.withColumn("a_id", F.expr(f"pair div {self.size_b}")).withColumn("b_id", F.col("pair") % self.size_b)
        return counts.withColumn("is_best", F.col("links") == F.max("links").over(Window.partitionBy("b_id")))

    def scores(self) -> DataFrame:
        """doc_id, n_a, n_b, n_groups, groups, n_links, n_best and count_sum of every document."""
        counts = self.pairs().select("pair", "links", "is_best")
        told = self.bitmaps().withColumnRenamed("block", "to").join(counts, "pair").select(
            "to", "plane", "bitmap", "links", "is_best")
        return self.documents().groupBy("block").cogroup(told.groupBy("to")).applyInArrow(
            _scored, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups string, n_links bigint, "
            "n_best bigint, count_sum bigint")


def _scored(docs: pa.Table, told: pa.Table) -> pa.Table:
    """Adds the counts of a block's postings to the documents that they name."""
    totals = np.zeros((3, BLOCK), np.int64)
    for batch in told.to_batches():
        plane, count, best = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("plane", "links", "is_best"))
        times = np.where(plane == _PRESENCE, 1, 1 << np.maximum(plane, 0).astype(np.int64))
        row, doc = members(batch.column("bitmap"))
        for total, weight in zip(totals, (times, times * best, times * count)):
            np.add.at(total, doc, weight[row])
    n_links, n_best, count_sum = totals[:, docs.column("doc").to_numpy()]
    out = docs.select(["doc_id", "n_a", "n_b", "n_groups", "groups"])
    for name, values in (("n_links", n_links), ("n_best", n_best), ("count_sum", count_sum)):
        out = out.append_column(name, pa.array(values, pa.int64()))
    return out


def align_documents(docs: DataFrame, a_json: str, b_model: str, digest: bool = True) -> DataFrame:
    """The scores of every document; with ``digest`` groups_sha256 in place of the groups."""
    out = Postings(docs, a_json, b_model, digest).scores()
    return out.withColumnRenamed("groups", "groups_sha256") if digest else out
