"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from the folder it lies in (on a cluster: ``--py-files`` or that folder)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    known = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), *env.get("PYTHONPATH", "").split(os.pathsep)]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    Only a local session without the setting (tests) gets a folder of its own;
    on a cluster a missing setting is an error, since a machine-local folder
    would lose rows there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="playgrid-shared-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def written(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), **options: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_HELD: list[tuple[str, dict]] = []


def held(owner: str) -> dict:
    """A dictionary in which the module ``owner`` keeps encoders and memos between its tasks in a Python worker."""
    _HELD.append((owner, {}))
    return _HELD[-1][1]


def tidy(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``task`` (batches -> batches), handing the memory that it freed back to the system at its end.

    Python workers live on between tasks, several to an executor, and would keep it. What other modules keep in the
    worker goes when the task begins, so a worker holds the memos of one operator at a time.
    """

    @wraps(task)
    def run(batches):
        for owner, kept in _HELD:
            if owner != task.__module__:
                kept.clear()
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
            trim(0)

    return run


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, end to end, and the n + 1 offsets (null: empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if not len(col):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1 + col.offset)[col.offset:]
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of about ``most`` text bytes (a longer text is a piece of its own)."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < b.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
            yield b.slice(at, to - at)
            at = to


LEAST_BITS, MOST_BITS = 20, 27
BITS_PER_KEY = 16


def unused(name: str, columns: Iterable[str]) -> str:
    """A column name like ``name`` that none of the columns has (Spark compares them without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


class Bitmap:
    """A set of low bits. Pickled, as for a broadcast, it is compressed: every executor keeps a file of it."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def __reduce__(self):
        return Bitmap._unpacked, (zstandard.compress(self.bits.tobytes(), 1), len(self.bits))

    @staticmethod
    def _unpacked(packed: bytes, size: int) -> "Bitmap":
        return Bitmap(np.frombuffer(zstandard.decompress(packed, size), np.uint8))


def bitmap_of(values: DataFrame, column: str, per_key: int = BITS_PER_KEY) -> Bitmap:
    """A bitmap of the column's low bits, of ``per_key`` bits or up to twice that a row of ``values`` (a written table),
    16 MB at most. Of other values, one in ``per_key`` at most is taken for a row's.

    Beyond 8 million rows it gets fuller, and clears less of what it is asked about.
    """
    bits = min(MOST_BITS, max(LEAST_BITS, (per_key * values.count() - 1).bit_length()))
    place = F.col(column).bitwiseAND(F.lit((1 << bits) - 1)) + 1
    rows = values.select(F.bitmap_bucket_number(place).alias("k"), F.bitmap_bit_position(place).alias("p")).groupBy("k").agg(
        F.bitmap_construct_agg("p").alias("b")).collect()
    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in rows:
        out[(r["k"] - 1) * 4096:r["k"] * 4096] = np.frombuffer(bytes(r["b"]), np.uint8)
    return Bitmap(out)


def in_bitmap(bitmap: Bitmap, values: np.ndarray) -> np.ndarray:
    """Which values' low bits are set: all that the bitmap was made of, and a few others."""
    place = values.astype(np.int64, copy=False) & (8 * len(bitmap.bits) - 1)
    return (bitmap.bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


class Memo(dict):
    """A memo of bounded size: on overflow the entries become the old generation, and the one before goes.

    Keys longer than ``longest`` are made anew each time.
    """

    def __init__(self, make: Callable, most: int, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest, self.old = make, most, longest, {}

    def __missing__(self, key):
        if len(key) > self.longest:
            return self.make(key)
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (splitmix64's finalizer)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_spans(data: np.ndarray, inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes with ``inside[byte]``, never across a text's end,
    and the n + 1 positions of each text's first word among them."""
    is_word = inside[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[off] = True
    before = np.concatenate(([False], is_word[:-1])) if len(data) else is_word
    after = np.concatenate((is_word[1:], [False])) if len(data) else is_word
    starts = np.flatnonzero(is_word & (~before | cut[:-1]))
    ends = np.flatnonzero(is_word & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


PLACES = 24
_PLACED = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _A + np.arange(PLACES, dtype=np.uint64)[:, None] * _B)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans: each byte keyed by its place in the span, summed, mixed with the length.

    Spans of up to ``PLACES`` bytes (nearly all words) are summed place by place from a table, longest first, so
    that those which still have a byte lie side by side.
    """
    lens = ends - starts
    long = lens > PLACES
    if long.all():
        return _long_hashes(data, starts, ends)
    order = np.argsort((PLACES + 1 - np.minimum(lens, PLACES + 1)).astype(np.uint8), kind="stable")
    n_long = int(np.count_nonzero(long))
    out = np.empty(len(starts), np.uint64)
    if n_long:
        out[order[:n_long]] = _long_hashes(data, starts[order[:n_long]], ends[order[:n_long]])
    order = order[n_long:]
    at, n = starts[order], lens[order]
    have = len(n) - np.cumsum(np.bincount(n, minlength=PLACES + 1))  # spans with a byte at each place
    total = n.astype(np.uint64)
    for place, count in enumerate(have[:PLACES].tolist()):
        if not count:
            break
        total[:count] += _PLACED[place][data[at[:count]]]
        at[:count] += 1
    out[order] = mix(total)
    return out


def _long_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.empty(0, np.uint64)
    lens = ends - starts
    at = np.arange(int(lens.sum()), dtype=np.int64)
    first = np.cumsum(lens) - lens
    place = at - np.repeat(first, lens)
    x = data[np.repeat(starts, lens) + place].astype(np.uint64) + np.uint64(1)
    x = mix(x * _A + place.astype(np.uint64) * _B)
    return mix(np.add.reduceat(x, first) + lens.astype(np.uint64))


WORD_SPACE = np.ones(256, bool)
WORD_SPACE[[0x20, 9, 10, 11, 12, 13]] = False  # words [^\x20\x09-\x0D]+
WORD_ALNUM = np.ones(256, bool)
WORD_ALNUM[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z only


def _parted(docs: DataFrame, keys: DataFrame, by: tuple[str, ...]) -> tuple[DataFrame, DataFrame, DataFrame, Column]:
    """The rows of ``docs`` that a bitmap of the keys may have, the others, the keys, and when a row has a key."""
    name = unused("_row_key", docs.columns)
    own = {k: unused(f"_key_{k}", docs.columns) for k in by}
    keys = written(keys.select(F.xxhash64(*by).alias(name), *(F.col(k).alias(v) for k, v in own.items())).distinct(), "keys")
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap_of(keys, name))

    @F.arrow_udf("boolean")
    def maybe(values: pa.Array) -> pa.Array:
        return pa.array(in_bitmap(bitmap.value, values.to_numpy()))

    keyed = docs.withColumn(name, F.xxhash64(*by))
    same = F.lit(True)
    for k in by:
        same = same & keyed[k].eqNullSafe(F.col(own[k]))
    return (keyed.filter(maybe(F.col(name))).drop(name), keyed.filter(~maybe(F.col(name))).drop(name), keys.drop(name), same)


def without(docs: DataFrame, gone: DataFrame, by: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``docs`` without the rows whose key is in ``gone``; rows that a bitmap of the gone keys clears are not shuffled."""
    hit, rest, keys, same = _parted(docs, gone, by)
    return rest.unionByName(hit.join(keys, same, "left_anti"))


def within(docs: DataFrame, wanted: DataFrame, by: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The rows of ``docs`` whose key is in ``wanted``; only rows that a bitmap of the keys may have are shuffled."""
    hit, _, keys, same = _parted(docs, wanted, by)
    return hit.join(keys, same, "left_semi")
