"""Suffix-array de-duplication of long byte strings with a logarithmic family of indexes.

Asked: every byte covered by a ``LENGTH``-byte string that also starts anywhere
else. The index is a sparse suffix array. Of the ``GRAM``-byte grams in a
``LENGTH``-byte window the one of least hash (the leftmost of equals) is the
window's anchor; equal windows have equal anchors at
equal distances, so only suffixes at anchors, one in about fifty, need entries.
An entry holds the hash of the suffix's first ``GRAM`` bytes, by which the array
is ordered, and the hash of the whole run of windows with that anchor.

Batches come in one after the other. Each gets its array, which is merge-scanned
(sort-merge join on the order key) against the existing levels; what matches is
noted; then the array becomes a level, and levels of one rank merge into one of
the next rank, so n batches leave at most log2(n) + 1 levels.

Matches are settled exactly in two more passes over the texts. Runs that occur
twice as a whole are covered as a whole. Runs whose anchor occurs twice with
different surroundings (the edges of repeated passages) are split into blocks of
16 windows; a block whose common core is unique has no repeated window, a block
that occurs twice as a whole is repeated, and only the windows of the others are
counted one by one. What goes to the tasks is bitmaps of fixed size; false hits
of a bitmap cost work and change nothing. 64-bit hashes stand for the strings.

Defined results: null and empty texts and texts shorter than ``LENGTH`` lose
nothing; repeated rows count as separate texts, so equal long texts go wholly;
matches never cross texts; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playgrid.llm.common import bitmap_of, in_bitmap, mix, slices, text_bytes, tidy, unused, written

LENGTH = 200
GRAM = 100
BLOCK = 16
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = mix(np.arange(101, 357, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class _Powers:
    """Powers of the hash base and of its inverse, grown as needed."""

    up, down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << max(19, n.bit_length())
            made = []
            for base in (_BASE, pow(_BASE, -1, 1 << 64)):
                p = np.full(size, base, np.uint64)
                p[0] = 1
                made.append(np.cumprod(p, dtype=np.uint64))
            cls.up, cls.down = made
        return cls.up[:n], cls.down[:n]


class Texts:
    """Byte-string hashes and anchors of some texts, end to end."""

    def __init__(self, data: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM):
        self.length, self.off = length, off
        n = len(data)
        up, self.down = _Powers.of(n + 1)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[:n], out=self.total[1:])
        none = np.empty(0, np.int64)
        self.doc = self.lo = self.hi = self.anchor = none
        self.key = np.empty(0, np.uint64)
        windows = length - gram + 1
        if n < length:
            return
        h = self.hash(np.arange(n - gram + 1), gram)
        least = (h >> np.uint64(32) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while 2 * width <= windows:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < windows:
            least = np.minimum(least[:width - windows], least[windows - width:])
        anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        doc = np.repeat(np.arange(len(off) - 1, dtype=np.int32), np.diff(off))
        inside = doc[:len(anchor)] == doc[length - 1:]
        start = inside.copy()
        start[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
        stop = inside.copy()
        stop[:-1] &= (anchor[1:] != anchor[:-1]) | ~inside[1:]
        self.lo, self.hi = np.flatnonzero(start), np.flatnonzero(stop)
        self.anchor, self.doc = anchor[self.lo], doc[self.lo]
        self.key = h[self.anchor]

    def hash(self, at: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        """Hashes of the strings that start at ``at``."""
        h = (self.total[at + length] - self.total[at]) * self.down[at]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        return h

    def runs(self) -> np.ndarray:
        """Hash of each anchor's run: its bytes, its length and where in it the anchor is."""
        span = self.hi - self.lo + self.length
        return mix(self.hash(self.lo, span) + mix((span << 16 | self.anchor - self.lo).astype(np.uint64)))

    def blocks(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the runs ``some``: run, first window, windows, hash of the core and of the whole of each block."""
        near, far = (self.anchor - self.hi)[some] // BLOCK, (self.anchor - self.lo)[some] // BLOCK
        count = far - near + 1
        run = np.repeat(some, count)
        j = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(near, count)
        lo = np.maximum(self.lo[run], self.anchor[run] - BLOCK * j - BLOCK + 1)
        hi = np.minimum(self.hi[run], self.anchor[run] - BLOCK * j)
        core = mix(self.hash(self.anchor[run] - BLOCK * j, self.length - BLOCK + 1) + mix(j.astype(np.uint64)))
        span = hi - lo + self.length
        whole = mix(self.hash(lo, span) + mix((span << 16 | self.anchor[run] - lo).astype(np.uint64)))
        return run, lo, hi - lo + 1, core, whole


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    for b in slices(batches, "text"):
        yield b, Texts(*text_bytes(b.column("text")))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


@tidy
def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, t in _texts(batches):
        yield pa.RecordBatch.from_arrays([_signed(t.key), _signed(t.runs())], ["prefix", "run"])


class IndexFamily:
    """Levels of sparse suffix arrays (prefix, run, n), and what matched among all batches so far."""

    def __init__(self):
        self.levels: list[tuple[int, DataFrame]] = []
        self.whole: DataFrame | None = None  # runs that occur twice
        self.edges: DataFrame | None = None  # prefixes that occur with different runs

    @staticmethod
    def array(texts: DataFrame) -> DataFrame:
        """The suffix array of a batch: its entries, with counts, in order of their prefixes within each partition."""
        entries = texts.select("text").mapInArrow(_entries, "prefix bigint, run bigint")
        return entries.groupBy("prefix", "run").agg(F.count("*").cast("int").alias("n")).sortWithinPartitions("prefix")

    def _note(self, whole: DataFrame, edges: DataFrame) -> None:
        self.whole = whole if self.whole is None else self.whole.union(whole)
        self.edges = edges if self.edges is None else self.edges.union(edges)

    def append(self, texts: DataFrame, last: bool = False) -> None:
        """Scans a batch against itself and all levels, then makes it a level (unless no batch will follow)."""
        new = written(self.array(texts), "array")
        self._note(new.filter("n > 1").select("run"),
                   new.groupBy("prefix").agg(F.count("*").alias("runs")).filter("runs > 1").select("prefix"))
        for _, level in self.levels:
            ends = level.groupBy("prefix").agg(F.min("run").alias("lo"), F.max("run").alias("hi"))
            met = written(new.select("prefix", "run").join(ends, "prefix"), "met")
            self._note(met.join(level.select("prefix", "run"), ["prefix", "run"], "left_semi").select("run"),
                       met.filter("lo != run or hi != run").select("prefix"))
        if last:
            return
        rank = 0
        while self.levels and self.levels[-1][0] == rank:
            _, old = self.levels.pop()
            merged = new.union(old).groupBy("prefix", "run").agg(F.sum("n").cast("int").alias("n"))
            new = written(merged.sortWithinPartitions("prefix"), "array")
            rank += 1
        self.levels.append((rank, new))

    def matches(self) -> tuple[DataFrame, DataFrame]:
        """run (occurs twice) and prefix (occurs with different runs), each once."""
        return written(self.whole.distinct(), "whole"), written(self.edges.distinct(), "edges")


class _Seen:
    """64-bit hashes met before in a task, as far as a table of 2^19 places remembers (the last one of each place)."""

    def __init__(self, bits: int = 19):
        self.last = np.zeros(1 << bits, np.int64)
        self.mask = np.int64((1 << bits) - 1)

    def new(self, values: np.ndarray) -> np.ndarray:
        """Which values are met for the first time; 0 is always new."""
        out = np.zeros(len(values), bool)
        some, first = np.unique(values, return_index=True)
        fresh = (self.last[some & self.mask] != some) | (some == 0)
        out[first[fresh]] = True
        self.last[some & self.mask] = some
        return out


def _block_rows(whole, edges):
    """Texts -> rows of repeated runs (kind 0, core and whole the run) and of the blocks of edge runs (kind 1).

    Copies are told once in a task: equal texts have equal rows of kind 0, and of a repeated run, whose places kind 0
    has, blocks are only there for others to match.
    """

    @tidy
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, runs = _Seen(), _Seen()
        for b, t in _texts(batches):
            keys = b.column("text_key").to_numpy()
            run_hash = t.runs().view(np.int64)
            repeated = in_bitmap(whole.value, run_hash)
            full = np.flatnonzero(repeated & texts.new(keys)[t.doc])
            edge = np.flatnonzero(in_bitmap(edges.value, t.key.view(np.int64)))
            edge = edge[~repeated[edge] | runs.new(run_hash[edge])]
            run, lo, n, core, block = t.blocks(edge)
            doc = np.concatenate((t.doc[full], t.doc[run]))
            at = np.concatenate((t.lo[full], lo)) - t.off[doc]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array([0, 1], np.int32), [len(full), len(run)])),
                 pa.array(np.concatenate((run_hash[full], core.view(np.int64)))),
                 pa.array(np.concatenate((run_hash[full], block.view(np.int64)))), pa.array(keys[doc]),
                 pa.array(at, pa.int32()), pa.array(np.concatenate(((t.hi - t.lo + 1)[full], n)), pa.int32())],
                ["kind", "core", "whole", "text_key", "at", "n"])

    return rows


def _window_rows(edges, cores, texts, single):
    """Texts -> hash and place of every window in a block whose core may be undecided.

    Blocks that occur twice as a whole are settled and stand here for others to match, once in a task.
    """

    @tidy
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = _Seen()
        some = (b.filter(pa.array(in_bitmap(texts.value, b.column("text_key").to_numpy()))) for b in batches)
        for b, t in _texts(some):
            keys = b.column("text_key").to_numpy()
            run, lo, n, core, block = t.blocks(np.flatnonzero(in_bitmap(edges.value, t.key.view(np.int64))))
            ok = in_bitmap(cores.value, core.view(np.int64))
            ok[ok] = in_bitmap(single.value, block.view(np.int64)[ok]) | told.new(block.view(np.int64)[ok])
            run, lo, n = run[ok], lo[ok], n[ok]
            at = np.repeat(lo, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            doc = np.repeat(t.doc[run], n)
            yield pa.RecordBatch.from_arrays(
                [_signed(t.hash(at, t.length)), pa.array(keys[doc]), pa.array(at - t.off[doc], pa.int32())],
                ["window", "text_key", "at"])

    return rows


def repeated_windows(texts: DataFrame, batches: int = 2) -> DataFrame:
    """text_key and its starts: array of (at, n), n repeated strings starting at byte ``at`` and after.

    ``texts`` has text_key (a hash of the text) and text; equal texts have equal rows in the result.
    """
    spark = texts.sparkSession
    family = IndexFamily()
    for k in range(batches):
        mine = texts.filter(F.pmod(F.xxhash64("text_key"), F.lit(batches)) == k) if batches > 1 else texts
        family.append(mine, last=k == batches - 1)
    whole, edges = family.matches()
    share = lambda df, c: spark.sparkContext.broadcast(bitmap_of(df, c))  # noqa: E731  df: a written table
    edge_bits = share(edges, "prefix")
    rows = written(texts.mapInArrow(_block_rows(share(whole, "run"), edge_bits),
                                    "kind int, core bigint, whole bigint, text_key bigint, at int, n int"), "blocks")
    runs = rows.filter("kind = 0").join(whole, F.col("core") == F.col("run"), "left_semi")
    blocks = rows.filter("kind = 1")
    counts = written(blocks.groupBy("core", "whole").agg(F.count("*").alias("times")), "block-counts")
    open_cores = written(counts.groupBy("core").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("core"), "cores")
    state = counts.join(open_cores.withColumn("open", F.lit(True)), "core", "left").filter("times > 1 or open")
    told = written(blocks.drop("kind").join(state, ["core", "whole"]), "told")
    settled = told.filter("times > 1")
    single = share(written(counts.filter("times = 1").join(open_cores, "core", "left_semi").select("whole"), "single"), "whole")
    unsettled = share(written(told.filter("open").select("text_key").distinct(), "unsettled"), "text_key")
    windows = written(texts.mapInArrow(_window_rows(edge_bits, share(open_cores, "core"), unsettled, single),
                                       "window bigint, text_key bigint, at int"), "windows")
    again = windows.groupBy("window").agg(F.count("*").alias("times")).filter("times > 1").select("window")
    single = windows.join(again, "window", "left_semi").select("text_key", "at", F.lit(1).alias("n"))
    found = runs.select("text_key", "at", "n").union(settled.select("text_key", "at", "n")).union(single)
    return found.groupBy("text_key").agg(F.collect_set(F.struct("at", "n")).alias("starts"))


def cutter(length: int = LENGTH, digest: bool = False):
    """Column function (text, starts) -> struct(n_bytes, n_removed, n_spans, kept_sha256 of the bytes left).

    Without ``digest`` the struct has the bytes themselves (kept) and the text
    they spell (kept_text, without characters that were cut in two).
    """
    last = [("kept_sha256", pa.string())] if digest else [("kept", pa.binary()), ("kept_text", pa.string())]

    @F.arrow_udf("struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,"
                 + ("kept_sha256:string>" if digest else "kept:binary,kept_text:string>"))
    @tidy
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, starts in batches:
            sizes, removed, spans, kept = [], [], [], []
            for k in range(len(text)):
                raw = (text[k].as_py() or "").encode()
                merged: list[list[int]] = []
                if starts[k].is_valid and len(starts[k]):
                    flat = starts[k].values
                    at, n = (flat.field(f).to_numpy().astype(np.int64) for f in ("at", "n"))
                    order = np.argsort(at, kind="stable")
                    lo, hi = at[order], np.maximum.accumulate(at[order] + n[order] - 1 + length)
                    new = np.concatenate(([True], lo[1:] > hi[:-1]))
                    merged = list(zip(lo[new].tolist(), hi[np.append(np.flatnonzero(new)[1:] - 1, len(hi) - 1)].tolist()))
                parts, done = [], 0
                for a, b in merged:
                    parts.append(raw[done:a])
                    done = b
                rest = b"".join([*parts, raw[done:]])
                sizes.append(len(raw))
                removed.append(len(raw) - len(rest))
                spans.append(len(merged))
                kept.append((hashlib.sha256(rest).hexdigest(),) if digest else (rest, rest.decode("utf-8", "ignore")))
            yield pa.StructArray.from_arrays(
                [pa.array(x, pa.int64()) for x in (sizes, removed, spans)]
                + [pa.array([x[i] for x in kept], kind) for i, (_, kind) in enumerate(last)],
                ["n_bytes", "n_removed", "n_spans", *(name for name, _ in last)])

    return cut


def dedup_column(docs: DataFrame, name: str, digest: bool = False, batches: int = 2) -> DataFrame:
    """``docs`` with the cutter's struct as column ``name``.

    Only texts that a bitmap of the cut ones may have go through the join with their starts.
    """
    key, starts = (unused(x, docs.columns) for x in ("_dedup_key", "_dedup_starts"))
    text = F.coalesce(F.col("text"), F.lit(""))
    found = written(repeated_windows(docs.select(F.xxhash64(text).alias("text_key"), text.alias("text")), batches), "starts")
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap_of(found, "text_key"))

    @F.arrow_udf("boolean")
    def touched(keys: pa.Array) -> pa.Array:
        return pa.array(in_bitmap(bitmap.value, keys.to_numpy()))

    keyed = docs.withColumn(key, F.xxhash64(text))
    found = found.select(F.col("text_key").alias(key), F.col("starts").alias(starts))
    hit = keyed.filter(touched(F.col(key))).join(found, key, "left").drop(key)
    kind = found.schema[starts].dataType
    miss = keyed.filter(~touched(F.col(key))).drop(key).withColumn(starts, F.lit(None).cast(kind))
    return hit.unionByName(miss).withColumn(name, cutter(digest=digest)(F.col("text"), F.col(starts))).drop(starts)


def dedup_documents(docs: DataFrame, batches: int = 2) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for every row of ``docs``."""
    return dedup_column(docs.select("doc_id", "text"), "cut", digest=True, batches=batches).select("doc_id", "cut.*")
