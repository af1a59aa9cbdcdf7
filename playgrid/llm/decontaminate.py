"""Benchmark decontamination: an FM-index per training shard, searched for the benchmark's phrases.

A shard is a run of texts of a few MB inside a partition. Its words that can
belong to a phrase (chains of word pairs that the benchmark has) become one
stream of symbols; the stream's suffix array gives the Burrows-Wheeler
transform, kept as a wavelet matrix with ranks. All phrases are searched
backwards at once: each step narrows an interval of suffixes by two wavelet
ranks per level. Occurrences are located from sampled suffix positions by
walking back through the transform, and their word ranges are merged into
removal spans.

A phrase (window) is 13 consecutive words of an item; an item of fewer words,
but not none, is one phrase. The benchmark goes to the tasks in blocks of at
most ``block_mb`` of text, a pass each; every task's closure holds all of them.

Defined results: null and empty texts have no words and no hits; items without
words have no phrase; items of one item_id are one item; repeated rows give
repeated rows; an empty benchmark hits nothing; very long texts are a shard of
their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playgrid.llm.common import LOWER, WORD_ALNUM, mix, span_hashes, text_bytes, tidy, word_spans

WINDOW = 13
SHARD_BYTES = 4 << 20
SAMPLE = 16


class WaveletMatrix:
    """Access, rank and next-place (LF) queries over a sequence of small integers."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma - 1).bit_length())
        self.ones, self.zeros = [], []
        x = symbols
        for level in range(self.bits - 1, -1, -1):
            bit = (x >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))))
            self.zeros.append(len(x) - int(bit.sum()))
            x = np.concatenate((x[bit == 0], x[bit == 1]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        lo, hi = np.zeros_like(at), at
        for k, level in enumerate(range(self.bits - 1, -1, -1)):
            one = ((symbol >> level) & 1).astype(bool)
            a, b = self.ones[k][lo], self.ones[k][hi]
            lo, hi = np.where(one, self.zeros[k] + a, lo - a), np.where(one, self.zeros[k] + b, hi - b)
        return hi - lo

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(at)
        for k in range(self.bits):
            one = self.ones[k][at + 1] - self.ones[k][at]
            symbol = symbol << 1 | one
            at = np.where(one == 1, self.zeros[k] + self.ones[k][at], at - self.ones[k][at])
        return symbol


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by doubling the compared length until no two are equal."""
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64)
    h, n = 1, len(s)
    while True:
        after = np.zeros(n, np.int64)
        after[:max(0, n - h)] = rank[h:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.concatenate(([0], np.cumsum(sorted_key[1:] != sorted_key[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        h *= 2


class FMIndex:
    """Index of a symbol sequence; symbol 0 is the end mark and must not occur in it."""

    def __init__(self, symbols: np.ndarray, sigma: int, sample: int = SAMPLE):
        s = np.append(symbols, 0)
        sa = suffix_array(s)
        bwt = s[sa - 1]
        self.before = np.concatenate(([0], np.cumsum(np.bincount(s, minlength=sigma))))
        self.wavelet, self.n = WaveletMatrix(bwt, sigma), len(s)
        marked = sa % sample == 0
        self.marked, self.marked_rank, self.kept = marked, np.concatenate(([0], np.cumsum(marked))), sa[marked]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals of phrases (rows of one length) by backward search."""
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for k in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[live, k]
            lo[live] = self.before[c] + self.wavelet.rank(c, lo[live])
            hi[live] = self.before[c] + self.wavelet.rank(c, hi[live])
            live = live[lo[live] < hi[live]]
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the sequence of suffix rows, walking back to a sampled one."""
        out, steps, rows = np.empty(len(rows), np.int64), 0, rows.copy()
        todo = np.arange(len(rows))
        while len(todo):
            here = self.marked[rows[todo]]
            done = todo[here]
            out[done] = self.kept[self.marked_rank[rows[done]]] + steps
            todo = todo[~here]
            c = self.wavelet.access(rows[todo])
            rows[todo] = self.before[c] + self.wavelet.rank(c, rows[todo])
            steps += 1
        return out


class Phrases:
    """The distinct windows of a block of benchmark items, as symbols, and the items of each."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        data, off = text_bytes(pa.array([t for _, t in items], pa.string()))
        data = LOWER[data]
        starts, ends, first = word_spans(data, WORD_ALNUM, off)
        hashes = span_hashes(data, starts, ends)
        self.vocab, symbols = np.unique(hashes, return_inverse=True)
        symbols = symbols.astype(np.int64) + 2
        self.sigma = len(self.vocab) + 2
        pairs, found = [], {}
        for k, (item, _) in enumerate(items):
            s = symbols[first[k]:first[k + 1]]
            pairs.append(pair_keys(hashes[first[k]:first[k + 1]]))
            n = min(window, len(s))
            for at in range(len(s) - n + 1 if n else 0):
                found.setdefault(tuple(s[at:at + n]), set()).add(item)
        self.by_length: dict[int, tuple[np.ndarray, list[list[str]]]] = {}
        for n in sorted({len(p) for p in found}):
            mine = [p for p in found if len(p) == n]
            self.by_length[n] = np.array(mine, np.int64), [sorted(found[p]) for p in mine]
        self.shortest = min(self.by_length, default=0)
        self.pair_filter = np.zeros(1 << 22, bool)
        if pairs:
            self.pair_filter[np.concatenate(pairs) >> np.uint64(42)] = True
        self.word_filter = np.zeros(1 << 20, bool)
        self.word_filter[self.vocab >> np.uint64(44)] = True

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Symbol of each word; 0 for words that the block has not."""
        out = np.zeros(len(hashes), np.int64)
        maybe = np.flatnonzero(self.word_filter[hashes >> np.uint64(44)])
        place = np.minimum(np.searchsorted(self.vocab, hashes[maybe]), len(self.vocab) - 1)
        ok = self.vocab[place] == hashes[maybe]
        out[maybe[ok]] = place[ok] + 2
        return out

    def stream(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the chains of words that can hold a phrase, a mark (1) after each chain, and their word places."""
        symbol = self.symbols(hashes)
        known = symbol > 0
        chained = np.zeros(len(hashes), bool)  # word k goes on from word k - 1
        if len(hashes) > 1:
            chained[1:] = known[1:] & known[:-1] & self.pair_filter[pair_keys(hashes) >> np.uint64(42)]
        chained[first[:-1][first[:-1] < len(hashes)]] = False
        head = np.flatnonzero(known & ~chained)
        stop = np.flatnonzero(known & ~np.append(chained[1:], False)) + 1
        long = stop - head >= self.shortest
        head, stop = head[long], stop[long]
        lens = stop - head + 1
        total = int(lens.sum())
        begin = np.cumsum(lens) - lens
        place = np.arange(total) - np.repeat(begin, lens) + np.repeat(head, lens)
        stream = np.ones(total, np.int64)
        inside = np.ones(total, bool)
        inside[begin + lens - 1] = False
        stream[inside] = symbol[place[inside]]
        return stream, place


def pair_keys(hashes: np.ndarray) -> np.ndarray:
    return mix(hashes[1:] + mix(hashes[:-1])) if len(hashes) > 1 else np.empty(0, np.uint64)


_KIND = "struct<n_words:bigint,spans:array<struct<start:int,stop:int>>,items:array<string>>"
_SPAN = pa.struct([("start", pa.int32()), ("stop", pa.int32())])


def find(data: np.ndarray, off: np.ndarray, phrases: Phrases):
    """Of a shard: words per text, merged hit spans (text, start, stop) and (text, item) pairs."""
    data = LOWER[data]
    starts, ends, first = word_spans(data, WORD_ALNUM, off)
    n_words = np.diff(first)
    none = np.empty(0, np.int64)
    if not phrases.by_length or not len(starts):
        return n_words, (none, none, none), []
    stream, place = phrases.stream(span_hashes(data, starts, ends), first)
    if not len(stream):
        return n_words, (none, none, none), []
    index = FMIndex(stream, phrases.sigma)
    change = np.zeros(len(starts) + 1, np.int64)
    doc_of = np.repeat(np.arange(len(n_words)), n_words)
    pairs: set[tuple[int, str]] = set()
    for n, (rows, items) in phrases.by_length.items():
        lo, hi = index.search(rows)
        hit = np.flatnonzero(hi > lo)
        count = hi[hit] - lo[hit]
        suffixes = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo[hit], count)
        at = place[index.locate(suffixes)]
        np.add.at(change, at, 1)
        np.add.at(change, at + n, -1)
        for d, w in np.unique(np.stack([doc_of[at], np.repeat(hit, count)]), axis=1).T.tolist():
            pairs.update((d, i) for i in items[w])
    covered = np.cumsum(change)[:-1] > 0
    edge = np.ones(len(covered), bool)
    edge[1:] = doc_of[1:] != doc_of[:-1]
    begin = np.flatnonzero(covered & (edge | ~np.concatenate(([False], covered[:-1]))))
    stop = np.flatnonzero(covered & (np.append(edge[1:], True) | ~np.append(covered[1:], False))) + 1
    doc = doc_of[begin]
    return n_words, (doc, begin - first[doc], stop - first[doc]), sorted(pairs)


def finder(items: list[tuple[str, str | None]], window: int = WINDOW):
    """Column function text -> struct(n_words, spans of hit words, items with a phrase in the text)."""
    made: list[Phrases] = []

    @F.arrow_udf(_KIND)
    @tidy
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        phrases = made[0] if made else Phrases(items, window)
        for col in batches:
            data, off = text_bytes(col)
            parts, at = [], 0
            while at < len(col):
                to = max(at + 1, int(np.searchsorted(off, off[at] + SHARD_BYTES, "right")) - 1)
                n, (doc, start, stop), pairs = find(data[off[at]:off[to]], off[at:to + 1] - off[at], phrases)
                cuts = np.searchsorted(doc, np.arange(to - at + 1))
                spans = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(start, pa.int32()), pa.array(stop, pa.int32())], fields=list(_SPAN)))
                icuts = np.searchsorted([d for d, _ in pairs], np.arange(to - at + 1))
                names = pa.ListArray.from_arrays(pa.array(icuts, pa.int32()), pa.array([i for _, i in pairs], pa.string()))
                parts.append(pa.StructArray.from_arrays([pa.array(n, pa.int64()), spans, names],
                                                        ["n_words", "spans", "items"]))
                at = to
            if parts:
                yield pa.concat_arrays(parts)
            else:
                yield pa.array([], pa.struct([("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.string()))]))

    return search


def item_blocks(benchmark: DataFrame, block_mb: int = 16) -> Iterator[list[tuple[str, str | None]]]:
    """The benchmark's items in blocks of about ``block_mb`` of text."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(size // (block_mb << 20)) + 1
    for k in range(n):
        mine = benchmark.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else benchmark
        yield [(r[0], r[1]) for r in mine.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), "text").collect()]


def merged(spans: Column) -> Column:
    """Sorted spans with overlapping and touching ones joined."""
    none = F.array().cast("array<struct<start:int,stop:int>>")

    def step(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        joins = (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["stop"] >= s["start"])
        joined = F.struct(last["start"].alias("start"), F.greatest(last["stop"], s["stop"]).alias("stop"))
        return F.when(joins, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(joined))
                      ).otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["stop"].alias("stop")))))

    return F.aggregate(F.array_sort(spans), none, step)


def scan_column(text: Column, benchmark: DataFrame, window: int = WINDOW, block_mb: int = 16) -> Column:
    """struct(n_words, spans, items) of each text against the whole benchmark, a block of items after the other."""
    found = [finder(items, window)(text) for items in item_blocks(benchmark, block_mb)]
    if len(found) == 1:
        return found[0]
    return F.struct(found[0]["n_words"].alias("n_words"), merged(F.concat(*[f["spans"] for f in found])).alias("spans"),
                    F.array_distinct(F.concat(*[f["items"] for f in found])).alias("items"))


def contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def n_hit(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, s: a + s["stop"] - s["start"])


def judge(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for every row of ``docs``."""
    r = docs.select("doc_id", scan_column(F.col("text"), benchmark).alias("r")).select("doc_id", "r.*")
    return r.select("doc_id", "n_words", n_hit(F.col("spans")).alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                    F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256")
                    ).withColumn("contaminated", contaminated(F.col("n_hit"), F.col("n_words")))
