"""Quality rules: frequent lines across the documents of a host are removed, depleted documents rejected.

Pass 1 (one scan of the texts) hashes each document's normalised lines (A-Z
lower-cased, digits as 0, white space dropped). Pass 2 counts, per host and
line, the distinct documents that have it, summed in each task before the
shuffle. A line is frequent when more than ``min_docs`` documents and more than
``share`` of the host's documents have it, or more than ``most_docs`` documents,
however large the host. The frequent lines are joined back per document. Pass 3
measures each document and cuts its frequent lines out of the text
(``clean_text``: the other lines, as they were); a document that loses more than
``most_lost`` of its characters by that is depleted. Only texts with a frequent
line are shuffled.

Base measures: words [^\\x20\\x09-\\x0D]+, code points in words, symbols
``#*$%&|<>``, lines with a word that equal an earlier line of the text, words in
8-word windows found twice or more in the text.

Defined results: a null text has no words and stays null; lines without a word
are never frequent; a text whose lines are all frequent becomes empty; null hosts are one host; documents
without words fail the base rules; rows repeated exactly count as
one document and give repeated rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playgrid.llm.common import (LOWER, WORD_SPACE, bitmap_of, in_bitmap, mix, slices, span_hashes, text_bytes, word_spans,
                                 within, written)

WINDOW = 8
_WINDOW_KEYS = mix(np.arange(11, 11 + WINDOW, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
#: The symbols that are counted.
SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_FOLD = LOWER.copy()
_FOLD[48:58] = 48
_NOT_NEWLINE = np.ones(256, bool)
_NOT_NEWLINE[10] = False


def repeated_words(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether each word lies in a window that its text has twice or more; first: n + 1 places of texts' first words."""
    n = len(hashes)
    covered = np.zeros(n + 1, np.int64)
    starts = n - WINDOW + 1
    if starts > 0:
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        h = np.zeros(starts, np.uint64)
        for k in range(WINDOW):
            h += hashes[k:starts + k] * _WINDOW_KEYS[k]
        h = mix(h + mix(doc[:starts].astype(np.uint64) + np.uint64(1)))
        own = np.flatnonzero(doc[:starts] == doc[WINDOW - 1:])
        order = np.argsort(h[own], kind="stable")
        sorted_h = h[own][order]
        same = np.zeros(len(own), bool)
        same[1:] = sorted_h[1:] == sorted_h[:-1]
        same[:-1] |= same[1:]
        at = own[order][same]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + WINDOW, -1)
    return np.cumsum(covered)[:n] > 0


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return total[first[1:]] - total[first[:-1]]


def measure(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """Base measures of texts given as UTF-8 bytes end to end."""
    starts, ends, first = word_spans(data, WORD_SPACE, off)
    points = WORD_SPACE[data] & ((data & 0xC0) != 0x80)
    out = {"n_words": np.diff(first), "word_chars": _per_text(points, off), "n_symbols": _per_text(_SYMBOL[data], off)}
    l_start, l_end, l_first = word_spans(data, _NOT_NEWLINE, off)
    has_word = np.searchsorted(starts, l_start) < np.searchsorted(starts, l_end)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(l_first))[has_word]
    lines = mix(span_hashes(data, l_start[has_word], l_end[has_word]) + mix(doc.astype(np.uint64) + np.uint64(1)))
    distinct = doc[np.unique(lines, return_index=True)[1]]
    out["n_dup_lines"] = np.bincount(doc, minlength=len(off) - 1) - np.bincount(distinct, minlength=len(off) - 1)
    out["n_repeat_words"] = _per_text(repeated_words(span_hashes(data, starts, ends), first), first)
    return out


def line_keys(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and characters of every line with a word, normalised."""
    keep = WORD_SPACE[data] | ~_NOT_NEWLINE[data]
    place = np.concatenate(([0], np.cumsum(keep)))
    flat, off = _FOLD[data[keep]], place[off]
    starts, ends, first = word_spans(flat, _NOT_NEWLINE, off)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    points = np.concatenate(([0], np.cumsum((flat & 0xC0) != 0x80)))
    return doc, span_hashes(flat, starts, ends), points[ends] - points[starts]


def _host_keys(source: pa.Array) -> np.ndarray:
    data, off = text_bytes(source)
    return _whole_hashes(data, off) + source.is_null().to_numpy(zero_copy_only=False)


def _whole_hashes(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Hash of each text; 0 for an empty one."""
    out = np.zeros(len(off) - 1, np.uint64)
    some = np.flatnonzero(np.diff(off) > 0)
    out[some] = span_hashes(data, off[:-1][some], off[1:][some])
    return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _host_lines(b: pa.RecordBatch, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """line_keys, each hash with its host's."""
    doc, line, chars = line_keys(data, off)
    return doc, mix(line + mix(_host_keys(b.column("source"))[doc])), chars


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        data, off = text_bytes(b.column("text"))
        doc, line, _ = _host_lines(b, data, off)
        order = np.lexsort((line, doc))
        doc, line = doc[order], line[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (line[1:] != line[:-1])
        cuts = np.searchsorted(doc[new], np.arange(len(off)))
        yield pa.RecordBatch.from_arrays(
            [_signed(_host_keys(b.column("source"))), b.column("row_key"),
             pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), _signed(line[new]))], ["host", "row_key", "lines"])


def without_lines(text: bytes, gone: set[int]) -> bytes:
    """A text without its lines of the numbers in ``gone``."""
    return b"\n".join(x for k, x in enumerate(text.split(b"\n")) if k not in gone)


_JUDGED = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
           "n_repeat_words bigint, line_chars bigint, lost_chars bigint, clean_text string")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text, source, frequent (line hashes or null) -> measures and the text without those lines."""
    for b in slices(batches, "text"):
        data, off = text_bytes(b.column("text"))
        m = measure(data, off)
        doc, line, chars = _host_lines(b, data, off)
        first = np.searchsorted(doc, np.arange(len(off)))
        lost, text = np.zeros(len(off) - 1, np.int64), b.column("text").cast(pa.string())
        hit = np.flatnonzero(b.column("frequent").is_valid().to_numpy(zero_copy_only=False))
        if len(hit):
            worded = np.concatenate(([0], np.cumsum(WORD_SPACE[data])))
            starts, ends, _ = word_spans(data, _NOT_NEWLINE, off)
            starts = starts[worded[ends] > worded[starts]]  # of the lines that line_keys gives, in its order
            newlines = np.concatenate(([0], np.cumsum(~_NOT_NEWLINE[data])))
            cleaned = text.to_pylist()
            for i in hit.tolist():
                own = slice(first[i], first[i + 1])
                bad = np.isin(line[own], np.array(b.column("frequent")[i].as_py(), np.int64).view(np.uint64))
                lost[i] = chars[own][bad].sum()
                if bad.any():
                    gone = newlines[starts[own][bad]] - newlines[off[i]]
                    cleaned[i] = without_lines(data[off[i]:off[i + 1]].tobytes(), set(gone.tolist())).decode()
            text = pa.array(cleaned, pa.string())
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), *(pa.array(m[k], pa.int64()) for k in
                                   ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
             pa.array(_per_text(chars, first)), pa.array(lost), text],
            ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_chars", "lost_chars",
             "clean_text"])


def judge(docs: DataFrame, min_docs: int = 20, share: float = 0.02, most_lost: float = 0.6, most_docs: int = 200) -> DataFrame:
    """doc_id, base measures, line measures (line_chars, lost_chars), verdicts and the text without frequent lines for
    every row of ``docs``."""
    keyed = docs.select(F.col("doc_id").cast("bigint"), "text", F.col("source").cast("string")).withColumn(
        "row_key", F.xxhash64("doc_id", "text", "source"))
    m = written(keyed.mapInArrow(_lines, "host bigint, row_key bigint, lines array<bigint>"), "quality")
    lines = m.select("host", "row_key", F.explode("lines").alias("line"))
    # equal rows are one document: what they are more than one is taken off again, so only their lines are shuffled twice
    times = written(m.groupBy("row_key").agg(F.count("*").alias("n")).filter("n > 1"), "repeated")
    spare = within(m, times, ("row_key",)).dropDuplicates(["row_key"]).join(times, "row_key").withColumn("w", 1 - F.col("n"))
    counted = m.withColumn("w", F.lit(1).cast("bigint")).select("host", "lines", "w").unionByName(spare.select("host", "lines", "w"))
    per_host = counted.groupBy("host").agg(F.sum("w").alias("host_docs"))
    above = (F.col("docs") > F.lit(share) * F.col("host_docs")) | (F.col("docs") > most_docs)
    counted = counted.select("host", F.explode("lines").alias("line"), "w")
    frequent = (counted.groupBy("line", "host").agg(F.sum("w").alias("docs")).filter(F.col("docs") > min_docs)
                .join(per_host, "host").filter(above).select("line"))
    cut = written(lines.join(frequent, "line").groupBy("row_key").agg(F.collect_set("line").alias("frequent")), "frequent")
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap_of(cut, "row_key", per_key=256))

    @F.arrow_udf("boolean")
    def maybe(keys: pa.Array) -> pa.Array:
        return pa.array(in_bitmap(bitmap.value, keys.to_numpy()))

    hit = keyed.filter(maybe(F.col("row_key"))).join(cut, "row_key", "left")
    rest = keyed.filter(~maybe(F.col("row_key"))).withColumn("frequent", F.lit(None).cast("array<bigint>"))
    judged = hit.unionByName(rest).drop("row_key").mapInArrow(_cut, _JUDGED)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    kept = ~F.col("base_failed") & (F.col("lost_chars") <= F.lit(most_lost) * F.col("line_chars"))
    return judged.withColumn("base_failed", failed).withColumn("kept", kept).select(
        *(c for c in judged.columns if c != "clean_text"), "base_failed", "kept", "clean_text")
