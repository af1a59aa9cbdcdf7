"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the 4- to 6-character grams of the lower-cased text (white space as
one space, a space at either end), hashed to 2^20 buckets; a text has a gram or
has not. On the labelled rows that may be learnt from, each bucket gets its log
ratio of smoothed document counts in the toxic and the other class; the
``FEATURES`` buckets whose shares differ most clearly between the classes are
kept, scaled by their ratio, and a logistic regression with an L2 penalty is
fitted on them. Scoring is one pass over whole texts without a shuffle.

The fit uses at most ``most_rows`` labelled rows, those with the smallest hash
of doc_id (a documented bound: what reaches the driver is their kept features
and the bucket counts of the kept features). Labels, lang, source and doc_id are
no inputs of a score.

Defined results: null and empty texts score as a text without any gram; a
doc_id labelled more than once counts as toxic if any label says so; null
labels are passed over; without labelled rows, or with one class alone, the
score is the smoothed share of toxic rows; repeated rows give repeated rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playgrid.llm.common import mix, tidy, written

BITS = 20
ORDERS = (4, 5, 6)
FEATURES = 2048
MOST_ROWS = 20_000
_KEYS = mix(np.arange(1, 9, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text, mod 5, is 0 (null ids as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def grams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the text number and bucket of every gram."""
    texts = [f" {t.lower()} " if t else "" for t in texts]
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    points[points <= 32] = 32
    lens = np.array([len(t) for t in texts], np.int64)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), lens)
    room = np.repeat(np.cumsum(lens), lens) - np.arange(len(points))
    for n in ORDERS:
        if len(points) < n:
            continue
        h = np.full(len(points) - n + 1, n, np.uint64)
        for k in range(n):
            h += points[k:len(points) - n + 1 + k] * _KEYS[k]
        h ^= h >> np.uint64(29)
        h *= _KEYS[7]
        ok = room[:len(h)] >= n
        yield doc[:len(h)][ok], (h >> np.uint64(64 - BITS)).astype(np.int64)[ok]


def text_parts(col: pa.Array, most: int = 1 << 18) -> Iterator[list[str | None]]:
    """The texts of a column in runs of about ``most`` characters."""
    part, size = [], 0
    for at in range(0, len(col), 64):
        for t in col.slice(at, 64).to_pylist():
            part.append(t)
            size += len(t or "")
            if size >= most:
                yield part
                part, size = [], 0
    if part:
        yield part


@tidy
def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's rows: bucket, documents of either class that have it; bucket -1 counts the documents."""
    counts = np.zeros((2, 1 << BITS), np.int64)
    docs, place = np.zeros(2, np.int64), np.zeros(1 << BITS, np.int64)
    for batch in batches:
        at, toxic = 0, batch.column(1).to_numpy(zero_copy_only=False)
        for part in text_parts(batch.column(0)):
            y = toxic[at:at + len(part)]
            at += len(part)
            docs += np.bincount(y, minlength=2)[:2]
            for doc, bucket in grams(part):
                cuts = np.searchsorted(doc, np.arange(len(part) + 1))
                for k, label in enumerate(y):
                    own = bucket[cuts[k]:cuts[k + 1]]
                    place[own] = number = np.arange(len(own))
                    counts[label, own[place[own] == number]] += 1  # each bucket once
    for lo in range(0, 1 << BITS, 1 << 16):
        some = lo + np.flatnonzero(counts[:, lo:lo + (1 << 16)].any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(counts[1, some]), pa.array(counts[0, some])],
                                         ["bucket", "toxic", "other"])
    yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array(docs[1:]), pa.array(docs[:1])],
                                     ["bucket", "toxic", "other"])


class Model:
    """Weights by bucket and the intercept."""

    def __init__(self, buckets: np.ndarray, weights: np.ndarray, bias: float):
        self.buckets, self.weights, self.bias = buckets, weights, bias

    def features(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text number, feature number) pairs."""
        place = np.full(1 << BITS, -1, np.int16)
        place[self.buckets] = np.arange(len(self.buckets))
        found = []
        for doc, bucket in grams(texts):
            f = place[bucket]
            ok = f >= 0
            found.append(doc[ok].astype(np.int64) << 16 | f[ok])
        pairs = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        return pairs >> 16, pairs & 0xFFFF

    def scores(self, texts: list[str | None]) -> np.ndarray:
        doc, f = self.features(texts)
        z = self.bias + np.bincount(doc, self.weights[f], len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _fit(rows: np.ndarray, feats: np.ndarray, y: np.ndarray, ratios: np.ndarray, penalty: float, steps: int = 400):
    """Logistic regression by accelerated gradient descent over sparse rows; weights on the raw features and bias."""
    n, m = len(y), len(ratios)
    x = ratios[feats]
    w, b = np.zeros(m), np.log((y.sum() + 1) / (n - y.sum() + 1))
    squared = np.bincount(rows, x * x, n)
    rate = 1 / (0.25 * (squared.mean() * 4 + 1) + penalty)
    vw, vb = w.copy(), b
    for t in range(steps):
        g = 1 / (1 + np.exp(-np.clip(vb + np.bincount(rows, x * vw[feats], n), -30, 30))) - y
        nw = vw - rate * (np.bincount(feats, x * g[rows], m) / n + penalty * vw)
        nb = vb - rate * g.mean()
        k = t / (t + 3)
        vw, vb, w, b = nw + k * (nw - w), nb + k * (nb - b), nw, nb
    return w * ratios, b


def train(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, penalty: float = 1e-4) -> Model:
    """Fits on labelled rows of ``docs`` outside the held-out fold, ``most_rows`` at most."""
    spark = docs.sparkSession
    usable = (labels.select("doc_id", "toxic").dropna().groupBy("doc_id")
              .agg((F.max("toxic") > 0).cast("int").alias("toxic")).filter(~held_out(F.col("doc_id"))))
    chosen = spark.createDataFrame(
        usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows).collect(), "doc_id bigint, toxic int")
    sample = written(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic"),
                     "toxic-sample")
    counts = sample.mapInArrow(_class_counts, "bucket bigint, toxic bigint, other bigint").groupBy("bucket").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    counts = written(counts, "toxic-counts")
    total = counts.filter("bucket < 0").collect()
    p, q = (total[0]["toxic"], total[0]["other"]) if total else (0, 0)
    bias = float(np.log((p + 1) / (q + 1)))
    if not p or not q:
        return Model(np.empty(0, np.int64), np.empty(0), bias)
    share = (F.col("toxic") + F.col("other") + 1) / F.lit(p + q + 2)
    clear = F.abs(F.col("toxic") / p - F.col("other") / q) / F.sqrt(share * (1 - share) * (1 / p + 1 / q))
    top = counts.filter("bucket >= 0").orderBy(clear.desc(), "bucket").limit(FEATURES).collect()
    buckets = np.array([r["bucket"] for r in top], np.int64)
    ratios = np.array([np.log((r["toxic"] + 1) / (p + 2)) - np.log((r["other"] + 1) / (q + 2)) for r in top])
    model = Model(buckets, np.zeros(len(top)), bias)

    @tidy
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in text_parts(batch.column(0)):
                doc, f = model.features(part)
                cuts = np.searchsorted(doc, np.arange(1, len(part)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.astype("<u2").tobytes() for x in np.split(f, cuts)], pa.binary()),
                     batch.column(1).slice(at, len(part))], ["feats", "toxic"])
                at += len(part)

    rows = sample.mapInArrow(kept, "feats binary, toxic int").orderBy("toxic", "feats").collect()
    feats = [np.frombuffer(r["feats"], "<u2") for r in rows]
    number = np.repeat(np.arange(len(rows)), [len(f) for f in feats])
    y = np.array([r["toxic"] for r in rows], float)
    model.weights, model.bias = _fit(number, np.concatenate(feats).astype(np.int64), y, ratios, penalty)
    return model


def score_column(text: Column, model: Model) -> Column:
    """Probability of toxicity of each text."""

    @F.arrow_udf("double")
    @tidy
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for col in batches:
            got = [model.scores(part) for part in text_parts(col)]
            yield pa.array(np.concatenate(got) if got else np.empty(0))

    return score(text)


def score_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    model = train(docs, labels, **options)
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                       score_column(F.col("text"), model).alias("score")).select(
        "*", (F.col("score") >= 0.5).cast("int").alias("predicted"))
