"""The corpus pipeline, stage by stage on what the stage before left, against brute force."""

import hashlib
import sys
from pathlib import Path

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline as P
from playgrid.llm import toxicity
from playgrid.llm.common import table, written

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

SF = "/root/testdata/sf0.001"


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def cut_text(text, seen, length=200):
    raw = (text or "").encode()
    gone = bytearray(len(raw))
    for s in range(len(raw) - length + 1):
        if seen[raw[s:s + length]] > 1:
            gone[s:s + length] = b"\1" * length
    return bytes(x for x, g in zip(raw, gone) if not g).decode("utf-8", "ignore") if any(gone) else text


def test_stages(spark):
    given = table(spark, SF, "documents")
    docs, left = given, []
    for name, stage in P.STAGES:
        docs = written(stage(spark, docs, SF), f"test-{name}")
        left.append(docs)
    toxic, near, cut, clean, ids = left
    for df in (toxic, near, cut, clean):
        assert df.columns == given.columns
    model = toxicity.train(given, table(spark, SF, "labels"))
    assert dict(rows(toxic)) == {i: t for i, t in rows(given) if model.scores([t])[0] < 0.5}
    groups = brute.near_duplicates(rows(toxic))
    assert dict(rows(near)) == {i: t for i, t in rows(toxic) if groups[i][1] == i}
    seen = brute.Counter(b[s:s + 200] for _, t in rows(near) for b in [(t or "").encode()] for s in range(len(b) - 199))
    assert dict(rows(cut)) == {i: cut_text(t, seen) for i, t in rows(near)}
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    judged = brute.contamination(rows(cut), items)
    assert dict(rows(clean)) == {i: t for i, t in rows(cut) if not judged[i][4]}
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r["doc_id"]: (r["n_tokens"], r["decoded_sha256"]) for r in ids.collect()}
    for i, t in rows(clean):
        own = sp.encode(t or "", add_bos=True, add_eos=True)
        assert got.pop(i) == (len(own), hashlib.sha256(sp.decode(own).encode()).hexdigest())
    assert not got


@pytest.mark.parametrize("texts", [[], [None, "", "x", "x", "a b c d e f " * 60, "a b c d e f " * 60]])
def test_odd_documents(spark, tmp_path, texts):
    kinds = table(spark, SF, "documents").select("doc_id", "text", "lang", "source", "n_chars").schema
    made = [(k, t, None, "s", None if t is None else len(t)) for k, t in enumerate(texts)]
    spark.createDataFrame(made, kinds).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        table(spark, SF, name).limit(0 if name == "labels" else 5).write.parquet(f"{tmp_path}/{name}.parquet")
    got = sorted(r["doc_id"] for r in P.run(spark, str(tmp_path)).collect())
    assert got == ([0, 1, 2, 4] if texts else [])


def test_repeated_rows_and_null_ids(spark):
    """One row of each group stays, whatever the ids; the repeats stage then leaves its text whole."""
    a, b, c, d = (" ".join(f"{w}{k}" for k in range(90)) for w in "abcd")
    made = [(1, a, "x"), (1, a, "x"), (1, a, "w"), (None, b, "x"), (None, b, "x"), (0, d.upper(), "x"), (2, c, "x"), (2, d, "x"),
            (None, d, "x"), (None, None, "x"), (None, None, "x"), (3, " ", "x"), (3, " ", "x")]
    docs = spark.createDataFrame([(i, t, None, s, None if t is None else len(t)) for i, t, s in made],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    near = written(P.drop_near_duplicates(spark, docs, SF), "test-near")
    want = [(1, a, "w"), (None, b, "x"), (0, d.upper(), "x"), (2, c, "x"), *made[-4:]]
    found = lambda df: sorted(map(tuple, df.select("doc_id", "text", "source").collect()), key=repr)
    assert near.columns == docs.columns and found(near) == sorted(want, key=repr)
    assert found(P.cut_repeats(spark, near, SF)) == sorted(want, key=repr)


def test_doubled_input(spark):
    docs = table(spark, SF, "documents")
    once, twice = (rows(written(P.drop_near_duplicates(spark, df, SF), "test-twice")) for df in (docs, docs.union(docs)))
    worded = lambda found: sorted(r for r in found if (r[1] or "").strip())
    assert worded(once) == worded(twice)


def test_clashing_columns_stay(spark):
    """Columns named like the stages' own come through unchanged, of any type."""
    from pyspark.sql import functions as F
    names = ["_toxicity", "_text_key", "_cut", "_scan", "_row_key", "_key_doc_id", "_dedup_key", "_dedup_starts", "row"]
    given = table(spark, SF, "documents").select("*", *(F.concat(F.lit(f"{n} "), "doc_id").alias(n) for n in names))
    docs = given.unionByName(given.filter("doc_id % 10 = 3"))
    for name, stage in P.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), f"clash-{name}")
        assert docs.columns == given.columns
    kept = docs.select("doc_id", *names).collect()
    assert kept and len(kept) == len({r["doc_id"] for r in kept})
    assert all(r[n] == f"{n} {r['doc_id']}" for r in kept for n in names)
