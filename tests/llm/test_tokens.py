"""Token operators against the libraries."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from playgrid.llm import sentencepiece_bpe, token_counts, token_store
from playgrid.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
MODEL, JSON = (public_tokenizers.path(x) for x in ("piece_bpe_32k.model", "byte_bpe_50k.json"))


def u4(ids):
    return np.array(ids, "<u4").tobytes()


@pytest.fixture(scope="module")
def all_texts(spark):
    return {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def expected_pieces(text):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids = sp.encode(text or "", add_bos=True, add_eos=True)
    return len(ids), hashlib.sha256(u4(ids)).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest(), 0


def test_sentencepiece_cases(documents, texts):
    got = {r[0]: tuple(r)[1:] for r in sentencepiece_bpe.encode_documents(documents, MODEL).collect()}
    assert got == {i: expected_pieces(t) for i, t in enumerate(texts)}


def test_sentencepiece_every_character():
    bpe = sentencepiece_bpe.PieceBPE(MODEL)
    for at in range(0, 0x20000, 997):
        text = "".join(chr(c) for c in range(at, at + 997) if not 0xD800 <= c < 0xE000)
        ids = bpe.encode(text)
        assert ids == bpe.library.encode(text) and bpe.decode(ids) == bpe.library.decode(ids)


def test_sentencepiece_full_output(spark, documents, texts):
    from pyspark.sql import functions as F
    out = documents.select("text", sentencepiece_bpe.encode_column(F.col("text"), MODEL).alias("e"))
    back = out.select("text", "e.decoded", sentencepiece_bpe.decoder(MODEL)("e.ids").alias("again")).collect()
    assert all(r["decoded"] == r["again"] == (r["text"] or "").replace("▁", " ") for r in back)


def test_op1(spark, all_texts):
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op1_sentencepiece"](spark, SF).collect()}
    assert got == {i: expected_pieces(t) for i, t in all_texts.items()}


def test_counts_cases(documents, texts):
    tok = Tokenizer.from_file(JSON)
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"])
           for r in token_counts.count_documents(documents, JSON, 100).collect()}
    want = {i: (len((t or "").encode()), n := len(tok.encode(t or "", add_special_tokens=False).ids), n > 100)
            for i, t in enumerate(texts)}
    assert got == want


def test_counts_every_prefix(texts):
    tok, c = Tokenizer.from_file(JSON), token_counts.PrefixCounter(JSON)
    for t in filter(None, texts):
        if "<|endoftext|>" in t:
            continue
        t = t[:200]
        n = c.prefix_counts(t)
        assert n == [len(tok.encode(t[:k], add_special_tokens=False).ids) for k in range(len(t) + 1)], t


def test_stored_prefixes_answer_budgets(documents, texts):
    from pyspark.sql import functions as F
    tok = Tokenizer.from_file(JSON)
    out = token_counts.count_documents(documents, JSON, 10, store_prefixes=True).select(
        "doc_id", token_counts.tokens_of_prefix(F.col("prefix_counts"), 7).alias("n7"),
        token_counts.longest_prefix(F.col("prefix_counts"), 10).alias("fit"))
    for r in out.collect():
        t = texts[r["doc_id"]] or ""
        if "<|endoftext|>" in t:
            continue
        count = lambda s: len(tok.encode(s, add_special_tokens=False).ids)
        assert r["n7"] == count(t[:7])
        assert r["fit"] == max(k for k in range(min(len(t), 400) + 1) if count(t[:k]) <= 10) or len(t) > 400


def test_fit_inside_words(spark):
    """The longest prefix within a budget, also of texts without spaces, by counting every prefix."""
    from pyspark.sql import functions as F
    tok = Tokenizer.from_file(JSON)
    texts = ["日本語テキスト" * 9, "a" * 90, "it's we'll I'd", "x  y   z    \n\n  w\t\t v", "'ll''ve'''s 'x", "1234567890" * 4, "!?…—–" * 6,
             "mixed日本12!?'s  end ", "supercalifragilisticexpialidocious", "   x", "ﬁ🙂🙃é" * 5]
    count = lambda s: len(tok.encode(s, add_special_tokens=False).ids)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for budget in (1, 2, 3, 5, 9, 17):
        for r in docs.select("text", token_counts.count_column(F.col("text"), JSON, budget).alias("c")).select("text", "c.*").collect():
            t = r["text"]
            assert r["fit_chars"] == max(k for k in range(len(t) + 1) if count(t[:k]) <= budget), (t, budget)
    long = "語" * 200_000
    r = token_counts.count_documents(spark.createDataFrame([(1, long)], "doc_id long, text string"), JSON, 512).first()
    assert count(long[:r["fit_chars"]]) <= 512 < count(long[:r["fit_chars"] + 1])


def test_split_pattern_white_space():
    """The cut before spaces and the split pattern treat every character as the library does."""
    tok, c = Tokenizer.from_file(JSON), token_counts.PrefixCounter(JSON)
    e = token_store.WordEncoder(JSON)
    for at in range(0, 0x11000, 331):
        text = "".join(f"a{chr(x)} b{chr(x)}" for x in range(at, at + 331) if not 0xD800 <= x < 0xE000)
        want = tok.encode(text, add_special_tokens=False).ids
        assert e.encode(text) == u4(want)
        assert c.boundaries(text)[1][-1:] == ([len(want)] if want else [])


def test_op3(spark, all_texts):
    tok = Tokenizer.from_file(JSON)
    for r in QUERIES["op3_token_counts"](spark, SF).collect():
        n = len(tok.encode(all_texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_tokens"], r["over_limit"], r["n_bytes"]) == (n, n > 512, len(all_texts[r["doc_id"]].encode()))


@pytest.mark.parametrize("planes", [4, 32])
def test_planes_round_trip(planes):
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 1000, 40_000):
        ids = rng.integers(0, 2**32, n, dtype=np.uint32)
        assert np.array_equal(token_store.unpack(token_store.pack(ids, planes, 1 << 12)), ids)


def expected_store(rows):
    tok, at, out = Tokenizer.from_file(JSON), 0, {}
    for i, t in sorted(rows.items()):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        out[i] = (at, len(ids), zlib.crc32(u4(ids)))
        at += len(ids)
    return out


def test_store_cases(documents, texts):
    got = {r["doc_id"]: tuple(r)[1:] for r in token_store.store_and_read(documents, JSON).collect()}
    assert got == expected_store(dict(enumerate(texts)))


def test_store_empty_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_store.store_and_read(empty, JSON).collect() == []
    odd = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b c"), (None, None)], "doc_id long, text string")
    got = sorted(tuple(r)[:3] for r in token_store.store_and_read(odd, JSON).select("start", "n_tokens", "doc_id").collect())
    assert [g[2] for g in got] == [None, None, 1, 1] and got[0][0] == 0


def test_op5(spark, all_texts):
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op5_token_store"](spark, SF).collect()}
    assert got == expected_store(all_texts)
