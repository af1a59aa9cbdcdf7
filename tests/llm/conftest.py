import pytest


@pytest.fixture()
def texts():
    """Texts with the awkward cases: null, empty, repeats, odd white space, other scripts, one long word."""
    return [None, "", " ", "  ", "a", "a", " a", "a ", "  two  spaces ", "tab\tand\nnew\n\n line \n x", "it's we'll 'tis",
            "naïve café œuvre", "日本語 テキスト", "emoji 🙂🙃 ok", "<s> </s> <unk> <0x41>", "▁mark ▁▁ inside▁",
            "x<|endoftext|>y <|endoftext|>", "1234567 89 ½ Ⅳ ²", "a b c\u0085d\x1ce\x00f", "ﬁ Ａ é é",
            "the " * 300, "z" * 500 + " " + "ab" * 300, "…—–!!!???\r\n\r\n", "Hello world. " * 50]


@pytest.fixture()
def documents(spark, texts):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)],
                                 "doc_id long, text string, n_tokens string, ids string")
