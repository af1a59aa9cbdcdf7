"""Packing, Merkle manifest and tokenizer alignment against the libraries and brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from playgrid.llm import alignment, library_bpe, merkle, packing
from playgrid.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SPECIAL = "<|endoftext|>"


@pytest.fixture(scope="module")
def rows(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*merkle.FIELDS).collect()]


@pytest.fixture()
def odd(spark, texts):
    """Awkward texts, equal and null ids, repeated rows and columns named like the operators' own."""
    long = " ".join(random.Random(1).choice(["alpha", "Beta", "γάμμα", "42", "x"]) for _ in range(60_000))
    data = [(i, t, "s", "en", 3, 1, 2, "z") for i, t in enumerate([*texts, long])]
    data += [(7, "same Row", None, None, None, 1, 2, "z")] * 3 + [(None, "no id", "s", "en", 5, 1, 2, "z"), (7, None, "", "", 0, 1, 2, "z")]
    return spark.createDataFrame(data, "doc_id long, text string, source string, lang string, n_chars long, "
                                       "idx int, size int, _group string").repartition(3).cache()


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, lang string, n_chars long")


# ------------------------------------------------------------------ encoder
@pytest.mark.parametrize("specials", [True, False])
def test_whole_texts_as_the_library(texts, specials):
    tok = Tokenizer.from_file(JSON)
    tok.encode_special_tokens = not specials
    e = library_bpe.ByteBPE(JSON, specials)
    assert e.fast
    for t in [*filter(None, texts), " " * 600_000, "\n" * 500_000 + "x", "z" * 300_000, SPECIAL * 3 + " a"]:
        assert e.encode(t).tolist() == tok.encode(t, add_special_tokens=False).ids


def test_every_character_as_the_library():
    tok, e = Tokenizer.from_file(JSON), library_bpe.ByteBPE(JSON)
    for at in range(0, 0x30000, 331):
        text = "".join(f"a{chr(x)}b {chr(x)}1 '{chr(x)}\n" for x in range(at, at + 331) if not 0xD800 <= x < 0xE000)
        assert e.encode(text).tolist() == tok.encode(text, add_special_tokens=False).ids


# ------------------------------------------------------------------ packing
def naive_first_fit(sizes, capacity):
    bins, free = [], []
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        at = next((i for i, f in enumerate(free) if f >= sizes[k]), None)
        if at is None:
            at = len(free)
            free.append(capacity)
            bins.append([])
        free[at] -= sizes[k]
        bins[at].append(k)
    return bins


def test_tournament_tree_is_first_fit():
    rng = random.Random(3)
    for _ in range(60):
        capacity = rng.choice([1, 7, 64, 2048])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 200))]
        assert packing.first_fit_decreasing(sizes, capacity) == naive_first_fit(sizes, capacity)


def check_packed(lengths, pieces, capacity):
    """Every id once, sequences gapless, within capacity, unpadded at powers of two."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for doc, start, n, sequence, offset in pieces:
        assert n > 0
        by_doc[doc].append((start, n))
        by_sequence[sequence].append((offset, n))
    for doc, n in enumerate(lengths):
        at = 0
        for start, k in sorted(by_doc[doc]):
            assert start == at
            at += k
        assert at == n
    fills = []
    for parts in by_sequence.values():
        at = 0
        for offset, k in sorted(parts):
            assert offset == at
            at += k
        assert at <= capacity
        fills.append(at)
    return fills


def test_pack_lengths():
    rng = random.Random(5)
    for _ in range(60):
        capacity = rng.choice([4, 64, 2048])
        lengths = [rng.choice([1, 2, capacity, capacity + 1, rng.randint(1, 5 * capacity)]) for _ in range(rng.randint(1, 120))]
        fills = check_packed(lengths, packing.pack_lengths(lengths, capacity), capacity)
        short = [f for f in fills if f < capacity]
        assert all(f & (f - 1) == 0 for f in short) and len(short) == len(set(short)) <= capacity.bit_length()


def expected_ids(text):
    return [*Tokenizer.from_file(JSON).encode(text or "", add_special_tokens=False).ids, 1]


def test_packed_ids_are_the_texts(odd):
    got = packing.pack_documents(odd, JSON, 64, group_bytes=100_000).collect()
    ids = {}
    for r in got:
        assert len(r["ids"]) == r["length"]
        ids.setdefault((r["sequence_id"], r["offset"]), r["ids"])
    want = Counter()
    for r in odd.collect():
        x = expected_ids(r["text"])
        want += Counter({(r["doc_id"], len(x), i, v): 1 for i, v in enumerate(x)})
    have = Counter((r["doc_id"], r["doc_tokens"], r["start"] + k, v) for r in got for k, v in enumerate(r["ids"]))
    assert have == want
    assert len(ids) == len(got)


def test_op11(spark, rows):
    got = QUERIES["op11_packing"](spark, SF).collect()
    ids = {r[0]: expected_ids(r[4]) for r in rows}
    order = {d: k for k, d in enumerate(ids)}
    fills = check_packed([len(x) for x in ids.values()],
                         [(order[r["doc_id"]], r["start"], r["length"], r["sequence_id"], r["offset"]) for r in got], 2048)
    assert all(f & (f - 1) == 0 for f in fills)
    for r in got:
        cut = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(cut, "<u4").tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
    assert packing.pack_documents(empty(spark), JSON).collect() == []


# ------------------------------------------------------------------- merkle
def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves, fan=16):
    """Root, and the siblings of each leaf level by level."""
    proofs, level, below = [[] for _ in leaves], leaves, [[i] for i in range(len(leaves))]
    while len(level) > 1:
        up, under = [], []
        for at in range(0, len(level), fan):
            run = level[at:at + fan]
            for k in range(len(run)):
                for i in below[at + k]:
                    proofs[i] += [(run[:k], run[k + 1:])]
            up.append(sha(*run))
            under.append([i for x in below[at:at + fan] for i in x])
        level, below = up, under
    return level[0], proofs


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_manifest(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append(r)
    trees = {}
    for source, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[source] = (own, *tree([leaf(r) for r in own]))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    root, above = tree([trees[s][1] for s in sources])
    out = []
    for s, more in zip(sources, above):
        own, subroot, proofs = trees[s]
        for r, proof in zip(own, proofs):
            steps = proof + more
            value = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                value = leaf((*r[:4], lowered(r[4])))
            for left, right in steps:
                value = sha(*left, value, *right)
            out.append((r[0], leaf(r), subroot, root, sha(*(d for x in steps for y in x for d in y)), value, value == root))
    return Counter(out)


def test_op12(spark, rows):
    got = QUERIES["op12_merkle"](spark, SF)
    assert got.columns[:7] == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = brute_manifest(rows)
    assert Counter(map(tuple, got.collect())) == want
    assert {v[6] for v in want} == {True, False}


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_merkle_shapes(spark, levels):
    """Groups of many sizes (one leaf, full and nearly full runs, several rounds), null and odd keys, more sources than a run."""
    rng, data, at = random.Random(levels), [], 0
    for k, n in enumerate([1, 2, 15, 16, 17, 31, 255, 256, 257, 273, 4097, *[3] * 30]):
        source = [None, "", "é", "Z", "a b"][k] if k < 5 else f"s{k}"
        for _ in range(n):
            at += rng.randint(1, 3)
            data.append((at if rng.random() > 0.01 else None, source, rng.choice([None, "en"]), rng.choice([None, -1, 0, 12]),
                         rng.choice([None, "", "Text É", f"Doc {at}"])))
    data += [data[5]] * 40
    docs = spark.createDataFrame(data, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    got = merkle.verify_documents(docs, proofs=True, levels=levels).collect()
    assert Counter(tuple(r)[:7] for r in got) == brute_manifest(data)
    assert all(sha(r["proof"]) == r["proof_sha256"] for r in got)


def test_merkle_odd_rows(spark, odd):
    want = brute_manifest([tuple(r) for r in odd.select(*merkle.FIELDS).collect()])
    assert Counter(map(tuple, merkle.verify_documents(odd).collect())) == want
    assert merkle.verify_documents(empty(spark)).collect() == []


def test_queue_stays_small(monkeypatch):
    """Messages wait only for the runs that are open, not for all leaves."""
    largest, push = [0], merkle.heapq.heappush

    def counted(queue, item):
        push(queue, item)
        largest[0] = max(largest[0], len(queue))

    monkeypatch.setattr(merkle.heapq, "heappush", counted)
    leaves = [sha(str(i)) for i in range(4000)]
    nodes = merkle.up(leaves, 3)
    assert nodes[3, 0] == tree(leaves)[0]
    proofs = dict(merkle.down(nodes, 3, 4000, "rest"))
    assert largest[0] <= 16 * 3 + 1
    assert proofs == {i: "".join(d for x in p for y in x for d in y) + "rest" for i, p in enumerate(tree(leaves)[1])}


# ---------------------------------------------------------------- alignment
def aligned(text, tok, sp, a_bytes):
    """Groups of (A ids, B ids) by walking both token lists."""
    none = []
    if not text:
        return none
    a, b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
    spell = [a_bytes[i] for i in a], [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else
                                      sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if any(b"".join(x) != (" " + text).encode() for x in spell):
        return none
    ends = [list(np.cumsum([len(t) for t in x])) for x in spell]
    both = set(ends[0]) & set(ends[1])
    cut = []
    for ids, e in zip((a, b), ends):
        parts, now = [], []
        for i, end in zip(ids, e):
            now.append(i)
            if end in both:
                parts.append(now)
                now = []
        cut.append(parts)
    return list(zip(*cut))


def brute_alignment(rows):
    tok, sp = Tokenizer.from_file(JSON), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    tok.encode_special_tokens = True
    a_bytes = library_bpe.ByteBPE(JSON).bytes_of
    groups = [(i, aligned(t, tok, sp, a_bytes)) for i, t in rows]
    count = Counter((a[-1], b[-1]) for _, g in groups for a, b in g)
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for i, g in groups:
        links = [(a[-1], b[-1]) for a, b in g]
        spelt = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sha(spelt) if g else "", len(links),
                    sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links)))
    documents = Counter(x for _, g in groups for x in {(a[-1], b[-1]) for a, b in g})
    return Counter(out), {x: (documents[x], n, n == best[x[1]]) for x, n in count.items()}


def test_op13(spark, rows):
    want, _ = brute_alignment([(r[0], r[4]) for r in rows])
    got = QUERIES["op13_alignment"](spark, SF).select("doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum")
    assert Counter(map(tuple, got.collect())) == want


def test_alignment_odd_rows_and_pairs(spark, odd):
    want, pairs = brute_alignment([(r["doc_id"], r["text"]) for r in odd.collect()])
    postings = alignment.Postings(odd, JSON, MODEL, digest=True)
    got = postings.scores().select("doc_id", "n_a", "n_b", "n_groups", "groups", "n_links", "n_best", "count_sum").collect()
    assert Counter(map(tuple, got)) == want
    assert {(r["a_id"], r["b_id"]): (r["documents"], r["links"], r["is_best"]) for r in postings.pairs().collect()} == pairs
    assert alignment.align_documents(empty(spark), JSON, MODEL).collect() == []


def test_alignment_many_blocks(spark, monkeypatch):
    """Blocks closed by their links or documents give the same counts; common pairs are dense bitmaps."""
    rng = random.Random(2)
    words = ["the", "The", "cat", "sat", "naïve", "1,234", "日本", "running"]
    data = [(i, " ".join(rng.choices(words, k=rng.randint(0, 9))) + " the the the") for i in range(1500)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(2)
    want, _ = brute_alignment(data)
    for name, value in ((None, None), ("BLOCK_LINKS", 900)):
        if name:
            monkeypatch.setattr(alignment, name, value)
        got = alignment.align_documents(docs, JSON, MODEL).select(
            "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum")
        assert Counter(map(tuple, got.collect())) == want


def test_planes_give_back_links():
    rng = np.random.default_rng(4)
    pair, doc = rng.integers(0, 40, 60_000) ** 2, rng.integers(0, 8000, 60_000) % rng.integers(1, 8000, 60_000)
    times = Counter()
    for plane, pairs, card, bitmaps in alignment.inverted(pair, doc):
        assert [len(x) == alignment.BLOCK // 8 for x in bitmaps.to_pylist()] == [c >= alignment.BLOCK // 16 for c in card]
        row, member = alignment.members(bitmaps.slice(3))
        first = Counter(zip(pairs[3:][row].tolist(), member.tolist()))
        row, member = alignment.members(bitmaps)
        assert np.array_equal(np.bincount(row, minlength=len(pairs)), card)
        assert all(v == 1 for v in first.values())
        for p, d in zip(pairs[row].tolist(), member.tolist()):
            times[p, d] += 1 if plane < 0 else 1 << plane
    assert times == Counter(zip(pair.tolist(), doc.tolist()))


def test_groups_are_lists():
    a = alignment.Aligner(JSON, MODEL).align(["a cat", None, "▁x", "x"])
    assert [len(g) for g in a.groups()] == a.n_groups.tolist() and a.groups()[1] == a.groups()[2] == []
    assert all(ids for g in a.groups() for pair in g for ids in pair)
