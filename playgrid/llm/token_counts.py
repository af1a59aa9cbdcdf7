"""Exact BPE token counts at every prefix of a text, by dynamic programming over prefixes.

For a byte-level BPE vocabulary the encoding of a prefix is the encoding of a
shorter prefix plus one token: the token t that ends the prefix and follows the
last token u of the shorter prefix such that u and t stay apart when their
bytes are encoded together. One such t exists for every prefix, so

    last[i] = the t with  stays_apart(last[i - len(t)], t)
    count[i] = count[i - len(t)] + 1

gives the count at every prefix of a pre-token in one pass, and the counts at
every prefix of a text follow by adding up the words before it. Truncation
("the longest prefix within a budget") and budget questions ("tokens of the
first k characters") are answered from the stored counts, without encoding
again.

Defined results: null and empty texts have 0 tokens and 0 bytes; the string of
a special token counts as that one token; repeated rows give repeated rows; a
very long text is handled word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playgrid.llm.byte_bpe import MEMO_WORDS, Splitter, UncutSpace, byte_letters
from playgrid.llm.common import Memo


class PrefixCounter:
    """Counts at all prefixes for one tokenizer file."""

    made: dict[str, "PrefixCounter"] = {}

    def __init__(self, tokenizer_json: str):
        self.split = Splitter(tokenizer_json)
        byte = {c: b for b, c in enumerate(byte_letters())}
        raw = lambda s: bytes(byte[c] for c in s)
        self.rank = {raw(a) + raw(b): i for i, (a, b) in enumerate(
            m.split(" ") if isinstance(m, str) else m for m in self.split.merges)}
        self.pairs = {(raw(a), raw(b)) for a, b in (
            m.split(" ") if isinstance(m, str) else m for m in self.split.merges)}
        tokens = [raw(t) for t in self.split.vocab if t not in self.split.specials]
        self.tokens = {t for t in tokens if len(t) == 1 or t in self.rank}
        self.longest = max(map(len, self.tokens))
        self.apart = Memo(lambda ut: self.bpe(ut[0] + ut[1]) == [*ut], 500_000)
        self.pretoken = Memo(self.run, MEMO_WORDS)
        self.word = Memo(lambda w: sum(self.pretoken[p][-1] for p in self.split.pieces(w)), MEMO_WORDS)

    @classmethod
    def of(cls, tokenizer_json: str) -> "PrefixCounter":
        if tokenizer_json not in cls.made:
            cls.made[tokenizer_json] = cls(tokenizer_json)
        return cls.made[tokenizer_json]

    def bpe(self, piece: bytes) -> list[bytes]:
        """Merges in the order of their ranks (for pairs of tokens, which are short)."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        rank = self.rank
        while len(parts) > 1:
            best = min(((rank[j], i) for i in range(len(parts) - 1)
                        if (j := parts[i] + parts[i + 1]) in rank and (parts[i], parts[i + 1]) in self.pairs),
                       default=None)
            if best is None:
                break
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def run(self, pretoken: str) -> list[int]:
        """Counts at each byte prefix of a pre-token, from 1 byte on; [0] for an empty one."""
        b = pretoken.encode()
        last: list[bytes] = [b""]
        count = [0]
        tokens, apart, longest = self.tokens, self.apart, self.longest
        for i in range(1, len(b) + 1):
            for j in range(max(0, i - longest), i):
                t = b[j:i]
                if t in tokens and (not j or apart[last[j], t]):
                    last.append(t)
                    count.append(count[j] + 1)
                    break
        return count[1:] or [0]

    def total(self, fragment: str) -> int:
        """Tokens of a stretch without special tokens that is encoded from its start."""
        return sum(self.pretoken[p][-1] for p in self.split.pretokens(fragment))

    def boundaries(self, text: str) -> tuple[list[str], list[int]]:
        """The words of a text (spaces and special tokens included) and the counts up to each word's end."""
        words: list[str] = []
        counts: list[int] = []
        names = {i: s for s, i in self.split.specials.items()}
        for segment, special in self.split.segments(text):
            first, *rest = segment.split(" ")
            try:
                more = list(map(self.word.__getitem__, rest))
            except UncutSpace:
                first, *rest = self.split.words(segment)
                more = [self.total(" " + w) for w in rest]
            if first:
                words.append(first)
                counts.append(self.total(first))
            words += map(" ".__add__, rest)
            counts += more
            if special is not None:
                words.append(names[special])
                counts.append(1)
        return words, list(accumulate(counts))

    def prefix_counts(self, text: str) -> list[int]:
        """Tokens of text[:k] for k = 0 .. len(text)."""
        words, ends = self.boundaries(text)
        out, base = [0], 0
        for w, end in zip(words, ends):
            out += [base + self._inside(w, k) for k in range(1, len(w))]
            out.append(end)
            base = end
        return out

    def _inside(self, word: str, k: int) -> int:
        """Tokens of a word's first k characters."""
        pre = self.split.pretokens(word[:k])
        return sum(self.pretoken[p][-1] for p in pre[:-1]) + self.run(pre[-1])[-1]

    def fit(self, words: list[str], ends: list[int], budget: int) -> int:
        """Characters of the longest prefix with at most ``budget`` tokens (strings of special tokens are not cut)."""
        n = int(np.searchsorted(ends, budget, "right"))
        whole = sum(map(len, words[:n]))
        if n == len(words) or words[n] in self.split.specials:
            return whole
        return whole + self._fit_inside(words[n], budget - (ends[n - 1] if n else 0))

    def _fit_inside(self, word: str, budget: int) -> int:
        """Characters of a word's longest prefix with at most ``budget`` tokens, fewer than the word has.

        Read from the counts stored at every prefix of the pre-token that crosses the budget. Where a prefix ends, white
        space and apostrophes may be split otherwise than in the word, so the places around are counted as they stand.
        """
        starts, base, held = [0], [0], []
        for p in self.split.pretokens(word):
            held = self.pretoken[p]
            starts.append(starts[-1] + len(p))
            base.append(base[-1] + held[-1])
            if base[-1] > budget:
                break
        start, stop = starts[-2:]
        chars = np.cumsum([len(c.encode()) for c in word[start:stop]])
        fits = np.flatnonzero(base[-2] + np.array(held)[chars - 1] <= budget)
        best = start + (int(fits[-1]) + 1 if len(fits) else 0)
        before = max(0, len(starts) - 4)  # two pre-tokens earlier, from where on a prefix is split anew
        near, used = starts[before], base[before]
        count = lambda k: used + sum(self.pretoken[p][-1] for p in self.split.pretokens(word[near:k]))
        for k in [*range(min(len(word), stop + 2), stop - 1, -1), *range(best, near, -1)]:
            if count(k) <= budget:
                return k
        return near


def counter(tokenizer_json: str, budget: int, store_prefixes: bool = False):
    """Column function text -> struct(n_bytes, n_tokens, over_limit, fit_chars[, prefix_counts]).

    ``over_limit``: more than ``budget`` tokens; ``fit_chars``: characters of the
    longest prefix within the budget, also inside a word; ``prefix_counts``: tokens
    of the first k characters, for every k.
    """
    names = ["n_bytes", "n_tokens", "over_limit", "fit_chars"] + ["prefix_counts"] * store_prefixes
    kinds = ["bigint", "bigint", "boolean", "bigint"] + ["array<int>"] * store_prefixes
    arrow = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.list_(pa.int32())]

    @F.arrow_udf("struct<" + ",".join(f"{n}:{k}" for n, k in zip(names, kinds)) + ">")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = PrefixCounter.of(tokenizer_json)
        for col in batches:
            rows = []
            for at in range(0, len(col), 256):
                for text in col.slice(at, 256).to_pylist():
                    words, ends = c.boundaries(text) if text else ([], [])
                    total = ends[-1] if ends else 0
                    n_bytes = len(text.encode()) if text else 0
                    fit = c.fit(words, ends, budget) if total > budget else len(text or "")
                    rows.append((n_bytes, total, total > budget, fit)
                                + ((c.prefix_counts(text or ""),) if store_prefixes else ()))
            yield pa.StructArray.from_arrays(
                [pa.array([r[k] for r in rows], arrow[k]) for k in range(len(names))], names)

    return count


def count_column(text: Column, tokenizer_json: str, budget: int = 512, store_prefixes: bool = False) -> Column:
    return counter(tokenizer_json, budget, store_prefixes)(text)


def tokens_of_prefix(prefix_counts: Column, chars: Column | int) -> Column:
    """Tokens of the first ``chars`` characters, read from stored counts."""
    return F.get(prefix_counts, F.least(F.lit(chars) if isinstance(chars, int) else chars, F.size(prefix_counts) - 1))


def longest_prefix(prefix_counts: Column, budget: int) -> Column:
    """Characters of the longest prefix with at most ``budget`` tokens, read from stored counts."""
    return F.aggregate(F.transform(prefix_counts, lambda c, k: F.when(c <= budget, k).otherwise(0)), F.lit(0),
                       lambda a, b: F.greatest(a, b))


def count_documents(docs: DataFrame, tokenizer_json: str, budget: int = 512, store_prefixes: bool = False) -> DataFrame:
    """doc_id and the counter's fields for every row of ``docs``."""
    return docs.select("doc_id", count_column(F.col("text"), tokenizer_json, budget, store_prefixes).alias("c")
                       ).select("doc_id", "c.*")
