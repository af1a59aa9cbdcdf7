"""Pieces of text that a byte-level BPE tokenizer (GPT-2's split pattern) encodes independently.

The split pattern never lets a token run from a non-space character into a
following space, so a text can be cut before each space that follows a
non-space character; the parts ("words") are encoded alone and memoised.
Strings of special tokens are cut out first, as the library does by default.
"""

from __future__ import annotations

import json
import re

import regex

_CUT = re.compile(r"(?<=\S) ")
MEMO_WORDS = 400_000

#: The printable characters that stand for the 256 bytes in byte-level vocabularies.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_letters() -> list[str]:
    rest = iter(range(256, 512))
    return [chr(b) if b in _PRINTABLE else chr(next(rest)) for b in range(256)]


class UncutSpace(Exception):
    """White space beside a space: the text must be cut by ``words`` instead of at every space."""


class Splitter:
    """Cuts texts into words and words into pre-tokens."""

    def __init__(self, tokenizer_json: str):
        import public_tokenizers

        with open(tokenizer_json, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) or r"(?!)")
        self.vocab, self.merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.pretokens = regex.compile(public_tokenizers.PATTERN).findall

    def segments(self, text: str) -> list[tuple[str, int | None]]:
        """Stretches without special tokens, each with the id of the special token after it."""
        if not any(s in text for s in self.specials):
            return [(text, None)]
        out, at = [], 0
        for m in self.special.finditer(text):
            out.append((text[at:m.start()], self.specials[m[0]]))
            at = m.end()
        return [*out, (text[at:], None)]

    @staticmethod
    def words(segment: str) -> list[str]:
        """Words, without the space before each but the first."""
        return _CUT.split(segment)

    def pieces(self, word: str) -> list[str]:
        """Pre-tokens of a space and a word that came of a cut at every space; UncutSpace if the cut was none."""
        if word.isalpha():
            return [" " + word]
        if not word or word[0].isspace() or word[-1].isspace():
            raise UncutSpace
        if word[:-1].isalpha() and word[-1] in ".,;:!?":
            return [" " + word[:-1], word[-1]]
        return self.pretokens(" " + word)
