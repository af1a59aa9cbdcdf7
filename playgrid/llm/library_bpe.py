"""Ids of whole texts by a byte-level BPE vocabulary file of the tokenizers library.

The vocabulary is read from the JSON file and encoded with tiktoken, which is
several times faster and gives the same ids where every merge makes the token
of the next rank (checked when the file is read). Where tiktoken cannot encode
a text (its pattern engine gives up on a million white-space characters) or the
file has another form, the tokenizers library itself is used.
"""

from __future__ import annotations

import json

import numpy as np

from playgrid.llm.byte_bpe import byte_letters


class ByteBPE:
    """Encoder of whole texts; ``specials`` says whether strings of special tokens become their ids."""

    made: dict[tuple[str, bool], "ByteBPE"] = {}

    def __init__(self, tokenizer_json: str, specials: bool = True):
        from tokenizers import Tokenizer

        with open(tokenizer_json, encoding="utf-8") as f:
            spec = json.load(f)
        byte = {letter: b for b, letter in enumerate(byte_letters())}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in self.added}
        self.bytes_of = {i: bytes(byte[c] for c in t) for t, i in vocab.items()}
        self.size = max([*self.bytes_of, *self.added.values()]) + 1
        self.specials = specials
        self.library = Tokenizer.from_file(tokenizer_json)
        self.library.encode_special_tokens = not specials
        self.fast = self._tiktoken() if self._ranked(spec, vocab) else None

    @classmethod
    def of(cls, tokenizer_json: str, specials: bool = True) -> "ByteBPE":
        """The encoder, kept for the life of a Python worker."""
        if (tokenizer_json, specials) not in cls.made:
            cls.made[tokenizer_json, specials] = cls(tokenizer_json, specials)
        return cls.made[tokenizer_json, specials]

    @staticmethod
    def _ranked(spec: dict, vocab: dict[str, int]) -> bool:
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        plain = (not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                 and not pre.get("add_prefix_space") and not model.get("ignore_merges")
                 and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]))
        return plain and sorted(vocab.values()) == list(range(256 + len(merges))) and all(
            vocab.get(a + b) == 256 + k for k, (a, b) in enumerate(merges))

    def _tiktoken(self):
        import public_tokenizers
        import tiktoken

        return tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, special_tokens=self.added,
                                 mergeable_ranks={b: i for i, b in self.bytes_of.items()})

    def encode(self, text: str) -> np.ndarray:
        """Ids as unsigned 32-bit integers."""
        if self.fast:
            try:
                if self.specials:
                    return self.fast.encode_to_numpy(text, allowed_special="all")
                return self.fast.encode_to_numpy(text, disallowed_special=())
            except ValueError:  # its pattern engine's stack is full
                pass
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
