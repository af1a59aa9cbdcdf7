"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding: the symbols of a text are merged best score first. An agenda (heap)
holds the adjacent symbol pairs that form a piece, ordered by score and then by
place; taking the best pair merges its two symbols and puts the new neighbours
on the agenda; pairs whose symbols have changed meanwhile are passed over.
Characters without a piece become byte pieces.

No piece has a word mark after another character, so no merge crosses from one
word into the next mark, and each word (marks before it included) can be merged
alone. A bounded memo in each Python worker holds the words seen last. Every
word that is merged anew is checked against the sentencepiece library in the
Arrow batch in which it appears; ``n_unequal`` counts, per text, the words for
which the library gave other ids (then the library's ids are taken).

Defined results: null and empty texts have no ids but begin and end; repeated
rows give repeated rows; a text without spaces is one word, merged in
O(n log n) steps.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playgrid.llm.common import Memo, held, tidy

MARK = "▁"
MEMO_WORDS = 500_000


class PieceBPE:
    """Encoder and decoder over the vocabulary of a sentencepiece model file."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.pieces: dict[str, tuple[float, int]] = {}
        self.byte_ids: dict[int, int] = {}
        self.byte_of: dict[int, int] = {}
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        self.silent = set()
        self.surface: dict[int, str] = {}
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(p[3:5], 16)] = i
                self.byte_of[i] = int(p[3:5], 16)
            elif sp.is_control(i):
                self.silent.add(i)
            elif sp.is_unknown(i):
                self.surface[i] = " ⁇ "
            else:
                self.pieces[p] = (-sp.get_score(i), i)
                self.surface[i] = p.replace(MARK, " ")
        self.by_word = not any(MARK in p.lstrip(MARK) for p in self.pieces)

    def merge(self, word: str) -> list[int]:
        """Ids of a run of characters by the agenda of adjacent pairs."""
        pieces = self.pieces
        if word in pieces and len(word) == 1:
            return [pieces[word][1]]
        n = len(word)
        sym: list[str | None] = list(word)
        prev, follow = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for i in range(n - 1):
            if hit := pieces.get(word[i:i + 2]):
                agenda.append((hit[0], i, i + 1, word[i:i + 2]))
        heapq.heapify(agenda)
        while agenda:
            _, i, j, joined = heapq.heappop(agenda)
            a, b = sym[i], sym[j]
            if a is None or b is None or follow[i] != j or len(a) + len(b) != len(joined):
                continue
            sym[i], sym[j] = joined, None
            k = follow[i] = follow[j]
            if k < n:
                prev[k] = i
                if hit := pieces.get(x := joined + sym[k]):
                    heapq.heappush(agenda, (hit[0], i, k, x))
            h = prev[i]
            if h >= 0 and (hit := pieces.get(x := sym[h] + joined)):
                heapq.heappush(agenda, (hit[0], h, i, x))
        ids = []
        for s in sym:
            if s is not None:
                if hit := pieces.get(s):
                    ids.append(hit[1])
                elif self.byte_ids:
                    ids.extend(self.byte_ids[b] for b in s.encode())
                else:
                    ids.append(self.unk)
        return ids

    def words(self, text: str) -> list[str]:
        """The parts of a text that are merged alone, marks in place of spaces and one before the text."""
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        return re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", marked) if self.by_word else [marked]

    def encode(self, text: str) -> list[int]:
        return [i for w in self.words(text) for i in self.merge(w)]

    def spell(self, ids) -> str:
        """Text of ids, before the mark that encoding put in front is taken off."""
        out, run = [], bytearray()
        for i in [*ids, None]:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            if i is not None and i not in self.silent:
                out.append(self.surface[i])
        return "".join(out)

    def decode(self, ids) -> str:
        return self.spell(ids).removeprefix(" ")


class _Odd(bytes):
    """Ids of a word that they do not spell; ``spelt`` is what they do."""

    @classmethod
    def of(cls, ids: bytes, spelt: str) -> "_Odd":
        out = cls(ids)
        out.spelt = spelt
        return out


class _Worker:
    """The encoder with its memo, kept for the life of a Python worker."""

    made: dict[str, "_Worker"] = held(__name__)

    def __init__(self, model_file: str):
        self.bpe = PieceBPE(model_file)
        self.fresh: dict[str, bytes] = {}
        self.wrong: dict[str, bytes] = {}
        self.memo = Memo(self.make, MEMO_WORDS)

    @classmethod
    def of(cls, model_file: str) -> "_Worker":
        if model_file not in cls.made:
            cls.made[model_file] = cls(model_file)
        return cls.made[model_file]

    def make(self, word: str) -> bytes:
        """Ids of a mark followed by ``word``; the memo has the spelling only where it is not the word's own."""
        ids = self.bpe.merge(MARK + word)
        entry, spelt = np.array(ids, "<u4").tobytes(), self.bpe.spell(ids)
        if spelt != " " + word.replace(MARK, " "):
            entry = _Odd.of(entry, spelt)
        self.fresh[word] = entry
        return entry

    def checked(self) -> dict[str, bytes]:
        """Checks what was merged since the last call; the words that the library encodes otherwise."""
        words, self_ids = list(self.fresh), list(self.fresh.values())
        self.fresh = {}
        sp, wrong = self.bpe.library, {}
        for w, own, ids in zip(words, self_ids, sp.encode([w.replace(MARK, " ") for w in words], num_threads=1)):
            if w and np.array(ids, "<u4").tobytes() != own:
                wrong[w] = _Odd.of(np.array(ids, "<u4").tobytes(), " " + sp.decode(ids))
        return wrong

    def parts(self, text: str) -> list[str]:
        """The words of a text, each without the first of its marks."""
        if MARK not in text and "  " not in text and text[0] != " " and text[-1] != " " and self.bpe.by_word:
            return text.split(" ")
        return [w[1:] for w in self.bpe.words(text)]

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bytes, int]]:
        """For each text: ids as little-endian 32-bit integers, spelling, words unlike the library's."""
        rows = [self.parts(t) if t else [] for t in texts]
        got = [self.look(r) for r in rows]
        if self.fresh:
            self.wrong |= self.checked()
        out = []
        for r, g in zip(rows, got):
            if bad := sum(map(self.wrong.__contains__, r)) if self.wrong else 0:
                g = [self.wrong.get(w, x) for w, x in zip(r, g)]
            out.append((b"".join(g), self.spelt(r, g).encode(), bad))
        return out

    @staticmethod
    def spelt(words: list[str], ids: list[bytes]) -> str:
        if _Odd not in set(map(type, ids)):
            return " ".join(words).replace(MARK, " ")
        return "".join(x.spelt if type(x) is _Odd else " " + w.replace(MARK, " ") for w, x in zip(words, ids)).removeprefix(" ")

    def look(self, words: list[str]) -> list[bytes]:
        return list(map(self.memo.__getitem__, words))


def encoder(model_file: str, digest: bool = False):
    """Column function text -> struct(n_tokens, ids, decoded, n_unequal), begin and end ids included.

    With ``digest`` the struct has sha256 digests in place of the ids and the decoded text.
    """
    kind = ("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string,n_unequal:bigint>" if digest
            else "struct<n_tokens:bigint,ids:array<int>,decoded:string,n_unequal:bigint>")

    @F.arrow_udf(kind)
    @tidy
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        w = _Worker.of(model_file)
        begin, end = (np.array([i], "<u4").tobytes() for i in (w.bpe.bos, w.bpe.eos))
        for col in batches:
            counts, a, b, unequal = [], [], [], []
            for at in range(0, len(col), 256):
                for ids, spelt, bad in w.encode(col.slice(at, 256).to_pylist()):
                    ids = begin + ids + end
                    counts.append(len(ids) // 4)
                    unequal.append(bad)
                    if digest:
                        a.append(hashlib.sha256(ids).hexdigest())
                        b.append(hashlib.sha256(spelt).hexdigest())
                    else:
                        a.append(np.frombuffer(ids, "<u4").astype(np.int32))
                        b.append(spelt.decode())
            n = pa.array(counts, pa.int64()), pa.array(unequal, pa.int64())
            if digest:
                yield pa.StructArray.from_arrays([n[0], pa.array(a, pa.string()), pa.array(b, pa.string()), n[1]],
                                                 ["n_tokens", "ids_sha256", "decoded_sha256", "n_unequal"])
            else:
                yield pa.StructArray.from_arrays(
                    [n[0], pa.array(a, pa.list_(pa.int32())), pa.array(b, pa.string()), n[1]],
                    ["n_tokens", "ids", "decoded", "n_unequal"])

    return encode


def encode_column(text: Column, model_file: str, digest: bool = False) -> Column:
    return encoder(model_file, digest)(text)


def decoder(model_file: str):
    """Column function ids (array<int>) -> text; null ids: null."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = _Worker.of(model_file).bpe
        for col in batches:
            yield pa.array([None if x is None else bpe.decode(x) for x in col.to_pylist()], pa.string())

    return decode


def encode_documents(docs: DataFrame, model_file: str, digest: bool = True) -> DataFrame:
    """doc_id and the fields of the encoder's struct for every row of ``docs``."""
    return docs.select("doc_id", encode_column(F.col("text"), model_file, digest).alias("e")).select("doc_id", "e.*")
