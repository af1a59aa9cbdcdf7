"""Packing of tokenized documents into sequences of fixed length.

Documents are dealt at random into groups of about ``GROUP_BYTES`` bytes of
text, and each group is packed alone by first-fit decreasing: a tournament tree
over the bins keeps the largest free capacity below every node, so the leftmost
bin that a piece fits into is found by one descent. A document longer than a
sequence first gives whole sequences and is then packed by its remainder.

First-fit leaves gaps, so the emptiest bins are poured into them, cut where a
gap is full: afterwards a group's sequences are all full, and the ids left over
(fewer than a sequence) fill sequences whose lengths are the powers of two that
their number is the sum of. Sequences of a power of two need no padding, so
nothing is padded where the capacity is such a power; with another capacity
only sequences of the left-over lengths are shorter than it, too.

One shuffle by group carries the texts; a group is encoded and packed in one
task, whose memory is that of a group or of the longest document. A group is
drawn from the row's place in its input (not only its id), so repeated rows are
dealt evenly, too; the input must give the same rows in the same order when it
is read again after a loss, as a table does.

Defined results: null and empty texts have the end id alone; repeated rows and
equal or null doc_ids are packed each for themselves; an empty table gives no
pieces; further columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playgrid.llm.library_bpe import ByteBPE

GROUP_BYTES = 4 << 20


class Bins:
    """Bins of equal capacity under a tournament tree of free capacities."""

    def __init__(self, most: int, capacity: int):
        self.leaves = 1 << max(0, most - 1).bit_length()
        self.tree = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """The number of the leftmost bin with room for ``size``, which is taken there."""
        tree, node, leaves = self.tree, 1, self.leaves
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bin_number = node - leaves
        tree[node] -= size
        while node > 1:
            node >>= 1
            left, right = tree[2 * node], tree[2 * node + 1]
            best = left if left >= right else right
            if tree[node] == best:
                break
            tree[node] = best
        return bin_number


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of places in ``sizes``; no size is above the capacity, equal ones keep their order."""
    bins, out = Bins(len(sizes), capacity), []
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        at = bins.place(sizes[k])
        if at == len(out):
            out.append([])
        out[at].append(k)
    return out


def pack_lengths(lengths: list[int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) for documents of these lengths."""
    pieces, rest, number = [], [], 0
    for doc, n in enumerate(lengths):
        whole = n - n % capacity
        for start in range(0, whole, capacity):
            pieces.append((doc, start, capacity, number, 0))
            number += 1
        if n > whole:
            rest.append((doc, whole, n - whole))
    bins = first_fit_decreasing([r[2] for r in rest], capacity)
    fill = [sum(rest[k][2] for k in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda b: -fill[b])
    full, left = divmod(sum(fill), capacity)
    room = []  # what the emptiest bins are poured into: sequence, offset, free ids
    for b in order[:full]:
        at = 0
        for k in bins[b]:
            pieces.append((*rest[k], number, at))
            at += rest[k][2]
        if at < capacity:
            room.append((number, at, capacity - at))
        number += 1
    for bit in reversed(range(left.bit_length())):
        if left >> bit & 1:
            room.append((number, 0, 1 << bit))
            number += 1
    gaps = iter(room)
    sequence, at, free = next(gaps, (0, 0, 0))
    for k in (k for b in order[full:] for k in bins[b]):
        doc, start, n = rest[k]
        while n:
            if not free:
                sequence, at, free = next(gaps)
            take = min(n, free)
            pieces.append((doc, start, take, sequence, at))
            start, n, at, free = start + take, n - take, at + take, free - take
    return pieces


def pack_documents(docs: DataFrame, tokenizer_json: str, capacity: int = 2048, end_id: int = 1,
                   digest: bool = False, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """doc_id, start, length, ids (or ids_crc32), doc_tokens, sequence_id and offset of every piece.

    ``sequence_id`` is the group's number times 2^32 plus the sequence's number in the group.
    """
    rows = docs.select("doc_id", "text")
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1)).first()[0] or 0
    groups = max(1, -(-size // group_bytes))
    last = "ids_crc32" if digest else "ids"

    def pack(group: pa.Table) -> pa.Table:
        encoder, end, ids = ByteBPE.of(tokenizer_json), np.array([end_id], np.uint32), []
        for text in group["text"]:
            ids.append(np.concatenate([encoder.encode(text.as_py() or ""), end]))
        pieces = pack_lengths([len(x) for x in ids], capacity)
        doc, start, length, sequence, offset = (np.array(x, np.int64) for x in (zip(*pieces)))
        cut = [ids[d][s:s + n] for d, s, n, _, _ in pieces]
        content = (pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in cut], pa.int64()) if digest
                   else pa.array([x.astype(np.int32) for x in cut], pa.list_(pa.int32())))
        return pa.table({
            "doc_id": group["doc_id"].take(pa.array(doc)), "start": start, "length": length, last: content,
            "doc_tokens": np.array([len(x) for x in ids], np.int64)[doc],
            "sequence_id": (group["_group"][0].as_py() << 32) + sequence, "offset": offset})

    dealt = rows.withColumn("_group", F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("_group").applyInArrow(
        pack, f"doc_id bigint, start bigint, length bigint, {last} {'bigint' if digest else 'array<int>'}, "
        "doc_tokens bigint, sequence_id bigint, offset bigint")
