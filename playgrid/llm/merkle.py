"""Merkle manifest of a table: a tree of digests per group of rows and one over the groups' roots.

Leaves are numbered within their group by one range shuffle. Time-forward
processing then works the tree in the order of its node labels (the last leaf
below a node, then its level): a node's digest is a message to its parent, a
priority queue holds the messages, and a node is made once all messages with its
label are at the queue's head. A task takes aligned subtrees of
``fan ** LEVELS`` leaves in label order; a message to a node above such a
subtree goes through a written table, which Spark's external shuffle sorts by
label for the task of the next round, so no task or queue holds more than a
subtree, whatever a group's size. Rounds end when every group has one node.

A reversed sweep, in falling label order, hands every node the rest of its proof
(the siblings on the levels above it, up to the root); a node sends each child
that child's siblings followed by its own rest. Leaves get their whole proof.

Defined results: null fields have a form of their own (``-``); null group keys
are a group, the first; equal keys are ordered by digest; repeated rows are
leaves each; a group of one leaf has that leaf as its root; an empty table has
no rows; texts of any length are hashed by Spark where they lie, only digests
are shuffled; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from playgrid.llm.common import written

FAN = 16
LEVELS = 3
WIDTH = 64  # characters of a digest


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(size: int, fan: int = FAN) -> int:
    """Levels above ``size`` nodes until one is left."""
    h = 0
    while size > 1:
        size, h = -(-size // fan), h + 1
    return h


def up(leaves: list[str], levels: int, fan: int = FAN) -> dict[tuple[int, int], str]:
    """Digests of all nodes (level, number) of a subtree with these leaves, ``levels`` high."""
    nodes, queue, n = {}, [], len(leaves)

    def made(level: int, number: int, value: str) -> None:
        nodes[level, number] = value
        if level < levels:
            to = number // fan
            last = min((to + 1) * fan ** (level + 1), n) - 1
            heapq.heappush(queue, (last, level + 1, to, number, value))

    for i, leaf in enumerate(leaves):
        made(0, i, leaf)
        while queue and queue[0][0] <= i:
            label, run = queue[0][:3], []
            while queue and queue[0][:3] == label:
                run.append(heapq.heappop(queue)[4])
            made(*label[1:], digest("".join(run)))
    return nodes


def down(nodes: dict[tuple[int, int], str], levels: int, n: int, rest: str, fan: int = FAN) -> Iterator[tuple[int, str]]:
    """(leaf number, its proof) for each leaf of a subtree whose top has the proof ``rest``, last leaf first."""
    queue = [(0, -levels, 0, rest)]
    while queue:
        _, level, number, rest = heapq.heappop(queue)
        if not level:
            yield number, rest
            continue
        below = -level - 1
        children = range(number * fan, min((number + 1) * fan, -(-n // fan ** below)))
        digests = [nodes[below, c] for c in children]
        for k, c in enumerate(children):
            last = min((c + 1) * fan ** below, n) - 1
            heapq.heappush(queue, (-last, -below, c, "".join(digests[:k] + digests[k + 1:]) + rest))


def fold(value: str, number: int, size: int, proof: str, fan: int = FAN) -> tuple[str, str]:
    """The root that a leaf's digest and proof give in a tree of ``size`` leaves, and what of the proof is left."""
    while size > 1:
        first = number - number % fan
        siblings, at = min(fan, size - first) - 1, number - first
        run, proof = proof[:siblings * WIDTH], proof[siblings * WIDTH:]
        value = digest(run[:at * WIDTH] + value + run[at * WIDTH:])
        number, size = number // fan, -(-size // fan)
    return value, proof


def field(c: Column) -> Column:
    """A value as text with its length in front; null: ``-``."""
    s = c.cast("string")
    return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_digest(*fields: Column) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows`` with ``idx``, their number within the group in this order, and ``size``, the group's rows.

    Rows must come of a table: they are range-partitioned by group, order and place, written, and counted per
    partition and group; ``idx`` is the rows of the group in earlier partitions plus the place in this one.
    """
    by = [group, *order, "_place"]
    place = F.monotonically_increasing_id()
    ranged = rows.withColumn("_place", place).repartitionByRange(*by).sortWithinPartitions(*by).drop("_place")
    ranged = written(ranged.withColumn("_at", place).withColumn("_part", F.shiftrightunsigned("_at", 33)), "merkle-ordered")
    counts = ranged.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_in")).agg(
        F.min("_at").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy("_group")
    counts = counts.withColumn("_base", F.sum("_n").over(whole.orderBy("_in")) - F.col("_n")).withColumn(
        "size", F.sum("_n").over(whole)).drop("_n")
    joined = ranged.join(counts, ranged[group].eqNullSafe(counts["_group"]) & (ranged["_part"] == counts["_in"]))
    return joined.withColumn("idx", F.col("_base") + F.col("_at") - F.col("_first")).drop(
        "_at", "_part", "_group", "_in", "_first", "_base")


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict | None, list[dict]]]:
    """(message to the top if there is one, leaves) of each subtree, from rows sorted by subtree and number."""
    now, message, leaves = None, None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = row["grp"], row["chunk"]
            if key != now:
                if leaves:
                    yield message, leaves
                now, message, leaves = key, None, []
            if row["idx"] < 0:
                message = row
            else:
                leaves.append(row)
    if leaves:
        yield message, leaves


@dataclass
class Trees:
    """One tree per group: ``nodes[0]`` are the leaves, ``nodes[k]`` what k rounds left of each group."""

    nodes: list[DataFrame]
    fan: int
    levels: int

    @classmethod
    def grow(cls, leaves: DataFrame, fan: int = FAN, levels: int = LEVELS) -> "Trees":
        """``leaves``: a table with grp (nullable string), idx, size, digest, perhaps more."""
        out = cls([leaves], fan, levels)
        while len(out.nodes) == 1 or (out.nodes[-1].agg(F.max("size")).first()[0] or 0) > 1:
            out.nodes.append(written(out._round(), f"merkle-round{len(out.nodes)}"))
        return out

    def _chunked(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("chunk", F.expr(f"idx div {self.fan ** self.levels}"))

    @staticmethod
    def _dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition("grp", "chunk").sortWithinPartitions("grp", "chunk", "idx")

    def _round(self) -> DataFrame:
        fan, most = self.fan, self.levels

        def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = []
            for _, leaves in _subtrees(batches):
                size = leaves[0]["size"]
                levels = min(most, height(size, fan))
                top = up([x["digest"] for x in leaves], levels, fan)[levels, 0]
                rows.append({"grp": leaves[0]["grp"], "idx": leaves[0]["chunk"], "size": -(-size // fan ** levels),
                             "digest": top})
                if len(rows) == 1024:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema)

        schema = pa.schema([("grp", pa.string()), ("idx", pa.int64()), ("size", pa.int64()), ("digest", pa.string())])
        last = self.nodes[-1]
        given = (last if len(self.nodes) == 1 else last.filter("size > 1")).select("grp", "idx", "size", "digest")
        return self._dealt(self._chunked(given)).mapInArrow(sweep, "grp string, idx bigint, size bigint, digest string")

    def roots(self) -> DataFrame:
        """grp and digest of each group's root."""
        out = None
        for nodes in self.nodes[1:]:
            top = nodes.filter("size = 1").select("grp", "digest")
            out = top if out is None else out.unionByName(top)
        return out

    def proofs(self, tops: DataFrame, finish: Callable[[dict, str, dict], dict], kind: str) -> DataFrame:
        """Every leaf with its proof, after ``tops``: grp, rest (the proof of the group's root), top (a struct kept).

        ``finish(leaf row, proof, top) -> dict`` makes the result rows, of the schema ``kind``.
        """
        top_kind = tops.schema["top"].dataType.simpleString()
        passed = f"grp string, idx bigint, rest string, top {top_kind}"
        messages = None
        for k in range(len(self.nodes) - 1, 0, -1):  # to the tops of the subtrees whose leaves are nodes[k - 1]
            ends = self.nodes[k].filter("size = 1").select(F.col("grp").alias("_grp"), "idx")
            ended = ends.join(tops, ends["_grp"].eqNullSafe(tops["grp"])).select("grp", "idx", "rest", "top")
            messages = ended if messages is None else ended.unionByName(messages)
            leaves = self.nodes[k - 1] if k == 1 else self.nodes[k - 1].filter("size > 1")
            if k == 1:
                return self._handed(leaves, messages, finish, kind)
            messages = written(self._handed(leaves, messages, self._passed, passed), f"merkle-rest{k}")

    @staticmethod
    def _passed(row: dict, rest: str, top: dict) -> dict:
        return {"grp": row["grp"], "idx": row["idx"], "rest": rest, "top": top}

    def _handed(self, leaves: DataFrame, messages: DataFrame, finish: Callable, kind: str) -> DataFrame:
        fan, most = self.fan, self.levels

        def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = []
            for message, below in _subtrees(batches):
                levels = min(most, height(below[0]["size"], fan))
                nodes = up([x["digest"] for x in below], levels, fan)
                for i, rest in down(nodes, levels, len(below), message["rest"], fan):
                    rows.append(finish(below[i], rest, message["top"]))
                    if len(rows) == 1024:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
            yield pa.RecordBatch.from_pylist(rows, schema)

        schema = to_arrow_schema(StructType.fromDDL(kind))
        told = messages.select("grp", F.col("idx").alias("chunk"), F.lit(-1).cast("bigint").alias("idx"), "rest", "top")
        both = self._chunked(leaves).unionByName(told, allowMissingColumns=True)
        return self._dealt(both).mapInArrow(sweep, kind)


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_A_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def verify_documents(docs: DataFrame, proofs: bool = False, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """The manifest of ``docs`` and a check of every proof, some against tampered rows.

    doc_id, leaf, subroot, root, proof_sha256 (with ``proofs`` also the proof itself), folded_root and verified.
    Where 5 divides the CRC-32 of the decimal doc_id, the text's A-Z are lower-cased for folded_root (a null
    doc_id is not tampered with).
    """
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    other = [F.translate(c, _A_Z, _A_Z.lower()) if c == "text" else F.col(c) for c in FIELDS]
    leaves = written(docs.select(
        "doc_id", F.col("source").alias("grp"), leaf_digest(*map(F.col, FIELDS)).alias("digest"),
        F.when(tampered, leaf_digest(*other)).alias("tampered")), "merkle-leaves")
    leaves = written(numbered(leaves, "grp", "doc_id", "digest"), "merkle-numbered")
    trees = Trees.grow(leaves, fan, levels)
    subroots = written(trees.roots().withColumn("all", F.lit("")), "merkle-subroots")
    over = written(numbered(subroots, "all", "grp").withColumnsRenamed({"grp": "source", "all": "grp"}), "merkle-tops")
    top = Trees.grow(over, fan, levels)
    root = top.roots().select("grp", F.lit("").alias("rest"), F.struct(F.col("digest").alias("root")).alias("top"))

    def at_source(row: dict, rest: str, above: dict) -> dict:
        return {"grp": row["source"], "rest": rest, "top": {
            "subroot": row["digest"], "root": above["root"], "number": row["idx"], "sources": row["size"]}}

    def at_leaf(row: dict, proof: str, above: dict) -> dict:
        value, rest = fold(row["tampered"] or row["digest"], row["idx"], row["size"], proof, fan)
        value, _ = fold(value, above["number"], above["sources"], rest, fan)
        out = {"doc_id": row["doc_id"], "leaf": row["digest"], "subroot": above["subroot"], "root": above["root"],
               "proof_sha256": digest(proof), "folded_root": value, "verified": value == above["root"]}
        return out | {"proof": proof} if proofs else out

    tops = written(top.proofs(root, at_source, "grp string, rest string, top struct<subroot:string,root:string,"
                                               "number:bigint,sources:bigint>"), "merkle-sources")
    return trees.proofs(tops, at_leaf, "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, "
                        "folded_root string, verified boolean" + (", proof string" if proofs else ""))
