"""Merkle manifest of a dataset, with a membership witness for every row, by aligned appends."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetable.plans.skew import same
from kinetable.session import cut_lineage

from .common import ship_by_value, sized_broadcast

ship_by_value(__name__)

LEVELS = 11  # a block holds 2 ** LEVELS leaves: bounds a task's witnesses to 1.5 MB
BROADCAST_WITNESSES = 20_000  # rows of at most some 40 steps: 64 MB
WITNESS = "array<struct<sibling:string,before:boolean>>"


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value; unambiguous when concatenated."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*fields: Column) -> Column:
    """Lowercase hex SHA-256 of the encoded fields, one after the other."""
    return F.sha2(F.concat(*map(encoded, fields)), 256)


class Appender:
    """A tree of aligned subtrees to which leaves are appended in order.

    Only the open subtrees, one for each level at most, are held as ``(level, first leaf, root)``. When a sibling
    completes, its root extends the witnesses of all leaves below the other: the leaves on the left, appended earlier,
    as well as those on the right. ``seen[level, leaf]`` is that sibling, empty where a node is alone in its run.
    """

    def __init__(self, leaves: int, height: int) -> None:
        self.seen = np.zeros((height, leaves), "S64")
        self.open: list[tuple[int, int, bytes]] = []
        self.n = 0

    def _pair(self, level: int, left: tuple[int, bytes], right: tuple[int, bytes]) -> bytes:
        self.seen[level, left[0] : right[0]] = right[1]
        self.seen[level, right[0] : self.n] = left[1]
        return sha256(left[1] + right[1]).hexdigest().encode()

    def append(self, root: bytes) -> None:
        level, first = 0, self.n
        self.n += 1
        while self.open and self.open[-1][0] == level:
            _, start, left = self.open.pop()
            root, first, level = self._pair(level, (start, left), (first, root)), start, level + 1
        self.open.append((level, first, root))

    def close(self, height: int) -> bytes:
        """The root at ``height``: open subtrees are raised, alone where no sibling came, until they meet."""
        level, first, root = self.open.pop()
        while level < height:
            if self.open and self.open[-1][0] == level:
                _, start, left = self.open.pop()
                root, first = self._pair(level, (start, left), (first, root)), start
            else:
                root = sha256(root).hexdigest().encode()
            level += 1
        return root


def _height(leaves: int) -> int:
    return (leaves - 1).bit_length()


def _block(rows: pa.Table, levels: int) -> pa.Table:
    """One block's leaves in order with their witnesses; its root stands on the first."""
    rows = rows.sort_by("index")
    height = min(levels, _height(rows.column("leaves")[0].as_py()))
    tree = Appender(rows.num_rows, height)
    for node in rows.column("node").to_pylist():
        tree.append(node.encode())
    top = tree.close(height).decode()
    flat = tree.seen.T.ravel()
    before = ((np.arange(rows.num_rows)[:, None] >> np.arange(height)[None, :]) & 1).astype(bool).ravel()
    steps = pa.StructArray.from_arrays([pa.array(flat, pa.binary(), mask=flat == b"").cast(pa.string()), pa.array(before)], ["sibling", "before"])
    witness = pa.ListArray.from_arrays(pa.array(np.arange(rows.num_rows + 1, dtype=np.int32) * height), steps)
    root = pa.array([top, *[None] * (rows.num_rows - 1)], pa.string())
    return rows.append_column("block_root", root).append_column("witness", witness)


def witnesses(nodes: DataFrame, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """``nodes`` with ``witness``, and ``(tree, root)``.

    ``nodes`` has ``(tree, index, node, leaves)`` and columns to take along: ``index`` counts a tree's rows from 0, ``leaves`` is
    their number, ``node`` their digest. Aligned blocks of ``2 ** levels`` rows are appended to in separate tasks, so a
    tree may hold any share of all rows. The roots of a tree's blocks are appended in turn, block by block, until one is
    left; each round is stored, and a row's witness is extended by that of its block.
    """
    block = F.shiftright("index", levels)

    def work(rows: pa.Table) -> pa.Table:
        return _block(rows, levels)

    wide = nodes.withColumns({"block_root": F.lit(None).cast("string"), "witness": F.lit(None).cast(WITNESS)}).schema
    done = cut_lineage(nodes.groupBy("tree", block).applyInArrow(work, wide))
    above = F.shiftright(F.col("leaves") + ((1 << levels) - 1), levels).alias("leaves")
    roots = done.where("block_root IS NOT NULL").select("tree", block.alias("index"), F.col("block_root").alias("node"), above)
    finished = roots.where("leaves = 1").select("tree", F.col("node").alias("root"))
    more = cut_lineage(roots.where("leaves > 1"))
    done = done.drop("block_root")
    if more.isEmpty():
        return done, finished
    upper, tops = witnesses(more, levels)
    upper = sized_broadcast(cut_lineage(upper.select("tree", F.col("index").alias("_block"), F.col("witness").alias("_upper"))), BROADCAST_WITNESSES)
    full = same(done.withColumn("_block", block), upper, ["tree", "_block"], "left")
    longer = F.when(F.col("_upper").isNull(), F.col("witness")).otherwise(F.concat("witness", "_upper"))
    return full.withColumn("witness", longer).drop("_block", "_upper"), finished.unionByName(tops)


def numbered(rows: DataFrame, tree: str, order: Sequence[Column]) -> DataFrame:
    """Stored ``rows`` with ``index``, from 0 along ``order`` within ``tree`` (null is one), and ``leaves``, the tree's rows.

    One sort over all partitions; then only one row per tree and partition is combined. Rows equal in the order are
    told apart by their place in the files, so no value fills a partition.
    """
    placed = rows.withColumn("_tie", F.monotonically_increasing_id())
    placed = placed.orderBy(F.col(tree).asc_nulls_first(), *order, "_tie").withColumn("_at", F.monotonically_increasing_id())
    placed = cut_lineage(placed.withColumn("_part", F.shiftright("_at", 33)))
    parts = placed.groupBy(tree, "_part").agg(F.min("_at").alias("_start"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(tree).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(tree, "_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_start")).alias("_move"),
                         F.sum("_n").over(Window.partitionBy(tree)).alias("leaves"))
    out = same(placed, sized_broadcast(cut_lineage(parts)), [tree, "_part"], "inner")
    return cut_lineage(out.withColumn("index", F.col("_at") + F.col("_move")).drop("_tie", "_at", "_part", "_move"))


def folded(leaf: Column, witness: Column) -> Column:
    """The root that a leaf's digest and its witness lead to."""

    def step(node: Column, at: Column) -> Column:
        sibling = F.coalesce(at["sibling"], F.lit(""))
        return F.sha2(F.when(at["before"], F.concat(sibling, node)).otherwise(F.concat(node, sibling)), 256)

    return F.aggregate(witness, leaf, step)


def siblings(witness: Column) -> Column:
    """All siblings of a witness, lowest level first, as one string."""
    return F.array_join(F.transform(witness, lambda at: at["sibling"]), "")


def manifest(docs: DataFrame, fields: Sequence[str], group: str = "lang", key: str = "doc_id", levels: int = LEVELS,
             keep: Mapping[str, Column] | None = None) -> DataFrame:
    """``(group, key, *keep, leaf, witness, subroot, root)``, one row per row of ``docs``.

    A leaf is the digest of the encoded ``fields``. Within a ``group`` leaves stand by ascending key (null last), equal keys by
    leaf; pairs become the digest of their digests, a node without partner the digest of its own, until one is
    left, the subroot. Subroots, by group (null first), lead to the root in the same way. The witness holds, level by level
    up to the root, the other node of the pair (null without one) and whether it stands before. Whole texts are read
    once and not shuffled. Null, empty and repeated rows are leaves like any other; no rows give no row. ``keep`` names
    expressions of ``docs`` to take along; other columns play no part.
    """
    keep = dict(keep or {})
    inner = {n: f"_k{i}" for i, n in enumerate(keep)}
    leaves = docs.select(F.col(group).alias("tree"), F.col(key).alias("_key"), digest(*map(F.col, fields)).alias("node"),
                         *[c.alias(inner[n]) for n, c in keep.items()])
    rows = numbered(cut_lineage(leaves), "tree", [F.col("_key").asc_nulls_last(), F.col("node")])
    found, subroots = witnesses(rows, levels)
    tops = cut_lineage(subroots.select(F.lit(0).alias("tree"), F.col("tree").alias("_of"), F.col("root").alias("node")))
    crowns, root = witnesses(numbered(tops, "tree", [F.col("_of").asc_nulls_first()]), levels)
    crowns = crowns.select(F.col("_of").alias("tree"), F.col("node").alias("subroot"), F.col("witness").alias("_crown"))
    full = same(found, sized_broadcast(cut_lineage(crowns), BROADCAST_WITNESSES), ["tree"], "inner")
    full = full.withColumn("root", root.select("root").scalar())
    return full.select(F.col("tree").alias(group), F.col("_key").alias(key), *[F.col(inner[n]).alias(n) for n in keep],
                       F.col("node").alias("leaf"), F.concat("witness", "_crown").alias("witness"), "subroot", "root")
