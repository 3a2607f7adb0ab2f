"""Shards by a hierarchical weighted hash tree of regions, racks and shards."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetable.session import cut_lineage


@dataclass(frozen=True)
class Shard:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def topology(n_shards: int, per_rack: int = 5, racks_per_region: int = 2) -> list[Shard]:
    """Equal shards filling racks and regions in order; a shard beyond full regions opens a new one."""
    return [Shard(s // (per_rack * racks_per_region), s // per_rack, s) for s in range(n_shards)]


def _children(tree: Sequence[Shard]) -> list[tuple[int, dict[int | None, dict[int, float]]]]:
    """By level: the children of every node with their weights, the sum of the shards below."""
    steps = (("region", None), ("rack", "region"), ("shard", "rack"))
    levels = []
    for level, (name, above) in enumerate(steps):
        nodes: dict[int | None, dict[int, float]] = {}
        for s in tree:
            own = nodes.setdefault(getattr(s, above) if above else None, {})
            own[getattr(s, name)] = own.get(getattr(s, name), 0.0) + s.weight
        levels.append((level, nodes))
    return levels


def _winner(keys: Sequence[Column], level: int, children: Column) -> Column:
    """The child with the smallest exponential draw, its weight being the rate: each wins by its weight."""

    def draw(child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(*keys, F.lit(level), child["id"]), 11)
        return F.struct((-F.log((bits + 0.5) / F.lit(float(1 << 53))) / child["w"]).alias("draw"), child["id"].alias("id"))

    return F.array_min(F.transform(children, draw))["id"]


def shard_of(keys: Sequence[Column], tree: Sequence[Shard]) -> Column:
    """The shard of a row, found by descending from region to rack to shard.

    At each level every child draws by (key, level, child) and its weight; the smallest draw wins. A
    child's draw depends on nothing but itself, so a changed weight moves rows only between that child
    and its siblings, and inside subtrees without a change nothing moves. Shards of weight 0 get nothing.
    """
    tree = [s for s in tree if s.weight > 0]
    if not tree:
        raise ValueError("no shard with a weight")
    if len({s.shard for s in tree}) != len(tree) or len({(s.rack, s.region) for s in tree}) != len({s.rack for s in tree}):
        raise ValueError("a shard or rack is named twice")
    at: Column | None = None
    for level, nodes in _children(tree):
        lists = {n: F.array(*(F.struct(F.lit(c).alias("id"), F.lit(w).alias("w")) for c, w in sorted(own.items()))) for n, own in nodes.items()}
        pick = lists[None] if at is None else F.element_at(F.create_map(*(x for n, a in sorted(lists.items()) for x in (F.lit(n), a))), at)
        at = _winner(keys, level, pick)
    return at


def number(rows: DataFrame, by: str, to: str) -> DataFrame:
    """``rows`` with ``to``: 0, 1, 2 ... within each ``by``, which is never null; any group size.

    Rows are stored first, so the splits of the stored files are the same whenever a task runs again. They
    are numbered within (group, split), a bounded number of rows, and moved by the rows of earlier splits; both
    steps need the same partitioning, so rows are shuffled once.
    """
    stored = cut_lineage(rows.drop(to))
    seen = stored.withColumns({"_split": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    local = F.row_number().over(Window.partitionBy(by, "_split").orderBy("_at")).cast("long") - 1
    counts = stored.select(F.col(by), F.spark_partition_id().alias("_split")).groupBy(by, "_split").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(by).orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    moved = counts.select(by, "_split", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    joined = seen.withColumn(to, local).join(moved, [by, "_split"])
    return joined.select(*stored.columns, (F.col(to) + F.col("_before")).alias(to))


def assign(docs: DataFrame, tree: Sequence[Shard], key: str = "doc_id") -> DataFrame:
    """``docs`` with ``shard`` and ``slot`` (gapless from 0 within the shard).

    The key alone decides; equal keys share a shard, and so do null keys. Columns of these names are
    replaced. Built-in expressions only; rows move once, to be numbered.
    """
    return number(docs.drop("shard", "slot").withColumn("shard", shard_of([F.col(key)], tree)), "shard", "slot")
