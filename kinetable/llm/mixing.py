"""Mixing overlapping sources to target weights by min-cost flow over membership patterns."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetable.session import cut_lineage

from .common import components, ship_by_value

ship_by_value(__name__)

BUCKETS = 12  # bits of a document's hash that name its bucket within a pattern
NO_SOURCE = "\U0010ffff"  # stands for a null source, which sorts after all others


def word_count(text: str = "text") -> Column:
    """Words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, cycle: Sequence[float] = (1.0, 2.0, 3.0)) -> DataFrame:
    """``sources(source, ...)`` with ``weight``: the cycle repeated along the sources by code point, null last.

    Sources are sorted by range partitions and counted per partition, so no task sees them all.
    """
    order = F.coalesce("source", F.lit(NO_SOURCE))
    ranged = sources.repartitionByRange(8, order).withColumn("_part", F.spark_partition_id())
    ranged = cut_lineage(ranged)
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row per part
    moved = counts.select("_part", before.alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    numbered = ranged.withColumn("_at", place).join(F.broadcast(moved), "_part")
    values = F.array(*(F.lit(float(w)) for w in cycle))
    return numbered.withColumn("weight", F.get(values, F.pmod(F.col("_at") + F.col("_before"), F.lit(len(cycle))).cast("int"))).drop("_part", "_at", "_before")


def targets(sources: DataFrame, total: float, repeats: int) -> DataFrame:
    """``sources(source, size, weight)`` with ``target``: ``total`` shared by weight, none above ``repeats`` x size.

    What is cut off is shared again by weight until no target is above its bound; every round is one
    aggregation over the sources, and the level only rises.
    """
    sources = cut_lineage(sources)
    bound = F.col("size") * float(repeats)
    level = 0.0
    while True:
        full = F.col("weight") * level >= bound
        free, used = sources.agg(
            F.sum(F.when(~full, F.col("weight")).otherwise(0.0)), F.sum(F.when(full, bound).otherwise(0.0))
        ).first()
        higher = (total - used) / free if free else level
        if not free or higher <= level * (1 + 1e-12):
            break
        level = higher
    return sources.withColumn("target", F.least(bound, F.col("weight") * level))


def flow(supplies: Sequence[tuple[float, Sequence[int]]], quotas: Sequence[float], repeats: int) -> list[dict[int, float]]:
    """Words that each pattern gives to each of its sources, at the least cost.

    ``supplies``: capacity and sources of each pattern. Taking a pattern's words for the k-th time costs
    k - 1 a word, so repetition is convex and spreads evenly. Successive shortest paths; quotas that the
    patterns can't fill stay short.
    """
    n, m = len(supplies), len(quotas)
    start, end = n + m, n + m + 1
    to: list[int] = []
    room: list[float] = []
    cost: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + m + 2)]

    def arc(a: int, b: int, most: float, price: int) -> None:
        for x, y, r, c in ((a, b, most, price), (b, a, 0.0, -price)):
            out[x].append(len(to))
            to.append(y)
            room.append(r)
            cost.append(c)

    for i, (capacity, own) in enumerate(supplies):
        for k in range(repeats):
            arc(start, i, capacity, k)
        for s in own:
            arc(i, n + s, float("inf"), 0)
    for s, quota in enumerate(quotas):
        arc(n + s, end, quota, 0)
    least = 1e-9 * max([1.0, *quotas])
    while True:
        far = [float("inf")] * len(out)
        via = [-1] * len(out)
        far[start], line, waiting = 0, deque([start]), {start}
        while line:
            a = line.popleft()
            waiting.discard(a)
            for e in out[a]:
                if room[e] > least and far[a] + cost[e] < far[to[e]]:
                    far[to[e]], via[to[e]] = far[a] + cost[e], e
                    if to[e] not in waiting:
                        waiting.add(to[e])
                        line.append(to[e])
        if via[end] < 0:
            break
        path, b = [], end
        while b != start:
            path.append(via[b])
            b = to[via[b] ^ 1]
        most = min(room[e] for e in path)
        for e in path:
            room[e] -= most
            room[e ^ 1] += most
    given: list[dict[int, float]] = [{} for _ in supplies]
    for i in range(n):
        for e in out[i]:
            if n <= to[e] < n + m:
                given[i][to[e] - n] = room[e ^ 1]
    return given


def route(patterns: DataFrame, quotas: DataFrame, repeats: int) -> DataFrame:
    """``(pattern, capacity, source, quantity)``: ``patterns(pattern, sources, capacity)`` and ``quotas(source, target)``
    solved as one flow per group of patterns that share sources. A group holds aggregated patterns, never documents.
    """
    pairs = cut_lineage(patterns.select("pattern", "capacity", F.explode("sources").alias("source")))
    key = F.xxhash64("source")
    first = pairs.groupBy("pattern").agg(F.min(key).alias("first"))
    joined = pairs.join(first, "pattern").select(F.col("first").alias("a"), key.alias("b"))
    groups = components(joined.where("a <> b").distinct())
    known = pairs.join(quotas, "source").withColumn("id", key).join(groups, "id", "left")
    known = known.withColumn("component", F.coalesce("component", "id")).select("component", "pattern", "capacity", "source", "target")

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        names = sorted(set(rows["source"]))
        quota = dict(zip(rows["source"], rows["target"], strict=True))
        own: dict = {}
        for pattern, capacity, source in sorted(zip(rows["pattern"], rows["capacity"], rows["source"], strict=True)):
            own.setdefault(pattern, (float(capacity), []))[1].append(names.index(source))
        given = flow(list(own.values()), [quota[s] for s in names], repeats)
        return pd.DataFrame(
            [(p, int(own[p][0]), names[s], q) for p, g in zip(own, given, strict=True) for s, q in g.items()],
            columns=["pattern", "capacity", "source", "quantity"],
        )

    return known.groupBy("component").applyInPandas(solve, "pattern long, capacity long, source string, quantity double")


def _rank(bits: Column) -> Column:
    """A hash as a number that is not negative, so that its upper bits name a bucket."""
    return F.shiftrightunsigned(bits, 1)


def cuts(sized: DataFrame, routed: DataFrame) -> DataFrame:
    """``(pattern, plan)``: for every source of a pattern, in order, how many whole passes over the pattern's
    documents end before its share ends, and up to which hash the next pass goes.

    A pattern's documents are ordered by hash and passed over again and again; sources take consecutive
    stretches. A document belongs to the stretch that its middle lies in. Sums per bucket of hashes find
    the bucket that holds each end, and only rows of those buckets are ordered.
    """
    in_order = Window.partitionBy("pattern").orderBy("source")
    ends = routed.withColumn("end", F.sum("quantity").over(in_order)).withColumn(
        "passes", F.when(F.col("capacity") > 0, F.floor(F.col("end") / F.col("capacity") + 1e-9)).otherwise(0).cast("int")
    )
    ends = cut_lineage(ends.withColumn("rest", F.greatest(F.col("end") - F.col("passes") * F.col("capacity"), F.lit(0.0))))
    bucket = F.shiftright("rank", 63 - BUCKETS).alias("bucket")
    sums = sized.groupBy("pattern", bucket).agg(F.sum("size").alias("words"))
    to_here = Window.partitionBy("pattern").orderBy("bucket")
    sums = sums.withColumn("upto", F.sum("words").over(to_here))
    wanted = ends.where("rest > 0").select("pattern", "source", "rest")
    inside = sums.join(wanted, "pattern").where("rest > upto - words AND rest <= upto")
    inside = cut_lineage(inside.select("pattern", "bucket", "source", (F.col("rest") - (F.col("upto") - F.col("words"))).alias("left")))
    by_hash = sized.withColumn("bucket", bucket).join(inside.select("pattern", "bucket").distinct(), ["pattern", "bucket"], "left_semi")
    by_hash = by_hash.groupBy("pattern", "bucket", "rank").agg(F.sum("size").alias("words"))
    middle = F.sum("words").over(Window.partitionBy("pattern", "bucket").orderBy("rank")) - F.col("words") / 2
    placed = by_hash.withColumn("middle", middle).join(inside, ["pattern", "bucket"])
    low = F.shiftleft(F.col("bucket"), 63 - BUCKETS)  # no row of the bucket is taken: stop before it
    last = placed.groupBy("pattern", "source").agg(F.max(F.when(F.col("middle") < F.col("left"), F.col("rank")).otherwise(low - 1)).alias("last"))
    plan = ends.join(last, ["pattern", "source"], "left").select("pattern", "source", "passes", F.coalesce("last", F.lit(-1)).alias("last"))
    return plan.groupBy("pattern").agg(F.array_sort(F.collect_list(F.struct("source", "passes", "last"))).alias("plan"))


def copies(plan: Column, rank: Column) -> Column:
    """How often a document is taken in all: the passes before the last end, and one more up to its hash."""
    end = F.element_at(plan, -1)
    return F.coalesce(end["passes"] + F.when(rank <= end["last"], 1).otherwise(0), F.lit(0))


def shares(plan: Column, rank: Column) -> Column:
    """Copies by source: ``array<struct<source, copies>>``."""
    count = F.transform(plan, lambda e: e["passes"] + F.when(rank <= e["last"], 1).otherwise(0))
    before = F.concat(F.array(F.lit(0)), count)
    return F.transform(plan, lambda e, i: F.struct(e["source"].alias("source"), (F.get(count, i) - F.get(before, i)).alias("copies")))


ADDED = ("_size", "copies", "shares", "quotas")


def mix(
    docs: DataFrame, sources: Column, key: Sequence[Column], size: Column, cycle: Sequence[float] = (1.0, 2.0, 3.0),
    repeats: int = 3, seed: int = 7, broadcast_bytes: int = 8 << 20,
) -> DataFrame:
    """``docs`` with ``_size``, ``copies``, ``shares`` (copies by source) and ``quotas`` (size and target by source).

    ``sources`` is an array of the sources a document belongs to; null, empty or null inside count as the
    null source. Documents with the same set form a pattern, and only patterns enter the flow.
    ``key`` and ``seed`` draw the order in which a pattern's documents are taken, so reruns agree; rows with
    equal keys are taken together. The plan has a row per pattern; it is broadcast up to
    ``broadcast_bytes`` and joined by shuffle beyond. Texts are never shuffled for a plan that is broadcast.
    An empty table stays empty. Columns of the four names are replaced.
    """
    seen = docs.drop("_size", "copies", "shares", "quotas", "_pattern", "_rank")
    names = F.coalesce(sources, F.array(F.lit(None).cast("string")))
    names = F.when(F.size(names) == 0, F.array(F.lit(None).cast("string"))).otherwise(names)
    names = F.array_sort(F.array_distinct(F.transform(names, lambda s: F.coalesce(s.cast("string"), F.lit(NO_SOURCE)))))
    marked = seen.withColumns({"_names": names, "_size": size}).withColumns({
        "_pattern": F.xxhash64(F.to_json("_names")), "_rank": _rank(F.xxhash64(F.lit(seed), *key)),
    })
    sized = cut_lineage(marked.select(F.col("_pattern").alias("pattern"), F.col("_names").alias("sources"), F.col("_rank").alias("rank"), F.col("_size").alias("size")))
    patterns = cut_lineage(sized.groupBy("pattern").agg(F.first("sources").alias("sources"), F.sum("size").alias("capacity")))
    by_source = patterns.select(F.explode("sources").alias("source"), "capacity").groupBy("source").agg(F.sum("capacity").alias("size"))
    total = patterns.agg(F.sum("capacity")).first()[0] or 0
    quota = cut_lineage(targets(cyclic_weights(by_source, cycle), float(total), repeats))
    routed = cut_lineage(route(patterns, quota.select("source", "target"), repeats))
    plan = cuts(sized.select("pattern", "rank", "size"), routed)
    of = patterns.select("pattern", F.explode("sources").alias("source")).join(quota, "source").groupBy("pattern")
    listed = of.agg(F.array_sort(F.collect_list(F.struct("source", "size", "target"))).alias("quotas"))
    plan = cut_lineage(listed.join(plan, "pattern", "left").withColumnsRenamed({"pattern": "_pattern", "plan": "_plan"}))
    cells = plan.agg(F.sum(64 + 48 * F.size("quotas") + F.octet_length(F.to_json("quotas")))).first()[0] or 0
    joined = marked.join(F.broadcast(plan) if cells <= broadcast_bytes else plan, "_pattern", "left")
    return joined.withColumns({
        "copies": copies(F.col("_plan"), F.col("_rank")), "shares": shares(F.col("_plan"), F.col("_rank")),
    }).drop("_names", "_pattern", "_rank", "_plan")


def repeat(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken."""
    mixed = mix(docs.select("*", F.struct(F.lit(0).alias("_"), *(c for c in docs.columns if c in ADDED)).alias("_own")), **options)
    turns = mixed.withColumn("_turn", F.explode(F.array_repeat(F.lit(0), F.col("copies"))))
    return turns.select(*(F.col(f"_own.{c}").alias(c) if c in ADDED else c for c in docs.columns))
