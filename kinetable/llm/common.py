"""Helpers that the operators of this folder share."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetable.session import cut_lineage


def ship_by_value(module: str) -> None:
    """Functions of ``module`` travel to the tasks themselves; executors need not have this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` of every id in ``links(a, b)`` but self-links; component is the smallest id reachable.

    Each round a vertex takes the smallest hash of that round among its neighbours' smallest neighbours, so a star
    of any size becomes one vertex at once; links are then rewritten to what their ends took. Hashes
    instead of ids keep sorted chains from shrinking by a few vertices a round. Every step is a join or a
    partially aggregated minimum, and each round is stored.
    """
    undirected = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = cut_lineage(undirected.distinct())
    labels = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct().select("id", F.col("id").alias("label"))
    turn = 0
    while not edges.isEmpty():
        turn += 1
        drawn = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("h"), F.col(c).alias("to"))
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = cut_lineage(ends.groupBy("a").agg(F.least(F.min(drawn("b")), drawn("a")).alias("m")))
        seen = ends.join(near.select(F.col("a").alias("b"), F.col("m").alias("m2")), "b").groupBy("a").agg(F.min("m2").alias("m2"))
        aims = cut_lineage(seen.join(near, "a").select(F.col("a").alias("v"), F.least("m", "m2")["to"].alias("to")))
        at = lambda c, t: aims.select(F.col("v").alias(c), F.col("to").alias(t))
        moved = edges.join(at("a", "x"), "a").join(at("b", "y"), "b").where("x <> y")
        edges = cut_lineage(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        labels = labels.join(at("label", "next"), "label", "left").select("id", F.coalesce("next", "label").alias("label"))
    labels = cut_lineage(labels)
    least = labels.groupBy("label").agg(F.min("id").alias("component"))
    return labels.join(least, "label").select("id", "component")


def sized_broadcast(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """``df``, whose rows are a few numbers each, with a broadcast hint if it has at most ``max_rows`` rows."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
