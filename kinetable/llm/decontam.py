"""Words of documents that lie in benchmark passages, by one Aho-Corasick automaton."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetable.session import cut_lineage

from .common import ship_by_value, sized_broadcast

ship_by_value(__name__)

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after lower-casing: digits, a-z and everything beyond ASCII
_WORD = re.compile(WORD)
_LOWER = {c: c + 32 for c in range(65, 91)}  # A-Z only


def words(text: str) -> tuple[list[str], list[int]]:
    """Normalised words and where each begins in the original text (lower-casing A-Z moves nothing)."""
    found = list(_WORD.finditer(text.translate(_LOWER)))
    return [m[0] for m in found], [m.start() for m in found]


def windows(text: str, width: int) -> list[str]:
    """Every run of ``width`` words, or all words of a shorter text, joined by single spaces."""
    own = words(text)[0]
    return [" ".join(own[i : i + width]) for i in range(max(1, len(own) - width + 1))] if own else []


def automaton(items: list[tuple[str, str]], width: int) -> ahocorasick.Automaton:
    """One automaton over the windows of ``(item, text)``; a pattern carries its word count and its items."""
    owners: dict[str, set[str]] = defaultdict(set)
    for item, text in items:
        for window in windows(text, width):
            owners[window].add(item)
    made = ahocorasick.Automaton()
    for window, of in owners.items():
        made.add_word(f" {window} ", (window.count(" ") + 1, tuple(sorted(of))))
    made.make_automaton()
    return made


def scan(text: str | None, made: ahocorasick.Automaton) -> tuple[int, list[tuple[int, int]], list[tuple[int, int]], list[str]]:
    """Word count, hit runs as word ranges and as offsets in the original text, items with an occurring window.

    The normalised text is scanned once; where each word ends in it leads back to the word's original offsets.
    """
    own, starts = words(text) if text else ([], [])
    if not own or not len(made):
        return len(own), [], [], []
    ends, at = [], 0  # position of the space after each word
    for word in own:
        at += len(word) + 1
        ends.append(at)
    runs: list[list[int]] = []
    items: set[str] = set()
    for end, (n, of) in made.iter(f" {' '.join(own)} "):
        last = bisect_left(ends, end)
        items.update(of)
        first = last - n + 1
        # matches come by their end, a longer one before a shorter one, so only the latest runs can grow; runs that only touch stay apart
        while runs and runs[-1][1] > first:
            first = min(first, runs.pop()[0])
        runs.append([first, last + 1])
    spans = [(starts[a], starts[b - 1] + len(own[b - 1])) for a, b in runs]
    return len(own), [(a, b) for a, b in runs], spans, sorted(items)


_FOUND = "n_words long, runs array<struct<first:int,end:int>>, spans array<struct<first:int,end:int>>, items array<string>"


def _scanner(items: list[tuple[str, str]], width: int):
    @F.pandas_udf(_FOUND)
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        made = automaton(items, width)
        for texts in batches:
            yield pd.DataFrame([scan(t, made) for t in texts], columns=["n_words", "runs", "spans", "items"])

    return scanned


def find(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", passage: str = "text",
    width: int = 13, block_bytes: int = 32 << 20,
) -> DataFrame:
    """``docs`` with ``found``: n_words, runs (hit word ranges, end exclusive), spans (the same as offsets of
    the original text) and items (sorted as strings).

    The benchmark's size is measured first; up to ``block_bytes`` of passages go into one automaton, and a
    larger benchmark is cut into blocks of about that size with one automaton each, one after the other: every block is
    a job that stores its hits, so driver and tasks hold one block at a time. A passage is never
    cut, so an item's windows are all in one block. Null and wordless texts have no words; a null
    item is named ``null``; an empty benchmark hits nothing.
    """
    known = benchmark.where(F.col(passage).isNotNull()).select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("i"), F.col(passage).alias("t")).distinct()
    size = known.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n_blocks = -(-size // block_bytes) or 1
    seen = docs.drop("found")

    def block(i: int) -> list[tuple[str, str]]:
        return [(r.i, r.t) for r in known.where(F.pmod(F.xxhash64("i", "t"), F.lit(n_blocks)) == i).collect()]  # bounded by block_bytes

    if n_blocks == 1:
        return seen.withColumn("found", _scanner(block(0), width)(F.col(text)))
    seen = cut_lineage(seen.withColumn("_row", F.monotonically_increasing_id()))
    hit = []
    for i in range(n_blocks):
        part = seen.select("_row", _scanner(block(i), width)(F.col(text)).alias("_f"))
        hit.append(cut_lineage(part.where(F.size("_f.runs") > 0)))
    every = reduce(DataFrame.unionByName, hit).groupBy("_row").agg(F.collect_list("_f").alias("_f"))  # one for each block at most
    merged = every.select("_row", *(union(F.flatten(F.col(f"_f.{c}"))).alias(f"_{c}") for c in ("runs", "spans")),
                          F.array_sort(F.array_distinct(F.flatten("_f.items"))).alias("_items"))
    joined = seen.withColumn("_none", _scanner([], width)(F.col(text))).join(sized_broadcast(cut_lineage(merged), 200_000), "_row", "left")
    found = F.struct(F.col("_none.n_words").alias("n_words"), *(F.coalesce(f"_{c}", f"_none.{c}").alias(c) for c in ("runs", "spans", "items")))
    return joined.withColumn("found", found).drop("_row", "_none", "_runs", "_spans", "_items")


def union(ranges: Column) -> Column:
    """Disjoint ranges covering the same positions, in order; ranges that only touch stay apart."""
    empty = F.slice(ranges, 1, 0)

    def add(done: Column, x: Column) -> Column:
        return F.when(
            (F.size(done) > 0) & (F.coalesce(F.try_element_at(done, F.lit(-1))["end"], F.lit(-1)) > x["first"]),
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(
                F.try_element_at(done, F.lit(-1))["first"].alias("first"),
                F.greatest(F.try_element_at(done, F.lit(-1))["end"], x["end"]).alias("end"),
            ))),
        ).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(ranges), empty, add)


def hits(found: Column) -> Column:
    """Number of hit words."""
    return F.coalesce(F.aggregate(found["runs"], F.lit(0).cast("long"), lambda n, r: n + (r["end"] - r["first"])), F.lit(0).cast("long"))


def is_contaminated(found: Column, share_of: int = 20) -> Column:
    """At least one word hit, and at least one in ``share_of`` words."""
    return (hits(found) > 0) & (share_of * hits(found) >= found["n_words"])


def strip(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without contaminated documents; all others, null texts too, stay as they are."""
    named = docs.withColumnRenamed("found", "_found") if "found" in docs.columns else docs
    kept = find(named, benchmark, **options).where(~is_contaminated(F.col("found"))).drop("found")
    return kept.withColumnRenamed("_found", "found") if "found" in docs.columns else kept
