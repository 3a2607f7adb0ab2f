"""Joins and concatenation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from kinetable.plans import skew

HOWS = ("left", "inner", "right", "outer", "anti", "semi")
_SPARK = {"left": "left", "inner": "inner", "right": "right", "outer": "full", "anti": "left_anti", "semi": "left_semi"}


def _resolve(left: DataFrame, right: DataFrame, on: Sequence[str], makeunique: bool) -> DataFrame:
    """Rename right-hand columns that the left also has, or refuse."""
    clash = [c for c in right.columns if c in left.columns and c not in on]
    if clash and not makeunique:
        raise ValueError(f"duplicate columns {clash}; pass makeunique=True")
    names, taken = {}, set(left.columns) | set(right.columns)
    for c in clash:
        i = 1
        while f"{c}_{i}" in taken:
            i += 1
        names[c] = f"{c}_{i}"
        taken.add(names[c])
    return right.withColumnsRenamed(names)


def join(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner",
    makeunique: bool = False, salt: int | None = None,
) -> DataFrame:
    """Equi join on like-named columns.

    Adaptive execution splits a hot key of either side of an inner join, and of the left side of
    a left, semi or anti join. For a hot key on the other side pass ``salt``: the preserved side
    is copied ``salt`` times and each copy meets one share of the hot side.
    """
    if how not in HOWS:
        raise ValueError(f"how must be one of {HOWS}")
    on = [on] if isinstance(on, str) else list(on)
    if how in ("anti", "semi"):
        return left.join(right.select(*on).distinct(), on, _SPARK[how])
    right = _resolve(left, right, on, makeunique)
    if salt is None:
        return left.join(right, on, _SPARK[how])
    if how == "inner":
        return _salted(left, right, on, salt)
    matched = _salted(left, right, on, salt)
    parts = [matched]
    if how in ("left", "outer"):
        parts.append(join(left, right, on, "anti"))
    if how in ("right", "outer"):
        parts.append(join(right, left, on, "anti"))
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return out.select(*matched.columns)


def _salted(left: DataFrame, right: DataFrame, on: Sequence[str], salt: int) -> DataFrame:
    """Inner join with the right side spread over ``salt`` shares of each key."""
    shares = F.explode(F.sequence(F.lit(0), F.lit(salt - 1)))
    spread = F.pmod(F.xxhash64(*right.columns), F.lit(salt)).cast("int")
    return left.withColumn("_s", shares).join(right.withColumn("_s", spread), [*on, "_s"], "inner").drop("_s")


def inner_join_many(frames: Sequence[DataFrame], on: str | Sequence[str], makeunique: bool = False) -> DataFrame:
    """Inner join of several tables on shared keys; repeated columns get _1, _2, ..."""
    return reduce(lambda a, b: join(a, b, on, "inner", makeunique), frames)


def cross_join(left: DataFrame, right: DataFrame, makeunique: bool = False) -> DataFrame:
    """Every pair of rows: the user's own request, so no side is hinted."""
    return left.crossJoin(_resolve(left, right, [], makeunique))


def vcat(*frames: DataFrame) -> DataFrame:
    """Stack tables by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def hcat(left: DataFrame, right: DataFrame, left_order: skew.Order, right_order: skew.Order,
         makeunique: bool = False) -> DataFrame:
    """Put two tables of equal length side by side, each under its stated order."""
    right = _resolve(left, right, [], makeunique)
    a = skew.row_number(left, left_order, "_rn")
    b = skew.row_number(right, right_order, "_rn")
    return a.join(b, "_rn", "full").drop("_rn")
