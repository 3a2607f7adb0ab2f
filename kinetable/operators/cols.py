"""Column operators."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from kinetable.plans import skew


def select_cols(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names)


def select_not(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def select_regex(df: DataFrame, pattern: str) -> DataFrame:
    return df.select(*[c for c in df.columns if re.search(pattern, c)])


def rename(df: DataFrame, names: Mapping[str | int, str]) -> DataFrame:
    """New names by old name or by 1-based position."""
    by_name = {df.columns[k - 1] if isinstance(k, int) else k: v for k, v in names.items()}
    absent = set(by_name) - set(df.columns)
    if absent:
        raise ValueError(f"no such columns: {sorted(absent)}")
    return df.withColumnsRenamed(by_name)


def add_const(df: DataFrame, name: str, value: Any) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def case_when(df: DataFrame, name: str, cases: Sequence[tuple[Column, Any]], otherwise: Any) -> DataFrame:
    """First matching case wins; a NULL condition does not match."""
    out = None
    for cond, value in cases:
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return df.withColumn(name, out.otherwise(otherwise))


def arith_cols(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(dict(exprs))


def cast_types(df: DataFrame, kinds: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Cast columns; a value that does not convert is an error, or NULL when not strict."""
    return df.withColumns({c: F.col(c).cast(k) if strict else F.col(c).try_cast(k) for c, k in kinds.items()})


def categorical_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<col>_code``: position (from 1) of the value among the column's sorted levels.

    The levels are joined back by a plan Spark sizes itself; nothing assumes that they are few.
    """
    for c in columns:
        levels = df.select(c).filter(F.col(c).isNotNull()).distinct()
        df = df.join(skew.row_number(levels, [(c, False)], f"{c}_code"), c, "left")
    return df


def missing_flag(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.withColumn(name, F.col(column).isNull())


def unit_convert(df: DataFrame, column: str, factor: float, unit: str, name: str | None = None) -> DataFrame:
    """Multiply by ``factor`` and note ``unit`` in the column metadata."""
    name = name or column
    return df.withColumn(name, F.col(column) * F.lit(factor)).withMetadata(name, {"unit": unit})


def round_sig(x: Column, digits: int) -> Column:
    """Round to significant digits; zero and NULL pass through."""
    k = (F.floor(F.log10(F.abs(x))) - (digits - 1)).cast("double")
    scale = F.pow(F.lit(10.0), F.abs(k))
    # multiply or divide by an exact power of ten only, so the result is the nearest double
    return F.when(x == 0, x).when(k < 0, F.round(x * scale) / scale).otherwise(F.round(x / scale) * scale)


def row_index(df: DataFrame, order: skew.Order, name: str = "COUNT") -> DataFrame:
    """Sequential row number (from 1) under a stated order."""
    return skew.row_number(df, order, name)


def axis_scale(df: DataFrame, column: str) -> DataFrame:
    """Natural, decimal and pseudo-decimal log of a value; the plain logs are NULL at or below zero."""
    x = F.col(column)
    return df.withColumns({
        "ln_value": F.when(x > 0, F.ln(x)),
        "log10_value": F.when(x > 0, F.log10(x)),
        "pseudolog10_value": F.asinh(x / 2) / F.ln(F.lit(10.0)),
    })
