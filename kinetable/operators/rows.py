"""Row operators: filters, order, slices and paging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from kinetable.plans import skew


def row_filter(df: DataFrame, *conditions: Column) -> DataFrame:
    """Rows for which every condition is true (NULL is not)."""
    for c in conditions:
        df = df.filter(c)
    return df


def drop_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(columns) if columns else None)


def unique_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows, or distinct values of the given columns."""
    return (df.select(*columns) if columns else df).distinct()


def order_by(df: DataFrame, *order: tuple[str, bool]) -> DataFrame:
    """Sort by (column, descending) pairs, missing last."""
    return df.orderBy(*[F.col(n).desc_nulls_last() if d else F.col(n).asc_nulls_last() for n, d in order])


def first_n(df: DataFrame, n: int, *order: tuple[str, bool]) -> DataFrame:
    return order_by(df, *order).limit(n)


def last_n(df: DataFrame, n: int, *order: tuple[str, bool]) -> DataFrame:
    """The last n rows, missing sort keys counting as last."""
    back = [F.col(c).asc_nulls_first() if d else F.col(c).desc_nulls_first() for c, d in order]
    return df.orderBy(*back).limit(n)


HEAD = 10_000  # slices ending here or earlier are taken from the sorted head, without numbering the table


def row_slice(df: DataFrame, order: skew.Order, start: int, stop: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows start..stop (from 1, both included) under the order; one cell when start = stop and one column."""
    head = order_by(df, *order).limit(stop) if stop <= HEAD else df
    cut = skew.row_number(head, order, "_rn").filter(F.col("_rn").between(start, stop)).drop("_rn")
    return cut.select(*columns) if columns else cut


def subject_index(df: DataFrame, id: str) -> DataFrame:
    """Distinct subjects with their position ``n`` (from 1) in id order."""
    return skew.row_number(df.select(id).distinct(), [(id, False)], "n")


def page_groups(df: DataFrame, id: str, panels: int) -> DataFrame:
    """Add the page number when each page shows ``panels`` subjects."""
    pages = subject_index(df, id).select(id, F.ceil(F.col("n") / panels).cast("long").alias("page"))
    return df.join(pages, id, "left")


def pick_subject(df: DataFrame, id: str, first: int, last: int | None = None) -> DataFrame:
    """Records of the first-th (to last-th) subject."""
    wanted = row_slice(df.select(id).distinct(), [(id, False)], first, last or first)
    return df.join(wanted, id, "left_semi")
