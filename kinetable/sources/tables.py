"""Delimited files with missing tokens, named tables, saved results, report tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

MISSING = ("NA", ".", "")  # fixed values: the missing tokens of the source files


def read_csv(
    spark: SparkSession, path: str, missing: Sequence[str] = MISSING, schema: str | StructType | None = None,
    required: Sequence[str] = (), skipto: int = 2,
) -> DataFrame:
    """CSV with a header and several missing tokens.

    ``skipto`` is the line of each file, the header being the first, with which its data begin.

    Columns are read as text so that words such as ``inf`` stay words, then converted to
    ``schema`` where given (text that does not convert is NULL). ``required`` drops lines whose
    named columns do not convert: units or comment lines between header and data.
    """
    raw = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    if skipto > 2:
        raw = skip_lines(raw, skipto - 2)
    trimmed = {c: F.trim(F.regexp_replace(F.col(c), "\r$", "")) for c in raw.columns}
    df = raw.withColumns({c: F.when(~x.isin(*missing), x) for c, x in trimmed.items()})
    if schema is None:
        return df
    want = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    df = df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in want.fields])
    return df.na.drop(subset=list(required)) if required else df


def skip_lines(df: DataFrame, lines: int) -> DataFrame:
    """``df``, just read from files, without the first ``lines`` rows of each file, whatever they hold.

    A file's rows stand in order and its first split begins at offset 0, so one row number of that split says which
    numbers go; only these, ``lines`` for each file, are broadcast. Rows stay where they were read. The lines must lie in
    a file's first split. Blank lines are no rows.
    """
    placed = df.select("*", F.monotonically_increasing_id().alias("_row"), F.col("_metadata.file_path").alias("_file"),
                       F.col("_metadata.file_block_start").alias("_offset"))
    first = placed.filter("_offset = 0").groupBy("_file").agg(F.min("_row").alias("_from"), F.count(F.lit(1)).alias("_n"))
    upto = F.col("_from") + F.least(F.col("_n"), F.lit(lines)) - 1
    gone = first.select(F.explode(F.sequence("_from", upto)).alias("_row"))
    return placed.join(F.broadcast(gone), "_row", "left_anti").select(*df.columns)


def rejected_values(spark: SparkSession, path: str, schema: str | StructType, missing: Sequence[str] = MISSING) -> DataFrame:
    """``(column, rejected)``: how many present values of each column ``read_csv`` makes NULL because they don't convert."""
    want = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = read_csv(spark, path, missing)
    names = [f.name for f in want.fields]
    lost = [F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name) for f in want.fields]
    return text.agg(*lost).unpivot([], names, "column", "rejected")


def read_csv_skip_units(spark: SparkSession, path: str, schema: str, key: str | None = None,
                        missing: Sequence[str] = MISSING, skipto: int = 3) -> DataFrame:
    """CSV with units lines below the header: the lines before ``skipto`` in each file or, where ``key`` is given, those whose
    key does not convert to its type.
    """
    if key:
        return read_csv(spark, path, missing, schema, required=[key])
    return read_csv(spark, path, missing, schema, skipto=skipto)


def write_csv(df: DataFrame, path: str, missing: str = "") -> None:
    df.write.option("header", True).option("nullValue", missing).option("emptyValue", '""').csv(path)


def dataset(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A named table."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def save_result(tables: Mapping[str, DataFrame], path: str) -> None:
    """Persist the tables of a fit: one folder per table."""
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{path}/{name}")


def load_result(spark: SparkSession, path: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{path}/{n}") for n in names}


def report_table(summary: DataFrame, keys: Sequence[str], stats: Sequence[str], meta: Mapping[str, Any]) -> DataFrame:
    """Long report table: keys, stat, value and the study's metadata columns."""
    wide = summary.withColumns({s: F.col(s).cast("double") for s in stats})
    long = wide.unpivot(list(keys), list(stats), "stat", "value")
    return long.withColumns({k: F.lit(v) for k, v in meta.items()})
