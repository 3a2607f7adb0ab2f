"""The corpus pipeline: five stages over ``documents``, each stored before the next one reads it."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetable.llm import decontam, langid, minhash, mixing, sharding
from kinetable.llm.common import table
from kinetable.session import cut_lineage

SHARDS = 40


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def apart(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage with columns beyond those of documents under names that no operator uses; they return as they came.

    One whose name the stage adds gives way.
    """

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        hidden = {c: f"_extra{i}_{c}" for i, c in enumerate(docs.columns) if c not in COLUMNS}
        out = stage(spark, docs.withColumnsRenamed(hidden), sf_dir)
        back = {h: c for c, h in hidden.items()}
        added = {c.lower() for c in out.columns if c not in COLUMNS and c not in back}
        return out.drop(*[h for h, c in back.items() if c.lower() in added]).withColumnsRenamed(back)

    return run


@apart
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; null and letterless texts and near ties go."""
    known = docs.where(~langid.held_out() & F.col("doc_id").isNotNull())
    found = langid.identify(docs, langid.fit(known))
    return found.where(~F.col("rejected")).select(*docs.columns)


@apart
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles."""
    return minhash.representatives(docs, width=5, percent=80)


@apart
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with less than a twentieth of their words in benchmark passages."""
    return decontam.strip(docs, table(spark, sf_dir, "benchmark"))


@apart
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, up to three times."""
    return mixing.repeat(docs, sources=F.array("source"), key=[F.col("doc_id"), F.xxhash64("text")], size=mixing.word_count())


@apart
def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot."""
    return sharding.assign(docs, sharding.topology(SHARDS))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mixture", mixture),
    ("shards", shards),
]

#: Compression, signatures and hashes of rows are no SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut_lineage(docs)
    return docs
