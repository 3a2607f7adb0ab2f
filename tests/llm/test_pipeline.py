"""Registered queries against their SQL twins, and the pipeline stage by stage."""

from __future__ import annotations

import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from kinetable.llm import decontam, langid, minhash
from kinetable.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_twins(spark, name):
    assert compare(spark, connect(SMALL), SMALL, QUERIES[name], ORACLES[name]) == []


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = [(-1, None, "en", None, 0), (-2, "", None, "x", 0), (None, "the thing and the other thing of it", "en", "src0", 5)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.cut_lineage(stage(spark, docs, SMALL))
        sizes.append(docs.count())
        ids = lambda d: {r.doc_id for r in d.select("doc_id").collect()}
        assert ids(docs) <= ids(before)
        if name == "language":
            assert not {-1, -2} & ids(docs) and sizes[-1] >= 0.97 * sizes[0]
        if name == "near_duplicates":
            assert ids(docs) == {r.id for r in minhash.group(before, width=5).where("kept").collect()}
        if name == "decontaminate":
            bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
            assert decontam.find(docs, bench).where(decontam.is_contaminated(F.col("found"))).count() == 0
        if name != "shards":
            assert docs.columns == columns
    assert docs.columns == [*columns, "shard", "slot"] and docs.where("shard < 0 or shard > 39").count() == 0
    extra = ["score", "Copies", "plan", "found", "ranges", "_found", "hash", "id", "shard", "lang_pred", "kept"]
    wide = spark.read.parquet(f"{SMALL}/documents.parquet").select("*", *[F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in extra])
    for name, stage in corpus_pipeline.STAGES:
        wide = corpus_pipeline.cut_lineage(stage(spark, wide, SMALL))
        own = [c for c in extra if c != "shard" or name != "shards"]
        assert set(wide.columns) == {*columns, *own, *(["shard", "slot"] if name == "shards" else [])}
        assert wide.count() > 0 and all(wide.where(F.col(c) != F.concat(F.lit(c), F.col("doc_id"))).count() == 0 for c in own)
    empty = docs.limit(0).select(columns)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0
    assert langid.fit(empty).dictionaries == {}
