"""Every registered query against its SQL twin, and the ordered ones again with a tiny row limit."""

from __future__ import annotations

import pytest
from conftest import SMALL
from oracle import compare

import __spark_entry__ as entry
from kinetable.catalog import ORACLES, QUERIES

SKEWED = ["occasion", "nca_report", "nca_summary", "be_nonpar", "be_stats_period", "box_stats", "group_multi_agg",
          "row_index", "categorical_codes", "be_endpoints", "score_regimen", "nca_intervals", "nca_multi_dose", "score_1cmt_oral", "predict_grid", "sir", "vpc_bands", "summary_stats"]


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert compare(spark, duck, SMALL, QUERIES[name], ORACLES[name]) == []


@pytest.mark.parametrize("name", SKEWED)
def test_query_with_hot_keys(spark, duck, tiny_limit, name):
    assert compare(spark, duck, SMALL, QUERIES[name], ORACLES[name]) == []


def test_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).limit(5).count() == 5
