"""Inputs on which results or plans of earlier rounds failed as the tables grow."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ledgerspark.page_queries import ORACLES, QUERIES
from tests.compare import differences, oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def later_suppliers(spark, tmp_path_factory):
    """The tables of sf0.001 with suppliers numbered from 2000 on, as larger tables have them."""
    root = tmp_path_factory.mktemp("later")
    for name in os.listdir(SF):
        key = {"supplier.parquet": "s_suppkey", "lineitem.parquet": "l_suppkey"}.get(name)
        if key:
            spark.read.parquet(f"{SF}/{name}").withColumn(key, F.col(key) + 2000).write.parquet(f"{root}/{name}")
        else:
            os.symlink(f"{SF}/{name}", f"{root}/{name}")
    return str(root)


def test_document_analysis_numbers_that_read_as_years(spark, later_suppliers):
    sql = ORACLES["document_analysis"].replace("FROM lineitem", f"FROM '{later_suppliers}/lineitem.parquet/*.parquet'").replace("JOIN supplier", f"JOIN '{later_suppliers}/supplier.parquet/*.parquet'")
    got = QUERIES["document_analysis"](spark, later_suppliers).toPandas()
    assert len(got) and got["has_time_series"].all()
    assert differences(got, oracle(SF, sql.replace("FROM supplier", f"FROM '{later_suppliers}/supplier.parquet/*.parquet'"))) == ""


def _exchanges(df) -> int:
    return sum("Exchange hashpartitioning" in line for line in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Final Plan" not in line)


def test_segments_lie_by_company(spark):
    from ledgerspark.operators import views
    from ledgerspark.sources import testtables

    s = testtables.segments(spark, SF)
    rows = _exchanges(s)
    assert rows <= 7 and _exchanges(views.segment_growth(s)) == rows  # the window finds the rows of a company together


def test_segment_tasks_follow_the_lines(spark, monkeypatch):
    from ledgerspark.sources import testtables

    monkeypatch.setattr(testtables, "LINES", 100)  # of 6000 lines
    assert testtables.segments(spark, SF).rdd.getNumPartitions() >= 55


def test_segment_tasks_hold_few_lines(spark):
    from ledgerspark.sources import testtables

    lines = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet").count()
    assert testtables.segments(spark, "/root/testdata/sf0.1").rdd.getNumPartitions() >= lines / 100_000 > 4  # the session's own number


def test_contexts_by_index_and_directly(spark, monkeypatch):
    from ledgerspark.operators import mining
    from ledgerspark.sources import orderpages

    rows = orderpages.contexts(spark, SF)
    direct = sorted(map(tuple, mining.similar_contexts(rows).collect()))
    monkeypatch.setattr(mining, "DIRECT", 0)
    assert direct and sorted(map(tuple, mining.similar_contexts(rows).collect())) == direct
    assert _exchanges(mining.similar_contexts(rows)) <= 8


def test_instances_are_handed_on_in_parts(spark, monkeypatch):
    from ledgerspark import queries
    from ledgerspark.operators import flatten

    whole = flatten.flatten_instances(queries.instances(spark, SF)).count()
    monkeypatch.setattr(flatten, "ROWS", 1)
    assert flatten.flatten_instances(queries.instances(spark, SF)).count() == whole > 0
