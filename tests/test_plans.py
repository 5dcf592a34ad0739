"""The plans keep the shape that holds at scale."""

import re

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placetime.operators import keyed, prep, search, spatial
from placetime.plans import fixtures
from placetime.plans.catalog import QUERIES
from placetime.plans.registry import table


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_slices_take_one_scan(spark, sf):
    text = plan(QUERIES["slice_counts"](spark, sf))
    tree = text.split("\n\n")[0]
    assert tree.count("Scan parquet") == 1
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in text


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(prep.only_equal(table(spark, sf, "customer"), "c_mktsegment", "BUILDING").select("c_custkey"))
    assert "EqualTo(c_mktsegment,BUILDING)" in text
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in text


@pytest.mark.parametrize("name", ["brushed_keys", "points_in_polygons", "points_within_radius", "overlapping_intervals", "resampled_cells", "linked_highlight"])
def test_range_joins_become_equi_joins(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def windows_in_one_task(tree):
    """Window nodes whose rows all come from an exchange into a single partition."""
    lines, found = tree.splitlines(), []
    depth = lambda line: len(re.match(r"[\s|:+-]*", line).group())
    for i, line in enumerate(lines):
        if not re.match(r"[\s|:+-]*(\*\(\d+\) )?Window ", line):
            continue
        for below in lines[i + 1:]:
            if depth(below) <= depth(line):
                break
            if "Exchange" in below:
                found += [line.strip()] if "SinglePartition" in below else []
                break
    return found


def test_windows_in_one_task_are_seen(spark):
    rows = spark.range(10)
    simple = lambda df: df._jdf.queryExecution().simpleString()
    assert windows_in_one_task(simple(rows.withColumn("n", F.row_number().over(W.orderBy("id")))))
    assert not windows_in_one_task(simple(rows.withColumn("n", F.row_number().over(W.partitionBy("id").orderBy("id")))))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_and_no_single_task_windows(spark, sf, name):
    df = QUERIES[name](spark, sf)
    text = plan(df)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "BatchEvalPython" not in text, "row-at-a-time Python"
    assert windows_in_one_task(df._jdf.queryExecution().simpleString()) == []


def test_top_k_is_cut_before_the_shuffle(spark):
    scored = spark.range(100).select((F.col("id") % 3).alias("query_id"), F.col("id").alias("doc_id"), F.rand(1).alias("score"))
    tree = plan(search.top_hits(scored)).split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2


def test_one_row_per_key_combines_before_the_shuffle(spark, sf):
    orders = table(spark, sf, "orders")
    for df in (prep.first_per_key(orders, ["o_orderdate"]), keyed.latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])):
        text = plan(df)
        assert re.search("partial_(min|max_by)", text) and "Window" not in text


def test_polygon_join_runs_without_python(spark, sf):
    df = spatial.points_in_polygons(fixtures.points(spark, sf), fixtures.polygons(spark, sf))
    text = plan(df)
    assert "Python" not in text and "Pandas" not in text
    assert len(re.findall(r"Scan parquet[^\n]*\n(?:(?!\n\n).)*events\.parquet", text, re.S)) == 1
    joined = df.columns
    assert "rings" not in joined and "box_id" in joined
