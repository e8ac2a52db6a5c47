"""The plans have the shape they are meant to have."""

import re

import __spark_entry__ as entry
import pytest
from lotledger.operators import ranges as R
from lotledger.session import SPREAD_ROWS, spread, written
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["r1_split", "r2_split2", "a2_counts", "j1_new", "j3_lookup", "j4_cross", "m3_merge", "m4_run", "m6_outcome", "w1_lead"]
)
def test_no_nested_loop(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["w3_first", "d3_run", "r3_cap", "w2_pages", "d1_clean_url", "flagship_pages_added"])
def test_rank_filter_is_cut_before_the_shuffle(spark, name):
    assert "Partial" in "".join(re.findall(r"WindowGroupLimit.*", plan(entry.queries()[name](spark, SF))))


@pytest.mark.parametrize("name", ["r3_cap", "r3_cap_u", "w2_pages"])
def test_cells_are_ranked_in_slices(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    exchanges = re.findall(r"Exchange hashpartitioning\((.*?)\d+\)", text)
    assert len(exchanges) == 2 and "_salt" in exchanges[1]
    assert len(re.findall(r"WindowGroupLimit.*Partial", text)) == 2


@pytest.mark.parametrize("name,most", [("r1_split", 1), ("r2_split2", 4), ("a2_counts", 4)])
def test_splits_read_stored_counts(spark, name, most):
    text = plan(entry.queries()[name](spark, SF))
    assert len(re.findall(r"FileScan|BatchScan", text)) <= most and "lineitem" not in text and "Python" not in text


@pytest.mark.parametrize("name", ["m3_merge", "m4_run", "m5_merge_price"])
def test_merge_does_not_need_the_whole_table_shuffled(spark, name):
    assert "FullOuter" not in plan(entry.queries()[name](spark, SF))


def test_scan_reads_only_what_is_used(spark):
    text = plan(entry.queries()["p7_recent"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text and "GreaterThanOrEqual(ts" in text
    text = plan(entry.queries()["d1_clean_url"](spark, SF))
    assert "html" not in text


def test_page_text_is_not_shuffled(spark):
    text = plan(entry.queries()["flagship_pages_added"](spark, SF))
    for line in text.splitlines():
        if "Exchange" in line:
            assert "html" not in line


def test_detail_pages_send_back_values_only(spark):
    """The elements of a page stay in the task that reads it; no lambda goes over them afterwards."""
    text = plan(entry.queries()["e3_detail_record"](spark, SF))
    assert "MapInArrow" in text and "nodes" not in text and "cldt" not in text.split("MapInArrow")[0]


def test_spread_deals_rows_not_pieces(spark, tmp_path):
    """A file has more splits than row groups: its one full piece is dealt out, however many empty ones there are."""
    path = str(tmp_path / "rows.parquet")
    spark.range(60_000).selectExpr("id", "md5(cast(id AS string)) AS x", "id % 4000 AS page").coalesce(1).write.parquet(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        rows = spark.read.parquet(path)
        assert rows.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        sizes = lambda df: [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes(rows)) == 60_000 and max(sizes(spread(rows))) <= 1.1 * SPREAD_ROWS
        by_page = spread(rows, "page")
        assert max(sizes(by_page)) <= 2 * SPREAD_ROWS
        assert by_page.select("page", F.spark_partition_id()).distinct().count() == 4000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_result_pages_are_dealt_before_their_text_is_built(spark, tmp_path):
    """One shuffle, of narrow rows by page: no page text and no second exchange."""
    orders = spark.range(90).selectExpr("id AS o_orderkey", "id % 9 AS o_custkey", "'O' AS o_orderstatus", "id + 0.5D AS o_totalprice", "current_date() AS o_orderdate", "'x' AS o_orderpriority")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    found = plan(entry.queries()["e3_shallow_record"](spark, str(tmp_path)))
    assert len(re.findall(r"Exchange ", found)) == 1 and "REPARTITION_BY_NUM" in found, found


def test_functions_need_no_python(spark):
    for name, fn in entry.queries().items():
        if re.match(r"[fup]\d", name):
            text = plan(fn(spark, SF))
            assert "Python" not in text and "Exchange" not in text, name


def test_roll_up_is_dealt_by_number(spark, tmp_path, monkeypatch):
    """Each lowest cell becomes a row per level, so their number, not their bytes, says how many tasks roll them up."""
    hist = spark.range(3000).selectExpr("id * 37 % 100003 AS v", "id % 5 + 1 AS n")
    cells = sorted(tuple(r) for r in R.split_counts(hist, 0, 1_000_000, 7).collect())
    monkeypatch.setattr(R, "ROLL_UP_ROWS", 100, raising=False)
    stored = written(R.with_path(hist, 0, 1_000_000), str(tmp_path / "cells"))
    assert re.search(r"hashpartitioning\(path#\d+L, 30\), REPARTITION_BY_NUM", plan(R._children(stored, 0, 15, 20, [])))
    assert sorted(tuple(r) for r in R.split_counts(hist, 0, 1_000_000, 7).collect()) == cells
