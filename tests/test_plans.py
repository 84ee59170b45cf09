"""The shape of the physical plans that the design counts on."""

from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemark.operators import loads, reconcile
from tidemark.operators.latest import latest_per_key
from tidemark.sinks.tables import parked
from tidemark.sources import batches


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_latest_cuts_rows_before_the_shuffle(spark):
    text = plan(latest_per_key(spark.read.parquet(f"{SMALL}/orders.parquet"), "o_custkey", ["o_orderdate"]))
    assert "WindowGroupLimit" in text and ", Partial" in text


def test_a_batch_is_a_pushed_down_filter_without_sort(spark):
    df = batches.incremental_extract(spark.read.parquet(f"{SMALL}/events.parquet"), "event_id", 10, 50)
    text = plan(df)
    assert "GreaterThan(event_id,10)" in text and "LessThan(event_id,61)" in text
    assert "Exchange" not in text and "Sort" not in text


def test_staged_small_batch_does_not_shuffle_the_table(spark):
    o = spark.read.parquet(f"{SMALL}/orders.parquet")
    batch = parked(spark.createDataFrame([(1, 2.0)], "o_orderkey long, o_totalprice double"))
    text = plan(loads.merge(o, batch, "o_orderkey", plan="lookup"))
    assert "hashpartitioning" not in text and "SortMergeJoin" not in text


def test_insert_only_reads_only_the_key_of_the_table(spark):
    o = spark.read.parquet(f"{SMALL}/orders.parquet")
    batch = o.filter("o_orderkey < 5").select("o_orderkey", F.lit("x").alias("o_orderstatus"))
    text = plan(loads.new_rows(o, batch, "o_orderkey"))
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_value_difference_is_one_shuffle_with_map_side_combine(spark):
    o = spark.read.parquet(f"{SMALL}/orders.parquet")
    text = plan(reconcile.value_difference(o, o, ["o_orderkey", "o_orderstatus"]))
    assert text.count("Exchange") == 1 and text.count("HashAggregate") == 2
