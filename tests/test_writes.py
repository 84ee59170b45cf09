"""Loads by partition, synced tables, range lookups and the spread of hot keys."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import lookup, running
from tidemark.plans import sync
from tidemark.sinks import tables

SHAPE = "id long, v string, at timestamp_ntz, day string"


def frame(spark, *items):
    return spark.createDataFrame([(i, v, datetime(2024, 1, d), f"d{d}") for i, v, d in items], SHAPE)


def test_only_the_batch_partitions_are_read_and_empty_ones_go(spark, tmp_path):
    path = f"{tmp_path}/t"
    frame(spark, (1, "a", 1), (2, "b", 2), (3, "c", 3), (4, "e", 4)).write.partitionBy("day").parquet(path)
    table = spark.read.parquet(path)
    plan = tables.of_partitions(table, "day", ["d1", "d2"])._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "day" in filters and "d1" in filters and "d2" in filters
    tables.merge_partitions(path, frame(spark, (2, "B", 2), (9, "n", 5)), "id", "day")
    assert rows(spark.read.parquet(path), "id", "v") == [(1, "a"), (2, "B"), (3, "c"), (4, "e"), (9, "n")]
    tables.publish_partitions(path, frame(spark, (1, "A", 1)), "day", ["d1", "d3"])
    assert rows(spark.read.parquet(path), "id", "v") == [(1, "A"), (2, "B"), (4, "e"), (9, "n")]
    with pytest.raises(ValueError):
        tables.publish_partitions(path, frame(spark, (1, "A", 1)), "day", ["d3"])


def test_a_sync_writes_and_logs(spark, tmp_path):
    path, log, now = f"{tmp_path}/t", f"{tmp_path}/log", datetime(2024, 2, 1)
    rule = sync.SyncRule("public", "t", order_field="at", key_field="id", columns_to_hash="v")
    first = frame(spark, (1, "a@x", 1), (2, "b", 2))
    assert sync.sync_table(rule, first, path, log, "day", now, "pepper") == 2
    assert sync.sync_table(rule, first.unionByName(frame(spark, (3, "c", 3))), path, log, "day", now, "pepper") == 1
    assert sync.sync_table(rule.with_(load_method="merge", order_field=None), frame(spark, (2, "B", 2)), path, log, "day", now, "pepper") == 1
    assert [r[1] if "@" in r[1] or len(r[1]) < 9 else "hashed" for r in rows(spark.read.parquet(path), "id", "v")] == ["hashed", "B", "c"]
    assert sync.sync_table(rule.with_(load_method="truncate-insert", batch_max_rows=1), frame(spark, (7, "x", 7), (8, "y", 7)), path, log, "day", now, "p") == 2
    assert rows(spark.read.parquet(path), "id") == [(7,), (8,)]
    for bad in (rule.with_(load_method="upsert"), rule.with_(sql="SELECT id FROM somewhere.else")):
        with pytest.raises(ValueError):
            sync.sync_table(bad, first, path, log, "day", now, "pepper")
    with pytest.raises(ValueError, match="pepper"):
        sync.sync_table(rule, first, path, log, "day", now)
    with pytest.raises(Exception, match="UNRESOLVED_ROUTINE"):
        sync.projected(rule.with_(sql="SELECT id, etl.f_mask(v) AS v FROM {source}"), first)
    states = [r[0] for r in rows(spark.read.parquet(log), "status")]
    assert (states.count("STARTED"), states.count("COMPLETED"), states.count("FAILED")) == (7, 4, 3)


def test_ranges_of_all_widths(spark):
    rng, at, spans = random.Random(1), 0, []
    for width in [1] * 300 + [2**40, 3, 2**33, 70_000, 16, 17, 255, 2**20, 1]:
        at += rng.choice([1, 1, 5])
        spans.append((at, at + width - 1, f"r{at}"))
        at += width
    numbers = sorted({x for lo, hi, _ in spans for x in (lo - 1, lo, (lo + hi) // 2, hi, hi + 1)}) + [-5, at + 10**15]
    ranges = spark.createDataFrame(spans, "lo long, hi long, name string")
    assert lookup.range_blocks(ranges).groupBy("lo").count().agg(F.max("count")).first()[0] <= 3
    got = lookup.range_lookup(spark.createDataFrame([(n,) for n in [*numbers, None]], "n long"), "n", ranges)
    want = {n: next((name for lo, hi, name in spans if lo <= n <= hi), None) for n in numbers} | {None: None}
    assert {r["n"]: r["name"] for r in got.collect()} == want
    assert lookup.overlapping_ranges(ranges).isEmpty()
    over = ranges.unionByName(spark.createDataFrame([(spans[300][0] + 9, spans[300][0] + 10, "in"), (spans[0][0], spans[0][0], "again")], ranges.schema))
    assert {"in"} < {r["name"] for r in lookup.overlapping_ranges(over).collect()} == {"in", "again", spans[0][2]}


@pytest.fixture
def plain_shuffles(spark):
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def largest_share(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes) / sum(sizes)


def test_hot_keys_are_spread(spark, plain_shuffles):
    df = spark.range(60_000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("k"))
    assert largest_share(running.group_count(df, ["k"], "n")) < 0.25
    numbered = running.global_row_number(df, ["k"], [F.col("id").asc()], "n")
    assert largest_share(numbered) < 0.25
    assert numbered.agg(F.countDistinct("n"), F.max("n")).first()[:] == (60_000, 60_000)
    again = numbered.orderBy("n").limit(2).collect()
    assert [r["id"] for r in again] == [0, 3]
