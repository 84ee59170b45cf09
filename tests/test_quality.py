from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import rows
from tidemark.operators import gaps, reconcile, running
from pyspark.sql import functions as F

FEW = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
DAY = datetime(2024, 1, 1, 22)


@FEW
@given(st.lists(st.tuples(st.sampled_from(["a", "PAYMENTS_PAYMENTS"]), st.integers(0, 40000)), max_size=25))
def test_gaps_equal_sorted_scan(spark, points):
    df = spark.createDataFrame([(f, DAY + timedelta(seconds=s / 2)) for f, s in points], "feed string, ts timestamp_ntz")
    want = []
    for feed, limit in (("a", 300), ("PAYMENTS_PAYMENTS", 14400)):
        times = sorted((DAY + timedelta(seconds=s // 2)) for f, s in points if f == feed)
        want += [(feed, x, y, int((y - x).total_seconds())) for x, y in zip(times, times[1:]) if (y - x).total_seconds() > limit]
    assert rows(gaps.find_gaps(df, "feed", "ts")) == sorted(want, key=repr)


def test_gap_across_midnight_counts_for_the_day_it_starts(spark):
    df = spark.createDataFrame([("a", datetime(2024, 1, 1, 23, 50)), ("a", datetime(2024, 1, 3, 0, 10)), ("a", datetime(2024, 1, 3, 0, 11))], "feed string, ts timestamp_ntz")
    s = gaps.gap_summary(gaps.find_gaps(df, "feed", "ts")).collect()
    assert len(s) == 1 and str(s[0]["day"]) == "2024-01-01" and s[0]["span_seconds"] == 24 * 3600 + 20 * 60


def test_value_difference_is_two_sided_distinct_and_null_safe(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y"), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "z"), (2, "z")], "k int, v string")
    assert rows(reconcile.value_difference(a, b, ["k", "v"])) == [(2, "x", "source"), (2, "z", "target"), (3, "y", "source")]


def test_counts_of_empty_tables(spark):
    e = spark.createDataFrame([], "k int")
    assert rows(reconcile.count_difference(e, spark.range(3).toDF("k"), "t")) == [("t", 0, 3, -3)]


def test_window_of_the_catalog_check(spark):
    low, high = reconcile.check_window("2024-05-06 07:08:09", 1)
    assert tuple(spark.range(1).select(low, high).first()) == (datetime(2023, 1, 1), datetime(2024, 5, 6, 5))


@FEW
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 100)), max_size=20, unique=True))
def test_global_row_number(spark, data):
    df = spark.createDataFrame(data, "k int, v int")
    got = sorted((r["n"], r["k"], r["v"]) for r in running.global_row_number(df, ["k"], [F.col("v")], "n").collect())
    want = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [(k, v) for _, k, v in got] == want and [n for n, *_ in got] == list(range(1, len(want) + 1))


def test_group_count_of_null_key_is_zero(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int")
    assert rows(running.group_count(df, ["k"], "n"), "v", "n") == [(1, 2), (2, 2), (3, 0)]


def test_total_row_keeps_a_null_key_apart(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    assert rows(running.with_total_row(df, "k", [F.sum("v").alias("v")]), "k", "v") == [("Total", 3), ("a", 1), (None, 2)]
