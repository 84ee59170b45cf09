from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import rows
from tidemark.sources import batches as b

FEW = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))


def numbers(spark, values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "f long, i long")


def model(values, mark, cap):
    """Rows of the next batch by sorting: complete values only, or the whole first value."""
    left = sorted(v for v in values if v is not None and (mark is None or v > mark))
    if len(left) <= cap:
        return left
    edge = left[cap]
    whole = [v for v in left if v < edge]
    return whole or [v for v in left if v == edge]


@FEW
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50), st.integers(-10**12, 10**12)), max_size=30), st.integers(1, 8))
def test_batch_equals_model(spark, values, cap):
    df = numbers(spark, values)
    got = sorted(r[0] for r in b.incremental_extract(df, "f", None, cap).collect())
    assert got == model(values, None, cap)


@FEW
@given(st.lists(st.integers(0, 6), min_size=1, max_size=25), st.integers(1, 6))
def test_batches_cover_every_row_once(spark, values, cap):
    seen = [r[1] for part in b.batches(numbers(spark, values), "f", cap) for r in part.collect()]
    assert sorted(seen) == list(range(len(values)))


def test_a_group_larger_than_the_cap_is_one_batch(spark):
    parts = [sorted(r[0] for r in p.collect()) for p in b.batches(numbers(spark, [1, 1, 1, 1, 2, 3]), "f", 2)]
    assert parts == [[1, 1, 1, 1], [2, 3]]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_time_fields(spark, kind):
    start = date(2024, 3, 1) if kind == "date" else datetime(2024, 3, 1, 1, 2, 3, 456789)
    step = timedelta(days=1) if kind == "date" else timedelta(microseconds=1)
    df = spark.createDataFrame([(start + step * n, n) for n in range(10)], f"f {kind}, i int")
    got = sorted(r[1] for r in b.incremental_extract(df, "f", start + step * 2, 4).collect())
    assert got == [3, 4, 5, 6]


def test_high_volume_leaves_out_the_open_minute(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([(t + timedelta(seconds=20 * n), n) for n in range(30)], "f timestamp_ntz, i int")
    got = sorted(r[1] for r in b.incremental_extract(df, "f", None, 20, volume="high").collect())
    assert got == [n for n in range(30) if 20 * n < 300]  # the 20th row is at 00:06:20


def test_high_volume_moves_on_when_all_rows_are_within_two_minutes(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([(t + timedelta(seconds=n), n) for n in range(30)], "f timestamp_ntz, i int")
    assert b.incremental_extract(df, "f", None, 10, volume="high").count() == 10


def test_high_volume_on_a_number_is_the_plain_batch(spark):
    assert rows(b.incremental_extract(numbers(spark, [1, 2, 3, 4]), "f", 1, 2, volume="high"), "f") == [(2,), (3,)]


def test_condition_holds_in_every_mode(spark):
    df = numbers(spark, [1, 2, 3, 4])
    assert rows(b.incremental_extract(df, None, condition="f > 2"), "f") == [(3,), (4,)]
    assert rows(b.incremental_extract(df, "f", 0, 2, condition="f <> 2"), "f") == [(1,), (3,)]


def test_unsupported_order_field(spark):
    df = spark.createDataFrame([("a",), ("b",)], "f string")
    with pytest.raises(TypeError):
        b.incremental_extract(df, "f", None, 1)
