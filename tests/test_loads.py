from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import rows
from tidemark.operators import loads
from tidemark.operators.latest import at_max_per_group, latest_per_key

T = "id long, v string, at timestamp_ntz"


def ts(n):
    return datetime(2024, 1, 1, 0, 0, n)


def frame(spark, data):
    return spark.createDataFrame(data, T)


ROW = st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.sampled_from(["a", "b", None]), st.integers(0, 30).map(ts))
TARGET = st.lists(ROW, max_size=6, unique_by=lambda r: r[0])
SOURCE = st.lists(ROW, max_size=8, unique_by=lambda r: (r[0], r[2]))
FEW = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def expected_merge(target, source):
    newest = {}
    for r in source:
        if r[0] is not None and (r[0] not in newest or r[2] > newest[r[0]][2]):
            newest[r[0]] = r
    out = [newest.pop(r[0]) if r[0] in newest and r[0] is not None else r for r in target]
    return sorted(out + list(newest.values()) + [r for r in source if r[0] is None], key=repr)


@FEW
@given(TARGET, SOURCE)
def test_merge_equals_model_under_both_plans(spark, target, source):
    t, s = frame(spark, target), frame(spark, source)
    for plan in ("full_outer", "lookup"):
        assert rows(loads.merge(t, s, "id", newest_by=["at"], plan=plan)) == expected_merge(target, source)


@FEW
@given(TARGET, SOURCE)
def test_merge_twice_is_merge_once(spark, target, source):
    keyed = [r for r in source if r[0] is not None]
    t, s = frame(spark, target), frame(spark, keyed)
    once = loads.merge(t, s, "id", newest_by=["at"])
    assert rows(loads.merge(once, s, "id", newest_by=["at"])) == rows(once)


@FEW
@given(TARGET, SOURCE)
def test_insert_only_never_alters_a_row(spark, target, source):
    out = rows(loads.insert_only(frame(spark, target), frame(spark, source), "id", newest_by=["at"]))
    for r in target:
        assert tuple(r) in out
    known = {r[0] for r in target if r[0] is not None}
    assert len([r for r in out if r[0] in known]) == len(known)
    assert len({r[0] for r in out if r[0] is not None}) == len([r for r in out if r[0] is not None])


def test_nulls_overwrite_and_defaults_stay(spark):
    t = spark.createDataFrame([(1, "a", "x")], "id long, v string, dw string")
    s = spark.createDataFrame([(1, None), (2, "n")], "id long, v string")
    assert rows(loads.merge(t, s, "id", defaults=["dw"])) == [(1, None, "x"), (2, "n", None)]


def test_two_column_key(spark):
    t = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k long, j long, v string")
    s = spark.createDataFrame([(1, 2, "B"), (2, 2, "c")], "k long, j long, v string")
    for plan in ("full_outer", "lookup"):
        assert rows(loads.merge(t, s, ["k", "j"], plan=plan)) == [(1, 1, "a"), (1, 2, "B"), (2, 2, "c")]


def test_conditional_upsert_needs_the_old_row_to_match(spark):
    t = spark.createDataFrame([(1, "P", 1, 1), (2, "Q", 2, 2), (3, None, 3, 3)], "id long, name string, a int, b int")
    s = spark.createDataFrame([(1, "Z", 10, 10), (2, "Z", 20, 20), (3, "Z", 30, 30), (4, "Z", 40, 40)], "id long, name string, a int, b int")
    for plan in ("full_outer", "lookup"):
        out = loads.conditional_upsert(t, s, "id", ["a"], "name = 'P'", plan=plan)
        assert rows(out) == [(1, "P", 10, 1), (2, "Q", 2, 2), (3, None, 3, 3), (4, "Z", 40, 40)]


def test_unknown_method_and_plan_are_refused(spark):
    t = frame(spark, [(1, "a", ts(0))])
    with pytest.raises(ValueError):
        loads.load("append", t, t, "id")
    with pytest.raises(ValueError):
        loads.merge(t, t, "id", plan="magic")


def test_overwrite_window_twice_is_once_and_keeps_rows_without_time(spark):
    t = frame(spark, [(1, "a", ts(1)), (2, "b", ts(5)), (3, "c", None), (4, "d", ts(3))])
    s = frame(spark, [(9, "n", ts(4)), (8, "out", ts(20)), (7, "start", ts(1))])
    once = loads.overwrite_window(t, s, "at", ts(1), ts(5))
    assert rows(once) == rows(frame(spark, [(1, "a", ts(1)), (3, "c", None), (9, "n", ts(4))]))
    assert rows(loads.overwrite_window(once, s, "at", ts(1), ts(5))) == rows(once)


def test_dedupe_keeps_one_of_equal_copies_and_old_rows(spark):
    d = frame(spark, [(1, "a", ts(5)), (1, "b", ts(5)), (1, "old", ts(1)), (2, "c", ts(6)), (None, "n", ts(6)), (None, "m", ts(6))])
    out = loads.dedupe_recent(d, "id", "at", ts(4), ["v"])
    assert rows(out) == rows(frame(spark, [(1, "b", ts(5)), (1, "old", ts(1)), (2, "c", ts(6)), (None, "n", ts(6)), (None, "m", ts(6))]))


def test_empty_target_looks_back_to_1970(spark):
    empty = frame(spark, []).withColumnRenamed("at", "updated_at")
    for period in ("1 hour", "14 days"):
        assert loads.watermark_with_lookback(empty, "updated_at", period, ts(0)).first()[0] == datetime(1970, 1, 1)
    assert loads.hour_lookback(empty, "updated_at").first()[0] == datetime(1970, 1, 1)


def test_look_back_mode_can_be_chosen(spark):
    t = frame(spark, [(1, "a", datetime(2024, 1, 10))]).withColumnRenamed("at", "updated_at")
    now = datetime(2024, 1, 20)
    assert loads.watermark_with_lookback(t, "updated_at", "1 day", now).first()[0] == datetime(2024, 1, 9)
    assert loads.watermark_with_lookback(t, "updated_at", "14 days", now).first()[0] == datetime(2024, 1, 6)
    assert loads.watermark_with_lookback(t, "updated_at", "14 days", now, "max").first()[0] == datetime(2023, 12, 27)


def test_latest_and_maximum(spark):
    d = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("k", 2, "c"), (None, 1, "d"), ("z", None, "e"), ("z", 5, "f")], "k string, n int, v string")
    assert rows(latest_per_key(d, "k", ["n", "v"])) == rows(spark.createDataFrame([("k", 2, "c"), (None, 1, "d"), ("z", None, "e")], d.schema))
    assert rows(at_max_per_group(d, "k", "n")) == rows(spark.createDataFrame([("k", 2, "b"), ("k", 2, "c"), (None, 1, "d"), ("z", 5, "f")], d.schema))
