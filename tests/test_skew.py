"""One key holding a third of the rows changes no result."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import gaps, loads, lookup, reconcile, running
from tidemark.operators.latest import latest_per_key

N = 3000
T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def facts(spark):
    """Row i has key 0 for every third i, else its own small key."""
    data = [(i, 0 if i % 3 == 0 else i % 97 + 1, T0 + timedelta(seconds=7 * i)) for i in range(N)]
    return spark.createDataFrame(data, "i long, k long, at timestamp_ntz").repartition(8), data


def test_keep_latest(facts):
    df, data = facts
    best = {}
    for i, k, _ in data:
        best[k] = max(best.get(k, -1), i)
    assert sorted((r["k"], r["i"]) for r in latest_per_key(df, "k", ["at", "i"]).collect()) == sorted(best.items())


def test_group_count_and_numbering(facts):
    df, data = facts
    hot = sum(k == 0 for _, k, _ in data)
    counted = running.group_count(df, ["k"], "n")
    assert counted.count() == N and counted.filter("k = 0").select("n").distinct().collect()[0][0] == hot
    numbers = sorted(r["n"] for r in running.global_row_number(df, ["k"], [F.col("i")], "n").collect())
    assert numbers == list(range(1, N + 1))


def test_merge_with_a_hot_key_in_the_batch(facts):
    df, data = facts
    target = df.sparkSession.createDataFrame([(0, -1), (500, -1)], "k long, i long")
    batch = df.select("k", "i")
    for plan in ("full_outer", "lookup"):
        out = {r["k"]: r["i"] for r in loads.merge(target, batch, "k", newest_by=["i"], plan=plan).collect()}
        assert out[0] == N - 3 and out[500] == -1 and len(out) == 99


def test_duplicates_and_differences(facts):
    df, _ = facts
    dup = reconcile.duplicate_keys(df, "k", "at", T0).filter("k = 0").first()
    assert dup["copies"] == N // 3
    assert reconcile.value_difference(df.select("k"), df.select("k").distinct(), ["k"]).count() == 0


def test_lookup_of_one_busy_address(spark, facts):
    df, _ = facts
    ips = df.withColumn("ip", F.concat_ws(".", F.lit("10.0"), F.col("k").cast("string"), F.lit("1")))
    ranges = spark.createDataFrame([(167772160, 167772160 + 255, "HOT")], "lo long, hi long, place string")
    placed = lookup.ip_place(ips, "ip", ranges, ["place"])
    assert placed.count() == N and placed.filter("place = 'HOT'").count() == N // 3


def test_salt_spreads_the_hot_key(spark, facts):
    df, _ = facts
    names = spark.createDataFrame([(0, "hot"), (1, "one")], "k long, name string")
    assert rows(lookup.salted_join(df, names, ["k"], "left", 8, ["i"]), "i", "name") == rows(df.join(names, "k", "left"), "i", "name")


def test_lookup_rows_of_other_keys_are_not_repeated(spark, facts):
    df, _ = facts
    names = spark.range(500).selectExpr("id AS k", "'n' || id AS name")
    joined = lookup.salted_join(df, names, ["k"], "inner", 8, ["i"])
    assert joined.count() == N
    joined.collect()
    node, repeated = joined._jdf.queryExecution().executedPlan().toString(), []

    def generated(plan):
        if plan.nodeName().startswith("Generate"):
            repeated.append(plan.metrics().apply("numOutputRows").value())
        inner = plan.finalPhysicalPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan.plan() if "QueryStage" in plan.nodeName() else None
        for child in [inner] if inner is not None else [plan.children().apply(i) for i in range(plan.children().size())]:
            generated(child)

    generated(joined._jdf.queryExecution().executedPlan())
    assert repeated and sum(repeated) == 500 + 7, node


def test_gaps_of_a_busy_feed(spark, facts):
    df, _ = facts
    feed = df.filter("i < 1000 or i > 1100").withColumn("feed", F.when(F.col("k") == 0, "hot").otherwise("rest"))
    kept = [i for i in range(N) if i < 1000 or i > 1100]
    want = []
    for name, mine in (("hot", [i for i in kept if i % 3 == 0]), ("rest", [i for i in kept if i % 3])):
        want += [(name, 7 * (b - a)) for a, b in zip(mine, mine[1:]) if 7 * (b - a) > 300]
    found = gaps.find_gaps(feed, "feed", "at", {}, 300).select("feed", "gap_seconds").collect()
    assert sorted(tuple(r) for r in found) == sorted(want)
