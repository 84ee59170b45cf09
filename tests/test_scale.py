"""Large groups, many pages, streams that repeat themselves, stored maps, checksums, footers, networks."""

import ipaddress
import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_writes import largest_share, plain_shuffles  # noqa: F401
from tidemark.catalog.domain import Domain
from tidemark.functions import pii
from tidemark.operators import lookup, reconcile, running
from tidemark.plans.threeds import authentication_funnel
from tidemark.sources import batches as b
from tidemark.streaming import ingest

FEW = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- groups -----------------------------------------------------------------------------

@FEW
@given(st.lists(st.tuples(st.sampled_from([None, "a", "b", "c"]), st.one_of(st.none(), st.integers(-99, 99))), max_size=60))
def test_running_totals_equal_the_window(spark, items):
    df = spark.createDataFrame([(g, i, v) for i, (g, v) in enumerate(items)], "g string, i long, v long").repartition(5)
    want = running.running_share(df, ["g"], ["i"], "v")
    got = running.running_totals(df, ["g"], ["i"], "v")
    assert rows(got, "i", "running_total", "group_total", "running_ratio") == rows(want, "i", "running_total", "group_total", "running_ratio")


def test_one_group_of_a_million_rows_is_summed_by_many_tasks(spark, plain_shuffles):  # noqa: F811
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    df = spark.range(1_000_000).select(F.lit("one").alias("g"), F.col("id"), (F.col("id") % 7).cast("decimal(18,2)").alias("v"))
    out = running.running_totals(df, ["g"], ["id"], "v")
    assert largest_share(out) < 0.1
    total = sum(i % 7 for i in range(1_000_000))
    last = out.agg(F.max("running_total"), F.min("group_total"), F.max("group_total"), F.count("*")).first()
    assert tuple(last) == (Decimal(total), Decimal(total), Decimal(total), 1_000_000)
    some = {r["id"]: int(r["running_total"]) for r in out.filter("id in (0, 5, 499999, 999998)").collect()}
    assert some == {i: sum(x % 7 for x in range(i + 1)) for i in (0, 5, 499_999, 999_998)}


def test_only_heavy_groups_are_repeated(spark, plain_shuffles):  # noqa: F811
    df = spark.range(40_000).select("id", F.when(F.col("id") % 2 == 0, F.lit(-1)).when(F.col("id") % 5 > 0, F.col("id")).alias("k"))
    got = running.with_group_values(df, ["k"], [F.max("id").alias("top")])
    assert largest_share(got) < 0.2
    assert got.filter("k = -1").agg(F.min("top"), F.count("*")).first()[:] == (39_998, 20_000)
    assert got.filter("k is null").agg(F.count("top"), F.count("*")).first()[:] == (0, 4_000)
    assert got.filter("k <> -1 and top <> id").isEmpty() and got.count() == 40_000
    plan = plan_of(running.group_count(df.filter("k <> -1"), ["k"], "n"))
    assert "Generate explode" not in plan and "__salt" not in plan


# --- pages ------------------------------------------------------------------------------

def pages_of(values, cap):
    """Pages by counting off: a value belongs to the page of its last row; one over the cap is divided after its first value."""
    held, seen = {}, 0
    for v in sorted(set(values)):
        seen += values.count(v)
        held.setdefault((seen - 1) // cap, []).append(v)
    out = []
    for vs in held.values():
        long = sum(values.count(v) for v in vs) > cap and len(vs) > 1
        out += [vs[:1], vs[1:]] if long else [vs]
    return [sorted(x for x in values if x in vs) for vs in out]


@FEW
@given(st.lists(st.one_of(st.integers(0, 6), st.integers(-10**15, 10**15)), min_size=1, max_size=40), st.integers(1, 9))
def test_pages_are_whole_and_within_the_cap(spark, values, cap):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "f long")
    got = [sorted(r[0] for r in p.collect()) for p in b.batches(df, "f", cap)]
    assert got == pages_of(values, cap)
    assert all(len(p) <= cap or len(set(p)) == 1 for p in got)


def test_the_number_of_jobs_does_not_grow_with_the_pages(spark):
    start = datetime(2024, 1, 1)
    df = spark.createDataFrame([(start + timedelta(microseconds=i * i * 1009),) for i in range(3000)], "at timestamp_ntz")
    tracker = spark.sparkContext.statusTracker()
    used = {}
    for cap in (1500, 10):
        name = f"pages {cap}"
        spark.sparkContext.setJobGroup(name, name)
        starts = b.page_starts(df, "at", cap)
        used[cap] = len(tracker.getJobIdsForGroup(name))
        assert len(starts) == 3000 // cap
    spark.sparkContext.setJobGroup("", "")
    assert used[10] <= used[1500] + 2 and used[10] < 30


def test_the_first_pages_do_not_wait_for_the_others(spark, monkeypatch):
    df = spark.range(4000).select((F.col("id") * 7919 % 4000).alias("f"))
    asked = []
    known = b.value_of
    monkeypatch.setattr(b, "value_of", lambda *a: asked.append(a[-1]) or known(*a))
    pages = b.batches(df, "f", 4)
    firsts = [next(pages).agg(F.min("f"), F.count("f")).first()[:] for _ in range(3)]
    assert firsts == [(0, 4), (4, 4), (8, 4)] and len(asked) < 10


@pytest.mark.parametrize("values", [[5] * 40, [1, 2] + [5] * 40 + [6, 7, 8], [i // 7 for i in range(90)], [1] * 9 + list(range(2, 30)), list(range(50))])
def test_lots_of_pages_found_one_after_another_are_the_pages(spark, monkeypatch, values):
    monkeypatch.setattr(b, "_AHEAD", 2)
    monkeypatch.setattr(b, "_MOST_AHEAD", 3)
    df = spark.createDataFrame([(v,) for v in values], "f long").coalesce(1)
    assert [sorted(r[0] for r in p.collect()) for p in b.batches(df, "f", 4)] == pages_of(values, 4)


# --- streams ----------------------------------------------------------------------------

SHAPE = "event_id long, v string, dw_created_at timestamp_ntz, day string"


def events(spark, *items):
    return spark.createDataFrame([(i, v, datetime(2024, 1, d), f"2024-01-{d:02d}") for i, v, d in items], SHAPE)


def test_a_repeated_micro_batch_changes_nothing_and_the_newest_copy_stays(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    put = lambda n, *items: ingest.merge_batch(events(spark, *items), n, path, "event_id", ["dw_created_at"], "day")
    now = lambda: rows(spark.read.parquet(path), "event_id", "v")
    assert put(0) and put(1, (1, "a", 2), (1, "older", 1), (None, "no id", 1))
    assert not put(1, (1, "a", 2), (None, "no id", 1)) and now() == [(1, "a"), (None, "no id")]
    assert put(2, (1, "late", 1), (2, "b", 3)) and now() == [(1, "a"), (2, "b"), (None, "no id")]
    assert put(3, (1, "new", 9)) and now() == [(1, "new"), (2, "b"), (None, "no id")]

    class Stopped(Exception):
        pass

    def stop(*_):
        raise Stopped

    with monkeypatch.context() as m:
        m.setattr("tidemark.sinks.tables.overwrite_partitions", stop)
        with pytest.raises(Stopped):
            put(4, (2, "B", 8), (None, "no id either", 2))
    assert not put(4, (2, "B", 8), (None, "no id either", 2))  # finished, not done again
    assert now() == [(1, "new"), (2, "B"), (None, "no id either"), (None, "no id")] or sorted(now(), key=repr) == sorted([(1, "new"), (2, "B"), (None, "no id"), (None, "no id either")], key=repr)


def test_a_stream_goes_on_where_it_stopped(spark, tmp_path):
    def load(*items):
        events(spark, *items).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        shape = spark.read.schema(SHAPE).parquet(f"{tmp_path}/in").schema
        stream = ingest.event_stream(spark, f"{tmp_path}/in", shape, files_per_trigger=1).drop("source_file")
        ingest.ingest_newest(stream, f"{tmp_path}/t", f"{tmp_path}/state").awaitTermination()
        return rows(spark.read.parquet(f"{tmp_path}/t"), "event_id", "v")

    assert load((1, "a", 1), (2, "b", 2)) == [(1, "a"), (2, "b")]
    assert load((2, "B", 5), (1, "old", 1)) in ([(1, "a"), (2, "B")], [(1, "old"), (2, "B")])  # equal times are interchangeable
    assert load((3, "c", 1))[2:] == [(3, "c")]


# --- stored tokens ------------------------------------------------------------------------

def exchanges_above(plan, relation):
    """Exchanges between the root and the scan of a relation, by the plan's indentation."""
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if relation in x and "Scan" in x)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-*()0123456789"))
    found = 0
    for x in reversed(lines[:at]):
        d = len(x) - len(x.lstrip(" :+-*()0123456789"))
        if d < depth:
            found, depth = found + ("Exchange" in x), d
    return found


def test_the_stored_map_is_not_shuffled(spark, plain_shuffles):  # noqa: F811
    spark.sql("DROP TABLE IF EXISTS tokens")
    mails = spark.range(500).select(F.concat(F.lit("u"), F.col("id") % 50, F.lit("@x")).alias("m"), "id")
    first = pii.extend_stored_map(mails.filter("id % 50 < 20"), "m", "tokens", "one", buckets=16)
    assert first.count() == 20
    both = pii.extend_stored_map(mails, "m", "tokens", "two", buckets=16)
    assert both.count() == 50 and both.filter(F.col("token") == pii.email_token("email", "one")).count() == 20
    for df in (pii.apply_tokens(mails, spark.table("tokens"), "m"), pii.new_tokens(spark.table("tokens"), mails, "m", "x")):
        plan = plan_of(df)
        assert "tokens" in plan and exchanges_above(plan, "tokens") == 0, plan
    assert pii.apply_tokens(mails, both, "m").filter("m like '%@%'").isEmpty()


# --- reconciliation -------------------------------------------------------------------------

@FEW
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-10**6, 10**6)), st.sampled_from(["x", "y", None])), max_size=30), st.integers(0, 3), st.sampled_from([2, 7, 1024]))
def test_differences_by_ranges_equal_plain_ones(spark, items, changes, ranges):
    other = [(k, v) if i >= changes else (k, "z") for i, (k, v) in enumerate(items)]
    s, t = (spark.createDataFrame(x, "k long, v string") for x in (items, other[::-1]))
    got = reconcile.value_difference_by_ranges(s, t, "k", ["k", "v"], ranges=ranges)
    assert rows(got) == rows(reconcile.value_difference(s, t, ["k", "v"]))


def test_equal_tables_exchange_no_rows_and_others_only_what_differs(spark):
    df = spark.range(100_000).select("id", (F.col("id") * 3).alias("v"), F.when(F.col("id") % 2 == 0, "e").alias("w"))
    assert reconcile.differing_places(df, df.orderBy(F.desc("id")), "id", ["id", "v", "w"])[2:] == ([], False)
    assert reconcile.value_difference_by_ranges(df, df, "id", ["id", "v", "w"]).isEmpty()
    changed = df.withColumn("v", F.when(F.col("id").isin(777, 90_000), -1).otherwise(F.col("v"))).filter("id <> 5")
    base, width, places, nulls = reconcile.differing_places(df, changed, "id", ["id", "v", "w"])
    assert len(places) * width < 100 and not nulls and {(x - base) // width for x in (5, 777, 90_000)} == set(places)
    assert len(rows(reconcile.value_difference_by_ranges(df, changed, "id", ["id", "v", "w"]))) == 5
    swapped = df.select("id", F.when(F.col("id") != 9, F.col("v")).alias("v"), F.when(F.col("id") == 9, "27").otherwise(F.col("w")).alias("w"))
    assert reconcile.differing_places(df, swapped, "id", ["id", "v", "w"])[2] != []


def test_stored_rows_are_counted_by_their_footers(spark, tmp_path):
    df = spark.range(1000).select("id", F.concat(F.lit("d"), F.col("id") % 4).alias("day"))
    df.write.partitionBy("day").parquet(f"{tmp_path}/a")
    df.filter("id < 900").write.partitionBy("day").parquet(f"{tmp_path}/b")
    for where, n in ((None, 1000), ("day = 'd1'", 250), ("day in ('d1', 'd2')", 500)):
        counted = reconcile.stored_count(spark, f"{tmp_path}/a", where)
        assert "PushedAggregation: [COUNT(*)]" in plan_of(counted).replace("COUNT(1)", "COUNT(*)") and counted.first()[0] == n
    assert reconcile.stored_count(spark, f"{tmp_path}/a", "id < 10").first()[0] == 10
    assert rows(reconcile.stored_count_check(spark, {"t": (f"{tmp_path}/a", f"{tmp_path}/b")}, "day <> 'd0'")) == [("t", 750, 675, 75)]
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


# --- networks -------------------------------------------------------------------------------

def spellings(rng):
    a = ipaddress.ip_address(rng.getrandbits(128) if rng.random() < 0.5 else rng.getrandbits(24) << rng.choice([0, 40, 100]))
    return rng.choice([str(a), a.exploded, a.compressed.upper()])


def bits_of(text):
    try:
        a = ipaddress.ip_address(text)
    except ValueError:
        return None
    if "%" in text:
        return None
    if a.version == 6 and a.ipv4_mapped:
        a = a.ipv4_mapped
    return format(int(a), f"0{a.max_prefixlen}b")


def test_addresses_are_read_as_the_standard_says(spark):
    rng = random.Random(3)
    texts = [spellings(rng) for _ in range(300)] + [
        "::", "::1", "1::", "::ffff:1.2.3.4", "::1.2.3.4", "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "10.0.0.1", "255.255.255.255", "0.0.0.0",
        "1::2::3", ":::", "1:2:3", "1:2:3:4:5:6:7:8:9", "1:2:3:4:5:6:7:8::", "12345::", "g::", ":1", "1:", "", " ::1", "fe80::1%eth0", "1.2.3", "256.1.1.1", "1.2.3.4::", "::1.2.3", "1:2:3:4:5:6:7:1.2.3.4", None, "x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").distinct()
    got = {r[0]: r[1] for r in df.select("t", lookup.address_bits("t")).collect()}
    assert got == {t: None if t is None else bits_of(t) for t in texts}


def test_the_longest_network_counts(spark):
    rng = random.Random(4)
    nets = {}
    for n in range(120):
        v6 = rng.random() < 0.6
        length = rng.choice([0, 8, 19, 32, 33, 48, 64, 127, 128] if v6 else [0, 8, 11, 24, 31, 32])
        base = (0x20010DB8 << 96 | rng.getrandbits(6) << 90 | rng.getrandbits(20)) if v6 else (10 << 24 | rng.getrandbits(20))
        net = ipaddress.ip_network((base, length), strict=False)
        nets.setdefault(net, f"p{n:03d}")
    table = [(f"{n.network_address}/{n.prefixlen}", p) for n, p in nets.items()] + [("10.0.0.0/8", "zz"), ("10.0.0.0/33", "bad"), ("::/129", "bad"), ("x/3", "bad"), ("1.2.3.4", "bad"), (None, "bad")]
    ips = [str(ipaddress.ip_address(int(n.network_address) + rng.randrange(min(n.num_addresses, 1 << 40)))) for n in nets for _ in range(3)] + ["11.0.0.1", "bad", None, "::ffff:10.0.0.1"]
    facts = spark.createDataFrame([(i, t) for i, t in enumerate(ips)], "i long, ip string")
    got = {r["i"]: r["place"] for r in lookup.network_place(facts, "ip", spark.createDataFrame(table, "network string, place string"), ["place"]).collect()}
    for i, t in enumerate(ips):
        bits = bits_of(t) if t else None
        best = None
        if bits:
            a = ipaddress.ip_address(int(bits, 2)) if len(bits) == 128 else ipaddress.IPv4Address(int(bits, 2))
            a = ipaddress.IPv6Address(int(bits, 2)) if len(bits) == 128 else a
            held = [(n.prefixlen, p) for n, p in nets.items() if n.version == a.version and a in n]
            best = max(held)[1] if held else ("zz" if a.version == 4 and a in ipaddress.ip_network("10.0.0.0/8") else None)
            if held and max(held)[0] < 8 and a.version == 4 and a in ipaddress.ip_network("10.0.0.0/8"):
                best = "zz"
        assert got[i] == best, (t, got[i], best)
    assert len(got) == len(ips)
    assert lookup.network_place(facts, "ip", spark.createDataFrame([], "network string, place string"), ["place"]).filter("place is null").count() == len(ips)


# --- narrow exchanges, index by key -------------------------------------------------------

def test_json_is_read_before_the_rows_of_cases_are_joined(spark):
    from tidemark.catalog.domain import Domain
    from tidemark.plans import chargebacks as cb
    from tests.conftest import SMALL

    def joins(plan):
        if plan.nodeName() == "Join":
            yield plan.output().mkString(",")
        for i in range(plan.children().size()):
            yield from joins(plan.children().apply(i))

    t = Domain(spark, SMALL)
    cases = cb.identity_cases(t, "2001-12-01", 4000)
    peers = spark.createDataFrame([(1, "h")], "payment_id long, txn_hash string")
    for df in (cases, cb.avs_answers(t, peers), cb.answered_eci(t, peers), cb.authentication_evidence(t, peers), cb._ip_features(t, peers)):
        found = list(joins(df._jdf.queryExecution().optimizedPlan()))
        assert found and not any(name in x for x in found for name in ("raw_response", "threeds#", "data#"))


def test_the_index_is_written_by_more_tasks_than_it_has_slots(spark, tmp_path, plain_shuffles):  # noqa: F811
    from tidemark.sinks.keyindex import KeyIndex

    index = KeyIndex(spark, str(tmp_path / "table"), "id", "day", slots=2)
    rows = spark.range(5000).selectExpr("id", "'d' || id % 3 AS day")
    index.done(index.note(rows))
    assert min(len(list(p.glob("*.parquet"))) for p in (tmp_path / "table__keys" / "segment=1").glob("__slot=*")) > 4
    assert index.misplaced(rows).isEmpty()


# --- authentication funnel --------------------------------------------------------------

def _orders(spark, folder, keys):
    spark.createDataFrame([(k, k % 50, "F", 10.0, datetime(1996, 1, 1)) for k in keys],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz").write.parquet(f"{folder}/orders.parquet")
    return Domain(spark, str(folder))


def test_the_funnel_reads_its_requests_once(spark, tmp_path):
    df = authentication_funnel(_orders(spark, tmp_path, range(200)), "1995-06-01")
    assert plan_of(df).count("json_tuple(request_data") == 1
    assert df.where("threeds_id is null").count() > 20 < df.where("threeds_id is not null").count()


def test_requests_without_an_authentication_are_spread(spark, plain_shuffles, tmp_path):  # noqa: F811
    df = authentication_funnel(_orders(spark, tmp_path, range(4, 20_000, 5)), "1995-06-01")  # no such order has a link
    assert df.where("threeds_id is not null").isEmpty()
    assert largest_share(df) < 0.2
