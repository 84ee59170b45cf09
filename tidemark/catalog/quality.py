"""Gaps and reconciliation over events and orders."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.loads import DUPLICATED, NOW, loaded_events
from tidemark.catalog.registry import register, table
from tidemark.functions.jsonops import text_at
from tidemark.functions.temporal import ntz
from tidemark.operators import gaps, reconcile
from tidemark.session import shared_folder

THRESHOLDS = {"click": 900, "error": 1800, "signup": 4200}

GAPS = """marks AS (SELECT event_type AS feed, date_trunc('second', ts) AS t,
    CASE event_type WHEN 'click' THEN 900 WHEN 'error' THEN 1800 WHEN 'signup' THEN 4200 ELSE 300 END AS lim FROM events),
  steps AS (SELECT feed, lim, lag(t) OVER (PARTITION BY feed ORDER BY t) AS gap_start, t AS gap_end FROM marks),
  gaps AS (SELECT feed, gap_start, gap_end, date_diff('second', gap_start, gap_end) AS gap_seconds FROM steps
    WHERE date_diff('second', gap_start, gap_end) > lim)"""


@register("feed_gaps", f"WITH {GAPS} SELECT * FROM gaps")
def feed_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return gaps.find_gaps(table(spark, sf, "events"), "event_type", "ts", THRESHOLDS)


@register("feed_gap_summary", f"""
WITH {GAPS} SELECT feed, CAST(gap_start AS DATE) AS day, count(*) AS gaps, max(gap_seconds) AS longest_seconds,
  min(gap_start) AS first_start, max(gap_end) AS last_end, date_diff('second', min(gap_start), max(gap_end)) AS span_seconds
FROM gaps GROUP BY 1, 2""")
def feed_gap_summary(spark: SparkSession, sf: str) -> DataFrame:
    return gaps.gap_summary(gaps.find_gaps(table(spark, sf, "events"), "event_type", "ts", THRESHOLDS))


@register("recent_feed_gaps", """
WITH recent AS (SELECT event_type AS feed, date_trunc('second', ts) AS t FROM events
  WHERE ts BETWEEN TIMESTAMP '2024-01-31' - INTERVAL 7 DAY AND TIMESTAMP '2024-01-31' - INTERVAL 3 HOUR),
steps AS (SELECT feed, lag(t) OVER (PARTITION BY feed ORDER BY t) AS gap_start, t AS gap_end FROM recent)
SELECT feed, count(*) AS gaps, max(date_diff('second', gap_start, gap_end)) AS longest_seconds FROM steps
WHERE date_diff('second', gap_start, gap_end) > 300 GROUP BY feed""")
def recent_feed_gaps(spark: SparkSession, sf: str) -> DataFrame:
    recent = gaps.recent_feed(table(spark, sf, "events"), "ts", NOW)
    return gaps.find_gaps(recent, "event_type", "ts").groupBy("feed").agg(
        F.count(F.lit(1)).alias("gaps"), F.max("gap_seconds").alias("longest_seconds"))


@register("count_difference", """
SELECT 'orders' AS table_name, count(*) AS source_count, count(*) FILTER (WHERE o_orderstatus <> 'P') AS target_count,
  count(*) - count(*) FILTER (WHERE o_orderstatus <> 'P') AS delta FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'""")
def count_difference(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    recent = "o_orderdate >= timestamp_ntz'1997-01-01'"
    return reconcile.count_difference(o, o, "orders", recent, recent + " and o_orderstatus <> 'P'")


COPY = """copy AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 100 = 3 THEN NULL
  WHEN o_orderkey % 100 = 4 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate FROM orders WHERE o_orderkey % 50 <> 7)"""


def drifted(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").filter("o_orderkey % 50 <> 7")
    m = F.col("o_orderkey") % 100
    price = F.when(m == 4, F.col("o_totalprice") + 1).when(m != 3, F.col("o_totalprice"))
    return o.withColumn("o_totalprice", price)


@register("value_difference", f"""
WITH {COPY}, s AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
t AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM copy WHERE o_orderdate >= TIMESTAMP '1998-01-01')
SELECT *, 'source' AS only_in FROM (SELECT * FROM s EXCEPT SELECT * FROM t)
UNION ALL SELECT *, 'target' FROM (SELECT * FROM t EXCEPT SELECT * FROM s)""")
def value_difference(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.value_difference(table(spark, sf, "orders"), drifted(spark, sf),
                                      ["o_orderkey", "o_orderstatus", "o_totalprice"],
                                      "o_orderdate >= timestamp_ntz'1998-01-01'")


@register("value_difference_by_ranges", f"""
WITH {COPY}, s AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
t AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM copy WHERE o_orderdate >= TIMESTAMP '1998-01-01')
SELECT *, 'source' AS only_in FROM (SELECT * FROM s EXCEPT SELECT * FROM t)
UNION ALL SELECT *, 'target' FROM (SELECT * FROM t EXCEPT SELECT * FROM s)""")
def value_difference_by_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.value_difference_by_ranges(table(spark, sf, "orders"), drifted(spark, sf), "o_orderkey",
                                                ["o_orderkey", "o_orderstatus", "o_totalprice"], "o_orderdate >= timestamp_ntz'1998-01-01'")


@register("stored_count_check", """
SELECT 'events' AS table_name, count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-20') AS source_count, count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-20' AND event_id % 7 <> 0) AS target_count,
  count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-20' AND event_id % 7 = 0) AS delta FROM events""")
def stored_count_check(spark: SparkSession, sf: str) -> DataFrame:
    """Two stored tables counted by their files' footers, some of their days only."""
    folder = f"{shared_folder(spark)}/counted-{uuid.uuid4().hex}"
    e = table(spark, sf, "events").select("event_id", "value", F.to_date("ts").alias("day"))
    e.write.partitionBy("day").parquet(f"{folder}/source")
    e.filter("event_id % 7 <> 0").write.partitionBy("day").parquet(f"{folder}/target")
    return reconcile.stored_count_check(spark, {"events": (f"{folder}/source", f"{folder}/target")}, "day < date'2024-01-20'")


@register("transform_check", f"""
WITH {COPY}, s AS (SELECT o_orderkey, o_totalprice FROM orders), t AS (SELECT o_orderkey, o_totalprice FROM copy)
SELECT 'orders' AS table_name, (SELECT count(*) FROM s) AS source_count, (SELECT count(*) FROM t) AS target_count,
  (SELECT count(*) FROM s) - (SELECT count(*) FROM t) AS delta,
  (SELECT count(*) FROM (SELECT * FROM s EXCEPT SELECT * FROM t)) AS missing_in_target,
  (SELECT count(*) FROM (SELECT * FROM t EXCEPT SELECT * FROM s)) AS missing_in_source""")
def transform_check(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.transform_check(table(spark, sf, "orders"), drifted(spark, sf), "orders",
                                     ["o_orderkey", "o_totalprice"])


@register("catalog_count_check", """
WITH w AS (SELECT TIMESTAMP '2024-01-01' - INTERVAL 26 YEAR AS low, TIMESTAMP '2024-01-30 22:00:00' AS high)
SELECT 'public.orders' AS table_name, count(*) AS source_count, count(*) FILTER (WHERE o_orderkey % 9 <> 0) AS target_count,
  count(*) FILTER (WHERE o_orderkey % 9 = 0) AS delta FROM orders, w WHERE o_orderdate BETWEEN low AND high
UNION ALL SELECT 'public.events', count(*), count(*), 0 FROM events, w WHERE ts BETWEEN low AND high""")
def catalog_count_check(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").withColumnRenamed("o_orderdate", "created_at")
    e = table(spark, sf, "events").withColumnRenamed("ts", "inserted_at")
    li = table(spark, sf, "lineitem").withColumnRenamed("l_shipdate", "created_at")
    sources = {"public.orders": o, "public.events": e, "public.lines": li, "other.lines": li,
               "public.nation": table(spark, sf, "nation")}
    targets = dict(sources, **{"public.orders": o.filter("o_orderkey % 9 <> 0")})
    return reconcile.catalog_count_check(sources, targets, NOW, years_back=26, skip=["LINES"], schemas=["PUBLIC"])


@register("custom_count_checks", """
SELECT 'closed_orders' AS table_name, count(*) AS source_count, count(*) FILTER (WHERE o_orderkey % 10 <> 0) AS target_count,
  count(*) FILTER (WHERE o_orderkey % 10 = 0) AS delta FROM orders WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '2001-01-01' - INTERVAL 14 DAY
UNION ALL
SELECT 'joined_lines', (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
  (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey % 10 <> 0),
  (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey % 10 = 0)""")
def custom_count_checks(spark: SparkSession, sf: str) -> DataFrame:
    source = {"orders": table(spark, sf, "orders"), "lineitem": table(spark, sf, "lineitem")}
    target = dict(source, orders=source["orders"].filter("o_orderkey % 10 <> 0"))
    checks = {
        "closed_orders": lambda t, now: t["orders"].filter(
            (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < ntz(now) - F.expr("interval 14 day"))),
        "joined_lines": lambda t, now: t["lineitem"].join(
            t["orders"], F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey"),
    }
    return reconcile.custom_checks(checks, source, target, "2001-01-01")


@register("projection_against_log", """
SELECT 'approved' AS table_name, count(*) FILTER (WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) >= 20) AS source_count,
  count(*) FILTER (WHERE event_type = 'purchase') AS target_count,
  count(*) FILTER (WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) >= 20) - count(*) FILTER (WHERE event_type = 'purchase') AS delta
FROM events""")
def projection_against_log(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    projected = e.filter(text_at("props", "k").cast("int") >= 20)
    return reconcile.count_difference(projected, e, "approved", where_target="event_type = 'purchase'")


@register("duplicate_keys", f"""
WITH {DUPLICATED}
SELECT event_id, count(*) AS copies, max(dw_created_at) AS newest FROM loaded WHERE dw_created_at >= TIMESTAMP '2024-01-15'
GROUP BY event_id HAVING count(*) > 1""")
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.duplicate_keys(loaded_events(spark, sf), "event_id", "dw_created_at", "2024-01-15")
