"""Sources and load methods over orders, customers and events."""

from __future__ import annotations

import uuid
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.registry import register, table
from tidemark.functions.temporal import ntz
from tidemark.functions.text import split_pair
from tidemark.operators import loads
from tidemark.operators.latest import latest_per_key
from tidemark.operators.running import ordered_listing
from tidemark.session import shared_folder
from tidemark.sinks import tables, versions
from tidemark.sinks.exports import csv_record, json_record
from tidemark.sources import batches, files
from tidemark.sources.tables import read_table
from tidemark.sources.ticks import flatten_ticks

NOW = "2024-01-31 00:00:00"

# --- the same small derivations in both dialects --------------------------------------

TARGET = """target AS (
  SELECT o_orderkey AS id, o_custkey AS customer, o_orderstatus AS status, o_totalprice AS price,
         o_orderdate AS updated_at
  FROM orders WHERE o_orderkey % 3 <> 0)"""

SOURCE = """source AS (
  SELECT o_orderkey AS id, o_custkey AS customer,
         CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'X' END AS status, o_totalprice + 1 AS price,
         o_orderdate + INTERVAL 1 DAY AS updated_at
  FROM orders WHERE o_orderkey % 2 = 0)"""

VERSIONS = """versions AS (
  SELECT * FROM source
  UNION ALL
  SELECT id, customer, status, price + 10 AS price, updated_at + INTERVAL 1 DAY AS updated_at
  FROM source WHERE id % 5 = 0)"""

DUPLICATED = """loaded AS (
  SELECT event_id, ts, event_type, value, ts + INTERVAL 1 HOUR AS dw_created_at, 'a' AS source_file FROM events
  UNION ALL
  SELECT event_id, ts, event_type, value + 1, ts + INTERVAL 2 HOUR, 'b' FROM events WHERE event_id % 10 = 0
  UNION ALL
  SELECT event_id, ts, event_type, value + 2, ts + INTERVAL 2 HOUR, 'c' FROM events WHERE event_id % 20 = 0)"""


def orders_target(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").filter("o_orderkey % 3 <> 0")
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer"),
                    F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"),
                    F.col("o_orderdate").alias("updated_at"))


def orders_source(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").filter("o_orderkey % 2 = 0")
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer"),
                    F.when(F.col("o_orderkey") % 4 != 0, F.lit("X")).alias("status"),
                    (F.col("o_totalprice") + 1).alias("price"),
                    (F.col("o_orderdate") + F.expr("interval 1 day")).alias("updated_at"))


def order_versions(spark: SparkSession, sf: str) -> DataFrame:
    src = orders_source(spark, sf)
    later = src.filter("id % 5 = 0").withColumns(
        {"price": F.col("price") + 10, "updated_at": F.col("updated_at") + F.expr("interval 1 day")})
    return src.unionByName(later)


def loaded_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with load time and file; each tenth was loaded again, each twentieth twice."""
    copies = F.when(F.col("event_id") % 20 == 0, F.array(F.lit(0), F.lit(1), F.lit(2))) \
        .when(F.col("event_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    e = table(spark, sf, "events").withColumn("copy", F.explode(copies))
    hours = F.make_dt_interval(hours=F.when(F.col("copy") == 0, 1).otherwise(2))
    return e.select("event_id", "ts", "event_type", (F.col("value") + F.col("copy")).alias("value"),
                    (F.col("ts") + hours).alias("dw_created_at"),
                    F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), F.col("copy") + 1).alias("source_file"))


# --- sources --------------------------------------------------------------------------

@register("scan_table", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'")
def scan_table(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_totalprice"],
                      "o_orderdate >= timestamp_ntz'1998-01-01'")


@register("bulk_text_extract", """
SELECT o_orderkey || ',' || o_custkey || ',' || o_orderstatus || ',' || o_orderpriority AS line FROM orders""")
def bulk_text_extract(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return o.select(csv_record(o).alias("line"))


TIED = "tied AS (SELECT event_id, event_type, date_trunc('hour', ts) AS hour_at FROM events)"


def tied_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", "event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_at"))


@register("incremental_extract", """
WITH fresh AS (SELECT event_id, ts, value, rank() OVER (ORDER BY ts) AS r FROM events
               WHERE ts > TIMESTAMP '2024-01-10 00:00:00')
SELECT event_id, ts, value FROM fresh WHERE r <= 1500""")
def incremental_extract(spark: SparkSession, sf: str) -> DataFrame:
    return batches.incremental_extract(
        table(spark, sf, "events"), "ts", "2024-01-10 00:00:00", 1500).select("event_id", "ts", "value")


@register("incremental_extract_by_id", """
SELECT event_id, value FROM events WHERE event_id > 300 AND event_id <= 300 + 2000""")
def incremental_extract_by_id(spark: SparkSession, sf: str) -> DataFrame:
    return batches.incremental_extract(table(spark, sf, "events"), "event_id", 300, 2000).select("event_id", "value")


@register("incremental_extract_ties", f"""
WITH {TIED}, sizes AS (
  SELECT hour_at, sum(count(*)) OVER (ORDER BY hour_at) AS upto FROM tied
  WHERE hour_at > TIMESTAMP '2024-01-05 00:00:00' GROUP BY hour_at)
SELECT event_id, event_type, tied.hour_at FROM tied JOIN sizes ON tied.hour_at = sizes.hour_at WHERE upto <= 3000""")
def incremental_extract_ties(spark: SparkSession, sf: str) -> DataFrame:
    return batches.incremental_extract(tied_events(spark, sf), "hour_at", "2024-01-05 00:00:00", 3000)


@register("high_volume_extract", """
WITH fresh AS (SELECT *, row_number() OVER (ORDER BY ts) AS r FROM events WHERE ts > TIMESTAMP '2024-01-08 00:00:00'),
edge AS (SELECT date_trunc('minute', max(ts)) - INTERVAL 1 MINUTE AS t FROM fresh WHERE r <= 2500)
SELECT event_id, ts, event_type FROM fresh WHERE ts < (SELECT t FROM edge)""")
def high_volume_extract(spark: SparkSession, sf: str) -> DataFrame:
    return batches.incremental_extract(table(spark, sf, "events"), "ts", "2024-01-08 00:00:00", 2500,
                                       volume="high").select("event_id", "ts", "event_type")


@register("high_volume_quiet_feed", """
WITH fresh AS (SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-29 12:00:00'),
edge AS (SELECT date_trunc('minute', max(ts)) - INTERVAL 1 MINUTE AS t FROM fresh)
SELECT event_id, ts FROM fresh WHERE ts < (SELECT t FROM edge)
UNION ALL SELECT event_id, ts FROM events WHERE ts >= (SELECT t FROM edge) AND ts < (SELECT t FROM edge)""")
def high_volume_quiet_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Fewer rows than the cap: the closed minutes are loaded; what lies in the open ones only waits."""
    e = table(spark, sf, "events")
    closed = batches.incremental_extract(e, "ts", "2024-01-29 12:00:00", 1_000_000_000, volume="high").select("event_id", "ts")
    newest = e.agg(F.date_trunc("minute", F.max("ts").cast("timestamp")).cast("timestamp_ntz")).first()[0]
    open_only = e.filter(F.col("ts") >= F.lit(newest))
    return closed.unionByName(batches.incremental_extract(open_only, "ts", None, 1_000_000_000, volume="high").select("event_id", "ts"))


@register("full_scan", "SELECT p_partkey, p_brand, p_size FROM part")
def full_scan(spark: SparkSession, sf: str) -> DataFrame:
    return batches.incremental_extract(table(spark, sf, "part"), None).select("p_partkey", "p_brand", "p_size")


@register("extract_with_condition", """
SELECT event_id, value FROM events WHERE event_type = 'click' AND ts < TIMESTAMP '2024-01-20' AND event_id > 100""")
def extract_with_condition(spark: SparkSession, sf: str) -> DataFrame:
    return batches.incremental_extract(
        table(spark, sf, "events"), "event_id", 100,
        condition="event_type = 'click' and ts < timestamp_ntz'2024-01-20'").select("event_id", "value")


@register("paged_read", """
SELECT event_id, CAST(event_id // (SELECT CAST(ceil(count(*) / 4.0) AS BIGINT) FROM events) + 1 AS INTEGER) AS page FROM events""")
def paged_read(spark: SparkSession, sf: str) -> DataFrame:
    """A source read in four pages, each starting where the last one ended."""
    e = table(spark, sf, "events").select("event_id")
    pages = [p.withColumn("page", F.lit(n)) for n, p in enumerate(batches.batches(e, "event_id", -(-e.count() // 4)), 1)]
    return reduce(DataFrame.unionByName, pages)


@register("paged_read_ties", """
WITH v AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1), c AS (SELECT k, n, sum(n) OVER (ORDER BY k) AS upto FROM v),
p AS (SELECT k, n, upto, (upto - 1) // 40 AS raw FROM c), q AS (SELECT *, k = min(k) OVER w AS lead, sum(n) OVER w > 40 AND count(*) OVER w > 1 AS long FROM p WINDOW w AS (PARTITION BY raw)),
pages AS (SELECT k, dense_rank() OVER (ORDER BY raw, long AND NOT lead) AS page FROM q)
SELECT page, count(*) AS n, min(o_custkey) AS first_key, max(o_custkey) AS last_key FROM orders JOIN pages ON k = o_custkey WHERE page <= 60 GROUP BY page""")
def paged_read_ties(spark: SparkSession, sf: str) -> DataFrame:
    """The first sixty pages of a source with many rows of one order value; no value is in two pages."""
    o = table(spark, sf, "orders").select("o_custkey")
    pages = [p.agg(F.count(F.lit(1)).alias("n"), F.min("o_custkey").alias("first_key"), F.max("o_custkey").alias("last_key")).withColumn("page", F.lit(n).cast("long"))
             for n, p in zip(range(1, 61), batches.batches(o, "o_custkey", 40))]
    return reduce(DataFrame.unionByName, pages).filter("n > 0")


@register("event_files", """
SELECT event_type, count(*) AS n, 'events.parquet' AS file_name, true AS has_load_time FROM events GROUP BY event_type""")
def event_files(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.sources.files import with_origin
    e = with_origin(table(spark, sf, "events")).filter(F.col("source_file").rlike(r"^.*/events\.parquet$"))
    name = F.element_at(F.split("source_file", "/"), -1)
    return e.groupBy("event_type", name.alias("file_name"), F.col("dw_created_at").isNotNull().alias("has_load_time")) \
        .agg(F.count(F.lit(1)).alias("n"))


TICK_JSON = """'[{"pair":"' || event_type || 'usd","data":[{"time":' || (1700000000 + event_id * 60)
 || ',"close":' || event_id || '.5},{"time":' || (1700000060 + event_id * 60) || ',"close":' || event_id || '.75}]}]'"""


@register("flatten_ticks", """
SELECT event_type || 'usd' AS currency_pair, CAST(event_id + 0.5 + k * 0.25 AS DOUBLE) AS price,
       strftime(make_timestamp((1700000000 + 60 * k + event_id * 60) * 1000000), '%Y-%m-%d %H:%M:%S') AS ts
FROM events, (VALUES (0), (1)) v(k)""")
def flatten_tick_answers(spark: SparkSession, sf: str) -> DataFrame:
    payload = table(spark, sf, "events").select(F.expr(TICK_JSON).alias("payload"))
    return flatten_ticks(payload, "payload")


@register("split_pairs", """
SELECT DISTINCT upper(event_type) AS from_symbol, 'USD' AS to_symbol, lower(event_type) || 'usd' AS pair FROM events""")
def split_pairs(spark: SparkSession, sf: str) -> DataFrame:
    pairs = table(spark, sf, "events").select(F.concat(F.upper("event_type"), F.lit("/USD")).alias("p")).distinct()
    a, b = split_pair("p")
    return pairs.select(a.alias("from_symbol"), b.alias("to_symbol"), F.concat(F.lower(a), F.lower(b)).alias("pair"))


# --- watermarks -----------------------------------------------------------------------

@register("watermark", "SELECT max(ts) AS max_order, count(*) AS table_count FROM events")
def watermark(spark: SparkSession, sf: str) -> DataFrame:
    return loads.watermark(table(spark, sf, "events"), "ts")


@register("watermark_lookback", """
SELECT 'days' AS mode, least(max(ts), TIMESTAMP '2024-01-31' - INTERVAL 14 DAY) AS max_order, count(*) AS table_count FROM events
UNION ALL SELECT 'hour', max(ts) - INTERVAL 1 HOUR, count(*) FROM events
UNION ALL SELECT 'none', max(ts), count(*) FROM events
UNION ALL SELECT 'empty', TIMESTAMP '1970-01-01', 0""")
def watermark_lookback(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumnRenamed("ts", "updated_at")
    parts = {
        "days": loads.watermark_with_lookback(e, "updated_at", "14 days", NOW),
        "hour": loads.watermark_with_lookback(e, "updated_at", "1 hour", NOW),
        "none": loads.watermark_with_lookback(e.withColumnRenamed("updated_at", "seen"), "seen", "1 hour", NOW),
        "empty": loads.watermark_with_lookback(e.filter("event_id < 0"), "updated_at", "1 hour", NOW),
    }
    tagged = [df.select(F.lit(k).alias("mode"), F.col("max_order").cast("timestamp_ntz").alias("max_order"),
                        "table_count") for k, df in parts.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df)
    return out


@register("reread_after_hour_lookback", """
WITH target AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-15'),
since AS (SELECT date_trunc('hour', max(ts) - INTERVAL 12 HOUR) AS t FROM target)
SELECT event_id, ts FROM events WHERE ts > (SELECT t FROM since)""")
def reread_after_hour_lookback(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return loads.reread_since(e, e.filter(F.col("ts") < ntz("2024-01-15")), "ts").select("event_id", "ts")


# --- key-matching loads ---------------------------------------------------------------

MERGED = """
SELECT coalesce(s.id, t.id) AS id,
       CASE WHEN s.id IS NOT NULL THEN s.customer ELSE t.customer END AS customer,
       CASE WHEN s.id IS NOT NULL THEN s.status ELSE t.status END AS status,
       CASE WHEN s.id IS NOT NULL THEN s.price ELSE t.price END AS price,
       CASE WHEN s.id IS NOT NULL THEN s.updated_at ELSE t.updated_at END AS updated_at
FROM target t FULL JOIN newest s ON t.id = s.id"""
NEWEST = """newest AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) AS rn FROM versions) WHERE rn = 1)"""


@register("merge", f"WITH {TARGET}, {SOURCE}, {VERSIONS}, {NEWEST} {MERGED}")
def merge(spark: SparkSession, sf: str) -> DataFrame:
    return loads.merge(orders_target(spark, sf), order_versions(spark, sf), "id", newest_by=["updated_at"])


@register("merge_small_batch", f"""
WITH {TARGET}, {SOURCE}, newest AS (SELECT * FROM source WHERE updated_at > TIMESTAMP '2001-07-01') {MERGED}""")
def merge_small_batch(spark: SparkSession, sf: str) -> DataFrame:
    batch = orders_source(spark, sf).filter(F.col("updated_at") > ntz("2001-07-01"))
    return loads.merge(orders_target(spark, sf), batch, "id", plan="lookup")


@register("insert_only", f"""
WITH {TARGET}, {SOURCE}, {VERSIONS}, {NEWEST}
SELECT * FROM target UNION ALL SELECT * FROM newest WHERE id NOT IN (SELECT id FROM target)""")
def insert_only(spark: SparkSession, sf: str) -> DataFrame:
    return loads.insert_only(orders_target(spark, sf), order_versions(spark, sf), "id", newest_by=["updated_at"])


@register("truncate_insert", "SELECT n_nationkey, n_name, n_regionkey, CAST(NULL AS VARCHAR) AS note FROM nation")
def truncate_insert(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation")
    old = n.filter("n_regionkey = 1").withColumn("note", F.lit("old"))
    return loads.truncate_insert(old, n)


@register("loaded_columns", """
SELECT 'orders' AS table_name, 'id, customer, status, price' AS column_list, count(*) AS n FROM orders WHERE o_orderkey % 3 <> 0""")
def loaded_columns(spark: SparkSession, sf: str) -> DataFrame:
    t = orders_target(spark, sf)
    names = ", ".join(loads.loaded_columns(t, ["updated_at"]))
    return t.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("orders").alias("table_name"), F.lit(names).alias("column_list"), "n")


CRM = """target AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance,
    TIMESTAMP '2024-01-01' AS dw_created_at, CAST(NULL AS TIMESTAMP) AS dw_updated_at FROM customer WHERE c_custkey % 4 <> 0),
  source AS (SELECT c_custkey AS id, c_name || '*' AS name, c_acctbal + 5 AS balance FROM customer WHERE c_custkey % 3 = 0)"""


@register("merge_with_audit", f"""
WITH {CRM}
SELECT coalesce(s.id, t.id) AS id,
  CASE WHEN s.id IS NULL THEN t.name ELSE s.name END AS name,
  CASE WHEN s.id IS NULL THEN t.balance ELSE s.balance END AS balance,
  CASE WHEN t.id IS NULL THEN TIMESTAMP '2024-01-31' ELSE t.dw_created_at END AS dw_created_at,
  CASE WHEN s.id IS NOT NULL AND t.id IS NOT NULL THEN TIMESTAMP '2024-01-31' ELSE t.dw_updated_at END AS dw_updated_at
FROM target t FULL JOIN source s ON t.id = s.id""")
def merge_with_audit(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    target = c.filter("c_custkey % 4 <> 0").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        ntz("2024-01-01").alias("dw_created_at"), F.lit(None).cast("timestamp_ntz").alias("dw_updated_at"))
    source = c.filter("c_custkey % 3 = 0").select(
        F.col("c_custkey").alias("id"), F.concat("c_name", F.lit("*")).alias("name"),
        (F.col("c_acctbal") + 5).alias("balance"))
    return loads.merge(target, source, "id", created_column="dw_created_at", updated_column="dw_updated_at", now=NOW)


@register("conditional_upsert", """
WITH target AS (SELECT event_id AS id, event_type, value, user_id FROM events WHERE event_id % 3 <> 1),
source AS (SELECT event_id AS id, 'late' AS event_type, value + 100 AS value, user_id + 1 AS user_id FROM events WHERE event_id % 2 = 0)
SELECT coalesce(t.id, s.id) AS id, coalesce(t.event_type, s.event_type) AS event_type,
  CASE WHEN t.id IS NULL OR (s.id IS NOT NULL AND t.event_type = 'click') THEN s.value ELSE t.value END AS value,
  coalesce(t.user_id, s.user_id) AS user_id
FROM target t FULL JOIN source s ON t.id = s.id""")
def conditional_upsert(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumnRenamed("event_id", "id")
    target = e.filter("id % 3 <> 1").select("id", "event_type", "value", "user_id")
    source = e.filter("id % 2 = 0").select("id", F.lit("late").alias("event_type"),
                                           (F.col("value") + 100).alias("value"), (F.col("user_id") + 1).alias("user_id"))
    return loads.conditional_upsert(target, source, "id", ["value"], "event_type = 'click'")


# --- windows of time ------------------------------------------------------------------

@register("overwrite_window", """
SELECT event_id, ts, value FROM events
WHERE NOT (ts > TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-12')
UNION ALL
SELECT event_id, ts, value * 2 FROM events
WHERE ts > TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-12' AND event_id % 2 = 0""")
def overwrite_window(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "ts", "value")
    again = e.filter("event_id % 2 = 0").withColumn("value", F.col("value") * 2)
    return loads.overwrite_window(e, again, "ts", "2024-01-10", "2024-01-12")


@register("rebuild_trailing", """
SELECT o_orderkey AS id, o_orderdate AS at, o_totalprice AS price FROM orders WHERE o_orderdate <= TIMESTAMP '2001-08-01' - INTERVAL 30 DAY
UNION ALL
SELECT o_orderkey, o_orderdate, o_totalprice + 1 FROM orders WHERE o_orderdate > TIMESTAMP '2001-08-01' - INTERVAL 30 DAY""")
def rebuild_trailing(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("at"),
                                          F.col("o_totalprice").alias("price"))
    return loads.rebuild_trailing(o, o.withColumn("price", F.col("price") + 1), "at", "2001-08-01", 30)


@register("stage_reload", "SELECT event_id, event_type FROM events WHERE ts > TIMESTAMP '2024-01-20'")
def stage_reload(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "event_type", "ts")
    folder = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    for part in ("ts <= timestamp_ntz'2024-01-20'", "ts > timestamp_ntz'2024-01-20'"):  # the second load empties the stage first
        staged = tables.stage(loads.truncate_insert(e.drop("ts"), e.filter(part)), folder)
    return staged


@register("dedupe_recent", f"""
WITH {DUPLICATED}
SELECT event_id, value, dw_created_at, source_file FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY dw_created_at DESC, source_file DESC) AS rn
  FROM loaded WHERE dw_created_at >= TIMESTAMP '2024-01-20') WHERE rn = 1
UNION ALL
SELECT event_id, value, dw_created_at, source_file FROM loaded WHERE dw_created_at < TIMESTAMP '2024-01-20'""")
def dedupe_recent(spark: SparkSession, sf: str) -> DataFrame:
    return loads.dedupe_recent(loaded_events(spark, sf), "event_id", "dw_created_at", "2024-01-20",
                               ["source_file"]).select("event_id", "value", "dw_created_at", "source_file")


# --- tables written by partition and read back ------------------------------------------

def _by_day(spark: SparkSession, rows: DataFrame, at: str) -> str:
    """A new table in the shared folder, partitioned by the day of ``at``."""
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    rows.withColumn("day", F.to_date(at)).write.partitionBy("day").parquet(path)
    return path


@register("overwrite_window_partitions", """
SELECT event_id, ts, value FROM events
WHERE NOT (ts > TIMESTAMP '2024-01-10 06:00:00' AND ts <= TIMESTAMP '2024-01-12')
UNION ALL
SELECT event_id, ts, value * 2 FROM events
WHERE ts > TIMESTAMP '2024-01-10 06:00:00' AND ts <= TIMESTAMP '2024-01-12' AND ts < TIMESTAMP '2024-01-11' AND event_id % 2 = 0""")
def overwrite_window_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """A window in which one day loses all its rows."""
    e = table(spark, sf, "events").select("event_id", "ts", "value")
    path = _by_day(spark, e, "ts")
    again = e.filter("event_id % 2 = 0 and ts < timestamp_ntz'2024-01-11'").withColumn("value", F.col("value") * 2)
    tables.overwrite_window_partitions(path, again, "ts", "2024-01-10 06:00:00", "2024-01-12 00:00:00")
    return spark.read.parquet(path).select("event_id", "ts", "value")


@register("rebuild_partitions", """
SELECT event_id, ts, value FROM events WHERE ts <= TIMESTAMP '2024-01-21'
UNION ALL SELECT event_id, ts, value + 1 FROM events WHERE ts > TIMESTAMP '2024-01-21'""")
def rebuild_partitions(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "ts", "value")
    path = _by_day(spark, e, "ts")
    tables.rebuild_partitions(path, e.withColumn("value", F.col("value") + 1), "ts", "2024-01-31 00:00:00", 10)
    return spark.read.parquet(path).select("event_id", "ts", "value")


@register("merge_partitions", """
SELECT event_id, ts, CASE WHEN ts >= TIMESTAMP '2024-01-20' AND event_id % 2 = 0 THEN value + 5 ELSE value END AS value FROM events
WHERE event_id % 3 <> 0 OR ts >= TIMESTAMP '2024-01-20' AND event_id % 2 = 0""")
def merge_partitions(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "ts", "value")
    path = _by_day(spark, e.filter("event_id % 3 <> 0"), "ts")
    batch = e.filter("ts >= timestamp_ntz'2024-01-20' and event_id % 2 = 0").select(
        "event_id", "ts", (F.col("value") + 5).alias("value"), F.to_date("ts").alias("day"))
    tables.merge_partitions(path, batch, "event_id", "day")
    return spark.read.parquet(path).select("event_id", "ts", "value")


@register("dedupe_partitions", f"""
WITH {DUPLICATED}
SELECT event_id, value, source_file FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY dw_created_at DESC, source_file DESC) AS rn
  FROM loaded WHERE dw_created_at >= TIMESTAMP '2024-01-20' AND dw_created_at < TIMESTAMP '2024-01-23') WHERE rn = 1
UNION ALL
SELECT event_id, value, source_file FROM loaded WHERE dw_created_at < TIMESTAMP '2024-01-20' OR dw_created_at >= TIMESTAMP '2024-01-23'""")
def dedupe_partitions(spark: SparkSession, sf: str) -> DataFrame:
    path = _by_day(spark, loaded_events(spark, sf), "dw_created_at")
    tables.dedupe_partitions(path, "event_id", "dw_created_at", "2024-01-20", "2024-01-22", ["source_file"])
    return spark.read.parquet(path).select("event_id", "value", "source_file")


@register("conditional_upsert_partitions", """
SELECT event_id, ts, event_type, CASE WHEN event_type = 'click' AND event_id % 2 = 0 AND ts >= TIMESTAMP '2024-01-20' THEN value + 100 ELSE value END AS value
FROM events WHERE event_id % 3 <> 0
UNION ALL SELECT event_id, ts, 'new', value + 100 FROM events WHERE event_id % 3 = 0 AND event_id % 2 = 0 AND ts >= TIMESTAMP '2024-01-20'""")
def conditional_upsert_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """New events come in, known ones change one column if they are clicks; only the batch's days are written."""
    e = table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    path = _by_day(spark, e.filter("event_id % 3 <> 0"), "ts")
    batch = e.filter("ts >= timestamp_ntz'2024-01-20' and event_id % 2 = 0").select(
        "event_id", "ts", F.lit("new").alias("event_type"), (F.col("value") + 100).alias("value"), F.to_date("ts").alias("day"))
    tables.upsert_partitions(path, batch, "event_id", "day", ["value"], "event_type = 'click'")
    return spark.read.parquet(path).select("event_id", "ts", "event_type", "value")


@register("replaced_catalog_table", "SELECT o_orderkey, o_totalprice * 3 AS price FROM orders WHERE o_orderkey % 2 = 0")
def replaced_catalog_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table of the catalog replaced twice, the second time from itself."""
    name = f"replaced_{uuid.uuid4().hex}"
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    tables.replace_table(spark, o, name)
    tables.replace_table(spark, o.withColumn("price", F.col("price") * 3), name)
    tables.replace_table(spark, spark.table(name).filter("o_orderkey % 2 = 0"), name)
    return spark.table(name)


@register("replaced_catalog_partitions", """
SELECT event_id, value, strftime(ts, '%Y-%m-%d') AS day FROM events WHERE ts < TIMESTAMP '2024-01-10' OR ts >= TIMESTAMP '2024-01-12'
UNION ALL SELECT event_id, value * 2, strftime(ts, '%Y-%m-%d') FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11' AND event_id % 2 = 0""")
def replaced_catalog_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Two days of a partitioned catalog table replaced; one of them has no rows left."""
    name = f"days_{uuid.uuid4().hex}"
    e = table(spark, sf, "events").select("event_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    e.write.partitionBy("day").format("parquet").saveAsTable(name)
    new = e.filter("day = '2024-01-10' and event_id % 2 = 0").withColumn("value", F.col("value") * 2)
    versions.replace_partitions(spark, new, name, "day", ["2024-01-10", "2024-01-11"])
    return spark.table(name)


# --- files ------------------------------------------------------------------------------

@register("dated_event_files", """
SELECT event_id, value, TIMESTAMP '2024-01-12 05:00:00' AS dw_created_at FROM events WHERE ts >= TIMESTAMP '2024-01-11' AND ts < TIMESTAMP '2024-01-13'""")
def dated_event_files(spark: SparkSession, sf: str) -> DataFrame:
    """Yesterday's and today's event files by their dated prefixes; a day without any gives no rows."""
    root = f"{shared_folder(spark)}/feed-{uuid.uuid4().hex}"
    e = table(spark, sf, "events").select("event_id", "value", "ts", F.date_format("ts", "yyyy").alias("y"), F.date_format("ts", "MM").alias("m"),
                                          F.date_format("ts", "dd").alias("d"))
    for day in ("2024-01-10", "2024-01-11", "2024-01-12"):
        e.filter(F.to_date("ts") == F.lit(day).cast("date")).select("event_id", "value").write.parquet(f"{root}/{day.replace('-', '/')}")
    read = lambda days: files.load_events(spark, root, days, schema="event_id long, value double", loaded_at="2024-01-12 05:00:00")
    got = read(files.dated_prefixes(date(2024, 1, 12))).unionByName(read(["2031/01/01"]))
    return got.select("event_id", "value", "dw_created_at")


@register("renamed_csv", "SELECT n_nationkey::VARCHAR AS key, n_name AS full_name, '2022-01-18 10:11:12.123' AS at FROM nation")
def renamed_csv(spark: SparkSession, sf: str) -> DataFrame:
    """A UTF-16 file with header, written and read with other names."""
    folder = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("Key"), F.col("n_name").alias("FullName"), F.lit("2022-01-18 10:11:12.123456").alias("At"))
    n.coalesce(1).write.option("header", "true").option("encoding", "UTF-16LE").option("lineSep", "\n").csv(folder)
    return files.read_renamed_csv(spark, folder, {"Key": "key", "FullName": "full_name", "At": "at"}, trim_times=["at"])


@register("csv_folder_appended", "SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, s_name FROM supplier")
def csv_folder_appended(spark: SparkSession, sf: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    table(spark, sf, "supplier").select("s_suppkey", "s_name").write.option("header", "true").csv(f"{folder}/in")
    for _ in range(2):
        files.append_csv_folder(spark, f"{folder}/in", f"{folder}/table", "s_suppkey long, s_name string")
    return spark.read.parquet(f"{folder}/table")


@register("unknown_method_raises", "SELECT count(*) AS rows, 'load_method is not recognized: upsert' AS said FROM region")
def unknown_method_raises(spark: SparkSession, sf: str) -> DataFrame:
    r = table(spark, sf, "region")
    try:
        loads.load("upsert", r, r, "r_regionkey")
        said = "nothing"
    except ValueError as e:
        said = str(e)
    return r.agg(F.count(F.lit(1)).alias("rows"), F.lit(said).alias("said"))


# --- record exports -------------------------------------------------------------------

@register("tab_separated_rows", """
SELECT n_nationkey || chr(9) || n_name || chr(9) || CASE WHEN n_regionkey = 2 THEN '' ELSE n_regionkey::VARCHAR END AS line FROM nation""")
def tab_separated_rows(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation").withColumn("n_regionkey", F.when(F.col("n_regionkey") != 2, F.col("n_regionkey")))
    return n.select(csv_record(n, "\t").alias("line"))


@register("json_records", """
SELECT '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '","note":null}' AS record FROM orders""")
def json_records(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.lit(None).cast("string").alias("note"))
    return o.select(json_record(o).alias("record"))


@register("csv_export_rows", """
SELECT c_custkey || ',' || c_name || ',' || c_mktsegment AS line FROM customer""")
def csv_export_rows(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return c.select(csv_record(c).alias("line"))


# --- flagship -------------------------------------------------------------------------

@register("revenue_after_merge", f"""
WITH {TARGET}, {SOURCE}, {VERSIONS}, {NEWEST}, merged AS ({MERGED})
SELECT c_mktsegment AS segment, count(*) AS orders_count,
       CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM merged JOIN customer ON customer = c_custkey GROUP BY c_mktsegment""")
def revenue_after_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Newest order versions merged into the order table, then revenue by segment."""
    newest = latest_per_key(order_versions(spark, sf), "id", ["updated_at"])
    merged = loads.merge(orders_target(spark, sf), newest, "id")
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    return (
        merged.join(c, merged.customer == c.c_custkey).groupBy("segment")
        .agg(F.count(F.lit(1)).alias("orders_count"),
             F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("revenue"))
    )


@register("listed_columns", """
SELECT n_regionkey AS region, string_agg(n_name, ', ' ORDER BY n_nationkey) AS names FROM nation GROUP BY n_regionkey""")
def listed_columns(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation").withColumnRenamed("n_regionkey", "region")
    return ordered_listing(n, ["region"], "n_name", "n_nationkey", ", ", "names")
