"""Whole syncs, the change log and the event stream over the given tables."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.loads import NOW
from tidemark.catalog.registry import register, table
from tidemark.plans.sync import SyncRule, latest_run_status, pull_changes, run_sync, sync_table
from tidemark.session import shared_folder
from tidemark.sinks.keyindex import KeyIndex
from tidemark.streaming.ingest import event_stream, first_copies, ingest, ingest_newest

_MERGE_RULE = SyncRule("public", "orders", load_method="merge", order_field="updated_at", key_field="id", batch_max_rows=4000,
                       backward_update_period="1 hour", columns_to_hash="email")

_SYNC_SOURCE = """source AS (SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice * 2 AS price, 'u' || o_custkey || '@x.org' AS email,
    o_orderdate + (o_orderkey % 86400) * INTERVAL 1 SECOND AS updated_at FROM orders),
  target AS (SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS price, 'kept' AS email,
    o_orderdate + (o_orderkey % 86400) * INTERVAL 1 SECOND AS updated_at FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')"""


def _sync_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf, "orders")
    at = (F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_orderkey") % 86400)).alias("updated_at")
    source = o.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), (F.col("o_totalprice") * 2).alias("price"),
                      F.expr("'u' || o_custkey || '@x.org'").alias("email"), at)
    target = o.filter("o_orderdate < timestamp_ntz'1998-01-01'").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"),
        F.lit("kept").alias("email"), at)
    return source, target


@register("sync_merge", f"""
WITH {_SYNC_SOURCE}, mark AS (SELECT max(updated_at) - INTERVAL 1 HOUR AS m FROM target),
ranked AS (SELECT *, rank() OVER (ORDER BY updated_at) + count(*) OVER (PARTITION BY updated_at) - 1 AS last_place FROM source WHERE updated_at > (SELECT m FROM mark)),
batch AS (SELECT * FROM ranked WHERE last_place <= 4000)
SELECT coalesce(b.id, t.id) AS id, CASE WHEN b.id IS NULL THEN t.status ELSE b.status END AS status, CASE WHEN b.id IS NULL THEN t.price ELSE b.price END AS price,
  CASE WHEN b.id IS NULL THEN t.email ELSE sha256(b.email || 'pepper') END AS email, CASE WHEN b.id IS NULL THEN t.updated_at ELSE b.updated_at END AS updated_at
FROM target t FULL JOIN batch b ON b.id = t.id""")
def sync_merge(spark: SparkSession, sf: str) -> DataFrame:
    source, target = _sync_tables(spark, sf)
    return run_sync(_MERGE_RULE, source, target, NOW, "pepper")


@register("sync_insert_only", f"""
WITH {_SYNC_SOURCE}, mark AS (SELECT max(updated_at) AS m FROM target),
ranked AS (SELECT *, rank() OVER (ORDER BY updated_at) + count(*) OVER (PARTITION BY updated_at) - 1 AS last_place FROM source WHERE updated_at > (SELECT m FROM mark) AND status <> 'P')
SELECT * FROM target UNION ALL SELECT * EXCLUDE (last_place) FROM ranked WHERE last_place <= 2500""")
def sync_insert_only(spark: SparkSession, sf: str) -> DataFrame:
    source, target = _sync_tables(spark, sf)
    rule = SyncRule("public", "orders", order_field="updated_at", key_field="id", batch_max_rows=2500, sql_condition=" AND status <> 'P'")
    return run_sync(rule, source, target, NOW)


@register("sync_truncate_insert", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def sync_truncate_insert(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return run_sync(SyncRule("public", "partners", load_method="truncate-insert"), s, s.filter("s_acctbal < 0"), NOW)


@register("sync_truncate_with_cap", f"""
WITH {_SYNC_SOURCE} SELECT id, status, price, sha256(email || 'pepper') AS email, updated_at FROM source WHERE status <> 'P'""")
def sync_truncate_with_cap(spark: SparkSession, sf: str) -> DataFrame:
    """A full replacement takes the whole source, whatever order field and cap the rule has."""
    source, target = _sync_tables(spark, sf)
    rule = _MERGE_RULE.with_(load_method="truncate-insert", batch_max_rows=100, sql_condition="AND status <> 'P'")
    return run_sync(rule, source, target, NOW, "pepper")


@register("sync_with_projection", f"""
WITH {_SYNC_SOURCE} SELECT id, 'O**' AS status, sha256(email || 'pepper') AS email, '{{"price":' || id || '}}' AS body, TIMESTAMP '1995-01-01'::DATE AS born
FROM source WHERE updated_at > TIMESTAMP '1970-01-01'""")
def sync_with_projection(spark: SparkSession, sf: str) -> DataFrame:
    """The rule's own SELECT masks, drops and leaves out columns before anything is loaded."""
    source, _ = _sync_tables(spark, sf)
    sql = """SELECT id, mask_text('Oxy', 1) AS status, email, json_drop(concat('{"ip":"1.2.3.4","price":', id, '}'), array('ip')) AS body,
             mask_date('1995-07-09') AS born, updated_at FROM {source}"""
    rule = SyncRule("public", "orders", load_method="merge", order_field="updated_at", key_field="id", columns_to_hash="email", sql=sql)
    target = spark.createDataFrame([], "id long, status string, email string, body string, born date, updated_at timestamp_ntz")
    return run_sync(rule, source, target, NOW, "pepper").drop("updated_at")


@register("change_log_pull", """
WITH source AS (SELECT 'c' || c_custkey AS "Id", c_name || '!' AS name, 1600000000000 + c_custkey * 1000 AS modified FROM customer),
loaded AS (SELECT 'c' || c_custkey AS "Id", c_name AS name, 1600000000000 + c_custkey * 1000 - c_custkey % 2 * 5000000 AS modified FROM customer WHERE c_acctbal > 5000),
since AS (SELECT max(modified) - 5000000 AS m, max(modified) AS top FROM loaded),
changed AS (SELECT * FROM source WHERE modified >= (SELECT top FROM since))
SELECT coalesce(c."Id", l."Id") AS "Id", coalesce(c.name, l.name) AS name, coalesce(c.modified, l.modified) AS "LastModifiedDate",
  CASE WHEN l."Id" IS NULL THEN TIMESTAMP '2024-01-31' END AS "DW_CREATED_AT",
  CASE WHEN l."Id" IS NOT NULL AND c."Id" IS NOT NULL THEN TIMESTAMP '2024-01-31' END AS "DW_UPDATED_AT"
FROM loaded l FULL JOIN changed c ON c."Id" = l."Id" """)
def change_log_pull(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    key, stamp = F.expr("'c' || c_custkey").alias("Id"), F.lit(1600000000000) + F.col("c_custkey") * 1000
    source = c.select(key, F.concat("c_name", F.lit("!")).alias("name"), stamp.alias("LastModifiedDate"))
    none = F.lit(None).cast("timestamp_ntz")
    loaded = c.filter("c_acctbal > 5000").select(
        key, F.col("c_name").alias("name"), (stamp - F.col("c_custkey") % 2 * 5000000).alias("LastModifiedDate"),
        none.alias("DW_CREATED_AT"), none.alias("DW_UPDATED_AT"))
    return pull_changes(source, loaded, now=NOW)


@register("latest_run_status", """
SELECT 'public' AS schema_name, event_type AS table_name, max(ts) AS latest_event_time, arg_max(CASE WHEN value > 10 THEN 'COMPLETED' ELSE 'FAILED' END, ts) AS latest_status,
  arg_max(CASE WHEN value > 10 THEN '-' ELSE 'value ' || event_id END, ts) AS error_message FROM events WHERE event_type <> 'error' GROUP BY event_type""")
def run_status(spark: SparkSession, sf: str) -> DataFrame:
    good = F.col("value") > 10
    log = table(spark, sf, "events").select(
        F.lit("public").alias("schema_name"), F.col("event_type").alias("table_name"), F.col("ts").alias("event_ts"),
        F.when(good, "COMPLETED").otherwise("FAILED").alias("status"),
        F.when(good, "-").otherwise(F.expr("'value ' || event_id")).alias("error_message"))
    return latest_run_status(log, skip=("error",))


@register("event_stream", "SELECT event_id, ts, event_type, value, 'events.parquet' AS file_name FROM events")
def streamed_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events through a file stream in which each fifth event comes twice.

    Written below the application's shared folder.
    """
    shape = table(spark, sf, "events").schema
    copies = F.sequence(F.lit(1), F.when(F.col("event_id") % 5 == 0, 2).otherwise(1))
    name = F.element_at(F.split("source_file", "/"), -1).alias("file_name")
    columns = ["event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type", "value"]
    run = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    doubled = event_stream(spark, sf, shape, "events.parquet").withColumn("copy", F.explode(copies)).drop("copy")
    query = ingest(first_copies(doubled), f"{run}/table", f"{run}/state")
    query.awaitTermination()
    return spark.read.parquet(f"{run}/table").select(*columns, name)


@register("event_stream_newest", """
WITH copies AS (SELECT event_id, ts, value, 1 AS version FROM events UNION ALL SELECT event_id, ts + INTERVAL 1 DAY, value + 1, 2 FROM events WHERE event_id % 5 = 0
  UNION ALL SELECT event_id, ts, value - 1, 0 FROM events WHERE event_id % 4 = 0)
SELECT event_id, arg_max(ts, version) AS ts, arg_max(value, version) AS value, strftime(arg_max(ts, version), '%Y-%m-%d') AS day FROM copies GROUP BY event_id""")
def streamed_newest(spark: SparkSession, sf: str) -> DataFrame:
    """Files of events in three micro-batches, newer and older copies of some in later ones; a copy may lie on another day."""
    run = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    e = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "value", F.lit(1).alias("version"))
    newer = e.filter("event_id % 5 = 0").select("event_id", F.expr("ts + interval 1 day").alias("ts"), (F.col("value") + 1).alias("value"), F.lit(2).alias("version"))
    older = e.filter("event_id % 4 = 0").select("event_id", "ts", (F.col("value") - 1).alias("value"), F.lit(0).alias("version"))
    for part in (e, newer, older):  # each a micro-batch of as many files as it takes
        part.withColumn("day", F.date_format("ts", "yyyy-MM-dd")).write.mode("append").parquet(f"{run}/in")
        shape = spark.read.parquet(f"{run}/in").schema
        query = ingest_newest(event_stream(spark, f"{run}/in", shape).drop("source_file"), f"{run}/table", f"{run}/state", newest_by=["version"])
        query.awaitTermination()
    return spark.read.parquet(f"{run}/table").select("event_id", "ts", "value", F.col("day").cast("string").alias("day"))


# --- written tables --------------------------------------------------------------------

@register("sync_table_written", f"""
WITH {_SYNC_SOURCE}, t2 AS (SELECT id, status, price, email, updated_at FROM target),
b AS (SELECT id, status, price, sha256(email || 'pepper') AS email, updated_at FROM source WHERE updated_at > (SELECT max(updated_at) - INTERVAL 1 HOUR FROM target))
SELECT coalesce(b.id, t.id) AS id, CASE WHEN b.id IS NULL THEN t.price ELSE b.price END AS price, CASE WHEN b.id IS NULL THEN t.email ELSE b.email END AS email,
  'STARTED,COMPLETED' AS log FROM t2 t FULL JOIN b ON b.id = t.id""")
def sync_table_written(spark: SparkSession, sf: str) -> DataFrame:
    """A merge rule run on a partitioned table in the shared folder, and its log."""
    source, target = _sync_tables(spark, sf)
    month = F.date_format("updated_at", "yyyy-MM").alias("month")
    folder = f"{shared_folder(spark)}/sync-{uuid.uuid4().hex}"
    target.select("*", month).write.partitionBy("month").parquet(f"{folder}/table")
    rule = _MERGE_RULE.with_(batch_max_rows=None)
    sync_table(rule, source.select("*", month), f"{folder}/table", f"{folder}/log", "month", datetime(2024, 1, 31), "pepper")
    states = spark.read.parquet(f"{folder}/log").agg(F.array_join(F.sort_array(F.collect_list("status"), asc=False), ",")).first()[0]
    return spark.read.parquet(f"{folder}/table").select("id", "price", "email", F.lit(states).alias("log"))


@register("sync_moved_key", f"""
WITH {_SYNC_SOURCE}, moved AS (SELECT id, price, updated_at + CASE WHEN id % 5 = 0 THEN INTERVAL 3 MONTH WHEN id % 11 = 0 THEN INTERVAL 400 DAY ELSE INTERVAL 1 SECOND END AS at
  FROM source WHERE id % 3 <> 1)
SELECT coalesce(m.id, t.id) AS id, CASE WHEN m.id IS NULL THEN t.price ELSE m.price END AS price, strftime(coalesce(m.at, t.updated_at), '%Y-%m') AS month, 0::BIGINT AS unknown_to_index
FROM target t FULL JOIN moved m ON m.id = t.id""")
def sync_moved_key(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of a merge rule whose updates fall into other months than the rows they replace."""
    source, target = _sync_tables(spark, sf)
    month = F.date_format("updated_at", "yyyy-MM").alias("month")
    folder = f"{shared_folder(spark)}/sync-{uuid.uuid4().hex}"
    target.select("*", month).write.partitionBy("month").parquet(f"{folder}/table")
    at = F.col("updated_at")
    later = (F.when(F.col("id") % 5 == 0, at + F.expr("interval 3 month")).when(F.col("id") % 11 == 0, at + F.expr("interval 400 day"))
             .otherwise(at + F.expr("interval 1 second")))
    moved = source.filter("id % 3 <> 1").withColumn("updated_at", later).select("*", month)
    rule = SyncRule("public", "orders", load_method="merge", key_field="id")
    for part in ("id % 2 = 0", "id % 2 = 1 or id % 5 = 0"):
        sync_table(rule, moved.filter(part), f"{folder}/table", f"{folder}/log", "month", datetime(2024, 1, 31))
    table_now = spark.read.parquet(f"{folder}/table")
    unknown = KeyIndex(spark, f"{folder}/table", "id", "month").misplaced(table_now).count()
    return table_now.select("id", "price", "month", F.lit(unknown).cast("long").alias("unknown_to_index"))
