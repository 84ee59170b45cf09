"""Replacing partitions of catalog tables without a moment in which they are absent.

As ``tables.replace_table`` does with a whole table: the new rows are written to a folder of their own, and
``ALTER TABLE .. PARTITION .. SET LOCATION`` makes them the partition's content.  Each partition is the old or the new one
at any time and never absent.  The list of switches is written before the first of them, and the next run finishes a list it finds.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sinks import store
from tidemark.sinks.tables import number_of, partition_values, stage, version_folder


def _value(v: object) -> str:
    return "null" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def replace_partitions(spark: SparkSession, df: DataFrame, table: str, partition: str, touched: Sequence) -> None:
    """Put the rows of ``df`` in place of the touched partitions of a Parquet table of the catalog; those without rows go."""
    finish_replacing(spark, table)
    base = f"{version_folder(spark, table)}/{uuid.uuid4().hex}"
    rows = stage(df, f"{base}-rows")
    left = partition_values(rows, partition)
    if stray := set(left) - set(touched):
        store.delete(spark, f"{base}-rows")
        raise ValueError(f"rows belong to other partitions: {sorted(map(str, stray))[:5]}")
    rows.repartition(partition).write.partitionBy(partition).parquet(base)
    put = [[_value(v), f"{base}/{store.partition_folder(spark, partition, v)}"] for v in left]
    gone = [_value(v) for v in set(touched) - set(left)]
    store.put(spark, f"{base}/note.json", json.dumps({"partition": partition, "put": put, "gone": gone}))
    store.delete(spark, f"{base}-rows")
    _switch(spark, table, base)


def _switch(spark: SparkSession, table: str, base: str) -> None:
    """Doing it twice changes nothing more."""
    note = json.loads(store.get(spark, f"{base}/note.json"))
    for value, folder in note["put"]:
        spec = f"PARTITION (`{note['partition']}` = {value})"
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {spec} LOCATION '{folder}'")
        spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION '{folder}'")
    for value in note["gone"]:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`{note['partition']}` = {value})")
    store.put(spark, f"{base}/_DONE", "")
    spark.catalog.refreshTable(table)


def finish_replacing(spark: SparkSession, table: str) -> int:
    """Finish the switches an earlier run has left half-done; returns how many."""
    base, done = version_folder(spark, table), 0
    for name in store.names(spark, base):
        if number_of(name) is not None:
            continue
        if store.exists(spark, f"{base}/{name}/note.json"):
            if not store.exists(spark, f"{base}/{name}/_DONE"):
                _switch(spark, table, f"{base}/{name}")
                done += 1
        else:  # rows that never were complete
            store.delete(spark, f"{base}/{name}")
    return done


def forget_old_partitions(spark: SparkSession, table: str, partition: str) -> int:
    """Delete version folders of partitions that the catalog names no more, when no reader can still have them; returns how many."""
    base, gone = version_folder(spark, table), 0
    specs = [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    used = set()
    for spec in specs:
        value = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(spec.split("=", 1)[1])
        known = _value(None if value == "null" or value == "__HIVE_DEFAULT_PARTITION__" else value)
        at = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION (`{partition}` = {known})").filter(F.col("col_name") == "Location").first()[1]
        used.add(at.rstrip("/").rsplit("/", 2)[1])
    for name in store.names(spark, base):
        if number_of(name) is None and name not in used and store.exists(spark, f"{base}/{name}/_DONE"):
            store.delete(spark, f"{base}/{name}")
            gone += 1
    return gone
