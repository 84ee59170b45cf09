"""Publishing tables.  New content is complete before old content goes away."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import loads
from tidemark.sinks import store
from tidemark.session import shared_folder


def location(spark: SparkSession, table: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first()[1]


def version_folder(spark: SparkSession, table: str) -> str:
    """Where the versions of a table are: below the warehouse, by the table's name."""
    name = table.replace("`", "").replace(".", "/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}__versions"


def _plain(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name.lower(), f.dataType.simpleString().lower()) for f in schema.fields]


def number_of(name: str) -> int | None:
    """The number of a version folder, None for other names."""
    return int(name[1:]) if name[:1] == "v" and name[1:].isdigit() else None


def replace_table(spark: SparkSession, df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Truncate-insert of a whole table; a table that is not there is created.

    The new content is written to a version folder of its own, and one ``ALTER TABLE .. SET LOCATION`` makes it the
    table's content: readers find the old version or the new one, whole, at any time.  The version before the current
    one stays for readers that have listed its files; older ones, and those of runs that never got to the switch, are
    deleted by the next run.
    A failure while writing leaves the old table as it was.  A table of other columns has to be dropped
    first: its name stays, so its readers would find other columns under it.
    """
    base = version_folder(spark, table)
    there = spark.catalog.tableExists(table)
    if there and _plain(spark.table(table).schema) != _plain(df.schema):
        raise ValueError(f"{table} has other columns: drop it first")
    known = [n for n in (number_of(x) for x in store.names(spark, base)) if n is not None]
    current = location(spark, table).rstrip("/").rpartition("/")[2] if there else ""
    at = number_of(current) if there and location(spark, table).rstrip("/").endswith(f"__versions/{current}") else None
    for n in known:  # what the last run has replaced, and what a run has left that never came to the switch
        if at is None or n != at:
            store.delete(spark, f"{base}/v{n}")
    new = f"{base}/v{max([n for n in known if at is not None and n <= at], default=0) + 1}"
    df.write.format(fmt).mode("overwrite").save(new)
    if there:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{new}'")
        spark.catalog.refreshTable(table)
    else:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING {fmt} LOCATION '{new}'")


def overwrite_partitions(df: DataFrame, path: str, *partition_columns: str) -> None:
    """Replace only the partitions that occur in ``df``.

    ``df`` must not read from ``path``; stage it first if it does.
    """
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_columns).parquet(path))


def stage(df: DataFrame, folder: str) -> DataFrame:
    """Write a batch once and read it back.

    Later joins then plan on the true size of the batch, and a lost executor does not
    cause the source to be read again.
    """
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def parked(df: DataFrame) -> DataFrame:
    """A small intermediate result that many joins use, computed once.

    Written as Parquet to the application's shared folder, so it outlives lost executors
    and its true size is known when the joins are planned.  ``session.forget_intermediates``
    removes all of them.
    """
    return stage(df, f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}")


#: More partitions than this are not changed by one load.
MOST_PARTITIONS = 10_000


def partition_values(df: DataFrame, partition: str) -> list:
    """The partitions a batch touches; raises beyond ``MOST_PARTITIONS``."""
    values = [r[0] for r in df.select(partition).distinct().limit(MOST_PARTITIONS + 1).collect()]
    if len(values) > MOST_PARTITIONS:
        raise ValueError(f"a batch touches more than {MOST_PARTITIONS} partitions: reload the table instead")
    return values


def of_partitions(table: DataFrame, partition: str, values: Sequence) -> DataFrame:
    """The rows of some partitions, by a constant filter that prunes the files."""
    known, none = [v for v in values if v is not None], None in values
    keep = F.col(partition).isin(known) if known else F.lit(False)
    return table.filter(keep | F.col(partition).isNull() if none else keep)


def staging(path: str) -> str:
    """Where complete rows wait to be put in place of partitions of ``path``."""
    return f"{path.rstrip('/')}__staged"


def publish_partitions(path: str, rows: DataFrame, partition: str, touched: Sequence, mark: tuple[str, str] | None = None) -> None:
    """Put ``rows`` in place of the touched partitions; one that has no rows left is removed.

    The rows are complete beside the table, with a note of what they replace, before the first old file
    goes.  A run that ends between the steps is finished by the next one (``finish_publishing``).
    One load at a time may write to a table.  ``mark`` is a small file (path, content) that is written with the publication: it is there if and
    only if the rows are, once ``finish_publishing`` has run.
    """
    spark = rows.sparkSession
    finish_publishing(spark, path)
    folder = f"{staging(path)}/{uuid.uuid4().hex}"
    rows = stage(rows, f"{folder}/rows")
    left = set(partition_values(rows, partition))
    if stray := left - set(touched):
        store.delete(spark, folder)
        raise ValueError(f"rows belong to other partitions: {sorted(map(str, stray))[:5]}")
    gone = [store.partition_folder(spark, partition, v) for v in set(touched) - left]
    store.put(spark, f"{folder}/note.json", json.dumps({"partition": partition, "gone": gone, "schema": rows.schema.json(), "mark": mark}))
    _put_in_place(spark, path, folder)


def _put_in_place(spark: SparkSession, path: str, folder: str) -> None:
    """Doing it twice changes nothing more."""
    note = json.loads(store.get(spark, f"{folder}/note.json"))
    rows = spark.read.schema(T.StructType.fromJson(json.loads(note["schema"]))).parquet(f"{folder}/rows")
    overwrite_partitions(rows, path, note["partition"])
    for name in note["gone"]:
        store.delete(spark, f"{path}/{name}")
    if note["mark"]:
        store.put(spark, *note["mark"])
    store.delete(spark, folder)


def finish_publishing(spark: SparkSession, path: str) -> int:
    """Finish what an earlier run has left half-done; returns how many publications that were."""
    done = 0
    for name in store.names(spark, staging(path)):
        folder = f"{staging(path)}/{name}"
        if store.exists(spark, f"{folder}/note.json"):
            _put_in_place(spark, path, folder)
            done += 1
        else:  # the rows were not complete, so no file of the table was touched
            store.delete(spark, folder)
    return done


def merge_partitions(path: str, batch: DataFrame, key: str | Sequence[str], partition: str,
                     newest_by: Sequence[str] | None = None) -> None:
    """Upsert a batch into a partitioned Parquet table, touching only its own partitions.

    For keys that never change partition (a payment and its day); others need ``keyindex.merge_keyed``.
    """
    batch = parked(batch)
    touched = partition_values(batch, partition)
    finish_publishing(batch.sparkSession, path)
    table = of_partitions(batch.sparkSession.read.parquet(path), partition, touched)
    publish_partitions(path, loads.merge(table, batch, key, newest_by=newest_by), partition, touched)


def upsert_partitions(path: str, batch: DataFrame, key: str | Sequence[str], partition: str, set_columns: Sequence[str], update_where: str,
                      newest_by: Sequence[str] | None = None) -> None:
    """``loads.conditional_upsert`` on a partitioned Parquet table, touching only the batch's partitions.

    For keys that never change partition, which the set columns may therefore not name.
    """
    if partition in set_columns:
        raise ValueError(f"{partition} is the partition: a row cannot be moved by a conditional upsert")
    batch = parked(batch)
    touched = partition_values(batch, partition)
    finish_publishing(batch.sparkSession, path)
    table = of_partitions(batch.sparkSession.read.parquet(path), partition, touched)
    rows = loads.conditional_upsert(table, batch, key, set_columns, update_where, newest_by=newest_by, plan="lookup")
    publish_partitions(path, rows, partition, touched)


def _days(spark: SparkSession, first: object, last: object) -> list:
    return [r[0] for r in spark.sql(f"SELECT explode(sequence(DATE'{str(first)[:10]}', DATE'{str(last)[:10]}')) AS d").collect()]


def overwrite_window_partitions(path: str, source: DataFrame, ts: str, start: object, end: object, day: str = "day") -> None:
    """``loads.overwrite_window`` for a table partitioned by the day of ``ts``."""
    spark = source.sparkSession
    days = _days(spark, start, end)
    table = of_partitions(spark.read.parquet(path), day, days)
    fresh = source.filter(loads.in_window(ts, start, end)).withColumn(day, F.to_date(ts))
    publish_partitions(path, loads.overwrite_window(table, fresh.select(*table.columns), ts, start, end), day, days)


def rebuild_partitions(path: str, source: DataFrame, ts: str, today: object, days: int, day: str = "day") -> None:
    """``loads.rebuild_trailing`` for a table partitioned by the day of ``ts``: later partitions are pruned to."""
    spark = source.sparkSession
    since = spark.sql(f"SELECT CAST('{today}' AS TIMESTAMP_NTZ) - INTERVAL {int(days)} DAY").first()[0]
    table = spark.read.parquet(path).filter(F.col(day) >= F.lit(since.date()))
    fresh = source.filter(F.col(ts) > F.lit(since)).withColumn(day, F.to_date(ts))
    rows = parked(loads.rebuild_trailing(table, fresh.select(*table.columns), ts, today, days))
    publish_partitions(path, rows, day, list({*partition_values(table, day), *partition_values(rows, day)}))


def dedupe_partitions(path: str, key: str, loaded_at: str, first: object, last: object, tie_break: Sequence[str] = (),
                      day: str = "day") -> None:
    """One copy per key among the rows loaded on some days, in a table partitioned by the day of loading."""
    spark = SparkSession.getActiveSession()
    days = _days(spark, first, last)
    table = of_partitions(spark.read.parquet(path), day, days)
    publish_partitions(path, loads.dedupe_recent(table, key, loaded_at, first, tie_break), day, partition_values(table, day))
