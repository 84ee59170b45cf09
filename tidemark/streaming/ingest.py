"""Event files as a stream: each file is read once, copies of an event are dropped.

Where the batch job reads yesterday's and today's folder again and keeps the *newest*
copy, ``ingest`` remembers which files it has read and keeps the *first* copy that
arrives; state is held only as long as the look-back.  ``ingest_newest`` keeps the newest copy, as the batch job does, and
holds no state: each micro-batch is merged into a partitioned table by its keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.sinks import store
from tidemark.sinks.keyindex import merge_keyed
from tidemark.sinks.tables import finish_publishing


def event_stream(spark: SparkSession, folder: str, schema: T.StructType, pattern: str | None = None,
                 files_per_trigger: int | None = None) -> DataFrame:
    """The files of a folder, with the file they came from."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder).select("*", F.col("_metadata.file_path").alias("source_file"))


def first_copies(events: DataFrame, key: str = "event_id", ts: str = "ts", look_back: str = "1 day") -> DataFrame:
    """Each event once, copies being recognised within the look-back.

    Stream time needs a zone: wall-clock times are taken in the session's zone.
    """
    timed = events.withColumn(ts, F.col(ts).cast("timestamp"))
    return timed.withWatermark(ts, look_back).dropDuplicatesWithinWatermark([key])


def ingest(events: DataFrame, table_path: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived since the last run to a Parquet table, then stop."""
    return (
        events.writeStream.format("parquet").option("path", table_path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start())


def merge_batch(batch: DataFrame, batch_id: int, path: str, key: str, newest_by: Sequence[str], partition: str, name: str = "stream") -> bool:
    """Merge one micro-batch into a partitioned table so that the newest copy of a key stays; False if it was merged before.

    The number of the last batch is written with the rows, so a batch that is delivered again after any interruption changes nothing.
    Copies may lie in different partitions: the key index of the table finds them.
    """
    spark, mark = batch.sparkSession, f"{path.rstrip('/')}__batches/{name}.txt"
    finish_publishing(spark, path)
    if store.exists(spark, mark) and int(store.get(spark, mark)) >= batch_id:
        return False
    merge_keyed(path, batch, key, partition, newest_by, keep_newer=True, mark=(mark, str(batch_id)))
    return True


def ingest_newest(events: DataFrame, path: str, checkpoint: str, key: str = "event_id", newest_by: Sequence[str] = ("dw_created_at",),
                  partition: str = "day", name: str = "stream") -> StreamingQuery:
    """Merge what has arrived since the last run into a partitioned Parquet table, then stop.

    ``newest_by`` should decide between any two copies; those equal in it are interchangeable.
    """
    def put(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, batch_id, path, key, newest_by, partition, name)

    return events.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
