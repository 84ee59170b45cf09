"""Which partition holds which key: an index beside a partitioned table.

A merge has to find the old version of a key, whose partition may be another than the new version's.  The index
holds a narrow row (key, partition) for each key, so that a load reads a few columns of it instead of the table, and
then only the partitions that hold a key of its batch.

It is a set of segments, each written by one load and divided into ``SLOTS`` folders by a hash of the key, so that a
small batch prunes to few folders.  A segment is written *before* the load changes the table and marked as done
*after* it.  The last done segment that names a key says where it is; segments
that never were done may be true or not, and count as further places.  An interrupted load so makes a later one read a partition too
many, and never one too few.  After ``COMPACT_AFTER`` segments they are written as one.

Rows without a full key are in no index, as they match nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import loads
from tidemark.operators.latest import newest_where_keyed
from tidemark.sinks import store
from tidemark.sinks.tables import finish_publishing, of_partitions, parked, partition_values, publish_partitions

SLOTS, COMPACT_AFTER = 16, 32


class KeyIndex:
    """The index of the table at ``path``; ``partition`` is the table's partition column."""

    def __init__(self, spark: SparkSession, path: str, key: str | Sequence[str], partition: str, slots: int = SLOTS,
                 compact_after: int = COMPACT_AFTER):
        self.spark, self.partition, self.slots, self.compact_after = spark, partition, slots, compact_after
        self.keys = [key] if isinstance(key, str) else list(key)
        self.at = f"{path.rstrip('/')}__keys"

    def segments(self) -> dict[int, bool]:
        """The segments by number, and whether their load was done."""
        found = {}
        for name in store.names(self.spark, self.at):
            if name.startswith("segment="):
                found[int(name[8:])] = store.exists(self.spark, f"{self.at}/{name}/_DONE")
        return found

    def _folder(self, segment: int) -> str:
        return f"{self.at}/segment={segment}"

    def _slot(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.slots)).cast("int")

    def _keyed(self, rows: DataFrame) -> DataFrame:
        full = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])
        return rows.filter(full).select(*self.keys, F.col(self.partition).cast("string").alias("__at"))

    def note(self, rows: DataFrame) -> int:
        """Write where the keys of ``rows`` are going to be; returns the segment, to be marked when they are there."""
        segment = max(self.segments(), default=0) + 1
        # tasks by key, each with a part of every slot: as many as the rows ask for, where tasks by slot would be ``slots`` at most
        (self._keyed(rows).distinct().withColumn("__slot", self._slot()).write.mode("overwrite")
         .partitionBy("__slot").parquet(self._folder(segment)))
        return segment

    def done(self, segment: int) -> None:
        store.put(self.spark, f"{self._folder(segment)}/_DONE", "")
        if len(self.segments()) > self.compact_after:
            self.compact()

    def _entries(self, segments: dict[int, bool], slots: Sequence[int] | None = None) -> DataFrame | None:
        """Every (key, place) that may hold: those of a key's last done segment and of later ones that were not."""
        there = [s for s in sorted(segments) if any(n.startswith("__slot=") for n in store.names(self.spark, self._folder(s)))]
        if not there:
            return None
        rows = self.spark.read.option("basePath", self.at).parquet(*[self._folder(s) for s in there])
        if slots is not None:
            rows = rows.filter(F.col("__slot").isin(list(slots)))
        was_done = F.col("segment").isin([s for s in there if segments[s]]) if any(segments[s] for s in there) else F.lit(False)
        last = rows.filter(was_done).groupBy(*self.keys).agg(F.max("segment").alias("__last"))
        held = rows.join(last, self.keys, "left").filter((F.col("segment") >= F.col("__last")) | F.col("__last").isNull())
        return held.select(*self.keys, "__at").distinct()

    def locate(self, batch: DataFrame) -> DataFrame:
        """The places (key.., ``__at``) that may hold a key of the batch; keys the table does not know are absent.

        Without a hint: Spark broadcasts the batch's keys while they are few, and the index is then not shuffled.
        """
        wanted = self._keyed(batch).drop("__at").distinct()
        slots = [r[0] for r in wanted.select(self._slot().alias("s")).distinct().collect()]  # SLOTS at most
        entries = self._entries(self.segments(), slots)
        if entries is None:
            return self._keyed(batch).limit(0)
        return entries.join(wanted, self.keys, "left_semi")

    def build(self, table: DataFrame) -> None:
        """Index a table anew from its key and partition columns."""
        old = self.segments()
        self._replace(self.note(table), old)

    def _replace(self, segment: int, old: dict[int, bool]) -> None:
        store.put(self.spark, f"{self._folder(segment)}/_DONE", "")
        for s in old:
            store.delete(self.spark, self._folder(s))

    def compact(self) -> None:
        """All segments as one.  The new one is later than any other, so a run that ends before the old ones are deleted does no harm."""
        old = self.segments()
        entries = self._entries(old)
        if entries is not None:
            self._replace(self.note(parked(entries.withColumnRenamed("__at", self.partition))), old)

    def misplaced(self, table: DataFrame) -> DataFrame:
        """Rows' keys and partitions that the index does not know: empty unless the table was changed by other means."""
        rows, entries = self._keyed(table), self._entries(self.segments())
        if entries is None:
            return rows
        on = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(entries[c]) for c in [*self.keys, "__at"]])
        return rows.join(entries, on, "left_anti")


def _started(spark: SparkSession, path: str, partition: str) -> bool:
    return any(n.startswith(f"{partition}=") for n in store.names(spark, path))


def _table(batch: DataFrame, path: str, partition: str) -> DataFrame:
    """The table, its partition column of the batch's type instead of one guessed from the folders' names; none if it has not been started."""
    spark, kind = batch.sparkSession, batch.schema[partition].dataType
    if not _started(spark, path, partition):
        return batch.limit(0)
    shape = spark.read.parquet(path).schema
    return spark.read.schema(T.StructType([T.StructField(f.name, kind) if f.name == partition else f for f in shape])).parquet(path)


def index_of(batch: DataFrame, path: str, key: str | Sequence[str], partition: str) -> KeyIndex:
    """The index of the table a batch is for, built from the table if there is none yet, after finishing what an earlier load has left."""
    spark = batch.sparkSession
    finish_publishing(spark, path)
    index = KeyIndex(spark, path, key, partition)
    if _started(spark, path, partition) and not any(index.segments().values()):
        index.build(_table(batch, path, partition))
    return index


def _places(index: KeyIndex, batch: DataFrame) -> list:
    """The partitions that may hold a key of the batch."""
    places = index.locate(batch).select(F.col("__at").cast(batch.schema[index.partition].dataType).alias(index.partition))
    return partition_values(places, index.partition)


def merge_keyed(path: str, batch: DataFrame, key: str | Sequence[str], partition: str, newest_by: Sequence[str] | None = None,
                keep_newer: bool = False, mark: tuple[str, str] | None = None) -> None:
    """Upsert a batch into a partitioned Parquet table whose rows may change partition.

    Reads and rewrites the partitions that hold a key of the batch and those that the batch belongs to, and no
    others.  Rows without a full key are added.  With ``keep_newer`` a row of the table that is newer by ``newest_by`` than the
    batch's stays.  ``mark`` is written with the publication (``tables.publish_partitions``).
    """
    index = index_of(batch, path, key, partition)
    keys = index.keys
    batch = parked(newest_where_keyed(batch, keys, newest_by) if newest_by else batch)
    touched = list({*partition_values(batch, partition), *_places(index, batch)})
    table = of_partitions(_table(batch, path, partition), partition, touched)
    wanted = batch.select(*keys)
    old = table.join(wanted, keys, "left_semi")
    if keep_newer:
        put = newest_where_keyed(old.unionByName(batch, allowMissingColumns=True), keys, newest_by)
    else:  # an interrupted load may have left a row in two places; both give way to the new one
        put = loads.merge(old.dropDuplicates(keys), batch, keys, plan="lookup")
    put = parked(put)
    segment = index.note(put)
    publish_partitions(path, table.join(wanted, keys, "left_anti").unionByName(put), partition, touched, mark)
    index.done(segment)


def insert_keyed(path: str, batch: DataFrame, key: str | Sequence[str], partition: str, newest_by: Sequence[str] | None = None) -> DataFrame:
    """Append the rows of a batch whose key is not in the table; returns them.

    Of the table only the key columns of the partitions that the index names are read.
    """
    index = index_of(batch, path, key, partition)
    batch = parked(batch)
    there = of_partitions(_table(batch, path, partition), partition, _places(index, batch))
    fresh = parked(loads.new_rows(there, batch, index.keys, newest_by=newest_by))
    segment = index.note(fresh)
    fresh.write.mode("append").partitionBy(partition).parquet(path)
    index.done(segment)
    return fresh


def replace_keyed(path: str, rows: DataFrame, key: str | Sequence[str], partition: str) -> None:
    """Put ``rows`` in place of a whole table and of its index."""
    spark = rows.sparkSession
    finish_publishing(spark, path)
    index, rows = KeyIndex(spark, path, key, partition), parked(rows)
    old = index.segments()
    segment = index.note(rows)
    before = partition_values(_table(rows, path, partition), partition)
    publish_partitions(path, rows, partition, list({*before, *partition_values(rows, partition)}))
    index._replace(segment, old)
