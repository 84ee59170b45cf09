"""Running totals, shares, row numbers and total rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.sinks.tables import parked


def running_share(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Running sum, group total and their ratio, row by row.

    The order must be unique within a group.  Meant for rows that are already summed
    up per step (an hour, a day): one group is handled by one task.  ``running_totals`` takes groups of any size.
    """
    w = Window.partitionBy(*group)
    upto = w.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run, total = F.sum(value).over(upto), F.sum(value).over(w)
    return df.withColumns({"running_total": run, "group_total": total}).withColumn(
        "running_ratio", F.col("running_total").cast("double") / F.col("group_total").cast("double"))


def with_group_values(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """Add aggregates of each row's group, as window aggregates would.

    A map-side combined aggregate gives one row per group with its size.  Groups larger than an average shuffle
    partition, of which there are fewer than partitions, are heavy: only their rows are spread over salts, as many as
    give pieces of half a partition, and only their values are repeated.  All others meet in a plain equi-join.  Rows with a
    NULL key get NULLs; if there are many they are spread as well.
    """
    spark, n = df.sparkSession, "__group_rows"
    values = parked(df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n), *aggregates))
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    total, most, none = values.agg(F.sum(n), F.max(F.when(~no_key, F.col(n))), F.sum(F.when(no_key, F.col(n)))).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fair = max(1, (total or 0) // partitions)
    values = values.filter(~no_key)
    if max(most or 0, none or 0) <= fair:
        return df.join(values.drop(n), list(keys), "left")
    salts = F.ceil(2 * F.col(n) / fair).cast("long").alias("__salts")
    heavy = values.filter(F.col(n) > fair).select(*keys, salts)
    known = F.broadcast(spark.createDataFrame(heavy.collect(), heavy.schema))  # fewer rows than partitions
    lots = F.when(no_key, F.lit(partitions)).otherwise(F.coalesce("__salts", F.lit(1)))
    spread = df.join(known, list(keys), "left").withColumn("__salt", F.pmod(F.xxhash64(*df.columns), lots)).drop("__salts")
    repeated = (values.drop(n).join(known, list(keys), "left")
                .withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("__salts", F.lit(1)) - 1))).drop("__salts"))
    return spread.join(repeated, [*keys, "__salt"], "left").drop("__salt")


def running_totals(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """``running_share`` for groups of any size: no task sorts a whole group.

    The rows are dealt out by ranges of (group, order) and written with the number of their range.  Sums per
    group and range give what comes before a range, for the few groups that span several; within a range the
    sums run as usual.  The order must be unique within a group.
    """
    by, at = [*group, *order], "__range"
    ranged = parked(df.repartitionByRange(*by).withColumn(at, F.spark_partition_id()))
    whole = Window.partitionBy(*group)
    parts = ranged.groupBy(*group, at).agg(F.sum(value).alias("__sum"))
    before = F.sum("__sum").over(whole.orderBy(at).rowsBetween(Window.unboundedPreceding, -1))
    spanning = parked(parts.withColumns({"__before": before, "__total": F.sum("__sum").over(whole), "__n": F.count(F.lit(1)).over(whole)})
                      .filter("__n > 1").select(*[F.col(g).alias(f"__{g}") for g in group], F.col(at).alias("__at"), "__before", "__total"))
    here = Window.partitionBy(*group, at)
    kind = df.select(F.sum(value)).schema[0].dataType
    # range by range over the tasks: the window below needs no other exchange
    dealt = ranged.repartitionByRange(at)
    summed = dealt.withColumns({"__within": F.sum(value).over(here.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)),
                                 "__part": F.sum(value).over(here)})
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in group] + [F.col(at) == F.col("__at")])
    # a sum of NULLs alone is NULL; those before a range count as nothing once something was added
    run = F.when(F.col("__within").isNull(), F.col("__before")).otherwise(F.col("__within") + F.coalesce("__before", F.lit(0)))
    total = F.when(F.col("__at").isNull(), F.col("__part")).otherwise(F.col("__total"))
    return (summed.join(spanning, same, "left")
            .select(*df.columns, run.cast(kind).alias("running_total"), total.cast(kind).alias("group_total"))
            .withColumn("running_ratio", F.col("running_total").cast("double") / F.col("group_total").cast("double")))


def group_count(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Add the number of rows of each group; rows with a NULL key count 0."""
    counted = with_group_values(df, keys, [F.count(F.lit(1)).alias(name)])
    return counted.withColumn(name, F.coalesce(name, F.lit(0)))


def global_row_number(df: DataFrame, first: Sequence[str], then: Sequence[Column], name: str) -> DataFrame:
    """``row_number`` over the whole result without one task sorting all of it.

    The rows are dealt out by ranges of the whole order and written with the number of their range, so
    that ranges are the same when they are counted and when they are numbered.  One
    number per range gives the offsets.  A range holds about its share of the rows however few values the
    leading columns have; only rows equal in the whole order stay together.
    """
    order = [*[F.col(c).asc() for c in first], *then]
    ranged = parked(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__n")).select(
        "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    within = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return (
        ranged.withColumn("__within", within).join(offsets, "__range")
        .withColumn(name, (F.col("__before") + F.col("__within")).cast("long"))
        .select(name, *df.columns)
    )


def with_total_row(df: DataFrame, key: str, aggregates: Sequence[Column], label: str = "Total") -> DataFrame:
    """Aggregates per key, and one more row for all keys together."""
    name = F.when(F.grouping(key) == 1, F.lit(label)).otherwise(F.col(key))
    return df.rollup(key).agg(name.alias("__name"), *aggregates).drop(key).withColumnRenamed("__name", key)


def ordered_listing(df: DataFrame, group: Sequence[str], text: str, position: str, sep: str, name: str) -> DataFrame:
    """Texts of a group joined in the order of a position column.

    The result is one text per group, so it is for groups whose text fits a row, such as
    the columns of a table.
    """
    items = F.array_sort(F.collect_list(F.struct(position, text)))
    joined = F.array_join(F.transform(items, lambda x: x[text]), sep)
    return df.groupBy(*group).agg(joined.alias(name))
