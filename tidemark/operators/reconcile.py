"""Reconciliation between a source and its copy."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.temporal import ntz, trunc_ntz
from tidemark.sources.batches import ordinal, value_of


def _one_count(df: DataFrame, name: str, side: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(name).alias("table_name"), F.lit(side).alias("side"), "n")


def _compare(counts: Sequence[DataFrame]) -> DataFrame:
    rows = reduce(DataFrame.unionByName, counts)
    out = rows.groupBy("table_name").agg(
        F.sum(F.when(F.col("side") == "source", F.col("n")).otherwise(0)).alias("source_count"),
        F.sum(F.when(F.col("side") == "target", F.col("n")).otherwise(0)).alias("target_count"))
    return out.withColumn("delta", F.col("source_count") - F.col("target_count"))


def count_difference(source: DataFrame, target: DataFrame, name: str, where_source: str | None = None,
                     where_target: str | None = None) -> DataFrame:
    """One row ``(table_name, source_count, target_count, delta)``; each side has its own filter."""
    s = source.filter(F.expr(where_source)) if where_source else source
    t = target.filter(F.expr(where_target)) if where_target else target
    return _compare([_one_count(s, name, "source"), _one_count(t, name, "target")])


def value_difference(source: DataFrame, target: DataFrame, columns: Sequence[str],
                     where: str | None = None) -> DataFrame:
    """Distinct rows found on one side only, with the side.  NULLs compare equal.

    Both directions come from one aggregate over the two sides together, combined
    map-side: one shuffle, and duplicates collapse before it.
    """
    def part(df: DataFrame, side: str) -> DataFrame:
        df = df.filter(F.expr(where)) if where else df
        return df.select(*columns, F.lit(side == "source").alias("__s"), F.lit(side == "target").alias("__t"))

    both = part(source, "source").unionByName(part(target, "target"))
    seen = both.groupBy(*columns).agg(F.max("__s").alias("__s"), F.max("__t").alias("__t"))
    side = F.when(F.col("__s"), F.lit("source")).otherwise(F.lit("target"))
    return seen.filter(F.col("__s") != F.col("__t")).select(*columns, side.alias("only_in"))


def _checksums(df: DataFrame, side: str, at: Column, columns: Sequence[str]) -> DataFrame:
    """Per place its rows and two sums of row hashes; NULLs are told apart from absent values by their marks."""
    marks = [F.col(c).isNull().cast("int") for c in columns]
    said = [F.sum(F.xxhash64(F.lit(seed), *columns, *marks).cast("decimal(38,0)")) for seed in (1, 2)]
    out = df.groupBy(at.alias("__place")).agg(F.count(F.lit(1)).alias("__n"), said[0].alias("__a"), said[1].alias("__b"))
    return out.withColumn("__side", F.lit(side))


def _place(df: DataFrame, key: str, base: int, width: int) -> Column:
    return F.call_function("div", ordinal(df, key) - F.lit(base), F.lit(width))


def _within(df: DataFrame, key: str, base: int, width: int, places: Sequence[int], nulls: bool, spans: int = 16) -> DataFrame:
    """The rows of some places, and those with a NULL key if wanted; a few covering ranges of the key reach the scan."""
    none = F.col(key).isNull() if nulls else F.lit(False)
    if not places:
        return df.filter(none)
    gaps = sorted(((b - a, i) for i, (a, b) in enumerate(zip(places, places[1:])) if b - a > 1), reverse=True)[:spans - 1]
    edges = [0, *sorted(i + 1 for _, i in gaps), len(places)]
    cover = [F.col(key).between(value_of(df, key, base + places[i] * width), value_of(df, key, base + (places[j - 1] + 1) * width - 1)) for i, j in zip(edges, edges[1:])]
    return df.filter(reduce(lambda a, b: a | b, cover, none)).filter(_place(df, key, base, width).isin(list(places)) | none)


def differing_places(source: DataFrame, target: DataFrame, key: str, columns: Sequence[str], ranges: int = 1024,
                     rounds: int = 3) -> tuple[int, int, list[int], bool]:
    """(base, width, places, nulls): the two sides do not have the same rows where (key - base) div width is one of the places, nor,
    with ``nulls``, where the key is NULL.

    Each round compares count and checksums by place, which a map-side combined aggregate brings to as many rows a task as there are places, and
    the next divides those that differ, ``ranges`` pieces in all.  Two equal tables are settled by the first round: no row of theirs is exchanged.
    """
    bounds = [df.agg(F.min(ordinal(df, key)), F.max(ordinal(df, key))).first() for df in (source, target)]
    ends = [v for b in bounds for v in b if v is not None]
    base, width, places, nulls = (min(ends), max(ends) + 1 - min(ends), [0], True) if ends else (0, 1, [], True)
    for turn in range(rounds):
        finer = max(1, -(-width * max(1, len(places)) // ranges))
        if turn and (finer >= width or not places):
            break
        finer = width // max(1, width // finer)  # pieces of a place; the last may reach into the next
        sides = [_within(df, key, base, width, places, nulls and turn == 0) for df in (source, target)]
        both = reduce(DataFrame.unionByName, [_checksums(df, n, _place(df, key, base, finer), columns) for df, n in zip(sides, "st", strict=True)])
        differ = both.groupBy("__place").agg(*[F.sum(F.when(F.col("__side") == "s", F.col(c)).otherwise(-F.col(c))).alias(c) for c in ("__n", "__a", "__b")])
        found = [r[0] for r in differ.filter("__n <> 0 or __a <> 0 or __b <> 0").select("__place").collect()]  # about ``ranges`` at most
        nulls = None in found or (nulls and turn > 0)
        places, width = sorted(p for p in found if p is not None), finer
    return base, width, places, nulls


def value_difference_by_ranges(source: DataFrame, target: DataFrame, key: str, columns: Sequence[str], where: str | None = None,
                               ranges: int = 1024) -> DataFrame:
    """``value_difference`` of two tables that are nearly equal: rows are exchanged only from ranges of the key that differ.

    The key is an integer, date or time; covering ranges of it reach the scans.  ``columns`` must hold the key.
    """
    if where:
        source, target = source.filter(F.expr(where)), target.filter(F.expr(where))
    found = differing_places(source, target, key, columns, ranges)
    return value_difference(_within(source, key, *found), _within(target, key, *found), columns)


def stored_count(spark: SparkSession, path: str, where: str | None = None) -> DataFrame:
    """The number of rows of a Parquet table, one row ``n``, from the files' footers instead of their pages.

    A predicate on partition columns keeps it so; one on other columns is counted by reading them.  The plan is made in a session of
    its own, whose Parquet source hands aggregates down to the files.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    df = own.read.parquet(path)
    return (df.filter(F.expr(where)) if where else df).agg(F.count(F.lit(1)).alias("n"))


def stored_count_check(spark: SparkSession, tables: Mapping[str, tuple[str, str]], where: str | None = None) -> DataFrame:
    """Row counts of many stored tables, name to (source path, target path), by their footers: as ``catalog_count_check``."""
    rows = [(name, side, stored_count(spark, path, where).first()["n"]) for name, paths in tables.items()
            for side, path in zip(("source", "target"), paths, strict=True)]
    return _compare([spark.createDataFrame(rows, "table_name string, side string, n long")])


def transform_check(source: DataFrame, target: DataFrame, name: str, columns: Sequence[str],
                    where: str | None = None) -> DataFrame:
    """Value and count difference of one table in one row."""
    diff = value_difference(source, target, columns, where).groupBy("only_in").agg(F.count(F.lit(1)).alias("n"))
    sides = F.when(F.col("only_in") == "source", "missing_in_target").otherwise("missing_in_source")
    measures = reduce(DataFrame.unionByName, [
        _one_count(source, name, "source_count"), _one_count(target, name, "target_count"),
        diff.select(F.lit(name).alias("table_name"), sides.alias("side"), "n")])
    out = measures.groupBy("table_name").agg(*[
        F.sum(F.when(F.col("side") == m, F.col("n")).otherwise(0)).alias(m)
        for m in ("source_count", "target_count", "missing_in_target", "missing_in_source")])
    return out.withColumn("delta", F.col("source_count") - F.col("target_count"))


def check_window(now: object, years_back: int) -> tuple[Column, Column]:
    """From the start of the year ``years_back`` years ago to two hours before this hour."""
    start = trunc_ntz("year", ntz(now)) - F.expr(f"interval {int(years_back)} year")
    return start, trunc_ntz("hour", ntz(now)) - F.expr("interval 2 hour")


def catalog_count_check(sources: Mapping[str, DataFrame], targets: Mapping[str, DataFrame], now: object,
                        years_back: int = 1, skip: Sequence[str] = (), schemas: Sequence[str] | None = None,
                        time_columns: Sequence[str] = ("created_at", "inserted_at")) -> DataFrame:
    """Row counts of many tables within a window, source against target.

    Names are ``schema.table``.  Tables without a time column, outside the listed
    schemas or on the skip list are left out.  One plan covers all tables.
    """
    start, end = check_window(now, years_back)
    counts = []
    for name, target in targets.items():
        schema, _, table = name.rpartition(".")
        field = next((c for c in target.columns if c.lower() in time_columns), None)
        if field is None or table.lower() in {s.lower() for s in skip}:
            continue
        if schemas is not None and schema.lower() not in {s.lower() for s in schemas}:
            continue
        for side, df in (("source", sources[name]), ("target", target)):
            counts.append(_one_count(df.filter(F.col(field).between(start, end)), name, side))
    return _compare(counts)


Check = Callable[[Mapping[str, DataFrame], object], DataFrame]


def custom_checks(checks: Mapping[str, Check], source: Mapping[str, DataFrame], target: Mapping[str, DataFrame],
                  now: object) -> DataFrame:
    """Named checks: each is a function from the tables of one side and ``now`` to rows to count."""
    counts = []
    for name, check in checks.items():
        counts.append(_one_count(check(source, now), name, "source"))
        counts.append(_one_count(check(target, now), name, "target"))
    return _compare(counts)


def duplicate_keys(df: DataFrame, key: str, loaded_at: str, since: object) -> DataFrame:
    """Keys that occur more than once since a time: ``(key, copies, newest)``."""
    recent = df.filter((F.col(loaded_at) >= ntz(since)) & F.col(key).isNotNull())
    return recent.groupBy(key).agg(
        F.count(F.lit(1)).alias("copies"), F.max(loaded_at).alias("newest")).filter("copies > 1")
