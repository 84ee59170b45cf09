"""Watermarked batches that never split a group of rows sharing the order value.

The end of a batch is found by counting, not by sorting: rows are counted per bucket
of the order field, and the bucket holding the N-th row is divided again until one
value is left.  Each pass reads one narrow column, combines map-side and brings at
most ``_BUCKETS`` counts to the driver; the batch itself is a plain range filter that
reaches the scan, so it stays as parallel as the source.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from tidemark.functions.temporal import epoch_micros, ntz, trunc_ntz

_BUCKETS = 16384
_EPOCH = datetime(1970, 1, 1)
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class Cut:
    """Where a batch ends: rows with ``field < value`` (or ``<=`` if ``inclusive``)."""

    nth: Column
    value: Column
    inclusive: bool


def literal_for(df: DataFrame, field: str, value: object) -> Column:
    """A literal of the column's own type, so that the comparison can be pushed down."""
    return F.lit(str(value) if value is not None else None).cast(df.schema[field].dataType)


def ordinal(df: DataFrame, field: str) -> Column:
    """An order field as a long: integers, days, microseconds."""
    kind = df.schema[field].dataType
    if isinstance(kind, _INTEGERS):
        return F.col(field).cast("long")
    if isinstance(kind, T.DateType):
        return F.datediff(F.col(field), F.lit("1970-01-01").cast("date")).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(field))
    if isinstance(kind, T.TimestampNTZType):
        return epoch_micros(field)
    raise TypeError(f"order field {field} has type {kind.simpleString()}; need an integer, date or timestamp")


def value_of(df: DataFrame, field: str, ordinal: int) -> Column:
    """The literal of the field's type that ``ordinal`` stands for."""
    kind = df.schema[field].dataType
    if isinstance(kind, _INTEGERS):
        return F.lit(ordinal).cast(kind)
    if isinstance(kind, T.DateType):
        return F.date_add(F.lit("1970-01-01").cast("date"), ordinal)
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(ordinal))
    return ntz(_EPOCH + timedelta(microseconds=ordinal))


def find_cut(df: DataFrame, field: str, max_rows: int) -> Cut | None:
    """Where the first ``max_rows`` rows by ``field`` end; None if there are not more.

    Runs a few counting jobs.  Ties at the end are left for the next batch, unless
    they are the whole batch, which then keeps all of them.
    """
    pos = ordinal(df, field)
    total, low, high = df.agg(F.count(F.col(field)), F.min(pos), F.max(pos)).first()
    if total <= max_rows:
        return None
    below = 0
    while low < high:
        width = (high - low) // _BUCKETS + 1
        part = df.filter(F.col(field).between(value_of(df, field, low), value_of(df, field, high)))
        bucket_of = F.call_function("div", pos - F.lit(low), F.lit(width))
        counts = part.groupBy(bucket_of.alias("b")).count().collect()
        for bucket, n in sorted((r["b"], r["count"]) for r in counts):
            if below + n > max_rows:
                low, high = low + bucket * width, min(high, low + (bucket + 1) * width - 1)
                break
            below += n
    edge = value_of(df, field, low)
    if below == 0:
        return Cut(nth=edge, value=edge, inclusive=True)
    if below < max_rows:
        return Cut(nth=edge, value=edge, inclusive=False)
    last = df.filter(F.col(field) < edge).agg(F.max(pos)).first()[0]
    return Cut(nth=value_of(df, field, last), value=edge, inclusive=False)


def _until(df: DataFrame, field: str, cut: Cut | None) -> DataFrame:
    if cut is None:
        return df
    return df.filter(F.col(field) <= cut.value if cut.inclusive else F.col(field) < cut.value)


def incremental_extract(df: DataFrame, order_field: str | None, watermark: object = None,
                        max_rows: int | None = None, condition: str | None = None,
                        volume: str = "medium") -> DataFrame:
    """The next batch of a source: rows past the watermark, at most about ``max_rows``.

    Without an order field the whole source is the batch.  ``volume='high'`` on a time
    field also leaves out the minute still being written: it keeps rows before the
    start of the minute of the N-th row, less one minute.  If that leaves nothing although
    there are more than N rows, the ordinary cut is used so that the feed moves on; a
    feed whose few rows all lie in the open minutes waits.
    """
    if condition:
        df = df.filter(F.expr(condition))
    if order_field is None:
        return df
    fresh = df if watermark is None else df.filter(F.col(order_field) > literal_for(df, order_field, watermark))
    fresh = fresh.filter(F.col(order_field).isNotNull())
    cut = find_cut(fresh, order_field, max_rows) if max_rows else None
    is_time = isinstance(df.schema[order_field].dataType, (T.TimestampType, T.TimestampNTZType))
    if volume.lower() == "high" and is_time and max_rows:
        nth = cut.nth if cut else F.lit(fresh.agg(F.max(order_field).cast("string")).first()[0])
        nth = nth.cast(df.schema[order_field].dataType)
        minute = F.date_trunc("minute", nth) if isinstance(df.schema[order_field].dataType, T.TimestampType) \
            else trunc_ntz("minute", nth)
        closed = fresh.filter(F.col(order_field) < minute - F.expr("interval 1 minute"))
        if cut is None or not closed.isEmpty():
            return closed
    return _until(fresh, order_field, cut)


#: A bucket that holds the end of a page is divided into so many.
_DIVIDED = 512
#: Pages whose starts are found together: so many at first, more later.
_AHEAD, _MOST_AHEAD = 64, 65536


def page_starts(df: DataFrame, field: str, max_rows: int, first: int = 0, pages: int | None = None) -> list[int]:
    """The order values (as numbers, see ``ordinal``) at which the pages of a source start.

    A page has at most ``max_rows`` rows, or one order value.  A value belongs to the page that the last of its rows falls
    into when the rows are counted off; a page that gets more rows so, because its first value began in
    the page before, is divided after that value.

    One histogram of the field serves all pages, and each further job divides the buckets in which a page starts, all at once.  The number of
    jobs depends on the span of the field alone (six for microseconds of a century), whatever the number of pages.

    With ``pages`` only the starts of that many pages, from page ``first`` (0) on, when the rows are counted off: the driver holds no
    more than these.  A value that fills several pages starts in the first of them, and is given again for any of the others.
    """
    total, low, high = df.agg(F.count(F.col(field)), F.min(ordinal(df, field)), F.max(ordinal(df, field))).first()
    ranks = range(0, total, max_rows)[first:None if pages is None else first + pages]
    if not ranks:
        return []
    # one page more than is asked for, to know how many rows the last one gets
    beyond = [ranks[-1] + max_rows] if ranks[-1] + max_rows < total else []
    held = _holding(df, field, [*ranks, *beyond], low, high)
    found, out = sorted({held[rank] for rank in ranks}), []
    value, under, n = found[-1]
    following = -(-(under + n) // max_rows) * max_rows  # the first row counted off that is not in the last of these values
    if following < total:
        end_of_last = (held if following in held else _holding(df, field, [following], low, high))[following][1]
    else:
        end_of_last = total
    for (value, under, n), end in zip(found, [*(under for _, under, _ in found[1:]), end_of_last], strict=True):
        out.append(low + value)
        if end - under > max_rows and end - under > n:
            out.append(low + value + 1)
    return out


def _holding(df: DataFrame, field: str, ranks: Sequence[int], low: int, high: int) -> dict[int, tuple[int, int, int]]:
    """Of each row number (from 0, ascending) the order value that holds it, less ``low``, the rows before that value and its rows."""
    spark, pos = df.sparkSession, ordinal(df, field)
    width = 1
    while (high - low) // width >= _BUCKETS:
        width *= _DIVIDED
    place = F.call_function("div", pos - F.lit(low), F.lit(width))
    starts, below, todo = {}, 0, iter(ranks)
    counts = sorted((r["b"], r["count"]) for r in df.filter(F.col(field).isNotNull()).groupBy(place.alias("b")).count().collect())
    rank = next(todo, None)
    for bucket, n in counts:
        while rank is not None and rank < below + n:
            starts[rank] = (bucket, below, n)
            rank = next(todo, None)
        below += n
    while width > 1:
        width //= _DIVIDED
        asked = spark.createDataFrame([(b, k, under) for k, (b, under, _) in starts.items()], "__bucket long, __rank long, __under long")
        fine = F.call_function("div", pos - F.lit(low), F.lit(width))
        held = df.filter(F.col(field).isNotNull()).select(fine.alias("__fine")).withColumn("__bucket", F.call_function("div", "__fine", F.lit(_DIVIDED)))
        counted = held.join(F.broadcast(asked.select("__bucket").distinct()), "__bucket", "left_semi").groupBy("__bucket", "__fine").count()  # at most a row a page
        upto = F.sum("count").over(Window.partitionBy("__bucket").orderBy("__fine"))
        found = (counted.withColumn("__end", upto).join(F.broadcast(asked), "__bucket")
                 .filter((F.col("__rank") < F.col("__under") + F.col("__end")) & (F.col("__rank") >= F.col("__under") + F.col("__end") - F.col("count"))))
        starts = {r["__rank"]: (r["__fine"], r["__under"] + r["__end"] - r["count"], r["count"]) for r in found.collect()}
    return starts


def batches(df: DataFrame, order_field: str, max_rows: int, watermark: object = None) -> Iterator[DataFrame]:
    """All batches of a source, oldest first, each ending at a complete order value.

    The ends are found for some batches ahead when they are needed, for ``_AHEAD`` at first and for more and more later, so the first batches of
    a source cost the same however many follow.  Rows that come later belong to the last batch or, below its start, to the batch of
    their value.
    """
    rest = df if watermark is None else df.filter(F.col(order_field) > literal_for(df, order_field, watermark))
    rest = rest.filter(F.col(order_field).isNotNull())

    def part(start: int | None, end: int | None) -> DataFrame:
        out = rest if start is None else rest.filter(F.col(order_field) >= value_of(df, order_field, start))
        return out if end is None else out.filter(F.col(order_field) < value_of(df, order_field, end))

    seen, begin, first, ahead = None, None, 0, _AHEAD
    while starts := page_starts(rest, order_field, max_rows, first, ahead):
        for start in starts:
            if seen is not None and start > seen:
                yield part(begin, start)
                begin = start
            seen = start if seen is None else max(seen, start)  # what lies below the first start came later
        first, ahead = first + ahead, min(8 * ahead, _MOST_AHEAD)
    yield part(begin, None)
