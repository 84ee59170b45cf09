"""Silent stretches in event feeds.

Times are first put in buckets no wider than the feed's threshold and reduced, with
map-side combining, to the first and last time of each bucket.  Two times in one
bucket are closer than the threshold, so every gap that counts lies between two
buckets and no window ever sees the raw rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.functions.temporal import epoch_seconds, ntz, trunc_ntz
from tidemark.functions.text import code_map

DEFAULT_THRESHOLD = 300

# Feeds with their own threshold, in seconds.
THRESHOLDS = {
    "BUY_USER_INTERACTION_EVENTS": 15 * 60,
    "BUY_USER_EVENTS": 30 * 60,
    "COMPETITORS_COMPETITOR_QUOTES": 70 * 60,
    "PAYMENTS_PAYMENTS": 240 * 60,
}


def find_gaps(df: DataFrame, feed: str, ts: str, thresholds: Mapping[str, int] = THRESHOLDS,
              default: int = DEFAULT_THRESHOLD) -> DataFrame:
    """Gaps longer than the feed's threshold: ``(feed, gap_start, gap_end, gap_seconds)``.

    Times are compared in whole seconds.
    """
    limit = (code_map(feed, thresholds, default) if thresholds else F.lit(default)).cast("long")
    points = df.filter(F.col(ts).isNotNull()).select(
        F.col(feed).alias("feed"), trunc_ntz("second", ts).alias("t"), limit.alias("limit"))
    bucket = epoch_seconds("t") - F.pmod(epoch_seconds("t"), F.col("limit"))
    ends = points.groupBy("feed", "limit", bucket.alias("bucket")).agg(
        F.min("t").alias("first"), F.max("t").alias("last"))
    prev = F.lag("last").over(Window.partitionBy("feed").orderBy("first"))
    return (
        ends.withColumn("gap_start", prev)
        .withColumn("gap_seconds", epoch_seconds("first") - epoch_seconds("gap_start"))
        .filter(F.col("gap_seconds") > F.col("limit"))
        .select("feed", "gap_start", F.col("first").alias("gap_end"), "gap_seconds")
    )


def recent_feed(df: DataFrame, ts: str, now: object, days: int = 7, settle_hours: int = 3) -> DataFrame:
    """The stretch that is checked: the last days, less the hours still filling up."""
    low = ntz(now) - F.expr(f"interval {int(days)} day")
    high = ntz(now) - F.expr(f"interval {int(settle_hours)} hour")
    return df.filter(F.col(ts).between(low, high))


def gap_summary(gaps: DataFrame) -> DataFrame:
    """Per feed and day of gap start: count, longest, first start, last end and their span in seconds."""
    out = gaps.groupBy("feed", F.to_date("gap_start").alias("day")).agg(
        F.count(F.lit(1)).alias("gaps"), F.max("gap_seconds").alias("longest_seconds"),
        F.min("gap_start").alias("first_start"), F.max("gap_end").alias("last_end"))
    return out.withColumn("span_seconds", epoch_seconds("last_end") - epoch_seconds("first_start"))
