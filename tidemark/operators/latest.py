"""Keep one row, or the best rows, of each group.

A ``row_number() = 1`` filter lets Spark drop all but the first row of each key in
every map task, before the shuffle, so a key that owns a third of the table arrives
as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def first_per_key(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.  A NULL key is a key of its own."""
    w = Window.partitionBy(*_names(keys)).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def latest_per_key(df: DataFrame, keys: str | Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """The newest row of each key.  Later columns of ``newest_by`` break ties.

    NULL times count as newest, as in the warehouses' descending order.
    """
    return first_per_key(df, keys, [F.col(c).desc_nulls_first() for c in newest_by])


def at_max_per_group(df: DataFrame, keys: str | Sequence[str], value: str) -> DataFrame:
    """All rows whose value is the largest of their group; ties are all kept."""
    w = Window.partitionBy(*_names(keys)).orderBy(F.col(value).desc_nulls_last())
    return (
        df.filter(F.col(value).isNotNull())
        .withColumn("__rk", F.rank().over(w)).filter("__rk = 1").drop("__rk")
    )


def newest_where_keyed(df: DataFrame, keys: str | Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """Newest row per key; rows without a full key match nothing and are all kept."""
    names = _names(keys)
    keyed = F.lit(True)
    for k in names:
        keyed = keyed & F.col(k).isNotNull()
    return latest_per_key(df.filter(keyed), names, newest_by).unionByName(df.filter(~keyed))
