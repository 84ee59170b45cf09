"""Price history answers to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.temporal import epoch_s_to_text

TICKS = "array<struct<pair:string,data:array<struct<time:bigint,close:double>>>>"


def flatten_ticks(df: DataFrame, payload: str) -> DataFrame:
    """``[{pair, data: [{time, close}, ..]}, ..]`` to ``(currency_pair, price, ts)``, ts as UTC text."""
    return (
        df.select(F.explode(F.from_json(payload, TICKS)).alias("p"))
        .select(F.col("p.pair").alias("currency_pair"), F.explode("p.data").alias("d"))
        .select("currency_pair", F.col("d.close").alias("price"), epoch_s_to_text("d.time").alias("ts"))
    )

