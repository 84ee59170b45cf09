"""Intraday volume forecast per liquidity provider, against its daily cap."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.jsonops import text_at
from tidemark.functions.temporal import hour_text, iso_weekday, ntz, quarter_hour
from tidemark.functions.text import display_amount, display_percent
from tidemark.operators.latest import first_per_key, latest_per_key
from tidemark.operators.running import running_share

Tables = Mapping[str, DataFrame]

# Verifications and the approval rate that applies to them.
KYC_TYPES = ["kyc_identity", "kyc_liveness_identity"]
RATE_KEYS = {"kyc_rate": "poid", "photo_rate": "photo_selfie", "video_rate": "video_selfie"}


def _brokers(t: Tables) -> DataFrame:
    return t["partners"].filter(F.col("service_type") == "broker")


def _settled(t: Tables) -> DataFrame:
    """Settled payments of brokers, with the broker's name."""
    names = _brokers(t).select(F.col("id").alias("pay_to_partner_id"), "name")
    return t["payments"].filter("status = 2").join(names, "pay_to_partner_id").select("handling_at", "total_amount_usd", "name")


def reached_share(t: Tables, today: datetime) -> DataFrame:
    """Share of a day's volume reached by weekday, hour, quarter hour and provider, averaged
    over the three months that end two days ago.

    Payments are summed to one row per day, quarter hour and provider before the running
    total, so a day's window holds at most 96 rows per provider.
    """
    low, high = ntz(today - timedelta(days=92)), ntz(today - timedelta(days=2))
    past = _settled(t).filter(F.col("handling_at").between(low, high))
    steps = past.groupBy(
        F.to_date("handling_at").alias("day"), hour_text("handling_at").alias("hour"), quarter_hour("handling_at").alias("minutes"),
        iso_weekday("handling_at").alias("dow"), "name").agg(F.sum("total_amount_usd").alias("amount"))
    shares = running_share(steps, ["day"], ["hour", "minutes", "name"], "amount")
    return shares.groupBy("dow", "hour", "minutes", "name").agg(F.avg("running_ratio").alias("reached"))


def approval_rates(t: Tables, constant: str, providers: Sequence[str] | None = None) -> DataFrame:
    """Newest approval rates, one row per provider named in the constant's JSON."""
    newest = latest_per_key(t["constants"].filter(F.col("name") == constant), "name", ["inserted_at"])
    entries = newest.select(F.explode(F.from_json("json_value", "map<string,string>")).alias("provider", "rates"))
    if providers is not None:
        entries = entries.filter(F.col("provider").isin(*providers))
    return entries.select("provider", *[text_at("rates", k).cast("double").alias(n) for n, k in RATE_KEYS.items()])


def soon_approved(t: Tables, now: datetime, constant: str, providers: Sequence[str] | None = None) -> DataFrame:
    """Volume still under verification since yesterday, weighted by its approval rate, with a total row."""
    waiting = t["payments"].filter(F.col("status").isin(1, 25) & (F.col("updated_at") > ntz(now - timedelta(hours=24))))
    quotes = t["quotes"].select("quote_id", "broker_id", F.col("created_at").alias("quoted_at"))
    names = t["partners"].select(F.col("id").alias("broker_id"), F.col("name").alias("provider"))
    live = waiting.select("id", "quote_id", "total_amount_usd").join(quotes, "quote_id").join(names, "broker_id")
    live = first_per_key(live, "id", [F.col("quoted_at").desc()])
    checks = t["verifications"].select(F.col("initial_payment_id").alias("id"), "verification_type", "inserted_at")
    checks = checks.join(waiting.select("id"), "id", "left_semi")
    newest = first_per_key(checks, "id", [F.col("inserted_at").desc_nulls_first()]).drop("inserted_at")
    rows = live.join(newest, "id", "left").join(approval_rates(t, constant, providers), "provider")
    kind, amount = F.col("verification_type"), F.col("total_amount_usd").cast("double")
    weight = (
        F.when(kind.isin(KYC_TYPES), F.col("kyc_rate")).when(kind == "video_selfie", F.col("video_rate"))
        .when(kind == "photo_selfie", F.col("photo_rate")).otherwise(1.0))
    per = rows.groupBy("provider").agg(F.sum(amount * weight).alias("soon"))
    return per.unionByName(per.agg(F.sum("soon").alias("soon")).select(F.lit("Total").alias("provider"), "soon"))


def liquidity_status(t: Tables, now: datetime, constant: str, providers: Sequence[str] | None = None) -> DataFrame:
    """One row per provider active today, and a total row.

    The forecast is today's volume over the share usually reached by the current quarter
    hour; ``pred_left`` is what then remains of the daily cap.
    """
    today = datetime(now.year, now.month, now.day)
    current = _settled(t).filter(F.col("handling_at") > ntz(today)).groupBy("name").agg(
        F.max("handling_at").alias("at"), F.sum("total_amount_usd").cast("double").alias("volume"))
    current = current.select("name", "volume", hour_text("at").alias("hour"), quarter_hour("at").alias("minutes"), iso_weekday("at").alias("dow"))
    caps = _brokers(t).select("name", F.when(
        text_at("config", "activated") == "true", text_at("config", "capping", "daily_total_usd_amount").cast("double")
    ).otherwise(0.0).alias("cap"))
    by_quote = t["quotes"].select("quote_id", "broker_id")
    approved = (
        t["payments"].filter((F.col("status") == 2) & (F.col("updated_at") > ntz(today))).select("quote_id", "total_amount_usd")
        .join(by_quote, "quote_id").join(_brokers(t).select(F.col("id").alias("broker_id"), "name"), "broker_id")
        .groupBy("name").agg(F.sum("total_amount_usd").cast("double").alias("approved")))
    rows = (
        current.join(reached_share(t, today), ["hour", "dow", "name", "minutes"], "left")
        .join(caps, "name", "left").join(approved, "name", "left")
        .withColumn("forecast", 1 / F.col("reached") * F.col("volume")).withColumn("remaining", F.col("cap") - F.col("forecast")))
    measures = ["volume", "approved", "forecast", "cap", "remaining"]
    total = rows.agg(*[F.sum(m).alias(m) for m in measures]).select(F.lit("Total").alias("name"), *measures)
    summary = rows.select("name", *measures).unionByName(total)
    soon = soon_approved(t, now, constant, providers)
    coming = F.coalesce("soon", F.lit(0.0))
    return summary.join(soon, summary["name"] == soon["provider"], "left").select(
        F.col("name").alias("lp"), F.col("volume").alias("vol_today"), (F.col("approved") + coming).alias("app_and_soon_app_vol"),
        coming.alias("soon_app_vol"), F.col("forecast").alias("pred_eod_vol"), F.col("cap").alias("daily_cap"),
        F.col("remaining").alias("pred_left"),
        F.when(F.col("cap") == 0, 0.0).otherwise(F.round(100 * F.col("remaining") / F.col("cap"), 2)).alias("pred_left_percent"))


def for_provider(status: DataFrame, provider: str) -> DataFrame:
    """The rows one provider gets to see."""
    return status.filter(F.col("lp") == provider)


def shown(status: DataFrame) -> DataFrame:
    """The status as it is sent out: thousands separators and a percentage."""
    amounts = {c: display_amount(F.rint(c)) for c in status.columns if c not in ("lp", "pred_left_percent")}
    return status.withColumns({**amounts, "pred_left_percent": display_percent("pred_left_percent")})
