"""Partner profit and loss by month, and the dimensions that go with it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.codes import (
    CORPORATE_BRANDS, DEFAULT_COST_SHARE, DOMESTIC_COUNTRIES, EEA_COUNTRIES, PROCESSING_FEE, PROCESSOR_IDS)
from tidemark.functions.jsonops import text_at
from tidemark.functions.temporal import ntz
from tidemark.functions.text import code_map
from tidemark.operators.latest import latest_per_key
from tidemark.operators.running import global_row_number
from tidemark.sinks.tables import parked

Tables = Mapping[str, DataFrame]

# What a disputed payment costs, by the state of the dispute.
LABOR_COST = 27
FULL_LOSS = ["Accept", "Lost", "Withdraw", "Rejected"]
PARTIAL_LOSS = ["TBD", "Representment", "Continue"]
PARTIAL_SHARE = 0.27


def card_class(brand_name: Column | str, card_type: Column | str) -> Column:
    """Corporate brands are a class of their own; other cards keep their type."""
    brand = F.col(brand_name) if isinstance(brand_name, str) else brand_name
    kind = F.col(card_type) if isinstance(card_type, str) else card_type
    return F.when(F.lower(brand).isin(CORPORATE_BRANDS), "CORPORATE").otherwise(kind)


def processing_region(country: Column | str) -> Column:
    """Region that sets the processing price; an unknown country counts as international."""
    c = F.col(country) if isinstance(country, str) else country
    return F.when(c.isin(DOMESTIC_COUNTRIES), "Domestic").when(c.isin(EEA_COUNTRIES), "EEA").otherwise("International")


def card_facts(t: Tables) -> DataFrame:
    """What is known of a card range: brand, type, class, country, region, scheme."""
    base = latest_per_key(t["binbase"], "bin", ["ver"]).select(
        "bin", "card_brand", "card_type", F.col("issuing_country_iso_a2").alias("bin_country"))
    extra = latest_per_key(t["enrich_binlist"], "bin", ["inserted_at"]).select(
        "bin", text_at("response_data", "brand").alias("brand_name"), text_at("response_data", "scheme").alias("card_scheme"),
        F.upper(text_at("response_data", "type")).alias("listed_type"))
    kind = F.coalesce("card_type", "listed_type")
    return base.join(extra, "bin", "left").select(
        "bin", "card_brand", "card_scheme", "bin_country", card_class("brand_name", kind).alias("card_class"),
        processing_region("bin_country").alias("region"))


def settled_payments(t: Tables, start: object, end: object) -> DataFrame:
    """The period's settled payments, put aside: every side table is cut down to them."""
    p = t["payments"].filter((F.col("created_at") >= ntz(start)) & (F.col("created_at") < ntz(end)) & (F.col("status") == 2))
    return parked(p.select("id", "created_at", "currency", "usd_rate", "bin", "partner_end_user_id", "total_amount", "total_amount_usd"))


def captured_payments(t: Tables, p: DataFrame, skip_processors: Sequence[str]) -> DataFrame:
    """Settled payments with their processor and client."""
    requests = t["proc_requests"].join(p.select(F.col("id").alias("payment_id")), "payment_id", "left_semi")
    capture = requests.filter(
        (F.col("tx_type") == "capture-authorization") & (F.col("status") == "success") & ~F.col("processor").isin(*skip_processors)
    ).select(F.col("payment_id"), "processor", text_at("raw_response", "bin").alias("answer_bin"))
    client = t["partner_end_users"].select(F.col("id").alias("partner_end_user_id"), "partner_id")
    return (
        p.join(capture, p["id"] == capture["payment_id"]).join(client, "partner_end_user_id")
        .select(p["id"].alias("payment_id"), "currency", "usd_rate", F.coalesce("bin", "answer_bin").alias("bin"), "processor",
                "partner_id", F.date_format("created_at", "yyyy-MM-01").alias("month"),
                F.col("total_amount").cast("double").alias("volume"), F.col("total_amount_usd").cast("double").alias("volume_usd"))
    )


def profit_and_loss(t: Tables, start: object, end: object, today: object | None = None, *, partner: int = 10,
                    fee_types: Sequence[str] = ("serviceFee", "lpServiceFee"),
                    skip_processors: Sequence[str] = ("safecharge",)) -> DataFrame:
    """Volume, gross profit and net revenue per month, client, bank and currency.

    A processor without a known fee counts as fee 0.  With ``today`` only the cost
    shares valid on that day apply, otherwise any share of the card's class does.
    All side tables are cut down to the period's payments and reduced to one row per
    payment before the joins, which all run on the payment id.
    """
    settled = settled_payments(t, start, end)
    pay = captured_payments(t, settled, skip_processors)
    period = settled.select(F.col("id").alias("payment_id"))

    def of_period(df: DataFrame, key: str = "payment_id") -> DataFrame:
        return df.withColumnRenamed(key, "payment_id").join(period, "payment_id", "left_semi")

    fees = of_period(t["payment_fees"].filter(F.col("fee_type").isin(*fee_types)))
    fees = latest_per_key(fees, ["payment_id", "fee_type"], ["created_at"])
    fees = fees.groupBy("payment_id").agg(F.sum(F.col("amount").cast("double")).alias("fee"))

    second = of_period(t["second_quote_revenue"].filter(F.col("created_at") >= ntz(start)))
    second = latest_per_key(second, "payment_id", ["created_at"]).select(
        "payment_id", F.col("total_second_quote_revenue_usd").cast("double").alias("second_usd"))

    partner_fee = of_period(t["partner_fee"].filter(F.col("partner_fee_fiat_flag").isNotNull()), "txn_id")
    partner_fee = latest_per_key(partner_fee, "payment_id", ["created_at"]).select(
        "payment_id", F.col("partner_fee_fiat_usd").cast("double").alias("partner_fee_usd"))

    disputes = latest_per_key(of_period(t["chargebacks_log"], "payment_ref"), "payment_id", ["posting_date", "decision"])
    disputes = disputes.select("payment_id", "decision")

    facts = card_facts(t)
    cost = t["processing_cost_share"].select(
        F.col("bb_card_brand").alias("card_brand"), F.col("processing_cost_region").alias("region"),
        F.col("final_card_type").alias("card_class"), "processor", F.col("processing_cost_share").cast("double").alias("share"),
        "start_date", "end_date")
    if today is not None:
        day = F.lit(str(today)).cast("date")
        cost = cost.filter(F.lit(day).between(F.col("start_date"), F.col("end_date")))
    cost = cost.drop("start_date", "end_date")

    rows = (
        pay.join(fees, "payment_id").join(facts, "bin")
        .join(cost, ["card_brand", "region", "card_class", "processor"], "left")
        .join(second, "payment_id", "left").join(partner_fee, "payment_id", "left").join(disputes, "payment_id", "left")
    )
    zero = F.lit(0.0)
    lost = F.when(F.col("decision").isin(FULL_LOSS), F.col("volume_usd")).when(
        F.col("decision").isin(PARTIAL_LOSS), F.col("volume_usd") * PARTIAL_SHARE)
    labor = F.when(F.col("decision").isNotNull(), F.lit(float(LABOR_COST))).otherwise(zero)
    rate, share = F.col("usd_rate"), F.coalesce("share", F.lit(DEFAULT_COST_SHARE))
    revenue_usd = (F.col("fee") / rate + F.coalesce(code_map("processor", PROCESSING_FEE), zero)
                   + F.coalesce("second_usd", zero) + F.coalesce("partner_fee_usd", zero))
    rows = rows.select(
        "payment_id", F.col("partner_id").alias("ClientId"), F.col("month").alias("Date"),
        code_map("processor", PROCESSOR_IDS).cast("int").alias("BankId"), F.col("currency").alias("Currency"), "volume", "volume_usd",
        revenue_usd.alias("revenue_usd"), (revenue_usd * rate).alias("revenue"),
        (share * F.col("volume_usd")).alias("cost_usd"), (share * F.col("volume")).alias("cost"),
        F.coalesce(lost, zero).alias("lost_usd"), (F.coalesce(lost, zero) * rate).alias("lost"),
        labor.alias("labor_usd"), (labor * rate).alias("labor"))
    total = rows.groupBy("ClientId", "Date", "BankId", "Currency").agg(
        F.sum("volume").alias("Volume"), F.sum("volume_usd").alias("VolumeUSD"), F.count("payment_id").alias("RecordsCount"),
        F.sum("revenue").alias("GrossProfit"), F.sum("revenue_usd").alias("GrossProfitUSD"),
        (F.sum("revenue") - F.sum("cost") - F.sum("lost") - F.sum("labor")).alias("NetRevenue"),
        (F.sum("revenue_usd") - F.sum("cost_usd") - F.sum("lost_usd") - F.sum("labor_usd")).alias("NetRevenueUSD"))
    total = total.select(F.lit(partner).alias("PartnerId"), "*", F.col("GrossProfit").alias("ProcessingGrossProfit"),
                         F.col("GrossProfitUSD").alias("ProcessingGrossProfitUSD"))
    return global_row_number(total, ["ClientId"], [F.col("BankId").asc_nulls_last(), F.col("Currency"), F.col("Date")], "RecordId")


def bank_dimension(proc_requests: DataFrame, since: object, partner: int = 10, skip: Sequence[str] = ("unlimint",)) -> DataFrame:
    """Processors seen since a day, with the code banks are reported under."""
    seen = proc_requests.filter((F.col("created_at") >= ntz(since)) & ~F.col("processor").isin(*skip)).select("processor").distinct()
    return seen.select(F.col("processor").alias("Name"), code_map("processor", PROCESSOR_IDS).cast("int").alias("PartnerBankId"),
                       F.lit(partner).alias("PartnerId"))


def client_dimension(partners: DataFrame, partner: int = 10) -> DataFrame:
    """All clients under their reported names."""
    return partners.select(F.lit(partner).alias("PartnerId"), F.col("id").alias("PartnerClientId"), F.col("full_name").alias("Name"))
