"""Profit and loss, dimensions and the volume forecast over the derived payment domain."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.domain import Domain, with_tables
from tidemark.catalog.registry import register
from tidemark.functions.codes import CORPORATE_BRANDS, EEA_COUNTRIES
from tidemark.plans import liquidity, pnl

_BRANDS = ", ".join(f"'{b}'" for b in CORPORATE_BRANDS)
_EEA = ", ".join(f"'{c}'" for c in EEA_COUNTRIES)
_FACTS = f"""newest_bin AS (SELECT DISTINCT ON (bin) bin, card_brand, card_type, issuing_country_iso_a2 AS country FROM binbase ORDER BY bin, ver DESC),
newest_list AS (SELECT DISTINCT ON (bin) bin, response_data->>'$.brand' AS brand, response_data->>'$.scheme' AS scheme, upper(response_data->>'$.type') AS kind
  FROM enrich_binlist ORDER BY bin, inserted_at DESC),
facts AS (SELECT b.bin, b.card_brand, l.scheme AS card_scheme, b.country AS bin_country,
  CASE WHEN lower(l.brand) IN ({_BRANDS}) THEN 'CORPORATE' ELSE coalesce(b.card_type, l.kind) END AS card_class,
  CASE WHEN b.country = 'GB' THEN 'Domestic' WHEN b.country IN ({_EEA}) THEN 'EEA' ELSE 'International' END AS region
  FROM newest_bin b LEFT JOIN newest_list l ON b.bin = l.bin)"""


@register("card_classification", f"WITH {with_tables('binbase', 'enrich_binlist')}, {_FACTS} SELECT * FROM facts")
def card_classification(spark: SparkSession, sf: str) -> DataFrame:
    return pnl.card_facts(Domain(spark, sf))


def _pnl_sql(validity: str) -> str:
    return f"""
WITH {with_tables('payments', 'proc_requests', 'partner_end_users', 'payment_fees', 'second_quote_revenue', 'partner_fee', 'binbase',
                  'enrich_binlist', 'processing_cost_share', 'chargebacks_log')}, {_FACTS},
pay AS (SELECT p.id, p.currency, p.usd_rate, coalesce(p.bin, r.raw_response->>'$.bin') AS bin, r.processor, u.partner_id,
    strftime(p.created_at, '%Y-%m-01') AS month, p.total_amount::DOUBLE AS v, p.total_amount_usd::DOUBLE AS vu
  FROM payments p JOIN proc_requests r ON r.payment_id = p.id JOIN partner_end_users u ON u.id = p.partner_end_user_id
  WHERE p.status = 2 AND r.tx_type = 'capture-authorization' AND r.status = 'success' AND r.processor <> 'safecharge'
    AND p.created_at >= TIMESTAMP '1995-02-01' AND p.created_at < TIMESTAMP '2001-02-01'),
fee_rows AS (SELECT DISTINCT ON (f.payment_id, fee_type) f.payment_id, amount FROM payment_fees f WHERE fee_type IN ('serviceFee', 'lpServiceFee')
  ORDER BY f.payment_id, fee_type, created_at DESC),
fees AS (SELECT pay.id, sum(amount::DOUBLE / usd_rate) AS fee FROM fee_rows JOIN pay ON pay.id = payment_id GROUP BY pay.id),
sq AS (SELECT DISTINCT ON (payment_id) payment_id, total_second_quote_revenue_usd::DOUBLE AS x FROM second_quote_revenue
  WHERE created_at >= TIMESTAMP '1995-02-01' ORDER BY payment_id, created_at DESC),
pf AS (SELECT DISTINCT ON (txn_id) txn_id, partner_fee_fiat_usd::DOUBLE AS x FROM partner_fee WHERE partner_fee_fiat_flag IS NOT NULL ORDER BY txn_id, created_at DESC),
cb AS (SELECT DISTINCT ON (payment_ref) payment_ref, decision FROM chargebacks_log ORDER BY payment_ref, posting_date DESC, decision DESC),
money AS (SELECT pay.*, coalesce(s.processing_cost_share, 0.0205::DOUBLE) AS share,
    fee + CASE pay.processor WHEN 'ecp' THEN 0.25 ELSE 0.2 END::DOUBLE + coalesce(sq.x, 0) + coalesce(pf.x, 0) AS ru,
    CASE WHEN decision IN ('Accept', 'Lost', 'Withdraw', 'Rejected') THEN vu WHEN decision IN ('TBD', 'Representment', 'Continue') THEN vu * 0.27::DOUBLE ELSE 0 END AS lu,
    CASE WHEN decision IS NULL THEN 0 ELSE 27 END AS wu
  FROM pay JOIN fees ON fees.id = pay.id JOIN facts ON facts.bin = pay.bin
  LEFT JOIN processing_cost_share s ON s.bb_card_brand = card_brand AND s.processing_cost_region = region AND s.final_card_type = card_class AND s.processor = pay.processor {validity}
  LEFT JOIN sq ON sq.payment_id = pay.id LEFT JOIN pf ON pf.txn_id = pay.id LEFT JOIN cb ON cb.payment_ref = pay.id)
SELECT row_number() OVER (ORDER BY partner_id, CASE processor WHEN 'ecp' THEN 3 WHEN 'paysafe' THEN 5 WHEN 'worldline' THEN 7 ELSE 8 END, currency, month) AS "RecordId",
  10 AS "PartnerId", partner_id AS "ClientId", month AS "Date", CASE processor WHEN 'ecp' THEN 3 WHEN 'paysafe' THEN 5 WHEN 'worldline' THEN 7 ELSE 8 END AS "BankId",
  currency AS "Currency", sum(v) AS "Volume", sum(vu) AS "VolumeUSD", count(*) AS "RecordsCount",
  round(sum(ru * usd_rate), 6) AS "GrossProfit", round(sum(ru), 6) AS "GrossProfitUSD",
  round(sum(ru * usd_rate) - sum(share * v) - sum(lu * usd_rate) - sum(wu * usd_rate), 6) AS "NetRevenue",
  round(sum(ru) - sum(share * vu) - sum(lu) - sum(wu), 6) AS "NetRevenueUSD",
  round(sum(ru * usd_rate), 6) AS "ProcessingGrossProfit", round(sum(ru), 6) AS "ProcessingGrossProfitUSD"
FROM money GROUP BY partner_id, month, processor, currency"""


_ROUNDED = ["GrossProfit", "GrossProfitUSD", "NetRevenue", "NetRevenueUSD", "ProcessingGrossProfit", "ProcessingGrossProfitUSD"]


@register("partner_profit_and_loss", _pnl_sql("AND DATE '2001-02-01' BETWEEN s.start_date AND s.end_date"))
def partner_profit_and_loss(spark: SparkSession, sf: str) -> DataFrame:
    out = pnl.profit_and_loss(Domain(spark, sf), "1995-02-01", "2001-02-01", "2001-02-01")
    return out.withColumns({c: F.round(c, 6) for c in _ROUNDED})


@register("bank_dimension", f"""
WITH {with_tables('proc_requests')} SELECT DISTINCT processor AS "Name", CASE processor WHEN 'ecp' THEN 3 WHEN 'paysafe' THEN 5 WHEN 'worldline' THEN 7 WHEN 'safecharge' THEN 8 END AS "PartnerBankId",
  10 AS "PartnerId" FROM proc_requests WHERE created_at >= TIMESTAMP '1996-01-01' AND processor <> 'unlimint'""")
def bank_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return pnl.bank_dimension(Domain(spark, sf)["proc_requests"], "1996-01-01")


@register("client_dimension", f"""
WITH {with_tables('partners')} SELECT 10 AS "PartnerId", id AS "PartnerClientId", full_name AS "Name" FROM partners""")
def client_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return pnl.client_dimension(Domain(spark, sf)["partners"])


# --- volume forecast ------------------------------------------------------------------

NOW = datetime(2001, 7, 28, 18, 0)
RATES = "BROKERS_CONVERSION_RATES"
_SLOT = "strftime(handling_at, '%H') AS hour, lpad((extract(minute FROM handling_at) // 15 * 15)::VARCHAR, 2, '0') AS minutes, extract(isodow FROM handling_at) AS dow"

_LIQUIDITY = f"""{with_tables('payments', 'partners', 'quotes', 'constants', 'verifications')},
settled AS (SELECT handling_at, total_amount_usd AS amt, name FROM payments JOIN partners ON pay_to_partner_id = partners.id WHERE status = 2 AND service_type = 'broker'),
steps AS (SELECT handling_at::DATE AS day, {_SLOT}, name, sum(amt) AS amt FROM settled
  WHERE handling_at BETWEEN TIMESTAMP '2001-07-28' - INTERVAL 92 DAY AND TIMESTAMP '2001-07-28' - INTERVAL 2 DAY GROUP BY ALL),
ratios AS (SELECT *, (sum(amt) OVER (PARTITION BY day ORDER BY hour, minutes, name ROWS UNBOUNDED PRECEDING))::DOUBLE / (sum(amt) OVER (PARTITION BY day))::DOUBLE AS ratio FROM steps),
usual AS (SELECT dow, hour, minutes, name, avg(ratio) AS reached FROM ratios GROUP BY ALL)"""

_STATUS = f"""
WITH {_LIQUIDITY},
cur AS (SELECT name, vol, {_SLOT} FROM (SELECT name, max(handling_at) AS handling_at, sum(amt)::DOUBLE AS vol FROM settled WHERE handling_at > TIMESTAMP '2001-07-28' GROUP BY name)),
caps AS (SELECT name, CASE WHEN (config->>'$.activated') = 'true' THEN (config->>'$.capping.daily_total_usd_amount')::DOUBLE ELSE 0 END AS cap FROM partners WHERE service_type = 'broker'),
app AS (SELECT b.name, sum(total_amount_usd)::DOUBLE AS approved FROM payments p JOIN quotes q ON p.quote_id = q.quote_id JOIN partners b ON q.broker_id = b.id
  WHERE status = 2 AND b.service_type = 'broker' AND p.updated_at > TIMESTAMP '2001-07-28' GROUP BY b.name),
per AS (SELECT cur.name, vol, approved, 1 / reached * vol AS fc, cap, cap - 1 / reached * vol AS remaining FROM cur
  LEFT JOIN usual ON cur.hour = usual.hour AND cur.dow = usual.dow AND cur.name = usual.name AND cur.minutes = usual.minutes
  LEFT JOIN caps ON caps.name = cur.name LEFT JOIN app ON app.name = cur.name),
summed AS (SELECT * FROM per UNION ALL SELECT 'Total', sum(vol), sum(approved), sum(fc), sum(cap), sum(remaining) FROM per),
rates AS (SELECT provider, (json_value->provider->>'$.poid')::DOUBLE AS kyc, (json_value->provider->>'$.photo_selfie')::DOUBLE AS photo, (json_value->provider->>'$.video_selfie')::DOUBLE AS video
  FROM (SELECT json_value, unnest(json_keys(json_value)) AS provider FROM constants ORDER BY inserted_at DESC LIMIT 2)),
live AS (SELECT DISTINCT ON (p.id) p.id, total_amount_usd::DOUBLE AS amt, b.name FROM payments p JOIN quotes q ON p.quote_id = q.quote_id JOIN partners b ON q.broker_id = b.id
  WHERE p.status IN (1, 25) AND p.updated_at > TIMESTAMP '2001-07-27 18:00:00' ORDER BY p.id, q.created_at DESC),
kinds AS (SELECT DISTINCT ON (initial_payment_id) initial_payment_id, verification_type AS kind FROM verifications ORDER BY initial_payment_id, inserted_at DESC),
soon_each AS (SELECT name, sum(amt * CASE WHEN kind IN ('kyc_identity', 'kyc_liveness_identity') THEN kyc WHEN kind = 'video_selfie' THEN video WHEN kind = 'photo_selfie' THEN photo ELSE 1 END) AS soon
  FROM live JOIN rates ON rates.provider = live.name LEFT JOIN kinds ON initial_payment_id = id GROUP BY name),
soon AS (SELECT * FROM soon_each UNION ALL SELECT 'Total', sum(soon) FROM soon_each)
SELECT summed.name AS lp, vol AS vol_today, approved + coalesce(soon, 0) AS app_and_soon_app_vol, coalesce(soon, 0) AS soon_app_vol, round(fc, 4) AS pred_eod_vol,
  cap AS daily_cap, round(remaining, 4) AS pred_left, CASE WHEN cap = 0 THEN 0 ELSE round(100 * remaining / cap, 2) END AS pred_left_percent
FROM summed LEFT JOIN soon ON soon.name = summed.name"""


@register("volume_share_by_slot", f"WITH {_LIQUIDITY} SELECT dow, hour, minutes, name, round(reached, 8) AS reached FROM usual")
def volume_share_by_slot(spark: SparkSession, sf: str) -> DataFrame:
    return liquidity.reached_share(Domain(spark, sf), datetime(2001, 7, 28)).withColumn("reached", F.round("reached", 8))


def _status(spark: SparkSession, sf: str) -> DataFrame:
    s = liquidity.liquidity_status(Domain(spark, sf), NOW, RATES)
    return s.withColumns({c: F.round(c, 4) for c in ("pred_eod_vol", "pred_left")})


@register("liquidity_status", _STATUS)
def liquidity_status(spark: SparkSession, sf: str) -> DataFrame:
    return _status(spark, sf)


@register("liquidity_status_of_one", f"SELECT lp, vol_today, daily_cap FROM ({_STATUS}) WHERE lp = 'partner-38'")
def liquidity_status_of_one(spark: SparkSession, sf: str) -> DataFrame:
    return liquidity.for_provider(_status(spark, sf), "partner-38").select("lp", "vol_today", "daily_cap")


@register("liquidity_shown", f"""SELECT lp, format('{{:,}}', round_even(vol_today, 0)::BIGINT) AS vol_today FROM ({_STATUS})""")
def liquidity_shown(spark: SparkSession, sf: str) -> DataFrame:
    return liquidity.shown(_status(spark, sf)).select("lp", "vol_today")
