"""Dispute case files over the derived payment domain.

The window is wide enough to hold every dispute of the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.domain import Domain, with_tables
from tidemark.catalog.registry import register
from tidemark.functions import codes
from tidemark.plans import chargebacks as cb

AS_OF, DAYS, SINCE = "2001-12-01", 4000, "1990-01-01"


def _list(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _arn(col: str) -> str:
    return "coalesce(" + ", ".join(f"{col}->>'$.\"{k}\"'" for k in codes.ARN_KEYS) + ")"


_HIT = "({0}) IN (" + _list(["full_match", "partial_match"]) + ")"
_MATCH = _list(codes.AVS_MATCH["safecharge"])


def _avs_code(r: str) -> str:
    return (f"CASE {r}.processor WHEN 'ecp' THEN {r}.raw_response->>'$.avs_response_code' WHEN 'paysafe' THEN {r}.raw_response->>'$.avsResponse' "
            f"WHEN 'safecharge' THEN {r}.raw_response->>'$.paymentOption.card.avsCode' END")


def _avs(r: str) -> str:
    return (f"coalesce(CASE {r}.processor WHEN 'ecp' THEN ({_avs_code(r)}) IN ({_list(codes.AVS_MATCH['ecp'])}) "
            f"WHEN 'paysafe' THEN ({_avs_code(r)}) IN ({_list(codes.AVS_MATCH['paysafe'])}) WHEN 'safecharge' THEN ({_avs_code(r)}) IN ({_MATCH}) END, false)")


_IDENTITY_TABLES = with_tables(
    "payments", "proc_requests", "end_users", "partners", "chargebacks", "decisions", "r_payments", "r_payment_tags",
    "maxmind_triggers", "enrich_maxmind")

_CASES = f"""idc AS (
  SELECT c.payment_id, c.posted_at, {_arn('c.raw_data')} AS arn, p.cc_identifier, p.end_user_id, p.pay_to_partner_id, u.first_name, u.last_name,
    p.first_name_card, p.last_name_card, concat(p.first_name_card, ' ', p.last_name_card) AS card_name, concat(u.first_name, ' ', u.last_name) AS account_name,
    (SELECT max(raw_response->>'$.last4Digits') FROM proc_requests r WHERE r.payment_id = c.payment_id) AS last4
  FROM chargebacks c JOIN payments p ON p.id = c.payment_id JOIN end_users u ON u.id = p.end_user_id
  WHERE c.status = '1st_chargeback' AND c.reason_code IN ({_list(codes.IDENTITY_REASONS)})),
hist AS (SELECT p.cc_identifier, count(DISTINCT p.id) AS n, count(DISTINCT {_arn('x.raw_data')}) AS m FROM payments p LEFT JOIN chargebacks x ON x.payment_id = p.id
  WHERE p.status = 2 AND (p.cc_identifier, p.end_user_id) IN (SELECT cc_identifier, end_user_id FROM idc WHERE cc_identifier IS NOT NULL) GROUP BY 1),
whist AS (SELECT r.raw_response->>'$.last4Digits' AS last4, count(DISTINCT p.id) AS n, count(DISTINCT {_arn('x.raw_data')}) AS m
  FROM payments p JOIN proc_requests r ON r.payment_id = p.id JOIN chargebacks x ON x.payment_id = p.id
  WHERE p.status = 2 AND p.cc_identifier IS NULL AND r.tx_type = 'capture-authorization' AND r.payment_instrument_type = 'google_pay'
    AND (r.raw_response->>'$.last4Digits') IN (SELECT last4 FROM idc) GROUP BY 1),
age AS (SELECT idc.payment_id, date_sub('day', max(r.updated_at), any_value(posted_at)) AS days FROM idc JOIN proc_requests r ON r.payment_id = idc.payment_id
  WHERE r.tx_type = 'capture-authorization' AND r.status = 'success' GROUP BY 1)"""


@register("undisputed_history", f"""
WITH {_IDENTITY_TABLES}, {_CASES} SELECT cc_identifier, n AS payments, m AS disputes FROM hist""")
def undisputed_history(spark: SparkSession, sf: str) -> DataFrame:
    d = Domain(spark, sf)
    return cb.undisputed_history(d, cb.identity_cases(d, AS_OF, DAYS))


@register("undisputed_wallet_history", f"""
WITH {_IDENTITY_TABLES}, {_CASES} SELECT last4, n AS wallet_payments, m AS wallet_disputes FROM whist""")
def undisputed_wallet_history(spark: SparkSession, sf: str) -> DataFrame:
    d = Domain(spark, sf)
    return cb.undisputed_wallet_history(d, cb.identity_cases(d, AS_OF, DAYS))


@register("transaction_age", f"WITH {_IDENTITY_TABLES}, {_CASES} SELECT payment_id, days FROM age")
def transaction_age(spark: SparkSession, sf: str) -> DataFrame:
    d = Domain(spark, sf)
    return cb.transaction_age(d, cb.identity_cases(d, AS_OF, DAYS))


_V = "d.variables->'Analytic'->'variables'->'Analytic'->>"


def _identity_ctes(verified: str) -> str:
    return f"""{_CASES},
dec AS (SELECT payment_id, {_V}'buyer_email_name_match_level' AS e1, {_V}'buyer_ekata_email_name_match' AS e2, {_V}'buyer_ekata_name_phone_match' AS ph,
  {_V}'name_on_card_to_name_in_poid_valid_for_current_payment_match' AS inst, ({_V}'user_has_approved_kyc_from_broker') = 'true' AS kyc,
  ({_V}'user_verified_by_selfie') = 'true' AS selfie FROM decisions d WHERE application_name = 'decision-engine'),
ipf AS (SELECT r.payment_ref AS payment_id, (e.data->'billing_address'->>'distance_to_ip_location')::DOUBLE AS far, (e.data->'ip_address'->'location'->>'accuracy_radius')::DOUBLE AS acc,
  (e.data->'ip_address'->>'risk')::DOUBLE AS risk FROM r_payments r JOIN maxmind_triggers m ON m.r_payment_id = r.id JOIN enrich_maxmind e ON e.id = m.enrich_maxmind_id),
tag AS (SELECT DISTINCT ON (r.payment_ref) r.payment_ref AS payment_id, contains(lower(tags), 'fraud ring') AS ring FROM r_payment_tags g JOIN r_payments r ON g.r_payment_id = r.id
  ORDER BY r.payment_ref, g.inserted_at DESC),
avs AS (SELECT payment_id, {_avs('r')} AS avs FROM proc_requests r WHERE tx_type = 'authorization'),
f AS (SELECT idc.payment_id, left(arn, 1) AS dg, coalesce(pa.full_name = '{codes.EXAMPLE.us_broker}' AND left(arn, 1) = '7', false) AS us, pa.full_name, e1, e2, ph, inst,
    coalesce(kyc, false) AS kyc, coalesce(selfie, false) AS selfie, far, acc, risk, coalesce(ring, false) AS ring, days, avs, hist.n, hist.m, whist.n AS wn, whist.m AS wm,
    coalesce(lower(card_name) = lower(account_name), false)
      OR coalesce(left(lower(first_name), 1) = left(lower(first_name_card), 1) AND lower(last_name) = lower(last_name_card), false)
      OR coalesce(lower(first_name) = lower(first_name_card) AND length(last_name) <= 2 AND left(lower(last_name), 2) = left(lower(last_name_card), 2), false)
      OR coalesce(lower(first_name) = lower(first_name_card) AND length(last_name) >= 3 AND left(lower(last_name), 3) = left(lower(last_name_card), 3), false)
      OR coalesce(lower(first_name) = lower(last_name_card) AND lower(first_name_card) = lower(last_name), false) AS named
  FROM idc LEFT JOIN partners pa ON pa.id = idc.pay_to_partner_id LEFT JOIN dec ON dec.payment_id = idc.payment_id LEFT JOIN ipf ON ipf.payment_id = idc.payment_id
  LEFT JOIN tag ON tag.payment_id = idc.payment_id LEFT JOIN age ON age.payment_id = idc.payment_id LEFT JOIN avs ON avs.payment_id = idc.payment_id
  LEFT JOIN hist ON hist.cc_identifier = idc.cc_identifier LEFT JOIN whist ON whist.last4 = idc.last4),
w AS (SELECT payment_id,
  {verified} AS kyc,
  CASE WHEN dg IN ('7', '2', '8', '0') AND ((far < 100 AND acc <> 25 AND risk <> 5) OR (far > 100 AND acc < 25 AND risk < 5)) THEN 0.1 ELSE 0 END::DOUBLE AS ip_match,
  CASE WHEN named AND us THEN 0.15 WHEN named AND dg IN ('7', '2') THEN 0.1 WHEN named AND dg IN ('8', '0') THEN 0.15
    WHEN full_name IS NOT NULL AND {_HIT.format('inst')} AND dg IN ('7', '2') THEN 0.1 WHEN full_name IS NOT NULL AND {_HIT.format('inst')} AND dg IN ('8', '0') THEN 0.15 ELSE 0 END::DOUBLE AS cc_owner_match,
  CASE WHEN avs AND us THEN 0.2 WHEN avs AND dg IN ('7', '2') THEN 0.25 WHEN avs AND dg IN ('8', '0') THEN 0.2 ELSE 0 END::DOUBLE AS avs_match,
  CASE WHEN {_HIT.format('ph')} AND dg IN ('7', '2', '8', '0') THEN 0.15 ELSE 0 END::DOUBLE AS phone_match,
  CASE WHEN ({_HIT.format('e1')} OR {_HIT.format('e2')}) THEN CASE WHEN us THEN 0.2 WHEN dg IN ('7', '2') THEN 0.15 WHEN dg IN ('8', '0') THEN 0.2 ELSE 0 END ELSE 0 END::DOUBLE AS email_match,
  CASE WHEN n > m OR wn > wm THEN CASE WHEN us THEN 0.1 WHEN dg IN ('7', '2') THEN 0.25 WHEN dg IN ('8', '0') THEN 0.1 ELSE 0 END ELSE 0 END::DOUBLE AS undisputed_past,
  ring AS in_fraud_ring, coalesce(days > 120, false) AS late_dispute FROM f),
identity AS (SELECT *, round(kyc + ip_match + cc_owner_match + avs_match + phone_match + email_match + undisputed_past, 2) AS rank FROM w)"""


_FIXED = "CASE WHEN (us OR dg IN ('8', '0')) AND (kyc OR selfie) THEN 0.1 ELSE 0 END::DOUBLE"
_WRITTEN = "CASE WHEN us AND (kyc OR selfie) THEN 0.1 WHEN selfie THEN 0 WHEN dg IN ('8', '0') AND kyc THEN 0.1 ELSE 0 END::DOUBLE"


@register("identity_match", f"WITH {_IDENTITY_TABLES}, {_identity_ctes(_FIXED)} SELECT * FROM identity")
def identity_match(spark: SparkSession, sf: str) -> DataFrame:
    return cb.identity_match(Domain(spark, sf), AS_OF, DAYS)


@register("identity_match_as_written", f"WITH {_IDENTITY_TABLES}, {_identity_ctes(_WRITTEN)} SELECT payment_id, rank, kyc FROM identity")
def identity_match_as_written(spark: SparkSession, sf: str) -> DataFrame:
    return cb.identity_match(Domain(spark, sf), AS_OF, DAYS, as_written=True).select("payment_id", "rank", "kyc")


# --- evidence of every payment --------------------------------------------------------

_PEER = """peer AS (SELECT DISTINCT l.payment_id, blockchain_txn_hash AS h FROM payment_events_log l JOIN execution_responses x ON x.event_id = l.id WHERE blockchain_txn_hash IS NOT NULL)"""
_EVIDENCE_TABLES = with_tables("payments", "proc_requests", "payment_events_log", "execution_responses", "cc_identifiers")
_PLAIN = [c for c in codes.EXPLORERS if c not in {*codes.ADDRESS_COINS, *codes.HEX_COINS, "HBAR"}]
_LINKS = f"""coins(coin, prefix) AS (VALUES {", ".join(f"('{k}', '{v}')" for k, v in codes.EXPLORERS.items())}),
links AS (SELECT peer.payment_id, CASE WHEN coin IN ({_list(codes.ADDRESS_COINS)}) THEN prefix || crypto_currency_address WHEN coin IN ({_list(_PLAIN)}) THEN prefix || h
  WHEN coin IN ({_list(codes.HEX_COINS)}) THEN prefix || '0x' || h WHEN coin = 'HBAR' THEN prefix || regexp_replace(h, '[-.]', '', 'g')
  WHEN crypto_currency = 'BNB' AND crypto_currency_address NOT LIKE '0x%' THEN '{codes.EXPLORER_BNB}' || h
  WHEN crypto_currency IN ('BNB', 'BNB-SC') AND crypto_currency_address LIKE '0%' THEN '{codes.EXPLORER_BSC}' || h ELSE 'error' END AS blockchain_link
  FROM peer JOIN payments p ON p.id = peer.payment_id LEFT JOIN coins ON coin = p.crypto_currency WHERE crypto_currency_address IS NOT NULL)"""
_AVS = f"""avs_rows AS (SELECT DISTINCT r.payment_id, {_avs('r')} AS avs,
  coalesce(CASE r.processor WHEN 'ecp' THEN ({_avs_code('r')}) IN ({_list(codes.AVS_NOT_SENT['ecp'])}) WHEN 'safecharge' THEN ({_avs_code('r')}) IN ({_list(codes.AVS_NOT_SENT['safecharge'])}) END, false) AS avs_check,
  CASE WHEN r.processor = 'ecp' THEN right({_avs_code('r')}, 1) WHEN r.processor IN ('paysafe', 'safecharge') THEN {_avs_code('r')} ELSE 'Unknown' END AS avs_value
  FROM proc_requests r WHERE r.tx_type = 'authorization' AND r.status = 'success' AND r.payment_id IN (SELECT payment_id FROM peer))"""
_PROOF = """proof AS (SELECT DISTINCT r.payment_id, r.threeds->>'$.eci' AS eci, r.threeds->>'$.cavv' AS cavv, credit_card, coalesce(r.raw_response->>'$.authCode', '') AS auth_code
  FROM proc_requests r JOIN cc_identifiers ON identifier = r.cc_identifier WHERE r.status = 'success' AND (r.threeds->>'$.cavv') IS NOT NULL AND r.payment_id IN (SELECT payment_id FROM peer)),
answer AS (SELECT DISTINCT r.payment_id, r.raw_response->>'$.paymentOption.card.threeD.eci' AS answer_eci FROM proc_requests r
  WHERE r.status = 'success' AND (r.threeds->>'$.cavv') IS NOT NULL AND r.payment_id IN (SELECT payment_id FROM peer))"""


def _all(d: Domain) -> DataFrame:
    return d["payments"].select(F.col("id").alias("payment_id"))


@register("explorer_links", f"WITH {_EVIDENCE_TABLES}, {_PEER}, {_LINKS} SELECT * FROM links")
def explorer_links(spark: SparkSession, sf: str) -> DataFrame:
    d = Domain(spark, sf)
    return cb.explorer_links(d, cb.delivered(d, _all(d)))


@register("avs_answers", f"WITH {_EVIDENCE_TABLES}, {_PEER}, {_AVS} SELECT * FROM avs_rows")
def avs_answers(spark: SparkSession, sf: str) -> DataFrame:
    d = Domain(spark, sf)
    return cb.avs_answers(d, cb.delivered(d, _all(d)))


@register("authentication_evidence", f"""
WITH {_EVIDENCE_TABLES}, {_PEER}, {_PROOF} SELECT proof.*, answer_eci FROM proof JOIN answer ON answer.payment_id = proof.payment_id""")
def authentication_evidence(spark: SparkSession, sf: str) -> DataFrame:
    d = Domain(spark, sf)
    peers = cb.delivered(d, _all(d))
    return cb.authentication_evidence(d, peers).join(cb.answered_eci(d, peers), "payment_id")


def _fraud_sql(days: str, five: str) -> str:
    kinds = " ".join(f"WHEN processor = 'ecp' AND code = '{c}' THEN '{k}|{x}'" for c, k, x in codes.ECP_WARNINGS)
    names = " ".join(f"WHEN processor = 'safecharge' AND named = '{c}' THEN '{k}|{x}'" for c, k, x in codes.SAFECHARGE_WARNINGS)
    return f"""warn AS (SELECT DISTINCT payment_id, CASE
    WHEN processor = 'ecp' AND code = '5' AND dg IN ('7', '2') THEN 'V5|Miscellaneous' WHEN processor = 'ecp' AND code = '5' AND dg IN ({five}) THEN 'M5|Account takeover fraud'
    WHEN processor = 'safecharge' AND named = 'Other' AND dg IN ('7', '2') THEN 'V5|Miscellaneous'
    WHEN processor = 'safecharge' AND named = 'Account Takeover Fraud' AND dg IN ({five}) THEN 'M5|Account takeover fraud' {kinds} {names} END AS both_parts
  FROM (SELECT r.payment_id, r.processor, w.fraud_type_code AS code, w.raw_data->>'$.fraudType' AS named, left({_arn('c.raw_data')}, 1) AS dg
    FROM proc_requests r JOIN chargebacks c ON c.payment_id = r.payment_id LEFT JOIN fraud_warnings w ON w.payment_id = r.payment_id
    WHERE r.tx_type = 'authorization' AND r.status = 'success' AND c.inserted_at > TIMESTAMP '{AS_OF}' - INTERVAL {days} DAY)),
fraud AS (SELECT payment_id, coalesce(split_part(both_parts, '|', 1), 'Unknown') AS fraud_type, split_part(both_parts, '|', 2) AS fraud_description FROM warn)"""


@register("fraud_types", f"""
WITH {with_tables('proc_requests', 'chargebacks', 'fraud_warnings')}, {_fraud_sql('4000', "'8', '0', '9'")} SELECT * FROM fraud""")
def fraud_types(spark: SparkSession, sf: str) -> DataFrame:
    return cb.fraud_types(Domain(spark, sf), AS_OF, DAYS)


_DEVICE = """visit AS (SELECT DISTINCT ON (payment_id) payment_id, request_data->>'$.session.ip' AS ip, device_id FROM user_browser_events WHERE event_type = 'authorize' ORDER BY payment_id, id),
device AS (SELECT p.id AS payment_id, concat(u.first_name, ' ', u.last_name) AS full_acc_name, u.created_at AS registration_date, v.ip AS ip_address,
  concat(e.data->'ip_address'->'city'->'names'->>'en', ' ', e.data->'ip_address'->'subdivisions'->0->'names'->>'en', ' ', e.data->'ip_address'->'postal'->>'code', ' ', e.data->'ip_address'->'country'->'names'->>'en') AS ip_location,
  CASE WHEN (e.data->'billing_address'->>'distance_to_ip_location') = '0' THEN '<10' ELSE e.data->'billing_address'->>'distance_to_ip_location' END AS bill_add_dist,
  (e.data->'ip_address'->'location'->>'accuracy_radius')::DOUBLE AS accuracy_radius, (e.data->'ip_address'->>'risk')::DOUBLE AS proxy_score, device_id
  FROM payments p JOIN visit v ON v.payment_id = p.id LEFT JOIN end_users u ON u.id = p.end_user_id LEFT JOIN r_payments r ON r.payment_ref = p.id
  LEFT JOIN maxmind_triggers m ON m.r_payment_id = r.id LEFT JOIN enrich_maxmind e ON e.id = m.enrich_maxmind_id WHERE p.id IN (SELECT payment_id FROM chargebacks))"""


@register("device_details", f"""
WITH {with_tables('payments', 'chargebacks', 'user_browser_events', 'end_users', 'r_payments', 'maxmind_triggers', 'enrich_maxmind')}, {_DEVICE} SELECT * FROM device""")
def device_details(spark: SparkSession, sf: str) -> DataFrame:
    return cb.device_details(Domain(spark, sf), AS_OF, DAYS)


_FOUR = f"""four AS (
  SELECT p.id AS payment_id, CASE WHEN left(p.bin, 1) IN ('4', '2', '5', '6') THEN right(cc.credit_card, 4) ELSE right(w.display_name, 4) END AS last_4
  FROM payments p LEFT JOIN cc_identifiers cc ON cc.identifier = p.cc_identifier LEFT JOIN payment_credit_cards s ON s.payment_id = p.id
  LEFT JOIN wallet_attempts w ON w.payment_instrument_id = s.credit_card_id
  WHERE p.id IN (SELECT payment_id FROM chargebacks) AND p.id IN (SELECT payment_id FROM proc_requests WHERE tx_type = 'authorization' AND status = 'success' AND payment_instrument_type <> 'google_pay')
  UNION
  SELECT DISTINCT p.id, r.raw_response->>'$.last4Digits' FROM payments p JOIN proc_requests r ON r.payment_id = p.id WHERE p.status = 2 AND r.payment_instrument_type = 'google_pay'
    AND (r.raw_response->>'$.last4Digits', p.end_user_id) IN (SELECT r2.raw_response->>'$.last4Digits', p2.end_user_id FROM payments p2 JOIN proc_requests r2 ON r2.payment_id = p2.id
      WHERE r2.payment_instrument_type = 'google_pay' AND r2.tx_type = 'capture-authorization' AND p2.id IN (SELECT payment_id FROM chargebacks)))"""


@register("last_four_digits", f"""
WITH {with_tables('payments', 'chargebacks', 'proc_requests', 'cc_identifiers', 'payment_credit_cards', 'wallet_attempts')}, {_FOUR} SELECT * FROM four""")
def last_four_digits(spark: SparkSession, sf: str) -> DataFrame:
    return cb.last_four_digits(Domain(spark, sf), SINCE)


_BY_DAY = f"""by_day AS (SELECT cc_identifier, posted_on, sum(total_amount_usd) AS card_total FROM (SELECT DISTINCT c.payment_id, p.cc_identifier, c.posted_at::DATE AS posted_on, p.total_amount_usd
  FROM payments p JOIN chargebacks c ON c.payment_id = p.id WHERE p.status IN ({_list(codes.APPROVED_STATUSES)}) AND c.status = '1st_chargeback') GROUP BY 1, 2)"""


@register("disputed_by_card_and_day", f"""
WITH {with_tables('payments', 'chargebacks')}, {_BY_DAY} SELECT cc_identifier, posted_on, card_total::DOUBLE AS card_total FROM by_day""")
def disputed_by_card_and_day(spark: SparkSession, sf: str) -> DataFrame:
    return cb.disputed_by_card_and_day(Domain(spark, sf)).withColumn("card_total", F.col("card_total").cast("double"))


# --- the case file --------------------------------------------------------------------

_SHIFT = _list(codes.LIABILITY_SHIFT_ECI)
_FILE_TABLES = with_tables(
    "payments", "proc_requests", "end_users", "partners", "chargebacks", "decisions", "r_payments", "r_payment_tags", "maxmind_triggers",
    "enrich_maxmind", "payment_events_log", "execution_responses", "cc_identifiers", "fraud_warnings", "user_browser_events",
    "payment_credit_cards", "wallet_attempts", "chargeback_types", "chargeback_decisions", "fraud_warning_classifications", "quotes",
    "processors", "processors_mids", "binbase", "fraud_ring_tags")

_FILE = f"""
WITH {_FILE_TABLES}, {_identity_ctes(_FIXED)}, {_PEER}, {_LINKS}, {_AVS}, {_PROOF}, {_fraud_sql('4000', "'8', '0', '9'")}, {_DEVICE}, {_FOUR}, {_BY_DAY},
banks AS (SELECT DISTINCT bin, issuing_organization AS org, issuing_country_iso_a2 AS land FROM binbase WHERE ver = {codes.BINBASE_VERSION}),
issuers AS (SELECT DISTINCT request_data->>'$.bin' AS bin, request_data->>'$.i' AS ip, inserted_at::DATE AS day, data->'credit_card'->'issuer'->>'name' AS issuer FROM enrich_maxmind),
base AS (SELECT DISTINCT c.payment_id AS pid, c.posted_at::DATE AS posted_on, c.reason_code AS rc, c.raw_data AS raw, c.status AS stage, p.*,
    pr.threeds->>'$.eci' AS eci3, pr.threeds->>'$.cavv' AS cavv3, pr.raw_response->>'$.paymentOption.card.threeD.eci' AS zero, pr.payment_instrument_type AS instr,
    ct.chargeback_type AS kind, ct.reason_description AS why, org, land, issuer, coalesce(cd.fraud_type, fwc.fraud_type) AS analyst, coalesce(cd.sub_fraud_type, fwc.sub_fraud_type) AS sub,
    fw.reported_at, q.digital_amount, tk.id AS tk_id, tk.full_name AS tk_name, payee.full_name AS payee, pc.name AS proc, pm.descriptor, pm.config AS pmc, card_total,
    u.event_type = 'confirm-coin-delivery' AS confirmed
  FROM chargebacks c JOIN payments p ON p.id = c.payment_id JOIN proc_requests pr ON pr.payment_id = p.id AND pr.tx_type = 'authorization' AND pr.status = 'success'
  LEFT JOIN chargeback_types ct ON ct.reason_code = c.reason_code LEFT JOIN banks ON banks.bin = p.bin
  LEFT JOIN issuers ON issuers.bin = p.bin AND issuers.ip = p.login->>'$.ip' AND issuers.day = p.created_at::DATE
  LEFT JOIN chargeback_decisions cd ON cd.payment_id = p.id LEFT JOIN fraud_warning_classifications fwc ON fwc.payment_id = p.id LEFT JOIN fraud_warnings fw ON fw.payment_id = p.id
  LEFT JOIN quotes q ON q.quote_id = p.quote_id LEFT JOIN partners tk ON tk.name = q.wallet_id LEFT JOIN partners payee ON payee.id = p.pay_to_partner_id
  LEFT JOIN processors pc ON pc.id = p.processor_id LEFT JOIN processors_mids pm ON pm.descriptor = p.mid
  LEFT JOIN by_day ON by_day.cc_identifier = p.cc_identifier AND by_day.posted_on = c.posted_at::DATE
  LEFT JOIN user_browser_events u ON u.payment_id = p.id
  WHERE c.status = '1st_chargeback' AND c.reason_code <> '2700' AND p.status IN ({_list(codes.APPROVED_STATUSES)})
    AND p.id IN (SELECT payment_id FROM payment_events_log WHERE name IN ('payment_execution', 'payment_approved') AND partner_id IN ({_list(codes.EXAMPLE.executing_partners)}))),
out AS (SELECT pid, rc, base.currency, raw, bin,
  CASE WHEN kind = 'fraud' AND rc IN ('11.3', '4808') THEN 'Turnkey Service Level' WHEN kind = 'fraud' THEN 'Fraud' WHEN kind = 'service_level' THEN 'Turnkey Service Level' ELSE 'Error' END AS template,
  CASE WHEN proc = 'ecp' AND left(bin, 1) IN ('4', '5', '6') THEN posted_on + 8 WHEN proc = 'paysafe' THEN posted_on + 7 WHEN proc = 'safecharge' THEN posted_on + 5 END AS fight,
  CASE WHEN proc = 'ecp' AND left(bin, 1) = '4' THEN posted_on + 21 WHEN proc = 'ecp' AND left(bin, 1) = '5' THEN posted_on + 30 WHEN proc = 'paysafe' THEN posted_on + 15
    WHEN proc = 'safecharge' AND pay_to_partner_id = 40 THEN posted_on + 10 WHEN proc = 'safecharge' THEN posted_on + 14 END AS ab_fight,
  replace({_arn('raw')}, '''', '') AS arn, cc_identifier, analyst, sub, CASE WHEN pay_to_partner_id IN ({_list(codes.EXAMPLE.top_up_partners)}) THEN 'Top-Up' ELSE crypto_currency END AS coin, payee, phone,
  pay_to_partner_id, CASE WHEN cavv3 IS NOT NULL AND ((payee <> '{codes.EXAMPLE.us_broker}' AND eci3 IN ({_SHIFT})) OR (payee = '{codes.EXAMPLE.us_broker}' AND zero IN ({_SHIFT}))) THEN 'Yes' ELSE 'No' END AS threeds,
  CASE WHEN reported_at IS NULL THEN 'No' ELSE 'Yes' END AS has_fw, CASE WHEN status IN (13, 15) THEN 'Yes' ELSE 'No' END AS refunded, kind,
  CASE rc WHEN '10.5' THEN 'Visa Fraud Monitoring Program' ELSE why END AS why, total_amount, total_amount_usd,
  CASE proc WHEN 'ecp' THEN (((raw->>'$.amount')::DECIMAL(20,2) / -100)::DECIMAL(10,2))::VARCHAR WHEN 'paysafe' THEN replace(raw->>'$."Posting Amount"', ',', '') WHEN 'safecharge' THEN raw->>'$.chargebackAmount' END AS amt,
  CASE proc WHEN 'ecp' THEN 'USD' WHEN 'paysafe' THEN raw->>'$."Original Transaction Currency"' WHEN 'safecharge' THEN raw->>'$.currency' END AS amt_cur,
  handling_at, posted_on, stage, proc,
  CASE WHEN tk_id IS NULL THEN 'No' WHEN pay_to_partner_id = 40 OR (kind = 'service_level' AND pay_to_partner_id IN ({_list(codes.EXAMPLE.liable_service_partners)})) THEN 'Yes'
    WHEN kind = 'fraud' AND cavv3 IS NULL THEN 'Yes' ELSE 'No' END AS liable,
  CASE WHEN left(bin, 1) = '4' THEN 'Visa' WHEN left(bin, 1) IN ('2', '5', '6') THEN 'Mastercard'
    WHEN bin IS NULL THEN CASE WHEN instr = 'google_pay' THEN 'GooglePay-' ELSE 'ApplePay-' END || CASE WHEN (raw->>'$.paymentMethod') = 'Visa' THEN 'Visa' ELSE 'Mastercard' END ELSE 'Error' END AS scheme,
  CASE WHEN issuer IS NOT NULL THEN issuer WHEN bin IS NULL THEN raw->>'$.issuerBank' WHEN org IS NOT NULL THEN org ELSE 'Unknown' END AS bank, coalesce(land, country) AS land, order_id, payment_id AS long_id,
  card_total, raw->>'$."Transaction ID"' AS uti,
  coalesce(pmc->'accounts'->base.currency->>'account', pmc->'merchant'->>base.currency, pmc->'merchant'->>'uId', pmc->>'merchantId') AS mid, descriptor, coalesce(tk_name, descriptor) AS turnkey, tk_id,
  crypto_currency_address, digital_amount, concat(first_name_card, ' ', last_name_card) AS full_name, email, concat(address1, ' ', city, ' ', state, ' ', country, ' ', zipcode) AS address,
  CASE WHEN confirmed THEN 'Yes' ELSE 'No' END AS confirmed
  FROM base)
SELECT template AS "Chargeback_Template__c", fight AS "Fight_Until__c", out.arn AS "Name", pid AS "Payment_ID__c", cc_identifier AS "CC_Identifier__c", analyst AS "Fraud_Type__c",
  tag AS "Fraud_Ring__c", sub AS "Sub_Fraud_Type__c", coin AS "Crypto_Currency__c", payee AS "Partner_Name__c", pay_to_partner_id AS "Partner_Account_Number__c", threeds AS "X3DS__c", proof.eci AS "ECI__c",
  has_fw AS "Has_FW__c", refunded AS "Was_Refunded__c", kind AS "Chargeback_Type__c", rc AS "Reason_Code__c", why AS "Reason_Description__c", total_amount::DOUBLE AS "Payment_Amount__c", currency AS "Payment_Currency__c",
  amt AS "CBA_Amount__c", amt_cur AS "CB_Currency__c", total_amount_usd::DOUBLE AS "Payment_Amount_USD__c", handling_at AS "Transaction_Date__c", posted_on AS "Chargeback_Posting_Date__c",
  posted_on + 135 AS "Final_Decision_Date__c", 'New' AS "Status__c", stage AS "Stage__c", 'TBD' AS "Decision__c", proc AS "ARN_not_used__c", liable AS "Is_Company_Liable__c", scheme AS "Card_Scheme__c", bank AS "Issuing_Bank__c",
  land AS "Country__c", order_id AS "Partner_ID__c", long_id AS "Long_ID__c", card_total::DOUBLE AS "Total_Amount_By_Card__c", uti AS "UTI__c", mid AS "MID__c", descriptor AS "Descriptor__c", turnkey AS "Turnkey_or_Partner_Name__c",
  tk_id AS "Turnkey_or_Partner_ID__c", crypto_currency_address AS "Crypto_Address__c", digital_amount AS "Crypto_Amount__c", rank AS "Identity_Match__c", full_acc_name AS "Chargeback_Account_Name__c",
  registration_date AS "Registration_Date__c", ip_address AS "IP_Address__c", ip_location AS "IP_Location__c", bill_add_dist AS "Billing_Address_Distance__c", accuracy_radius AS "Accuracy_Radius__c",
  proxy_score AS "Proxy_Score__c", device_id AS "Device_Id__c", last_4 AS "Last_4_CC_Digits__c", replace(replace(replace(full_name, ',', ''), '.', ''), '#', '') AS "Full_Name__c", email AS "Email__c",
  replace(replace(replace(address, ',', ''), '.', ''), '#', '') AS "Billing_Address__c", ab_fight AS "AB_Fight_Until_Date__c", confirmed AS "Has_Email_Confirmation__c", blockchain_link AS "Blockchain_Website__c",
  phone AS "Phone__c", fraud_type AS "Fraud_Type_code__c", avs_value AS "AVS_value__c", CASE WHEN avs_rows.avs THEN 'Yes' ELSE 'No' END AS "AVS_Match__c", CASE WHEN avs_check THEN 'Yes' ELSE 'No' END AS "AVS_Check__c",
  CASE WHEN (payee <> '{codes.EXAMPLE.us_broker}' AND proof.eci IN ({_SHIFT})) OR (payee = '{codes.EXAMPLE.us_broker}' AND answer_eci IN ({_SHIFT}))
    THEN concat('ECI ', proof.eci, ', CAVV: ', proof.cavv, ', Card Number ', credit_card, ', Auth Code: ', auth_code) ELSE 'False' END AS "X3DS_Details__c"
FROM out LEFT JOIN identity ON identity.payment_id = pid LEFT JOIN links ON links.payment_id = pid LEFT JOIN avs_rows ON avs_rows.payment_id = pid
LEFT JOIN proof ON proof.payment_id = pid LEFT JOIN answer ON answer.payment_id = pid LEFT JOIN (SELECT DISTINCT payment_id, tag FROM fraud_ring_tags) rings ON rings.payment_id = pid
LEFT JOIN (SELECT DISTINCT payment_id, fraud_type FROM fraud) fraud ON fraud.payment_id = pid LEFT JOIN device ON device.payment_id = pid LEFT JOIN four ON four.payment_id = pid"""


@register("dispute_case_file", _FILE)
def dispute_case_file(spark: SparkSession, sf: str) -> DataFrame:
    out = cb.case_file(Domain(spark, sf), AS_OF, DAYS, SINCE)
    money = ["Payment_Amount__c", "Payment_Amount_USD__c", "Total_Amount_By_Card__c"]
    return out.withColumns({c: F.col(c).cast("double") for c in money})


@register("case_updates", f"""
WITH {with_tables('proc_requests', 'chargebacks', 'fraud_warnings', 'fraud_ring_tags')}, {_fraud_sql('100', "'8', '0'").replace(AS_OF, '2001-08-20')},
open_cases AS (SELECT DISTINCT payment_id FROM chargebacks WHERE posted_at >= TIMESTAMP '2001-08-20' - INTERVAL 100 DAY AND status = '1st_chargeback')
SELECT 'crm' || o.payment_id AS "Id", CASE WHEN tag = '{codes.EXAMPLE.mass_closing_tag}' THEN '' ELSE tag END AS "Fraud_Ring__c", fraud_type AS "Fraud_Type_code__c", fraud_description AS "Fraud_Type_Description__c",
  CASE WHEN w.payment_id IS NULL THEN 'No' ELSE 'Yes' END AS "Has_FW__c"
FROM open_cases o LEFT JOIN fraud_ring_tags t ON t.payment_id = o.payment_id LEFT JOIN fraud ON fraud.payment_id = o.payment_id
LEFT JOIN (SELECT DISTINCT payment_id FROM fraud_warnings WHERE inserted_at >= TIMESTAMP '2001-08-20' - INTERVAL 180 DAY) w ON w.payment_id = o.payment_id
WHERE o.payment_id % 4 <> 3""")
def case_updates(spark: SparkSession, sf: str) -> DataFrame:
    d = Domain(spark, sf)
    known = d["payments"].filter("id % 4 <> 3").select(F.col("id").cast("string").alias("payment_key"), F.expr("'crm' || id").alias("Id"))
    return cb.case_updates(d, "2001-08-20", known)
