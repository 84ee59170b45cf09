"""A payment domain derived from the given tables.

Orders play payments, customers play partners and users, parts play card ranges.  Every
table is one row-wise SELECT in the SQL that Spark and DuckDB share (``@name`` stands for
a given table), so it grows with the data and both sides of a check start from the same
rows.  Amounts are whole numbers and rates powers of two, which keeps sums exact.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_CREATED = "o_orderdate + (o_orderkey % 1440) * INTERVAL '1' MINUTE"
_PROCESSOR = "CASE o_orderkey % 4 WHEN 0 THEN 'ecp' WHEN 1 THEN 'paysafe' WHEN 2 THEN 'worldline' ELSE 'safecharge' END"
_PROCESSOR_ID = "CASE o_orderkey % 4 WHEN 0 THEN 3 WHEN 1 THEN 5 WHEN 2 THEN 7 ELSE 8 END"
_BIN = ("CAST(CASE o_orderkey % 500 % 4 WHEN 0 THEN 200000 WHEN 1 THEN 400000 WHEN 2 THEN 500000 ELSE 600000 END"
        " + o_orderkey % 500 AS STRING)")
_HAS_BIN = "o_orderkey % 13 <> 0"
_INSTRUMENT = "CASE WHEN o_orderkey % 13 = 0 AND o_orderkey % 2 = 0 THEN 'google_pay' ELSE 'credit_card' END"
_AVS = "substr('ABGRUXYZ', CAST(o_custkey % 8 + 1 AS INT), 1)"
_COIN = ("CASE o_orderkey % 9 WHEN 0 THEN 'BTC' WHEN 1 THEN 'ETH' WHEN 2 THEN 'BNB' WHEN 3 THEN 'BNB-SC' WHEN 4 THEN 'LINK'"
         " WHEN 5 THEN 'HBAR' WHEN 6 THEN 'ZZZ' WHEN 7 THEN 'XRP' ELSE 'DOGE' END")


def _sql(text: str) -> str:
    for name, value in {"CREATED": _CREATED, "PROCESSOR_ID": _PROCESSOR_ID, "PROCESSOR": _PROCESSOR, "HAS_BIN": _HAS_BIN,
                        "BIN": _BIN, "INSTRUMENT": _INSTRUMENT, "AVS": _AVS, "COIN": _COIN}.items():
        text = text.replace(f"<{name}>", value)
    return text


_PROC = """SELECT o_orderkey * 2 + {k} AS id, o_orderkey AS payment_id, <CREATED> + INTERVAL '{k}' HOUR AS created_at,
  <CREATED> + INTERVAL '{k}' DAY AS updated_at, {tx} AS tx_type, <PROCESSOR> AS processor,
  CASE WHEN o_orderkey % 19 = 0 THEN 'failed' ELSE 'success' END AS status,
  '{{"avs_response_code":"5' || <AVS> || '","avsResponse":"' || CASE WHEN o_custkey % 3 = 0 THEN 'MATCH' ELSE 'NO' END
  || '","paymentOption":{{"card":{{"avsCode":"' || <AVS> || '","threeD":{{"eci":"0' || (o_orderkey % 8) || '"}}}}}},"last4Digits":"'
  || (1000 + o_custkey % 50) || '","bin":"' || <BIN> || '","authCode":"A' || o_orderkey || '"}}' AS raw_response,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN '{{"eci":"07"}}'
       ELSE '{{"eci":"0' || (o_orderkey % 7) || '","cavv":"C' || o_orderkey || '"}}' END AS threeds,
  CASE WHEN <HAS_BIN> THEN 'cc' || o_custkey END AS cc_identifier, <INSTRUMENT> AS payment_instrument_type
FROM @orders"""

_AUTH = """SELECT o_orderkey AS payment_id, 'ar' || o_orderkey || '{suffix}' AS auth_request_id, {created} AS created_at,
  CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE 'pa' || o_orderkey END AS payment_attempt_reference_id,
  '{{' || CASE o_orderkey % 4 WHEN 0 THEN '"skip3ds":false' WHEN 1 THEN '"skip3ds":true' WHEN 2 THEN '"skip3ds":null' ELSE '"x":1' END
  || CASE o_custkey % 3 WHEN 0 THEN ',"initialRiskChecks":{{"action":{{"name":"threeds"}}}}'
       WHEN 1 THEN ',"initialRiskChecks":{{"action":{{"name":"none"}}}}' ELSE '' END
  || CASE o_custkey % 5 WHEN 0 THEN ',"processorName":"named"' ELSE '' END
  || ',"processorId":"' || (o_orderkey % 9) || '"'
  || CASE o_custkey % 4 WHEN 0 THEN ',"threeDsVersion":"0"' WHEN 1 THEN ',"threeDsVersion":"1.0"' WHEN 2 THEN ',"threeDsVersion":"2.1"' ELSE '' END
  || '}}' AS request_data
FROM @orders {where}"""

_LINK = """SELECT 'ar' || o_orderkey AS auth_request_id, 't' || o_orderkey || '{suffix}' AS threeds_id, {created} AS created_at
FROM @orders WHERE o_orderkey % 5 <> 4 {where}"""

_DOMAIN: dict[str, str] = {
    "payments": """SELECT o_orderkey AS id, 'long-' || o_orderkey AS payment_id, o_custkey AS partner_end_user_id,
  o_custkey AS end_user_id, <CREATED> AS created_at, <CREATED> + INTERVAL '2' HOUR AS updated_at,
  <CREATED> + INTERVAL '1' HOUR AS handling_at,
  CASE o_orderkey % 10 WHEN 6 THEN 13 WHEN 7 THEN 1 WHEN 8 THEN 25 WHEN 9 THEN 15 ELSE 2 END AS status,
  CASE o_orderkey % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' ELSE 'GBP' END AS currency,
  CAST(floor(o_totalprice) AS DECIMAL(18,2)) AS total_amount,
  CAST(floor(o_totalprice) + o_orderkey % 7 AS DECIMAL(18,2)) AS total_amount_usd,
  CASE o_orderkey % 4 WHEN 0 THEN CAST(1 AS DOUBLE) WHEN 1 THEN CAST(2 AS DOUBLE) WHEN 2 THEN CAST(0.5 AS DOUBLE) ELSE CAST(4 AS DOUBLE) END AS usd_rate,
  CASE WHEN <HAS_BIN> THEN <BIN> END AS bin, 'q' || o_orderkey AS quote_id,
  CASE o_orderkey % 6 WHEN 0 THEN CAST(40 AS BIGINT) WHEN 1 THEN CAST(38 AS BIGINT) WHEN 2 THEN CAST(67 AS BIGINT) WHEN 3 THEN CAST(1 AS BIGINT)
    WHEN 4 THEN CAST(23 AS BIGINT) ELSE o_custkey END AS pay_to_partner_id,
  <PROCESSOR_ID> AS processor_id, 'mid' || (o_orderkey % 10) AS mid,
  CASE WHEN <HAS_BIN> THEN 'cc' || o_custkey END AS cc_identifier, <COIN> AS crypto_currency,
  CASE WHEN o_orderkey % 2 = 0 THEN '0x' ELSE 'addr' END || o_orderkey AS crypto_currency_address,
  '{"ip":"10.0.0.' || (o_custkey % 250) || '"}' AS login, 'u' || o_custkey || '@x.org' AS email, '+1' || o_custkey AS phone,
  CASE o_custkey % 3 WHEN 0 THEN 'GB' WHEN 1 THEN 'DE' ELSE 'US' END AS country, 'ord' || o_orderkey AS order_id,
  'Ann' || (o_custkey % 7) AS first_name_card, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'Lee' || (o_custkey % 5) END AS last_name_card,
  'Street, 1.' AS address1, 'City' AS city, 'ST' AS state, '#12' AS zipcode
FROM @orders""",
    "proc_requests": " UNION ALL ".join(
        [_PROC.format(k=0, tx="'authorization'"), _PROC.format(k=1, tx="'capture-authorization'")]),
    "partner_end_users": "SELECT c_custkey AS id, c_custkey % 40 AS partner_id FROM @customer",
    "end_users": """SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'ann' ELSE 'Bob' END || (c_custkey % 7) AS first_name,
  'lee' || (c_custkey % 6) AS last_name, TIMESTAMP '1995-01-01 00:00:00' + (c_custkey % 100) * INTERVAL '1' DAY AS created_at FROM @customer""",
    "partners": """SELECT c_custkey AS id, 'partner-' || c_custkey AS name,
  CASE WHEN c_custkey = 40 THEN 'us-broker' ELSE c_name END AS full_name,
  CASE WHEN c_custkey % 2 = 0 OR c_custkey < 100 THEN 'broker' ELSE 'wallet' END AS service_type,
  CASE WHEN c_custkey % 5 = 0 THEN '{"activated":false}' ELSE '{"activated":true,"capping":{"daily_total_usd_amount":"' || (1000000 + c_custkey * 10) || '"}}' END AS config
FROM @customer""",
    "processors": """SELECT n_nationkey AS id, CASE n_nationkey WHEN 3 THEN 'ecp' WHEN 5 THEN 'paysafe' WHEN 7 THEN 'worldline' ELSE 'safecharge' END AS name
FROM @nation WHERE n_nationkey IN (3, 5, 7, 8)""",
    "processors_mids": """SELECT 'mid' || n_nationkey AS descriptor, CASE n_nationkey % 4 WHEN 0 THEN '{"accounts":{"EUR":{"account":"acc-eur"}},"merchantId":"m0"}'
  WHEN 1 THEN '{"merchant":{"USD":"m-usd","uId":"uid1"}}' WHEN 2 THEN '{"merchantId":"mid' || n_nationkey || '"}' ELSE '{}' END AS config
FROM @nation WHERE n_nationkey < 10""",
    "quotes": """SELECT 'q' || o_orderkey AS quote_id, CASE o_orderkey % 3 WHEN 0 THEN CAST(2 AS BIGINT) ELSE o_custkey END AS broker_id,
  CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE 'partner-' || o_custkey END AS wallet_id,
  CAST(o_orderkey AS DOUBLE) / 4 AS digital_amount, <CREATED> AS created_at FROM @orders""",
    "payment_fees": """SELECT o_orderkey AS payment_id, 'serviceFee' AS fee_type, CAST(o_orderkey % 50 + 4 AS DECIMAL(18,2)) AS amount, <CREATED> AS created_at FROM @orders
UNION ALL SELECT o_orderkey, 'serviceFee', CAST(o_orderkey % 50 AS DECIMAL(18,2)), <CREATED> + INTERVAL '1' DAY FROM @orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, 'lpServiceFee', CAST(o_orderkey % 20 AS DECIMAL(18,2)), <CREATED> FROM @orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT o_orderkey, 'otherFee', CAST(99 AS DECIMAL(18,2)), <CREATED> FROM @orders WHERE o_orderkey % 4 = 0""",
    "second_quote_revenue": """SELECT o_orderkey AS payment_id, CAST(o_orderkey % 11 AS DECIMAL(18,2)) AS total_second_quote_revenue_usd, <CREATED> AS created_at FROM @orders WHERE o_orderkey % 3 <> 1
UNION ALL SELECT o_orderkey, CAST(o_orderkey % 13 AS DECIMAL(18,2)), <CREATED> + INTERVAL '1' HOUR FROM @orders WHERE o_orderkey % 6 = 0""",
    "partner_fee": """SELECT o_orderkey AS txn_id, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'Y' END AS partner_fee_fiat_flag,
  CAST(o_orderkey % 17 AS DECIMAL(18,2)) AS partner_fee_fiat_usd, <CREATED> AS created_at FROM @orders WHERE o_orderkey % 4 <> 2""",
    "binbase": """SELECT CAST(CASE p_partkey % 500 % 4 WHEN 0 THEN 200000 WHEN 1 THEN 400000 WHEN 2 THEN 500000 ELSE 600000 END + p_partkey % 500 AS STRING) AS bin,
  CASE WHEN p_partkey % 4 = 1 THEN 'VISA' ELSE 'MASTERCARD' END AS card_brand,
  CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 3 = 1 THEN 'DEBIT' ELSE 'CREDIT' END AS card_type,
  CASE p_partkey % 4 WHEN 0 THEN 'GB' WHEN 1 THEN 'DE' WHEN 2 THEN 'US' ELSE 'FR' END AS issuing_country_iso_a2,
  'Bank ' || (p_partkey % 500 % 30) AS issuing_organization, CAST(14 - floor(p_partkey / 500) AS INT) AS ver FROM @part""",
    "enrich_binlist": """SELECT p_partkey AS id, CAST(CASE p_partkey % 500 % 4 WHEN 0 THEN 200000 WHEN 1 THEN 400000 WHEN 2 THEN 500000 ELSE 600000 END + p_partkey % 500 AS STRING) AS bin,
  TIMESTAMP '2000-01-01 00:00:00' + p_partkey * INTERVAL '1' MINUTE AS inserted_at,
  '{"brand":"' || CASE p_partkey % 5 WHEN 0 THEN 'Business' WHEN 1 THEN 'Gold' ELSE 'Classic' END || '","scheme":"s' || (p_partkey % 2) || '","type":"'
  || CASE WHEN p_partkey % 2 = 0 THEN 'debit' ELSE 'credit' END || '"}' AS response_data FROM @part WHERE p_partkey % 7 <> 0""",
    "processing_cost_share": """SELECT DISTINCT CASE WHEN p_partkey % 4 = 1 THEN 'VISA' ELSE 'MASTERCARD' END AS bb_card_brand,
  CASE p_size % 3 WHEN 0 THEN 'Domestic' WHEN 1 THEN 'EEA' ELSE 'International' END AS processing_cost_region,
  CASE WHEN p_size % 2 = 0 THEN 'DEBIT' ELSE 'CORPORATE' END AS final_card_type,
  CASE WHEN p_size % 5 < 3 THEN 'ecp' ELSE 'paysafe' END AS processor,
  CAST(p_size % 3 + 1 AS DOUBLE) / 64 AS processing_cost_share, CAST(TIMESTAMP '1996-01-01 00:00:00' AS DATE) AS start_date,
  CAST(CASE WHEN p_size % 7 = 0 THEN TIMESTAMP '1999-01-01 00:00:00' ELSE TIMESTAMP '2030-01-01 00:00:00' END AS DATE) AS end_date
FROM @part WHERE p_size < 30""",
    "chargebacks_log": """SELECT o_orderkey AS payment_ref, CASE o_orderkey % 8 WHEN 0 THEN 'Accept' WHEN 1 THEN 'Lost' WHEN 2 THEN 'TBD' WHEN 3 THEN 'Continue' ELSE 'Won' END AS decision,
  <CREATED> AS posting_date FROM @orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, 'Representment', <CREATED> + INTERVAL '3' DAY FROM @orders WHERE o_orderstatus = 'F' AND o_orderkey % 9 = 0""",
    "chargebacks": """SELECT o_orderkey AS id, o_orderkey AS payment_id, <CREATED> + INTERVAL '20' DAY AS inserted_at, <CREATED> + INTERVAL '10' DAY AS posted_at,
  CASE o_custkey % 7 WHEN 0 THEN '10.4' WHEN 1 THEN '4837' WHEN 2 THEN '11.3' WHEN 3 THEN '4808' WHEN 4 THEN '2700' WHEN 5 THEN '10.5' ELSE '13.1' END AS reason_code,
  '1st_chargeback' AS status,
  '{"' || CASE o_custkey % 4 WHEN 0 THEN 'arn' WHEN 1 THEN 'ARN' WHEN 2 THEN 'Acquirer ref number' ELSE 'Acquirer Ref Number' END || '":"'
  || CASE o_orderkey % 5 WHEN 0 THEN '7' WHEN 1 THEN '2' WHEN 2 THEN '8' WHEN 3 THEN '0' ELSE '9' END || o_orderkey || '''x","amount":"-' || (o_orderkey * 25)
  || '","Posting Amount":"1,' || (100 + o_orderkey % 900) || '","chargebackAmount":"' || o_orderkey || '.5","currency":"EUR","Original Transaction Currency":"USD","paymentMethod":"'
  || CASE WHEN o_custkey % 2 = 0 THEN 'Visa' ELSE 'MasterCard' END || '","issuerBank":"IB' || (o_custkey % 3) || '","Transaction ID":"tx' || o_orderkey || '"}' AS raw_data
FROM @orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey + 1000000000, o_orderkey, <CREATED> + INTERVAL '40' DAY, <CREATED> + INTERVAL '30' DAY, '10.4', '2nd_chargeback', '{"arn":"7"}'
FROM @orders WHERE o_orderstatus = 'F' AND o_orderkey % 17 = 0""",
    "chargeback_types": """SELECT CASE n_nationkey WHEN 0 THEN '10.4' WHEN 1 THEN '4837' WHEN 2 THEN '11.3' WHEN 3 THEN '4808' WHEN 4 THEN '2700' WHEN 5 THEN '10.5' ELSE '13.1' END AS reason_code,
  CASE WHEN n_nationkey < 6 THEN 'fraud' ELSE 'service_level' END AS chargeback_type, 'Reason ' || n_nationkey AS reason_description
FROM @nation WHERE n_nationkey < 7""",
    "chargeback_decisions": "SELECT o_orderkey AS payment_id, 'ft' || (o_orderkey % 3) AS fraud_type, 'sub' || (o_orderkey % 2) AS sub_fraud_type FROM @orders WHERE o_orderkey % 3 = 0",
    "fraud_warning_classifications": "SELECT o_orderkey AS payment_id, 'wt' || (o_orderkey % 3) AS fraud_type, 'ws' || (o_orderkey % 2) AS sub_fraud_type FROM @orders WHERE o_orderkey % 4 = 0",
    "fraud_warnings": """SELECT o_orderkey AS id, o_orderkey AS payment_id, <CREATED> + INTERVAL '5' DAY AS inserted_at, <CREATED> + INTERVAL '4' DAY AS reported_at,
  CASE o_custkey % 8 WHEN 6 THEN '6' WHEN 7 THEN 'NaN' ELSE CAST(o_custkey % 8 AS STRING) END AS fraud_type_code,
  '{"fraudType":"' || CASE o_custkey % 9 WHEN 0 THEN 'Lost Fraud' WHEN 1 THEN 'Stolen Fraud' WHEN 2 THEN 'Never Received Issue' WHEN 3 THEN 'Other'
  WHEN 4 THEN 'Account Takeover Fraud' WHEN 5 THEN 'Processing Error' WHEN 6 THEN 'Card Not Present Fraud' WHEN 7 THEN 'Unknown' ELSE 'Odd' END || '"}' AS raw_data
FROM @orders WHERE o_orderkey % 3 <> 2""",
    "fraud_ring_tags": """SELECT o_orderkey AS payment_id, CASE WHEN o_orderkey % 2 = 0 THEN true END AS third_party_scam,
  CASE WHEN o_orderkey % 10 = 0 THEN 'mass-closed' ELSE 'ring ' || (o_orderkey % 12) END AS tag FROM @orders WHERE o_orderkey % 5 = 0""",
    "payment_events_log": """SELECT o_orderkey * 2 AS id, o_orderkey AS payment_id, 'payment_approved' AS name,
  CASE WHEN o_orderkey % 12 = 11 THEN CAST(9 AS BIGINT) ELSE CAST(67 AS BIGINT) END AS partner_id FROM @orders
UNION ALL SELECT o_orderkey * 2 + 1, o_orderkey, 'payment_execution', CAST(23 AS BIGINT) FROM @orders WHERE o_orderkey % 2 = 0""",
    "execution_responses": "SELECT o_orderkey * 2 AS event_id, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'h-' || o_orderkey || '.z' END AS blockchain_txn_hash FROM @orders",
    "user_browser_events": """SELECT o_orderkey * 2 AS id, o_orderkey AS payment_id, 'authorize' AS event_type, '{"session":{"ip":"10.1.1.' || (o_orderkey % 250) || '"}}' AS request_data,
  'dev' || (o_orderkey % 77) AS device_id FROM @orders WHERE o_orderkey % 6 <> 5
UNION ALL SELECT o_orderkey * 2 + 1, o_orderkey, 'confirm-coin-delivery', '{}', 'dev0' FROM @orders WHERE o_orderkey % 6 = 5""",
    "r_payments": "SELECT o_orderkey + 5000000000 AS id, o_orderkey AS payment_ref FROM @orders",
    "r_payment_tags": """SELECT o_orderkey + 5000000000 AS r_payment_id, <CREATED> AS inserted_at, '[{"name":"a"},{"name":"Fraud Ring ' || (o_orderkey % 3) || '"}]' AS tags FROM @orders WHERE o_orderkey % 7 = 0
UNION ALL SELECT o_orderkey + 5000000000, <CREATED> + INTERVAL '1' DAY, '[{"name":"clean"}]' FROM @orders WHERE o_orderkey % 14 = 0""",
    "maxmind_triggers": "SELECT o_orderkey + 5000000000 AS r_payment_id, o_orderkey AS enrich_maxmind_id FROM @orders WHERE o_orderkey % 8 <> 7",
    "enrich_maxmind": """SELECT o_orderkey AS id, <CREATED> + INTERVAL '1' MINUTE AS inserted_at,
  '{"bin":"' || <BIN> || '","i":"10.0.0.' || (o_custkey % 250) || '"}' AS request_data,
  '{"billing_address":{"distance_to_ip_location":' || (o_orderkey % 3 * 80) || '},"ip_address":{"location":{"accuracy_radius":' || (o_custkey % 50)
  || '},"risk":' || (o_custkey % 9) || ',"city":{"names":{"en":"C' || (o_custkey % 9) || '"}},"subdivisions":[{"names":{"en":"Sub"}}],"postal":{"code":"P1"},"country":{"names":{"en":"Land"}}},"credit_card":{"issuer":'
  || CASE WHEN o_orderkey % 4 = 0 THEN '{"name":"Issuer ' || (o_custkey % 6) || '"}' ELSE '{}' END || '}}' AS data FROM @orders""",
    "decisions": """SELECT o_orderkey AS id, 'decision-engine' AS application_name, o_orderkey AS payment_id, <CREATED> AS created_at,
  '{"Analytic":{"variables":{"Analytic":{"buyer_email_name_match_level":"' || CASE o_custkey % 3 WHEN 0 THEN 'full_match' ELSE 'none' END
  || '","buyer_ekata_email_name_match":"' || CASE o_custkey % 5 WHEN 0 THEN 'partial_match' ELSE 'none' END
  || '","buyer_ekata_name_phone_match":"' || CASE o_custkey % 4 WHEN 0 THEN 'full_match' ELSE 'none' END
  || '","name_on_card_to_name_in_poid_valid_for_current_payment_match":"' || CASE o_custkey % 6 WHEN 0 THEN 'full_match' ELSE 'x' END
  || '","user_has_approved_kyc_from_broker":' || CASE WHEN o_orderkey % 3 = 0 THEN 'true' ELSE 'false' END
  || ',"user_verified_by_selfie":' || CASE WHEN o_custkey % 11 = 0 THEN 'true' ELSE 'false' END || '}}}}' AS variables FROM @orders WHERE o_orderkey % 9 <> 8
UNION ALL SELECT o_orderkey + 1000000000, 'Other', o_orderkey, <CREATED> + INTERVAL '1' DAY, '{}' FROM @orders WHERE o_orderkey % 2 = 0""",
    "cc_identifiers": "SELECT 'cc' || c_custkey AS identifier, '411111******' || (1000 + c_custkey) AS credit_card FROM @customer",
    "payment_credit_cards": "SELECT o_orderkey AS payment_id, 'card' || o_orderkey AS credit_card_id FROM @orders WHERE o_orderkey % 3 <> 0",
    "wallet_attempts": "SELECT 'card' || o_orderkey AS payment_instrument_id, 'Visa ' || (2000 + o_orderkey % 1000) AS display_name FROM @orders WHERE o_orderkey % 2 = 1",
    "verifications": """SELECT o_orderkey AS id, o_orderkey AS initial_payment_id, <CREATED> AS inserted_at,
  CASE o_custkey % 4 WHEN 0 THEN 'kyc_identity' WHEN 1 THEN 'video_selfie' WHEN 2 THEN 'photo_selfie' ELSE 'other' END AS verification_type FROM @orders WHERE o_orderkey % 3 <> 0
UNION ALL SELECT o_orderkey + 1000000000, o_orderkey, <CREATED> + INTERVAL '1' HOUR, 'video_selfie' FROM @orders WHERE o_orderkey % 5 = 0""",
    "constants": """SELECT 'BROKERS_CONVERSION_RATES' AS name, TIMESTAMP '2000-01-01 00:00:00' + n_nationkey * INTERVAL '1' DAY AS inserted_at,
  '{"partner-2":{"poid":0.5,"photo_selfie":0.25,"video_selfie":0.' || (n_nationkey % 2 * 2 + 5) || '},"partner-4":{"poid":0.75,"photo_selfie":0.5,"video_selfie":0.5}}' AS json_value FROM @nation""",
    # --- authentication ---------------------------------------------------------------
    "payments_auth_requests": " UNION ALL ".join([
        _AUTH.format(suffix="", created="<CREATED>", where=""),
        _AUTH.format(suffix="b", created="<CREATED> + INTERVAL '1' HOUR", where="WHERE o_orderkey % 3 = 0")]),
    "auth_request_threeds": " UNION ALL ".join([
        _LINK.format(suffix="", created="<CREATED>", where=""),
        _LINK.format(suffix="n", created="<CREATED> + INTERVAL '1' MINUTE", where="AND o_orderkey % 7 = 0")]),
    "auth_request_enrollments": "SELECT 'ar' || o_orderkey AS auth_request_id, o_orderkey AS mpi_enrollments_id FROM @orders WHERE o_orderkey % 6 = 0",
    "mpi_enrollments": """SELECT o_orderkey AS id, 'mpi' || (o_orderkey % 2) AS mpi_provider, o_custkey % 2 = 0 AS is_enrolled, CASE WHEN o_custkey % 2 = 0 THEN 'Y' ELSE 'N' END AS enrollment_res
FROM @orders WHERE o_orderkey % 6 = 0""",
    "auth_request_validations": "SELECT 'ar' || o_orderkey AS auth_request_id, o_orderkey AS mpi_authentication_validation_id FROM @orders WHERE o_orderkey % 6 = 0",
    "mpi_validations": "SELECT o_orderkey AS id, CASE WHEN o_custkey % 3 = 0 THEN 'Y' ELSE 'A' END AS three_d_result, '0' || (o_custkey % 8) AS eci FROM @orders WHERE o_orderkey % 12 = 0",
    "auth_request_proc_requests": "SELECT 'ar' || o_orderkey AS auth_request_id, o_orderkey * 2 AS proc_request_id FROM @orders WHERE o_orderkey % 3 <> 1",
    "initialized_threeds": """SELECT 't' || o_orderkey AS id, CAST(floor(o_totalprice) AS DOUBLE) AS amount, 'EUR' AS currency_code, 'visa' AS scheme, 'm' || (o_custkey % 5) AS merchant_name,
  'c' || o_custkey AS credit_card_id, CAST(o_custkey % 3 AS INT) AS version FROM @orders WHERE o_orderkey % 2 = 0""",
    "authorization_result": """SELECT 't' || o_orderkey AS threeds_id, CASE WHEN o_custkey % 2 = 0 THEN 'Y' ELSE 'N' END AS enrollment_status,
  CASE o_custkey % 4 WHEN 0 THEN '{"status":"SUCCESS"}' WHEN 1 THEN '{"status":"FAIL"}' WHEN 2 THEN '[]' END AS errors,
  CASE WHEN o_custkey % 3 = 0 THEN 'https://acs.bank' || (o_custkey % 9) || '.example/auth' END AS acs_url,
  CASE WHEN o_custkey % 10 = 0 THEN true END AS cascaded_to_v1 FROM @orders WHERE o_orderkey % 4 = 0""",
    "verified_threeds": "SELECT 't' || o_orderkey AS threeds_id, CASE WHEN o_custkey % 2 = 0 THEN 'Y' ELSE 'U' END AS threeds_status, CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE CAST(o_custkey % 8 AS INT) END AS eci FROM @orders WHERE o_orderkey % 8 = 0",
    "threeds": "SELECT 't' || o_orderkey AS id, CAST(floor(o_totalprice) AS DOUBLE) AS amount, 'USD' AS currency_code, 'mc' AS card_scheme, 'k' || (o_custkey % 4) AS mid_key, 'd' || o_custkey AS credit_card_id FROM @orders WHERE o_orderkey % 2 = 1",
    "create_pareq_requests": "SELECT o_orderkey AS id, 't' || o_orderkey AS threeds_id, 'prov' || (o_custkey % 2) AS threeds_provider FROM @orders WHERE o_orderkey % 4 = 1",
    "create_pareq_responses": "SELECT o_orderkey AS create_pareq_request_id, CASE o_custkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE 'U' END AS enrollment, CASE o_custkey % 4 WHEN 0 THEN '[]' WHEN 1 THEN '[\"e\"]' END AS errors FROM @orders WHERE o_orderkey % 4 = 1",
    "pares_validation_requests": "SELECT o_orderkey AS id, 't' || o_orderkey AS threeds_id FROM @orders WHERE o_orderkey % 4 = 1",
    "pares_validation_responses": "SELECT o_orderkey AS pares_validation_requests_id, CASE WHEN o_custkey % 2 = 0 THEN 'Y' ELSE 'N' END AS status, '0' || (o_custkey % 7) AS eci FROM @orders WHERE o_orderkey % 8 = 1",
    "threeds_versioning_requests": "SELECT 't' || o_orderkey AS threeds_id, o_orderkey AS version_request_id FROM @orders WHERE o_orderkey % 4 = 3",
    "versioning_requests": "SELECT o_orderkey AS id, 'ver' || (o_custkey % 2) AS threeds_provider FROM @orders WHERE o_orderkey % 4 = 3",
    "versioning_responses": "SELECT o_orderkey AS versioning_requests_id, CASE WHEN o_custkey % 3 = 0 THEN '[\"v\"]' END AS errors FROM @orders WHERE o_orderkey % 8 = 3",
    "authentication_requests": "SELECT o_orderkey AS id, 't' || o_orderkey AS threeds_id FROM @orders WHERE o_orderkey % 4 = 3",
    "authentication_responses": """SELECT o_orderkey AS authentication_requests_id, CASE WHEN o_custkey % 3 = 0 THEN 'C' ELSE 'Y' END AS status, '0' || (o_custkey % 8) AS eci,
  CASE WHEN o_custkey % 5 = 0 THEN '["a"]' END AS errors,
  '{"acsURL":"https://acs' || (o_custkey % 4) || '.example/x","authenticationResponse":{"transStatusReason":"' || lpad(CAST(o_custkey % 101 AS STRING), 2, '0') || '"}}' AS raw_response
FROM @orders WHERE o_orderkey % 4 = 3""",
    "results": "SELECT 't' || o_orderkey AS threeds_id, CASE WHEN o_custkey % 2 = 0 THEN 'Y' END AS status, CASE WHEN o_custkey % 2 = 0 THEN '0' || (o_custkey % 6) END AS eci, CASE WHEN o_custkey % 7 = 0 THEN '[\"r\"]' END AS errors FROM @orders WHERE o_orderkey % 8 = 3",
}


_GIVEN = re.compile(r"@(orders|customer|part|nation)\b")


class Domain:
    """The derived tables by name, read lazily: ``Domain(spark, folder)["payments"]``."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder
        self._tables: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._read(name)
        return self._tables[name]

    def _read(self, name: str) -> DataFrame:
        text = _GIVEN.sub(lambda m: f"parquet.`{self._folder}/{m.group(1)}.parquet`", _sql(_DOMAIN[name]))
        return self._spark.sql(text.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"))


def with_tables(*names: str) -> str:
    """The derived tables as CTEs for the checking SQL, without the leading WITH."""
    return ",\n".join(f"{n} AS ({_GIVEN.sub(lambda m: m.group(1), _sql(_DOMAIN[n]))})" for n in names)
