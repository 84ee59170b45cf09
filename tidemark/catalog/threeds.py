"""The authentication funnel over the derived payment domain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.domain import Domain, with_tables
from tidemark.catalog.registry import register
from tidemark.functions.codes import AUTH_REASON_RANGES, AUTH_REASONS
from tidemark.plans.threeds import authentication_funnel, rebuild_funnel

SINCE = "1995-06-01"
_TABLES = with_tables(
    "payments_auth_requests", "auth_request_threeds", "auth_request_enrollments", "mpi_enrollments",
    "auth_request_validations", "mpi_validations", "auth_request_proc_requests", "initialized_threeds",
    "authorization_result", "verified_threeds", "threeds", "create_pareq_requests", "create_pareq_responses",
    "pares_validation_requests", "pares_validation_responses", "threeds_versioning_requests", "versioning_requests",
    "versioning_responses", "authentication_requests", "authentication_responses", "results")
_REASONS = ", ".join(f"('{k}', '{v}')" for k, v in AUTH_REASONS.items())
_RANGES = " ".join(f"WHEN TRY_CAST(why AS INTEGER) BETWEEN {a} AND {b} THEN '{x}'" for a, b, x in AUTH_REASON_RANGES)


def funnel_sql(since: str) -> str:
    return f"""
WITH {_TABLES}, reasons(code, text) AS (VALUES {_REASONS}),
req AS (
  SELECT *, request_data::JSON AS j, count(payment_attempt_reference_id) OVER (PARTITION BY payment_attempt_reference_id) AS attempts
  FROM payments_auth_requests WHERE created_at > TIMESTAMP '{since}'
    AND (json_extract_string(request_data, '$.skip3ds') IS NOT NULL OR json_extract_string(request_data, '$.initialRiskChecks') IS NOT NULL)),
best AS (SELECT auth_request_id, max(created_at) AS m FROM auth_request_threeds WHERE created_at > TIMESTAMP '{since}' GROUP BY 1),
link AS (SELECT a.auth_request_id, a.threeds_id FROM auth_request_threeds a LEFT JOIN best b ON a.auth_request_id = b.auth_request_id
         WHERE b.m IS NULL OR b.m = a.created_at),
wide AS (
  SELECT req.*, j->>'$.threeDsVersion' AS ver, j->>'$.processorId' AS pid, j->>'$.processorName' AS pname, j->>'$.skip3ds' AS skip_flag,
    coalesce(CASE WHEN (j->>'$.initialRiskChecks.action.name') = 'threeds' THEN 'false' WHEN (j->>'$.initialRiskChecks.action.name') IS NOT NULL THEN 'true' END,
      j->>'$.skip3ds') AS skips,
    pp.proc_request_id, link.threeds_id, me.mpi_provider, me.is_enrolled AS me_enrolled, me.enrollment_res, mv.three_d_result, mv.eci AS mv_eci,
    it.id AS it_id, it.amount AS it_amount, it.currency_code AS it_cur, it.scheme AS it_scheme, it.merchant_name, it.credit_card_id AS it_card, it.version AS it_ver,
    tar.enrollment_status, tar.errors AS tar_errors, tar.acs_url, tar.cascaded_to_v1, tvt.threeds_status, tvt.eci AS tvt_eci,
    t.amount AS t_amount, t.currency_code AS t_cur, t.card_scheme AS t_scheme, t.mid_key, t.credit_card_id AS t_card,
    q.threeds_provider AS q_prov, q2.enrollment AS q_enr, q2.errors AS q_err, v2.status AS v_status, v2.eci AS v_eci,
    vq.threeds_provider AS vq_prov, vr.versioning_requests_id AS vr_id, vr.errors AS vr_err,
    ans.status AS a_status, ans.eci AS a_eci, ans.errors AS a_err, ans.raw_response->>'$.acsURL' AS a_url,
    ans.raw_response->>'$.authenticationResponse.transStatusReason' AS why, res.status AS r_status, res.eci AS r_eci, res.errors AS r_err
  FROM req
  LEFT JOIN auth_request_enrollments le ON le.auth_request_id = req.auth_request_id LEFT JOIN mpi_enrollments me ON me.id = le.mpi_enrollments_id
  LEFT JOIN auth_request_validations lv ON lv.auth_request_id = req.auth_request_id LEFT JOIN mpi_validations mv ON mv.id = lv.mpi_authentication_validation_id
  LEFT JOIN auth_request_proc_requests pp ON pp.auth_request_id = req.auth_request_id
  LEFT JOIN link ON link.auth_request_id = req.auth_request_id
  LEFT JOIN initialized_threeds it ON it.id = link.threeds_id LEFT JOIN authorization_result tar ON tar.threeds_id = it.id
  LEFT JOIN verified_threeds tvt ON tvt.threeds_id = it.id
  LEFT JOIN threeds t ON t.id = link.threeds_id
  LEFT JOIN create_pareq_requests q ON q.threeds_id = t.id LEFT JOIN create_pareq_responses q2 ON q2.create_pareq_request_id = q.id
  LEFT JOIN pares_validation_requests v ON v.threeds_id = t.id LEFT JOIN pares_validation_responses v2 ON v2.pares_validation_requests_id = v.id
  LEFT JOIN threeds_versioning_requests tv ON tv.threeds_id = t.id LEFT JOIN versioning_requests vq ON vq.id = tv.version_request_id
  LEFT JOIN versioning_responses vr ON vr.versioning_requests_id = vq.id
  LEFT JOIN authentication_requests ar ON ar.threeds_id = t.id LEFT JOIN authentication_responses ans ON ans.authentication_requests_id = ar.id
  LEFT JOIN results res ON res.threeds_id = t.id),
decided AS (
  SELECT *, left(ver, 1) AS major, coalesce(ver, '0') = '0' AS unversioned,
    CASE left(ver, 1) WHEN '2' THEN coalesce(threeds_status, r_status, a_status) WHEN '1' THEN coalesce(threeds_status, v_status) ELSE three_d_result END AS result,
    coalesce(tvt_eci::VARCHAR, replace(CASE left(ver, 1) WHEN '2' THEN coalesce(r_eci, a_eci) WHEN '1' THEN v_eci ELSE mv_eci END, '0', '')) AS indicator
  FROM wide)
SELECT auth_request_id, payment_attempt_reference_id, payment_id, coalesce(it_amount, t_amount) AS total_amount, coalesce(it_cur, t_cur) AS currency,
  coalesce(it_scheme, t_scheme) AS card_scheme,
  coalesce(pname, CASE pid WHEN '3' THEN 'ecp' WHEN '5' THEN 'paysafe' WHEN '7' THEN 'worldline' WHEN '8' THEN 'safecharge' ELSE pid END) AS processor,
  CASE WHEN it_id IS NULL THEN coalesce(vq_prov, q_prov, mpi_provider) ELSE 'safecharge' END AS threeds_provider,
  coalesce(nullif(regexp_extract(acs_url, '/([^/]+)', 1), ''), nullif(regexp_extract(a_url, '/([^/]+)', 1), '')) AS threeds_issuer,
  coalesce(merchant_name, mid_key) AS mid, coalesce(it_card, t_card) AS credit_card_id, created_at AS auth_request_created_at,
  CASE WHEN skip_flag = 'true' THEN NULL WHEN cascaded_to_v1 IS NOT NULL THEN '3DS 1.0' WHEN unversioned AND skips = 'false' THEN 'S2S'
    WHEN major = '1' OR it_ver = 1 THEN '3DS 1.0' WHEN major = '2' OR it_ver = 2 THEN '3DS 2.0' WHEN skips = 'false' THEN 'other' END AS flow,
  CASE WHEN enrollment_status = 'Y' THEN true WHEN unversioned THEN me_enrolled WHEN major = '1' AND q_enr = 'Y' THEN true
    WHEN major = '1' AND q_enr IN ('N', 'U') THEN false WHEN major = '2' AND (vr_id IS NULL OR vr_err IS NOT NULL) THEN false WHEN major = '2' THEN true END AS is_enrolled,
  coalesce(enrollment_status, q_enr, enrollment_res) AS enrollment_result,
  CASE WHEN coalesce(tar_errors, q_err) <> '[]' THEN true WHEN major = '2' AND vr_id IS NULL THEN true ELSE false END AS enrollment_errors,
  result AS threeds_validation_result,
  CASE WHEN reasons.text IS NOT NULL THEN reasons.text {_RANGES} ELSE 'UNKNOWN' END AS reason,
  '0' || indicator AS eci, acs_url IS NOT NULL OR coalesce(a_status = 'C', false) AS was_challenge_requested, attempts > 1 AS was_cascading_performed,
  result IS NULL AND proc_request_id IS NOT NULL AS was_routed_to_non_3ds,
  CASE WHEN (tar_errors->>'$.status') <> 'SUCCESS' THEN tar_errors WHEN q_err = '[]' THEN NULL ELSE coalesce(q_err, r_err, a_err) END AS validation_errors,
  proc_request_id, threeds_id, request_data
FROM decided LEFT JOIN reasons ON reasons.code = why"""


@register("authentication_funnel", funnel_sql(SINCE))
def funnel(spark: SparkSession, sf: str) -> DataFrame:
    return authentication_funnel(Domain(spark, sf), SINCE)


@register("funnel_rebuild", f"""
WITH fresh AS ({funnel_sql('2001-05-04')})
SELECT auth_request_id, flow FROM fresh WHERE auth_request_created_at > TIMESTAMP '2001-05-04'
UNION ALL SELECT 'ar' || o_orderkey, 'old' FROM orders WHERE o_orderdate <= TIMESTAMP '2001-05-04'""")
def funnel_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    d = Domain(spark, sf)
    kept = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.concat(F.lit("ar"), F.col("o_orderkey").cast("string")).alias("auth_request_id"), F.lit("old").alias("flow"),
        F.col("o_orderdate").alias("auth_request_created_at"))
    return rebuild_funnel(kept, d, "2001-08-02", 90).select("auth_request_id", "flow")
