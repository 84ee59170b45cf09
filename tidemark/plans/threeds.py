"""Authentication funnel: one row per authentication request of a card payment.

Two dozen satellite tables hang on the request table.  They are first cut down to the
window's requests and authentications, then joined among themselves by the
authentication they belong to, so that the large side is shuffled once by request and
once by authentication, whatever the number of satellites.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.functions.codes import AUTH_REASON_RANGES, AUTH_REASONS, PROCESSOR_IDS
from tidemark.functions.jsonops import text_at
from tidemark.functions.temporal import ntz
from tidemark.functions.text import code_map, url_host
from tidemark.operators.loads import rebuild_trailing
from tidemark.operators.lookup import near
from tidemark.operators.running import group_count
from tidemark.sinks.tables import parked

Tables = Mapping[str, DataFrame]


def reason_text(code: Column | str) -> Column:
    """Text of an authentication reason code; unknown and non-numeric codes give UNKNOWN."""
    c = F.col(code) if isinstance(code, str) else code
    number = c.try_cast("int")
    wide = F.lit(None).cast("string")
    for low, high, text in reversed(AUTH_REASON_RANGES):
        wide = F.when(number.between(low, high), text).otherwise(wide)
    return F.coalesce(code_map(c, AUTH_REASONS), wide, F.lit("UNKNOWN"))


def _requests(t: Tables, since: Column) -> DataFrame:
    """Requests of the window that say something about authentication, with the parts that are read."""
    parts = F.json_tuple("request_data", "skip3ds", "initialRiskChecks", "processorId", "processorName", "threeDsVersion")
    raw = t["payments_auth_requests"].filter(F.col("created_at") > since).select(
        "payment_id", "auth_request_id", "payment_attempt_reference_id", "request_data",
        F.col("created_at").alias("auth_request_created_at"),
        parts.alias("skip_flag", "checks", "processor_id", "processor_name", "version"))
    raw = raw.filter(F.col("skip_flag").isNotNull() | F.col("checks").isNotNull())
    action = text_at("checks", "action", "name")
    counted = group_count(raw, ["payment_attempt_reference_id"], "attempts")
    return counted.withColumn("skips", F.coalesce((action != "threeds").cast("string"), "skip_flag")).drop("checks")


def _newest_links(links: DataFrame, since: Column) -> DataFrame:
    """Links from a request to its authentication: the newest of the window, ties kept.

    A request without a link in the window keeps all its older ones.
    """
    newest_first = F.when(F.col("created_at") > since, F.col("created_at")).desc_nulls_last()
    rank = F.rank().over(Window.partitionBy("auth_request_id").orderBy(newest_first))
    return links.withColumn("__rk", rank).filter("__rk = 1").select("auth_request_id", "threeds_id")


def _answered(requests: DataFrame, responses: DataFrame, key: str) -> DataFrame:
    """Requests with their response, which names the request's ``id`` in column ``key``."""
    wanted = requests.withColumnRenamed("id", key)
    return wanted.join(near(responses, wanted, key).withColumn("__answered", F.lit(True)), key, "left")


def _first_flow(t: Tables, requests: DataFrame) -> DataFrame:
    """What the plug-in of the first flow recorded, by request."""
    links = near(t["auth_request_enrollments"], requests, "auth_request_id").withColumnRenamed("mpi_enrollments_id", "id")
    enrolled = _answered(links, t["mpi_enrollments"].withColumnRenamed("id", "link"), "link")
    links = near(t["auth_request_validations"], requests, "auth_request_id").withColumnRenamed("mpi_authentication_validation_id", "id")
    validated = _answered(links, t["mpi_validations"].withColumnRenamed("id", "link"), "link")
    return enrolled.select("auth_request_id", "mpi_provider", "is_enrolled", "enrollment_res").join(
        validated.select("auth_request_id", "three_d_result", F.col("eci").alias("mpi_eci")), "auth_request_id", "full_outer")


def _legacy(t: Tables, ids: DataFrame) -> DataFrame:
    """Everything the older service knows of some authentications."""
    def of_ids(name: str) -> DataFrame:
        return near(t[name], ids, "threeds_id")

    pareq = _answered(of_ids("create_pareq_requests"), t["create_pareq_responses"], "create_pareq_request_id").select(
        "threeds_id", F.col("threeds_provider").alias("pareq_provider"), F.col("enrollment").alias("pareq_enrollment"),
        F.col("errors").alias("pareq_errors"))
    pares = _answered(of_ids("pares_validation_requests"), t["pares_validation_responses"], "pares_validation_requests_id").select(
        "threeds_id", F.col("status").alias("pares_status"), F.col("eci").alias("pares_eci"))
    asked = of_ids("threeds_versioning_requests").withColumnRenamed("version_request_id", "id")
    asked = asked.join(near(t["versioning_requests"], asked, "id"), "id", "left")
    versions = _answered(asked, t["versioning_responses"], "versioning_requests_id").select(
        "threeds_id", F.col("threeds_provider").alias("version_provider"), F.col("__answered").alias("versioned"),
        F.col("errors").alias("version_errors"))
    answers = _answered(of_ids("authentication_requests"), t["authentication_responses"], "authentication_requests_id").select(
        "threeds_id", F.col("status").alias("answer_status"), F.col("eci").alias("answer_eci"),
        F.col("errors").alias("answer_errors"), text_at("raw_response", "acsURL").alias("answer_acs_url"),
        text_at("raw_response", "authenticationResponse", "transStatusReason").alias("answer_reason"))
    results = of_ids("results").select("threeds_id", F.col("status").alias("result_status"), F.col("eci").alias("result_eci"),
                                       F.col("errors").alias("result_errors"))
    base = near(t["threeds"].withColumnRenamed("id", "threeds_id"), ids, "threeds_id").select(
        "threeds_id", F.col("amount").alias("old_amount"), F.col("currency_code").alias("old_currency"),
        F.col("card_scheme").alias("old_scheme"), F.col("mid_key").alias("old_mid"),
        F.col("credit_card_id").alias("old_card"))
    for part in (pareq, pares, versions, answers, results):
        base = base.join(part, "threeds_id", "left")
    return base


def _modern(t: Tables, ids: DataFrame) -> DataFrame:
    """Everything the newer service knows of some authentications."""
    base = near(t["initialized_threeds"].withColumnRenamed("id", "threeds_id"), ids, "threeds_id").select(
        "threeds_id", F.lit(True).alias("is_new"), F.col("amount").alias("new_amount"),
        F.col("currency_code").alias("new_currency"), F.col("scheme").alias("new_scheme"),
        F.col("merchant_name").alias("new_mid"), F.col("credit_card_id").alias("new_card"),
        F.col("version").cast("string").alias("new_version"))
    outcome = near(t["authorization_result"], ids, "threeds_id").select(
        "threeds_id", F.col("enrollment_status").alias("new_enrollment"), F.col("errors").alias("new_errors"),
        F.col("acs_url").alias("new_acs_url"), "cascaded_to_v1")
    verified = near(t["verified_threeds"], ids, "threeds_id").select(
        "threeds_id", F.col("threeds_status").alias("new_status"), F.col("eci").cast("string").alias("new_eci"))
    return base.join(outcome, "threeds_id", "left").join(verified, "threeds_id", "left")


def _starts(version: Column, digit: str) -> Column:
    return F.coalesce(F.left(version, F.lit(1)) == digit, F.lit(False))


def _spread(key: str) -> Column:
    return F.xxhash64(F.col(key).cast("string"))


def authentication_funnel(t: Tables, since: object) -> DataFrame:
    """The funnel for requests created after ``since``.

    Several challenges of one authentication do not multiply its row.
    """
    low = ntz(since)
    window = parked(t["payments_auth_requests"].filter(F.col("created_at") > low).select("auth_request_id"))
    links = parked(_newest_links(near(t["auth_request_threeds"], window, "auth_request_id"), low))
    routed = near(t["auth_request_proc_requests"], window, "auth_request_id").select("auth_request_id", "proc_request_id")
    linked = (
        _requests(t, low)
        .join(_first_flow(t, window), "auth_request_id", "left").join(routed, "auth_request_id", "left")
        .join(links, "auth_request_id", "left")
    )
    # requests without an authentication have no outcome to look for; they are spread by their own id, as they would meet in one task
    r = linked.withColumn("__spread", F.when(F.col("threeds_id").isNotNull(), _spread("threeds_id")).otherwise(_spread("auth_request_id")))
    for service in (_modern(t, links), _legacy(t, links)):
        outcomes = service.filter("threeds_id is not null").withColumn("__spread", _spread("threeds_id"))
        r = r.join(outcomes, ["threeds_id", "__spread"], "left")
    version = F.col("version")
    no_version = F.coalesce((version == "0"), F.lit(False)) | version.isNull()
    v1, v2 = _starts(version, "1"), _starts(version, "2")
    runs = F.coalesce(F.col("skips") == "false", F.lit(False))
    not_versioned = ~F.coalesce(F.col("versioned"), F.lit(False))

    flow = (
        F.when(F.col("cascaded_to_v1").isNotNull(), "3DS 1.0")
        .when(no_version & runs, "S2S")
        .when(v1 | (F.col("new_version") == "1"), "3DS 1.0")
        .when(v2 | (F.col("new_version") == "2"), "3DS 2.0")
        .when(runs, "other"))
    provider = F.when(F.col("is_new"), "safecharge").otherwise(
        F.coalesce("version_provider", "pareq_provider", "mpi_provider"))
    enrolled = (
        F.when(F.col("new_enrollment") == "Y", True)
        .when(no_version, F.col("is_enrolled"))
        .when(v1 & (F.col("pareq_enrollment") == "Y"), True)
        .when(v1 & F.col("pareq_enrollment").isin("N", "U"), False)
        .when(v2, ~(not_versioned | F.col("version_errors").isNotNull())))
    enrollment_errors = F.coalesce(F.coalesce("new_errors", "pareq_errors") != "[]", F.lit(False)) | (v2 & not_versioned)
    outcome = (
        F.when(v2, F.coalesce("new_status", "result_status", "answer_status"))
        .when(v1, F.coalesce("new_status", "pares_status"))
        .otherwise(F.col("three_d_result")))
    old_eci = F.when(v2, F.coalesce("result_eci", "answer_eci")).when(v1, F.col("pares_eci")).otherwise(F.col("mpi_eci"))
    eci = F.coalesce("new_eci", F.replace(old_eci, F.lit("0"), F.lit("")))
    new_failed = F.coalesce(text_at("new_errors", "status") != "SUCCESS", F.lit(False))
    errors = (
        F.when(new_failed, F.col("new_errors"))
        .when(F.col("pareq_errors") == "[]", F.lit(None))
        .otherwise(F.coalesce("pareq_errors", "result_errors", "answer_errors")))
    by_id = code_map("processor_id", {str(n): name for name, n in PROCESSOR_IDS.items()})

    return r.select(
        "auth_request_id", "payment_attempt_reference_id", "payment_id",
        F.coalesce("new_amount", "old_amount").alias("total_amount"),
        F.coalesce("new_currency", "old_currency").alias("currency"),
        F.coalesce("new_scheme", "old_scheme").alias("card_scheme"),
        F.coalesce("processor_name", by_id, "processor_id").alias("processor"),
        provider.alias("threeds_provider"),
        F.coalesce(url_host("new_acs_url"), url_host("answer_acs_url")).alias("threeds_issuer"),
        F.coalesce("new_mid", "old_mid").alias("mid"), F.coalesce("new_card", "old_card").alias("credit_card_id"),
        "auth_request_created_at",
        F.when(F.coalesce(F.col("skip_flag") != "true", F.lit(True)), flow).alias("flow"),
        enrolled.alias("is_enrolled"),
        F.coalesce("new_enrollment", "pareq_enrollment", "enrollment_res").alias("enrollment_result"),
        enrollment_errors.alias("enrollment_errors"), outcome.alias("threeds_validation_result"),
        reason_text("answer_reason").alias("reason"), F.concat(F.lit("0"), eci).alias("eci"),
        (F.col("new_acs_url").isNotNull() | F.coalesce(F.col("answer_status") == "C", F.lit(False)))
        .alias("was_challenge_requested"),
        (F.col("attempts") > 1).alias("was_cascading_performed"),
        (outcome.isNull() & F.col("proc_request_id").isNotNull()).alias("was_routed_to_non_3ds"),
        errors.alias("validation_errors"), "proc_request_id", "threeds_id", "request_data")


def rebuild_funnel(target: DataFrame, t: Tables, today: str, days: int) -> DataFrame:
    """The funnel table with its last days computed anew; ``today`` is an ISO date."""
    since = date.fromisoformat(today) - timedelta(days=days)
    fresh = authentication_funnel(t, since).select(*target.columns)
    return rebuild_trailing(target, fresh, "auth_request_created_at", today, days)
