"""Text, number, time and JSON functions, and personal data, over the given tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.registry import register, table
from tidemark.functions import jsonops, pii, temporal
from tidemark.functions.text import concat_skip_null, display_amount, display_percent, strip_chars, trim_fraction, url_host
from tidemark.operators.lookup import ip_place, network_place, range_lookup

PEPPER, SALT = "pepper", "salt"


@register("text_functions", """
SELECT c_custkey, left(c_name, 4) AS head, right(c_name, 4) AS tail, lower(c_mktsegment) AS low, upper(c_name) AS up,
  length(c_name) AS len, concat('a ', CASE WHEN c_custkey % 2 = 0 THEN c_name END, ' z') AS joined,
  replace(replace(replace(c_name, '#', ''), '0', ''), 'C', '') AS cleaned, substring(c_name, 10, 6) AS part
FROM customer""")
def text_functions(spark: SparkSession, sf: str) -> DataFrame:
    name = F.col("c_name")
    return table(spark, sf, "customer").select(
        "c_custkey", F.left(name, F.lit(4)).alias("head"), F.right(name, F.lit(4)).alias("tail"),
        F.lower("c_mktsegment").alias("low"), F.upper(name).alias("up"), F.length(name).cast("bigint").alias("len"),
        concat_skip_null(F.lit("a "), F.when(F.col("c_custkey") % 2 == 0, name), F.lit(" z")).alias("joined"),
        strip_chars(name, "#0C").alias("cleaned"), F.substring(name, 10, 6).alias("part"))


@register("url_hosts", """
SELECT page_id, nullif(regexp_extract(url, '/([^/]+)', 1), '') AS host, regexp_replace(url, '[-.]', '', 'g') AS squeezed FROM pages""")
def url_hosts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", url_host("url").alias("host"),
                                            F.regexp_replace("url", "[-.]", "").alias("squeezed"))


@register("trim_fraction", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'no fraction' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') || '.' || left(strftime(ts, '%f'), 3) END AS trimmed FROM events""")
def trim_fractions(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("event_id") % 3 == 0, "no fraction").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return table(spark, sf, "events").select("event_id", trim_fraction(text).alias("trimmed"))


@register("time_functions", """
SELECT event_id, date_trunc('hour', ts) AS hour_at, strftime(ts, '%Y-%m-%d') AS day_text, extract(isodow FROM ts) AS weekday,
  lpad(CAST(CAST(floor(extract(minute FROM ts) / 15) AS INTEGER) * 15 AS VARCHAR), 2, '0') AS quarter, strftime(ts, '%H') AS hour,
  CAST(ts + INTERVAL 8 DAY AS DATE) AS due, date_sub('day', TIMESTAMP '2023-12-31 11:22:33', ts) AS age,
  CAST(date_trunc('month', ts) AS DATE) AS month
FROM events""")
def time_functions(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id", temporal.trunc_ntz("hour", t).alias("hour_at"), F.date_format(t, "yyyy-MM-dd").alias("day_text"),
        temporal.iso_weekday(t).alias("weekday"), temporal.quarter_hour(t).alias("quarter"),
        temporal.hour_text(t).alias("hour"), (t + F.expr("interval 8 day")).cast("date").alias("due"),
        temporal.whole_days(t, temporal.ntz("2023-12-31 11:22:33")).alias("age"), F.trunc(t.cast("date"), "month").alias("month"))


@register("epoch_functions", """
SELECT event_id, strftime(make_timestamp((1700000000 + event_id * 977) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS iso,
  strftime(make_timestamp((1600000000 + event_id * 31) * 1000000), '%Y-%m-%d %H:%M:%S') AS text, epoch_us(ts) AS micros FROM events""")
def epoch_functions(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    return table(spark, sf, "events").select(
        "event_id", temporal.epoch_ms_to_iso((F.lit(1700000000) + k * 977) * 1000 + 123).alias("iso"),
        temporal.epoch_s_to_text(F.lit(1600000000) + k * 31).alias("text"), temporal.epoch_micros("ts").alias("micros"))


@register("number_functions", """
SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 0 ELSE round(100 * CAST(p_retailprice AS DECIMAL(18,2)) / 7, 2)::DOUBLE END AS pct,
  CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS price, format('{:,}', CAST(round_even(p_retailprice * 10, 0) AS BIGINT)) AS shown,
  CAST(p_size AS VARCHAR) || '%' AS share FROM part""")
def number_functions(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("p_retailprice").cast("decimal(18,2)")
    pct = F.when(F.col("p_size") % 5 == 0, F.lit(0.0)).otherwise(F.round(price * 100 / 7, 2).cast("double"))
    return table(spark, sf, "part").select(
        "p_partkey", pct.alias("pct"), F.col("p_retailprice").cast("decimal(10,2)").cast("double").alias("price"),
        display_amount(F.rint(F.col("p_retailprice") * 10)).alias("shown"), display_percent("p_size").alias("share"))


@register("casts", """
SELECT event_id, CAST(event_id AS VARCHAR) AS as_text, CAST(value AS INTEGER) AS rounded, TRY_CAST(CASE WHEN event_id % 2 = 0 THEN event_type ELSE CAST(user_id AS VARCHAR) END AS BIGINT) AS number,
  CAST(ts AS DATE) AS day, CAST(CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS BOOLEAN) AS flag FROM events""")
def casts(spark: SparkSession, sf: str) -> DataFrame:
    even = F.col("event_id") % 2 == 0
    return table(spark, sf, "events").select(
        "event_id", F.col("event_id").cast("string").alias("as_text"), F.bround("value", 0).cast("int").alias("rounded"),
        F.when(even, F.col("event_type")).otherwise(F.col("user_id").cast("string")).try_cast("bigint").alias("number"),
        F.to_date("ts").alias("day"), F.when(even, "true").otherwise("false").cast("boolean").alias("flag"))


@register("conditional_functions", """
SELECT event_id, coalesce(CASE WHEN event_id % 3 = 0 THEN event_type END, CASE WHEN event_id % 2 = 0 THEN 'even' END, 'rest') AS first_known,
  nullif(event_type, 'click') AS not_click, CASE WHEN event_type = 'error' THEN NULL ELSE event_id % 2 = 0 END AS even FROM events""")
def conditional_functions(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    return table(spark, sf, "events").select(
        "event_id",
        F.coalesce(F.when(k % 3 == 0, F.col("event_type")), F.when(k % 2 == 0, "even"), F.lit("rest")).alias("first_known"),
        F.nullif("event_type", F.lit("click")).alias("not_click"),
        F.when(F.col("event_type") != "error", k % 2 == 0).alias("even"))


# --- JSON -----------------------------------------------------------------------------

_BODY = """'{"ip":"10.' || (event_id % 200) || '.3.4","user":{"name":"u' || user_id || '","address":{"zip":"' || event_id ||
  '","city":"X"}},"primary.phone":"555' || event_id || '","n":' || event_id || ',"list":[1,2,{"a":null}]}'"""


def bodies(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "user_id", F.expr(_BODY).alias("body"))


@register("json_read", f"""
WITH b AS (SELECT event_id, {_BODY} AS body FROM events)
SELECT event_id, json_extract_string(body, '$.user.address.zip') AS zip, json_extract_string(body, '$."primary.phone"') AS phone,
  json_extract_string(body, '$.list[1]') AS second, CAST(json_extract_string(body, '$.n') AS BIGINT) AS n,
  CAST(NULL AS VARCHAR) AS missing FROM b""")
def json_read(spark: SparkSession, sf: str) -> DataFrame:
    return bodies(spark, sf).select(
        "event_id", jsonops.text_at("body", "user", "address", "zip").alias("zip"),
        jsonops.text_at("body", "primary.phone").alias("phone"), jsonops.text_at("body", "list", 1).alias("second"),
        jsonops.text_at("body", "n").cast("bigint").alias("n"), jsonops.first_text("body", "no", "No one").alias("missing"))


@register("json_drop_keys", """
SELECT event_id, '{"list":[1,2,{"a":null}],"n":' || event_id || ',"user":{"address":{"city":"X","zip":"' || event_id || '"},"name":"u' || user_id || '"}}' AS body FROM events""")
def json_drop_keys(spark: SparkSession, sf: str) -> DataFrame:
    return bodies(spark, sf).select("event_id", jsonops.drop_keys("body", "ip", "primary.phone", "absent").alias("body"))


@register("json_drop_paths", """
SELECT event_id, '{"list":[1,2,{"a":null}],"n":' || event_id || ',"primary.phone":"555' || event_id || '","user":{"address":{"city":"X"}}}' AS body FROM events""")
def json_drop_paths(spark: SparkSession, sf: str) -> DataFrame:
    edited = jsonops.drop_paths("body", [["ip"], ["user", "name"], ["user", "address", "zip"], ["user", "absent", "x"]])
    return bodies(spark, sf).select("event_id", edited.alias("body"))


@register("json_overlay", """
SELECT event_id, '{"ip":"FR","list":[1,2,{"a":null}],"n":' || event_id || ',"primary.phone":null,"user":{"address":{"city":"Y","zip":"'
  || event_id || '"},"name":"u' || user_id || '"}}' AS body FROM events""")
def json_overlay(spark: SparkSession, sf: str) -> DataFrame:
    edited = jsonops.edit("body", over={"ip": F.lit("FR"), "primary.phone": F.lit(None).cast("string")},
                          put={("user", "address", "city"): F.lit('"Y"')})
    return bodies(spark, sf).select("event_id", edited.alias("body"))


@register("json_build", """
SELECT event_id, '{"country":"' || event_type || '","state":null}' AS body FROM events""")
def json_build(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", jsonops.build({"country": F.col("event_type"), "state": F.lit(None).cast("string")}).alias("body"))


# --- personal data --------------------------------------------------------------------

@register("pseudonymise_emails", f"""
WITH found AS (SELECT doc_id, nullif(regexp_extract(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+'), '') AS mail FROM documents)
SELECT doc_id, CASE WHEN contains(mail, '@') THEN sha256(mail || '{PEPPER}') ELSE mail END AS token,
  CASE WHEN contains(mail, '@') THEN sha256(sha256('{SALT}') || mail || '{PEPPER}') ELSE mail END AS salted FROM found""")
def pseudonymise_emails(spark: SparkSession, sf: str) -> DataFrame:
    mail = F.regexp_extract("text", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+", 0)
    d = table(spark, sf, "documents").select("doc_id", F.nullif(mail, F.lit("")).alias("mail"))
    return d.select("doc_id", pii.pseudonymise("mail", PEPPER).alias("token"),
                    pii.pseudonymise("mail", PEPPER, SALT).alias("salted"))


@register("pseudonymise_columns", f"""
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN 'none' ELSE sha256('u' || user_id || '@x.org{PEPPER}') END AS email,
  CASE WHEN event_id % 2 = 0 THEN '{{"a":{{"b":"' || sha256('o''' || user_id || '@y.org{PEPPER}') || '"}}}}' ELSE '{{"a":1}}' END AS body FROM events""")
def pseudonymise_columns(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select(
        "event_id",
        F.expr("CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN 'none' ELSE 'u' || user_id || '@x.org' END").alias("email"),
        F.expr("""CASE WHEN event_id % 2 = 0 THEN '{"a":{"b":"o\\'' || user_id || '@y.org"}}' ELSE '{"a":1}' END""").alias("body"))
    return pii.pseudonymise_columns(e, "email, body->a->b", PEPPER)


@register("pseudonymise_json_escaped", f"""
SELECT event_id, sha256('m' || user_id || '@y.org{PEPPER}') AS mail, 'xm' || user_id || '@y.org.uk' AS other FROM events""")
def pseudonymise_json_escaped(spark: SparkSession, sf: str) -> DataFrame:
    """An address written with an escape is found; another text that holds its letters is left."""
    body = """concat('{"a":{"b":"m', user_id, '\\\\u0040y.org"},"c":"xm', user_id, '@y.org.uk"}')"""
    e = table(spark, sf, "events").select("event_id", F.expr(body).alias("body"))
    done = pii.pseudonymise_columns(e, "body->a->b", PEPPER)
    return done.select("event_id", jsonops.text_at("body", "a", "b").alias("mail"), jsonops.text_at("body", "c").alias("other"))


@register("json_repeated_keys", "SELECT event_id, CAST(event_id AS VARCHAR) AS b, user_id::VARCHAR AS a FROM events")
def json_repeated_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Of a repeated key the last value stays; the text is not lost."""
    spark.conf.set(jsonops.REPEATED_KEYS, "true")
    body = F.expr("""concat('{"a":1,"ip":2,"a":', user_id, ',"b":', event_id, '}')""")
    kept = table(spark, sf, "events").select("event_id", jsonops.drop_keys(body, "ip").alias("body"))
    return kept.select("event_id", jsonops.text_at("body", "b").alias("b"), jsonops.text_at("body", "a").alias("a"))


@register("token_map", f"""
WITH mails AS (SELECT DISTINCT 'u' || user_id || '@x.org' AS email FROM events)
SELECT email, sha256(email || '{PEPPER}') AS token FROM mails WHERE CAST(substr(email, 2, strpos(email, '@') - 2) AS BIGINT) % 3 <> 0""")
def token_map(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select(F.expr("'u' || user_id || '@x.org'").alias("email"), "user_id")
    stored = e.filter("user_id % 3 = 0").select("email", F.lit("kept").alias("token")).distinct()
    return pii.new_tokens(stored, e, "email", PEPPER)


@register("apply_tokens", """
SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 't' || user_id ELSE 'u' || user_id || '@x.org' END AS email FROM events""")
def apply_tokens(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", F.expr("'u' || user_id || '@x.org'").alias("email"), "user_id")
    stored = e.filter("user_id % 3 = 0").select("email", F.expr("'t' || user_id").alias("token")).distinct()
    return pii.apply_tokens(e.drop("user_id"), stored, "email")


@register("stored_token_map", f"""
WITH mails AS (SELECT DISTINCT 'u' || user_id || '@x.org' AS email, user_id FROM events)
SELECT email, CASE WHEN user_id % 3 = 0 THEN 'kept' ELSE sha256(email || CASE WHEN user_id % 2 = 0 THEN 'first' ELSE '{PEPPER}' END) END AS token FROM mails""")
def stored_token_map(spark: SparkSession, sf: str) -> DataFrame:
    """A stored map extended by two batches; whoever was there first keeps the token."""
    e = table(spark, sf, "events").select(F.expr("'u' || user_id || '@x.org'").alias("email"), "user_id")
    name = f"tokens_{uuid.uuid4().hex}"
    pii.store_tokens(e.filter("user_id % 3 = 0").select("email", F.lit("kept").alias("token")).distinct(), name, 16)
    pii.extend_stored_map(e.filter("user_id % 2 = 0"), "email", name, "first", buckets=16)
    return pii.extend_stored_map(e, "email", name, PEPPER, buckets=16)


@register("email_check", """
WITH m AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'no mail' WHEN 3 THEN 'a.b+' || user_id || '@x-y.org' ELSE 'a@b c' END AS mail FROM events)
SELECT event_id, coalesce(mail = '' OR regexp_full_match(mail, '\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\b'), false) AS valid FROM m""")
def email_check(spark: SparkSession, sf: str) -> DataFrame:
    mail = F.expr("CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'no mail' "
                  "WHEN 3 THEN 'a.b+' || user_id || '@x-y.org' ELSE 'a@b c' END")
    return table(spark, sf, "events").select("event_id", pii.is_email(mail).alias("valid"))


@register("masks", """
SELECT o_orderkey, left(o_orderpriority, 3) || repeat('*', length(o_orderpriority) - 3) AS kept3, repeat('*', length(o_orderpriority)) AS hidden,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(date_trunc('year', o_orderdate) AS DATE) END AS year_start,
  sha256(o_orderpriority) AS hashed FROM orders""")
def masks(spark: SparkSession, sf: str) -> DataFrame:
    day = F.when(F.col("o_orderkey") % 4 == 0, "junk").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    return table(spark, sf, "orders").select(
        "o_orderkey", pii.mask_text("o_orderpriority", 3).alias("kept3"), pii.mask_text("o_orderpriority").alias("hidden"),
        pii.mask_date(day, "dd/MM/yyyy").alias("year_start"), pii.hash_text("o_orderpriority").alias("hashed"))


@register("ip_places", """
WITH seen AS (SELECT event_id, user_id * 26544 + event_id % 97 AS n FROM events),
ranges AS (SELECT s_suppkey * 40000 AS lo, s_suppkey * 40000 + 30000 AS hi,
  'C' || s_nationkey AS country, 'S' || s_suppkey AS state FROM supplier)
SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE country END AS country, CASE WHEN event_id % 11 = 0 THEN NULL ELSE state END AS state
FROM seen LEFT JOIN ranges ON n BETWEEN lo AND hi""")
def ip_places(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", (F.col("user_id") * 26544 + F.col("event_id") % 97).alias("n"))
    octets = [F.shiftright("n", k).bitwiseAND(F.lit(255)).cast("string") for k in (24, 16, 8, 0)]
    ips = e.select("event_id", F.when(F.col("event_id") % 11 == 0, "::1").otherwise(F.concat_ws(".", *octets)).alias("ip"))
    s = table(spark, sf, "supplier")
    low = F.col("s_suppkey") * 40000
    ranges = s.select(low.alias("lo"), (low + 30000).alias("hi"),
                      F.concat(F.lit("C"), F.col("s_nationkey").cast("string")).alias("country"),
                      F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("state"))
    return ip_place(ips, "ip", ranges, ["country", "state"]).drop("ip")


@register("ip_places_both_families", """
WITH a AS (SELECT event_id, user_id % 200 AS x, event_id % 7 AS y, event_id % 5 AS kind FROM events), s AS (SELECT s_suppkey AS k FROM supplier WHERE s_suppkey < 200)
SELECT event_id, CASE kind WHEN 4 THEN NULL WHEN 3 THEN CASE WHEN k IS NOT NULL THEN 'four-' || k WHEN x < 128 THEN 'four-low' END
  ELSE CASE WHEN k IS NOT NULL AND y = 3 THEN 'six-' || k || '-3' WHEN k IS NOT NULL THEN 'six-' || k ELSE 'six-all' END END AS place
FROM a LEFT JOIN s ON k = x""")
def ip_places_both_families(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses in several spellings, networks of several lengths within each other."""
    x, y, n = F.col("user_id") % 200, F.col("event_id") % 7, F.col("event_id")
    group = F.lower(F.hex(x))
    kind = F.col("event_id") % 5
    long = F.concat_ws(":", F.lit("2001:0DB8"), F.lpad(group, 4, "0"), F.lower(F.hex(y)), F.lit("0:0:0"), F.lower(F.hex(n % 65536)))
    short = F.concat(F.lit("2001:db8:"), group, F.lit(":"), F.hex(y), F.lit("::"), F.hex(n % 65535 + 1))
    dotted = F.concat(F.lit("2001:db8:"), group, F.lit(":"), F.hex(y), F.lit("::9.8.7.6"))
    four = F.concat(F.when(n % 2 == 0, "::ffff:").otherwise(""), F.lit("10."), x.cast("string"), F.lit("."), y.cast("string"), F.lit(".1"))
    ip = F.when(kind == 0, long).when(kind == 1, short).when(kind == 2, dotted).when(kind == 3, four).otherwise("1::2::3")
    e = table(spark, sf, "events").select("event_id", ip.alias("ip"))
    s = table(spark, sf, "supplier").filter("s_suppkey < 200").select("s_suppkey", F.lower(F.hex("s_suppkey")).alias("g"))
    name, rows = F.col("s_suppkey").cast("string"), []
    for network, place in ((F.concat(F.lit("2001:db8:"), "g", F.lit("::/48")), F.concat(F.lit("six-"), name)),
                           (F.concat(F.lit("2001:db8:"), "g", F.lit(":3::/64")), F.concat(F.lit("six-"), name, F.lit("-3"))),
                           (F.concat(F.lit("10."), name, F.lit(".0.0/16")), F.concat(F.lit("four-"), name))):
        rows.append(s.select(network.alias("network"), place.alias("place")))
    wide = spark.createDataFrame([("2001:db8::/32", "six-all"), ("10.0.0.0/9", "four-low"), ("nonsense/8", "x"), ("10.0.0.0/99", "x")], "network string, place string")
    return network_place(e, "ip", reduce(DataFrame.unionByName, rows, wide), ["place"]).drop("ip")


@register("range_lookup", """
WITH ranges AS (SELECT s_suppkey * 40 AS lo, s_suppkey * 40 + 30 AS hi, s_name AS name FROM supplier)
SELECT o_orderkey, name FROM orders LEFT JOIN ranges ON o_custkey BETWEEN lo AND hi""")
def range_of_customer(spark: SparkSession, sf: str) -> DataFrame:
    low = F.col("s_suppkey") * 40
    ranges = table(spark, sf, "supplier").select(low.alias("lo"), (low + 30).alias("hi"), F.col("s_name").alias("name"))
    return range_lookup(table(spark, sf, "orders"), "o_custkey", ranges).select("o_orderkey", "name")
