"""Projections, predicates, aggregates, rankings, joins and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.registry import register, table
from tidemark.functions.codes import AUTH_REASON_RANGES, AUTH_REASONS, EXPLORERS
from tidemark.functions.jsonops import is_json_null, present, text_at
from tidemark.functions.temporal import ntz
from tidemark.functions.text import code_map
from tidemark.operators.latest import at_max_per_group, first_per_key, latest_per_key
from tidemark.operators.lookup import salted_join
from tidemark.operators.running import global_row_number, group_count, running_share, running_totals, with_group_values, with_total_row

# --- projections and predicates -------------------------------------------------------


@register("projection_rename", """
SELECT o_orderkey AS "Payment_ID__c", o_orderstatus AS "Status__c", o_totalprice AS "Amount__c" FROM orders""")
def projection_rename(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Payment_ID__c"), F.col("o_orderstatus").alias("Status__c"),
        F.col("o_totalprice").alias("Amount__c"))


_REASON_VALUES = ", ".join(f"('{k}', '{v}')" for k, v in AUTH_REASONS.items())
_RANGE_ARMS = " ".join(
    f"WHEN TRY_CAST(code AS INTEGER) BETWEEN {a} AND {b} THEN '{text}'" for a, b, text in AUTH_REASON_RANGES)


@register("reason_text", f"""
WITH coded AS (SELECT event_id, CASE WHEN event_id % 101 = 100 THEN 'x1' ELSE lpad(CAST(event_id % 101 AS VARCHAR), 2, '0') END AS code
               FROM events),
reasons(code, reason) AS (VALUES {_REASON_VALUES})
SELECT event_id, coded.code, CASE WHEN reason IS NOT NULL THEN reason {_RANGE_ARMS.replace("code AS", "coded.code AS")}
  ELSE 'UNKNOWN' END AS reason FROM coded LEFT JOIN reasons ON coded.code = reasons.code""")
def reason_text_of_events(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.plans.threeds import reason_text
    code = F.when(F.col("event_id") % 101 == 100, F.lit("x1")).otherwise(
        F.lpad((F.col("event_id") % 101).cast("string"), 2, "0"))
    return table(spark, sf, "events").select("event_id", code.alias("code")).withColumn("reason", reason_text("code"))


@register("precedence_chain", """
SELECT d.doc_id, coalesce(l.quality, l.toxic, -1) AS grade, CASE WHEN l.doc_id IS NULL THEN 'unlabelled' ELSE 'labelled' END AS state
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def precedence_chain(spark: SparkSession, sf: str) -> DataFrame:
    d, lab = table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels")
    j = d.join(lab, d.doc_id == lab.doc_id, "left")
    return j.select(d.doc_id, F.coalesce("quality", "toxic", F.lit(-1)).alias("grade"),
                    F.when(lab.doc_id.isNull(), "unlabelled").otherwise("labelled").alias("state"))


@register("in_and_not_in", """
SELECT event_id FROM events WHERE event_type IN ('click', 'purchase') AND user_id NOT IN (1, 2, 3) AND event_id != 7""")
def in_and_not_in(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").filter(
        F.col("event_type").isin("click", "purchase") & ~F.col("user_id").isin(1, 2, 3) & (F.col("event_id") != 7)
    ).select("event_id")


@register("like_and_ilike", """
SELECT p_partkey, p_name LIKE 'red%' AS is_red, p_name ILIKE '%RING%' AS is_ring FROM part WHERE p_type LIKE 'S%' OR p_name ILIKE '%widget'""")
def like_and_ilike(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").filter(F.col("p_type").like("S%") | F.col("p_name").ilike("%widget")).select(
        "p_partkey", F.col("p_name").like("red%").alias("is_red"), F.col("p_name").ilike("%RING%").alias("is_ring"))


@register("between_dates", """
SELECT o_orderkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'""")
def between_dates(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").filter(F.col("o_orderdate").between(ntz("1996-01-01"), ntz("1996-12-31"))) \
        .select("o_orderkey")


@register("relative_dates", """
SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-31' - INTERVAL 5 DAY AND ts < TIMESTAMP '2024-01-30 22:00:00' - INTERVAL 24 HOUR""")
def relative_dates(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").filter(
        (F.col("ts") > ntz("2024-01-31") - F.expr("interval 5 day"))
        & (F.col("ts") < ntz("2024-01-30 22:00:00") - F.expr("interval 24 hour"))).select("event_id")


SKIP_JSON = """CASE event_id % 4 WHEN 0 THEN '{"skip":null}' WHEN 1 THEN '{"skip":true,"a b":{"c.d":' || event_id || '}}'
  WHEN 2 THEN '{}' ELSE '{"skip":"x"}' END"""


@register("json_null_and_missing", """
SELECT event_id, event_id % 2 = 1 AS has_value, CASE event_id % 4 WHEN 0 THEN true WHEN 2 THEN NULL ELSE false END AS null_flag,
  CASE WHEN event_id % 4 = 1 THEN CAST(event_id AS VARCHAR) END AS deep_value FROM events""")
def json_null_and_missing(spark: SparkSession, sf: str) -> DataFrame:
    j = table(spark, sf, "events").select("event_id", F.expr(SKIP_JSON).alias("j"))
    return j.select("event_id", present("j", "skip").alias("has_value"), is_json_null("j", "skip").alias("null_flag"),
                    text_at("j", "a b", "c.d").alias("deep_value"))


@register("tuple_in_subquery", """
SELECT o_orderkey, o_custkey FROM orders WHERE (o_orderkey, o_custkey % 7) IN (SELECT l_orderkey, l_suppkey % 7 FROM lineitem WHERE l_returnflag = 'R')""")
def tuple_in_subquery(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", (F.col("o_custkey") % 7).alias("k"))
    li = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey", (F.col("l_suppkey") % 7).alias("k"))
    return o.join(li, (o.o_orderkey == li.l_orderkey) & (o.k == li.k), "left_semi").select("o_orderkey", "o_custkey")


_COINS = list(EXPLORERS)
_COIN_VALUES = ", ".join(f"({i}, '{c}', '{EXPLORERS[c]}')" for i, c in enumerate(_COINS))


@register("constant_relation", f"""
WITH coins(i, coin, prefix_link) AS (VALUES {_COIN_VALUES})
SELECT o_orderkey, coin, prefix_link || o_orderkey AS link FROM orders LEFT JOIN coins ON o_orderkey % 70 = i""")
def constant_relation(spark: SparkSession, sf: str) -> DataFrame:
    by_number = {i: c for i, c in enumerate(_COINS)}
    o = table(spark, sf, "orders").select("o_orderkey", code_map(F.col("o_orderkey") % 70, by_number).alias("coin"))
    return o.withColumn("link", F.concat(code_map("coin", EXPLORERS), F.col("o_orderkey").cast("string")))


# --- aggregates and rankings ----------------------------------------------------------

@register("latest_status", """
SELECT user_id, event_type, ts AS latest_event_time, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1""")
def latest_status(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return latest_per_key(e, ["user_id", "event_type"], ["ts"]).select(
        "user_id", "event_type", F.col("ts").alias("latest_event_time"), "value")


@register("hash_aggregate", """
SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS DOUBLE) AS sum_qty,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price, count(*) AS n, max(l_shipdate) AS last_ship,
  round(avg(l_quantity), 6) AS avg_qty
FROM lineitem GROUP BY 1, 2""")
def hash_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("sum_price"),
        F.count(F.lit(1)).alias("n"), F.max("l_shipdate").alias("last_ship"),
        F.round(F.avg("l_quantity"), 6).alias("avg_qty"))


@register("count_distinct", """
SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY l_returnflag""")
def count_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.countDistinct("l_orderkey").alias("orders"), F.countDistinct("l_suppkey").alias("suppliers"))


@register("conditional_sum", """
SELECT l_suppkey, CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity * 2 WHEN l_returnflag = 'A' THEN 0 ELSE l_quantity END) AS DOUBLE) AS weighted
FROM lineitem GROUP BY l_suppkey""")
def conditional_sum(spark: SparkSession, sf: str) -> DataFrame:
    q = F.col("l_quantity")
    weight = F.when(F.col("l_returnflag") == "R", q * 2).when(F.col("l_returnflag") == "A", 0).otherwise(q)
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.sum(weight).alias("weighted"))


@register("keep_latest", """
SELECT * EXCLUDE (rn) FROM (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def keep_latest(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return latest_per_key(o, "o_custkey", ["o_orderdate", "o_orderkey"])


@register("distinct_on", """
SELECT DISTINCT ON (conv_id) conv_id, turn, role FROM conversations ORDER BY conv_id, turn DESC""")
def distinct_on(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return first_per_key(c, "conv_id", [F.col("turn").desc()])


@register("at_group_maximum", """
SELECT o_orderkey, o.o_custkey, o_orderdate FROM orders o
JOIN (SELECT o_custkey, max(o_orderdate) AS m FROM orders GROUP BY o_custkey) x ON o.o_custkey = x.o_custkey AND o_orderdate = m""")
def at_group_maximum(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return at_max_per_group(o, "o_custkey", "o_orderdate")


@register("group_count", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, count(*) OVER (PARTITION BY l_orderkey) AS lines FROM lineitem""")
def count_in_group(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return group_count(li, ["l_orderkey"], "lines")


@register("running_share", """
WITH daily AS (SELECT l_returnflag, l_shipdate AS day, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS price FROM lineitem GROUP BY 1, 2)
SELECT l_returnflag, day, CAST(price AS DOUBLE) AS price,
  CAST(sum(price) OVER w AS DOUBLE) AS running_total, CAST(sum(price) OVER (PARTITION BY l_returnflag) AS DOUBLE) AS group_total,
  round(CAST(sum(price) OVER w AS DOUBLE) / CAST(sum(price) OVER (PARTITION BY l_returnflag) AS DOUBLE), 8) AS running_ratio
FROM daily WINDOW w AS (PARTITION BY l_returnflag ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def running_share_of_days(spark: SparkSession, sf: str) -> DataFrame:
    daily = table(spark, sf, "lineitem").groupBy("l_returnflag", F.col("l_shipdate").alias("day")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("price"))
    r = running_share(daily, ["l_returnflag"], ["day"], "price")
    return r.select("l_returnflag", "day", *[F.col(c).cast("double").alias(c) for c in
                                             ("price", "running_total", "group_total")],
                    F.round("running_ratio", 8).alias("running_ratio"))


@register("running_totals", """
SELECT o_orderstatus, o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) AS running_total,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_orderstatus) AS DOUBLE) AS group_total
FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def running_totals_of_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Row by row over three groups, each a large part of the table."""
    o = table(spark, sf, "orders").select("o_orderstatus", "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    r = running_totals(o, ["o_orderstatus"], ["o_orderkey"], "price")
    return r.select("o_orderstatus", "o_orderkey", *[F.col(c).cast("double").alias(c) for c in ("running_total", "group_total")])


@register("group_count_few_keys", """
SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, count(*) OVER (PARTITION BY l_returnflag, l_linestatus) AS lines FROM lineitem""")
def group_count_few_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Groups that are all heavy."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return group_count(li, ["l_returnflag", "l_linestatus"], "lines")


@register("global_row_number", """
WITH sums AS (SELECT l_suppkey, l_returnflag, CAST(sum(l_quantity) AS DOUBLE) AS qty FROM lineitem GROUP BY 1, 2)
SELECT row_number() OVER (ORDER BY l_returnflag, l_suppkey) AS record_id, * FROM sums""")
def numbered_result(spark: SparkSession, sf: str) -> DataFrame:
    sums = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.sum("l_quantity").alias("qty"))
    return global_row_number(sums, ["l_returnflag"], [F.col("l_suppkey")], "record_id")


@register("total_row", """
SELECT l_linestatus, CAST(sum(l_quantity) AS DOUBLE) AS qty, count(*) AS n FROM lineitem GROUP BY l_linestatus
UNION SELECT 'Total', CAST(sum(l_quantity) AS DOUBLE), count(*) FROM lineitem""")
def total_row(spark: SparkSession, sf: str) -> DataFrame:
    return with_total_row(table(spark, sf, "lineitem"), "l_linestatus",
                          [F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("n")])


@register("sum_over_distinct", """
SELECT l_partkey, l_shipdate, CAST(sum(amount) AS DOUBLE) AS amount FROM (
  SELECT DISTINCT l_orderkey, l_partkey, l_shipdate, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount FROM lineitem)
GROUP BY 1, 2""")
def sum_over_distinct(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_shipdate", F.col("l_extendedprice").cast("decimal(18,2)").alias("amount")).distinct()
    return d.groupBy("l_partkey", "l_shipdate").agg(F.sum("amount").cast("double").alias("amount"))


# --- joins ----------------------------------------------------------------------------

@register("inner_join_chain", """
SELECT n_name, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def inner_join_chain(spark: SparkSession, sf: str) -> DataFrame:
    o, c, n = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    return (
        o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).groupBy("n_name")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))
    )


@register("left_join_chain", """
SELECT o_orderkey, c_name, n_name, r_name, s_name FROM orders
LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0 LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey < 20
LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN supplier ON s_suppkey = o_custkey""")
def left_join_chain(spark: SparkSession, sf: str) -> DataFrame:
    o, c, n, r, s = (table(spark, sf, t) for t in ("orders", "customer", "nation", "region", "supplier"))
    return (
        o.join(c.filter("c_acctbal > 0"), o.o_custkey == c.c_custkey, "left")
        .join(n.filter("n_nationkey < 20"), c.c_nationkey == n.n_nationkey, "left")
        .join(r, n.n_regionkey == r.r_regionkey, "left").join(s, s.s_suppkey == o.o_custkey, "left")
        .select("o_orderkey", "c_name", "n_name", "r_name", "s_name")
    )


@register("multi_key_left_join", """
WITH a AS (SELECT user_id, event_type, strftime(ts, '%H') AS hour, count(*) AS n FROM events WHERE event_id % 2 = 0 GROUP BY 1, 2, 3),
b AS (SELECT user_id, event_type, strftime(ts, '%H') AS hour, count(*) AS m FROM events WHERE event_id % 2 = 1 GROUP BY 1, 2, 3)
SELECT a.user_id, a.event_type, a.hour, n, m FROM a LEFT JOIN b ON a.user_id = b.user_id AND a.event_type = b.event_type AND a.hour = b.hour""")
def multi_key_left_join(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumn("hour", F.date_format("ts", "HH"))
    keys = ["user_id", "event_type", "hour"]
    a = e.filter("event_id % 2 = 0").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    b = e.filter("event_id % 2 = 1").groupBy(*keys).agg(F.count(F.lit(1)).alias("m"))
    return a.join(b, keys, "left")


@register("join_on_expressions", """
WITH keyed AS (SELECT event_id, event_type, CAST(ts AS DATE) AS day, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
firsts AS (SELECT day, k, min(event_id) AS first_purchase FROM keyed WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT event_id, first_purchase FROM keyed LEFT JOIN firsts ON keyed.day = firsts.day AND keyed.k = firsts.k WHERE event_type = 'click'""")
def join_on_expressions(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    key = [F.to_date("ts").alias("day"), text_at("props", "k").cast("bigint").alias("k")]
    firsts = e.filter("event_type = 'purchase'").groupBy(*key).agg(F.min("event_id").alias("first_purchase"))
    return e.filter("event_type = 'click'").select("event_id", *key).join(firsts, ["day", "k"], "left") \
        .select("event_id", "first_purchase")


@register("join_with_validity_dates", """
WITH shares AS (SELECT p_brand AS brand, p_size % 3 AS grade, min(p_retailprice) / 10000 AS share, DATE '1996-01-01' AS start_date,
                DATE '1998-12-31' AS end_date FROM part WHERE p_size < 40 GROUP BY 1, 2)
SELECT p_partkey, coalesce(share, 0.0205::DOUBLE) AS share FROM part LEFT JOIN shares
  ON p_brand = brand AND p_size % 3 = grade AND (start_date > DATE '1997-06-01' + (p_size || ' days')::INTERVAL OR end_date >= DATE '1997-06-01' + (p_size * 20 || ' days')::INTERVAL)""")
def join_with_validity_dates(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").withColumn("grade", F.col("p_size") % 3)
    shares = p.filter("p_size < 40").groupBy(F.col("p_brand").alias("brand"), F.col("grade").alias("g")).agg(
        (F.min("p_retailprice") / 10000).alias("share")).withColumns(
        {"start_date": F.lit("1996-01-01").cast("date"), "end_date": F.lit("1998-12-31").cast("date")})
    base = F.lit("1997-06-01").cast("date")
    valid = (F.col("start_date") > F.date_add(base, F.col("p_size"))) | \
        (F.col("end_date") >= F.date_add(base, F.col("p_size") * 20))
    return p.join(shares, (p.p_brand == shares.brand) & (p.grade == shares.g) & valid, "left").select(
        "p_partkey", F.coalesce("share", F.lit(0.0205)).alias("share"))


@register("lateral_left_join", """
SELECT c_custkey, o.o_orderkey, o.price2 FROM customer LEFT JOIN LATERAL (
  SELECT o_orderkey, o_totalprice * 2 AS price2 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') o ON true""")
def lateral_left_join(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    o = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(
        "o_custkey", "o_orderkey", (F.col("o_totalprice") * 2).alias("price2"))
    return c.join(o, c.c_custkey == o.o_custkey, "left").select("c_custkey", "o_orderkey", "price2")


TAGS = """'[{"name":"tag ' || event_type || '"},{"name":"Fraud Ring ' || (event_id % 7) || '","w":1}]'"""


@register("unnest_records", """
SELECT event_id, name FROM (
  SELECT event_id, 'tag ' || event_type AS name FROM events UNION ALL SELECT event_id, 'Fraud Ring ' || (event_id % 7) FROM events)
WHERE name ILIKE '%fraud ring%' OR name = 'tag click'""")
def unnest_records(spark: SparkSession, sf: str) -> DataFrame:
    tags = table(spark, sf, "events").select("event_id", F.expr(TAGS).alias("tags"))
    names = tags.select("event_id", F.explode(F.from_json("tags", "array<struct<name:string>>")).alias("t")) \
        .select("event_id", "t.name")
    return names.filter(F.col("name").ilike("%fraud ring%") | (F.col("name") == "tag click"))


@register("record_from_json", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS absent FROM events""")
def record_from_json(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", F.from_json("props", "k bigint, absent string").alias("r"))
    return e.select("event_id", "r.*")


@register("semi_join", """
SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""")
def semi_join(spark: SparkSession, sf: str) -> DataFrame:
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders").filter("o_totalprice > 300000")
    return c.join(o, c.c_custkey == o.o_custkey, "left_semi").select("c_custkey")


@register("anti_join", """
SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""")
def anti_join(spark: SparkSession, sf: str) -> DataFrame:
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders").filter("o_totalprice > 400000")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey")


@register("join_on_cast_key", """
SELECT o_orderkey AS id, count(*) AS n FROM orders JOIN (SELECT CAST(l_orderkey AS VARCHAR) AS k FROM lineitem WHERE l_tax = 0) l
  ON o_orderkey = CAST(k AS BIGINT) GROUP BY 1""")
def join_on_cast_key(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    li = table(spark, sf, "lineitem").filter("l_tax = 0").select(F.col("l_orderkey").cast("string").alias("k"))
    return o.join(li, o.id == li.k.try_cast("bigint")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@register("history_of_same_buyer", """
SELECT part, count(DISTINCT l_orderkey) AS earlier_orders FROM (
  SELECT l.l_partkey AS part, l.l_orderkey FROM lineitem l
  WHERE l.l_returnflag <> 'R' AND EXISTS (SELECT 1 FROM lineitem d WHERE d.l_returnflag = 'R' AND d.l_partkey = l.l_partkey AND d.l_suppkey = l.l_suppkey))
GROUP BY part""")
def history_of_same_buyer(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    disputed = li.filter("l_returnflag = 'R'").select("l_partkey", "l_suppkey").distinct()
    past = li.filter("l_returnflag <> 'R'").select("l_partkey", "l_suppkey", "l_orderkey")
    return past.join(disputed, ["l_partkey", "l_suppkey"], "left_semi").groupBy(F.col("l_partkey").alias("part")).agg(
        F.countDistinct("l_orderkey").alias("earlier_orders"))


@register("salted_join", """
SELECT event_id, c_name FROM events LEFT JOIN customer ON c_custkey = user_id % 3""")
def hot_key_join(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", (F.col("user_id") % 3).alias("k"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), "c_name")
    return salted_join(e, c, ["k"], spread_by=["event_id"]).select("event_id", "c_name")


# --- order, limit, sets ---------------------------------------------------------------

@register("top_by_several_keys", """
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 500""")
def top_by_several_keys(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice").orderBy(
        F.col("o_orderpriority").asc_nulls_last(), F.col("o_totalprice").desc_nulls_first(), "o_orderkey").limit(500)


@register("union_distinct", """
SELECT l_suppkey AS k FROM lineitem UNION SELECT o_custkey FROM orders""")
def union_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("k")).union(
        table(spark, sf, "orders").select("o_custkey")).distinct()


@register("except_distinct", """
SELECT l_partkey, l_returnflag FROM lineitem WHERE l_linestatus = 'F' EXCEPT SELECT l_partkey, l_returnflag FROM lineitem WHERE l_linestatus = 'O'""")
def except_distinct(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.filter("l_linestatus = 'F'").select("l_partkey", "l_returnflag").subtract(
        li.filter("l_linestatus = 'O'").select("l_partkey", "l_returnflag"))


@register("select_distinct", "SELECT DISTINCT event_type, user_id FROM events")
def select_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_type", "user_id").distinct()


@register("share_of_group", """
SELECT o_orderkey, round(o_totalprice / sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey), 9) AS share FROM orders""")
def share_of_group(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")
    return with_group_values(o, ["o_custkey"], [total]).select(
        "o_orderkey", F.round(F.col("o_totalprice") / F.col("total"), 9).alias("share"))
