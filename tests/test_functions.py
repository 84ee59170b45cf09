import json
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions import jsonops, pii, temporal, text
from tidemark.operators import lookup

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
LEAF = st.one_of(st.none(), st.booleans(), st.integers(-99, 99), st.sampled_from(["x", "", 'q"', "é"]))
VALUE = st.recursive(LEAF, lambda c: st.one_of(st.lists(c, max_size=3), st.dictionaries(st.sampled_from(["a", "b c", "d.e", "0"]), c, max_size=3)), max_leaves=8)


def one(spark, expr, schema="j string", *values):
    return spark.createDataFrame([values], schema).select(expr).first()[0]


def drop(value, path):
    head, rest = path[0], path[1:]
    if isinstance(value, dict) and head in value:
        return {k: (drop(v, rest) if k == head else v) for k, v in value.items() if rest or k != head}
    if isinstance(value, list) and head.isdigit() and int(head) < len(value):
        return [drop(v, rest) if i == int(head) else v for i, v in enumerate(value) if rest or i != int(head)]
    return value


@FEW
@given(st.lists(VALUE, min_size=1, max_size=12), st.lists(st.sampled_from(["a", "b c", "d.e", "0"]), min_size=1, max_size=3))
def test_drop_path_equals_model(spark, values, path):
    df = spark.createDataFrame([(json.dumps(v),) for v in values], "j string")
    got = [json.loads(r[0]) for r in df.select(jsonops.drop_path("j", *path)).collect()]
    assert got == [drop(v, path) for v in values]


def test_drop_many_paths_and_bad_text(spark):
    out = jsonops.drop_paths("j", [["a"], ["b", "c"], ["b", "d", "e"]])
    assert json.loads(one(spark, out, "j string", '{"a":1,"b":{"c":2,"d":{"e":3,"f":1.50}},"g":[1]}')) == {"b": {"d": {"f": 1.5}}, "g": [1]}
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        one(spark, out, "j string", "not json")
    assert one(spark, jsonops.is_json("j"), "j string", "not json") is False and one(spark, jsonops.is_json("j"), "j string", None) is None
    assert json.loads(one(spark, out, "j string", '{"a":1,"g":1,"g":2}')) == {"g": 2}
    assert one(spark, out, "j string", None) is None


def test_edit_in_one_pass(spark):
    out = jsonops.edit("j", drop=[["raw", "zip"], ["x"]], over={"phone": F.lit('5"5')}, put={("raw", "phone"): F.lit('"**"')})
    assert json.loads(one(spark, out, "j string", '{"x":1,"raw":{"zip":1,"k":[null]}}')) == {"phone": '5"5', "raw": {"k": [None], "phone": "**"}}


def test_null_and_missing_paths(spark):
    df = spark.createDataFrame([('{"k":null}',), ("{}",), ('{"k":0}',), (None,)], "j string")
    got = [tuple(r) for r in df.select(jsonops.present("j", "k"), jsonops.is_json_null("j", "k"), jsonops.text_at("j", "k")).collect()]
    assert got == [(False, True, None), (False, None, None), (True, False, "0"), (False, None, None)]


@pytest.mark.parametrize("mail", ["o'hara@x.org", "a@b", "no mail", "", None])
def test_tokens(spark, mail):
    import hashlib
    got = one(spark, pii.pseudonymise("j", "pep", "salt"), "j string", mail)
    if mail and "@" in mail:
        salt = hashlib.sha256(b"salt").hexdigest()
        assert got == hashlib.sha256((salt + mail + "pep").encode()).hexdigest()
    else:
        assert got == mail


def test_token_inside_json_without_mail(spark):
    expr = pii.pseudonymise_in_json("j", ["a", "b"], "p")
    assert one(spark, expr, "j string", '{"a":{"b":null}}') == '{"a":{"b":null}}'
    assert one(spark, expr, "j string", None) is None
    assert "@" not in one(spark, expr, "j string", '{"a":{"b":"x@y"}}')
    escaped = one(spark, expr, "j string", '{"a":{"b":"x\\u0040y.org"},"c":"xx@y.org.uk"}')
    assert json.loads(escaped)["c"] == "xx@y.org.uk" and len(json.loads(escaped)["a"]["b"]) == 64


def test_first_writer_of_a_token_wins(spark):
    stored = spark.createDataFrame([("a@x", "old")], "email string, token string")
    df = spark.createDataFrame([("a@x",), ("b@x",), ("b@x",), (None,), ("plain",)], "m string")
    fresh = pii.new_tokens(stored, df, "m", "pepper")
    assert [r[0] for r in fresh.collect()] == ["b@x"]
    out = rows(pii.apply_tokens(df, stored.unionByName(fresh), "m"))
    assert ("old",) in out and (None,) in out and ("plain",) in out and len(out) == 5


def test_masks(spark):
    assert one(spark, pii.mask_text("j", 3), "j string", "ab") == "ab"
    assert one(spark, pii.mask_text("j", 3), "j string", "abcde") == "abc**"
    assert one(spark, pii.mask_text("j"), "j string", None) is None
    assert str(one(spark, pii.mask_date("j", "dd/MM/yyyy"), "j string", "31/12/1999")) == "1999-01-01"
    assert one(spark, pii.mask_date("j"), "j string", "31/12/1999") is None


def test_text_and_time(spark):
    assert one(spark, text.url_host("j"), "j string", "https://acs.bank.example/x/y") == "acs.bank.example"
    assert one(spark, text.url_host("j"), "j string", "nothing") is None
    assert one(spark, text.trim_fraction("j"), "j string", "2022-01-01 10:00:00.1") == "2022-01-01 10:00:00.1"
    assert one(spark, text.code_map("j", {"a": 1}), "j string", "zz") is None
    t = datetime(1969, 12, 31, 23, 59, 59, 500000)
    assert one(spark, temporal.epoch_micros("t"), "t timestamp_ntz", t) == -500000
    assert one(spark, temporal.quarter_hour("t"), "t timestamp_ntz", t) == "45"
    assert one(spark, temporal.epoch_ms_to_iso(F.lit(1700000000123)), "j string", "x") == "2023-11-14T22:13:20Z"


def test_ip_places_and_overlaps(spark):
    ranges = spark.createDataFrame([(16777216, 16777471, "AU"), (16777472, 16909060, "CN"), (4294967295, 4294967295, "ZZ")], "lo long, hi long, country string")
    ips = spark.createDataFrame([(1, "1.0.0.0"), (2, "1.0.1.0"), (3, "1.2.3.4"), (4, "1.2.3.5"), (5, "::1"), (6, None), (7, "256.1.1.1"), (8, "255.255.255.255"), (9, "1.0.0.0")], "i int, ip string")
    got = {r["i"]: r["country"] for r in lookup.ip_place(ips, "ip", ranges, ["country"]).collect()}
    assert got == {1: "AU", 2: "CN", 3: "CN", 4: None, 5: None, 6: None, 7: None, 8: "ZZ", 9: "AU"}
    assert lookup.overlapping_ranges(ranges).count() == 0
    assert lookup.overlapping_ranges(ranges.unionByName(ranges.filter("country = 'AU'").selectExpr("lo + 5 AS lo", "hi + 5 AS hi", "country"))).count() > 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    fact = spark.range(200).withColumn("k", F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 != 1, F.col("id") % 7))
    look = spark.createDataFrame([(0, "a"), (0, "b"), (2, "c")], "k long, v string")
    assert rows(lookup.salted_join(fact, look, ["k"], how, 5, ["id"])) == rows(fact.join(look, "k", how).select(*lookup.salted_join(fact, look, ["k"], how, 5, ["id"]).columns))
    with pytest.raises(ValueError):
        lookup.salted_join(fact, look, ["k"], "full_outer")
