"""The masks and JSON edits under SQL names, for rules that bring their own SELECT."""

from __future__ import annotations

from pyspark.sql import SparkSession

_OBJECT = "try_variant_get(parse_json(j), '$', 'map<string,variant>')"

#: name and signature, and the expression it stands for
FUNCTIONS: dict[str, str] = {
    "mask_text(s STRING, keep INT DEFAULT 0) RETURNS STRING":
        "concat(substring(s, 1, keep), repeat('*', greatest(char_length(s) - keep, 0)))",
    "mask_date(s STRING, fmt STRING DEFAULT 'yyyy-MM-dd') RETURNS DATE": "trunc(CAST(try_to_timestamp(s, fmt) AS DATE), 'year')",
    "hash_text(s STRING) RETURNS STRING": "sha2(s, 256)",
    "json_drop(j STRING, names ARRAY<STRING>) RETURNS STRING":
        f"to_json(coalesce(to_variant_object(map_filter({_OBJECT}, (k, v) -> NOT array_contains(names, k))), parse_json(j)))",
    "json_keep(j STRING, names ARRAY<STRING>) RETURNS STRING":
        f"to_json(to_variant_object(map_filter({_OBJECT}, (k, v) -> array_contains(names, k))))",
    "json_text(j STRING, name STRING) RETURNS STRING": "get_json_object(j, concat('$[\\'', name, '\\']'))",
}


def register_functions(spark: SparkSession) -> None:
    """Make the names known to the session; they are expressions, not Python functions."""
    for signature, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
