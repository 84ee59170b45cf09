"""All corpus queries, as ``__spark_entry__`` adds them."""

from __future__ import annotations

import importlib

import corpus_pipeline
from tidemark.llm.common import ORACLES, QUERIES, register

for _m in ("quality", "sharding", "packing", "substrings", "extraction", "mixing", "neighbours", "nearcopies", "lines", "quotations",
           "repair", "archives", "lexical"):
    importlib.import_module(f"tidemark.llm.{_m}")


register("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
