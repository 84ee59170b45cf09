"""Every registered query against its SQL on DuckDB, on the small tables."""

import pytest

import __spark_entry__ as entry
import check
from tests.conftest import SMALL
from tidemark.catalog import registry

#: The queries of the warehouse part; the corpus operators have tests of their own.
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def con():
    return check.oracle_connection(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert name in ORACLES, "a query needs its SQL"
    df = QUERIES[name](spark, SMALL)
    diff, _ = check.compare(df, con, ORACLES[name])
    assert diff is None, diff
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["segment", "orders_count", "revenue"] and df.count() > 0
