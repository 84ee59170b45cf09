from datetime import datetime, timedelta

import pytest

from tests.conftest import rows
from tidemark.plans import sync
from tidemark.streaming.ingest import event_stream, first_copies, ingest

SHAPE = "id long, email string, updated_at timestamp_ntz"
T0 = datetime(2024, 1, 1)


def source(spark, n):
    return spark.createDataFrame([(i, f"u{i}@x", T0 + timedelta(minutes=i // 3)) for i in range(n)], SHAPE)


def test_rule_from_json():
    rule = sync.SyncRule.from_json('{"batch_max_rows": 5, "schedule": "x", "rules": [{"schema_name": "public", "table_name": "t", "key_field": "id", "prefix": "p_", "target_schema_name": "raw"}]}')
    assert rule.batch_max_rows == 5 and rule.load_method == "insert-only" and rule.target == "raw.p_t"


@pytest.mark.parametrize("method", ["merge", "insert-only"])
def test_repeated_runs_load_everything(spark, tmp_path, method):
    rule = sync.SyncRule("public", "t", load_method=method, order_field="updated_at", key_field="id", batch_max_rows=7, columns_to_hash="email")
    src, target, runs = source(spark, 20), spark.createDataFrame([], SHAPE), 0
    while target.count() < 20:
        out = sync.run_sync(rule, src, target, T0, "pepper")
        out.write.parquet(f"{tmp_path}/{runs}")
        target, runs = spark.read.parquet(f"{tmp_path}/{runs}"), runs + 1
        assert runs < 10
    assert runs == 4
    assert rows(target, "id") == [(i,) for i in sorted(range(20), key=lambda i: repr((i,)))]
    assert target.filter("email like '%@%'").count() == 0


def test_append_gives_only_new_rows(spark):
    rule = sync.SyncRule("public", "t", order_field="updated_at", key_field="id", backward_update_period="1 hour")
    src = source(spark, 12)
    assert rows(sync.rows_to_append(rule, src, src.filter("id < 9"), T0), "id") == [(10,), (11,), (9,)]
    with pytest.raises(ValueError):
        sync.rows_to_append(rule.with_(load_method="merge"), src, src, T0)
    with pytest.raises(ValueError):
        sync.run_sync(rule.with_(load_method="other"), src, src, T0)


def test_run_log(spark):
    rule = sync.SyncRule("public", "t")
    log = sync.log_entry(spark, rule, "STARTED", T0).unionByName(sync.log_entry(spark, rule, "COMPLETED", T0 + timedelta(hours=1)))
    failed = sync.failed_entry(log, "public_t", "it's bad", T0 + timedelta(hours=2))
    assert rows(sync.latest_run_status(log), "latest_status") == [("COMPLETED",)]
    assert rows(sync.latest_run_status(log.unionByName(failed)), "latest_status", "error_message") == [("FAILED", "its bad")]


def test_change_log_bound_is_inclusive_and_first_load_takes_all(spark):
    shape = "Id string, v string, LastModifiedDate long"
    audit = shape + ", DW_CREATED_AT timestamp_ntz, DW_UPDATED_AT timestamp_ntz"
    src = spark.createDataFrame([("a", "1", 1000), ("b", "2", 2000), ("b", "3", 2001), ("c", "4", 500)], shape)
    first = sync.pull_changes(src, spark.createDataFrame([], audit), now=T0)
    assert rows(first, "Id", "v", "DW_CREATED_AT", "DW_UPDATED_AT") == [("a", "1", T0, None), ("b", "3", T0, None), ("c", "4", T0, None)]
    loaded = spark.createDataFrame([("a", "old", 1000, T0, None)], audit)
    again = sync.pull_changes(src, loaded, now=T0 + timedelta(1))
    assert rows(again, "Id", "v") == [("a", "1"), ("b", "3")]


def test_stream_reads_each_file_once_and_drops_copies(spark, tmp_path):
    shape = "event_id long, ts timestamp_ntz, v string"
    folder, table, state = (str(tmp_path / x) for x in ("in", "table", "state"))

    def arrive(*data):
        spark.createDataFrame(list(data), shape).coalesce(1).write.mode("append").parquet(folder)
        ingest(first_copies(event_stream(spark, folder, spark.createDataFrame([], shape).schema)), table, state).awaitTermination()
        return rows(spark.read.parquet(table), "event_id", "v")

    assert arrive((1, T0, "a"), (2, T0, "b")) == [(1, "a"), (2, "b")]
    assert arrive((2, T0 + timedelta(minutes=5), "late copy"), (3, T0 + timedelta(minutes=6), "c")) == [(1, "a"), (2, "b"), (3, "c")]
    assert arrive((4, T0 + timedelta(hours=1), "d")) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
