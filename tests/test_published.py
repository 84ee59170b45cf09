"""Keys that move between partitions, publications that are cut short, tables that are never absent."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.plans import sync
from tidemark.sinks import keyindex, store, tables, versions

SHAPE = "id long, v string, day string"


def frame(spark, *items, shape=SHAPE):
    return spark.createDataFrame(list(items), shape)


def content(spark, path):
    return rows(spark.read.parquet(path), "id", "v", "day")


def test_a_key_that_moves_leaves_its_old_partition(spark, tmp_path):
    path = f"{tmp_path}/t"
    frame(spark, (1, "a", "d1"), (2, "b", "d1"), (3, "c", "d2"), (4, "e", "d3"), (None, "n", "d1")).write.partitionBy("day").parquet(path)
    keyindex.merge_keyed(path, frame(spark, (1, "A", "d2"), (5, "new", "d9"), (4, "E", None), (None, "m", "d2")), "id", "day")
    assert content(spark, path) == rows(frame(spark, (1, "A", "d2"), (2, "b", "d1"), (3, "c", "d2"), (4, "E", None), (5, "new", "d9"), (None, "n", "d1"), (None, "m", "d2")))
    assert not store.exists(spark, f"{path}/day=d3")
    keyindex.merge_keyed(path, frame(spark, (4, "back", "d1"), (1, "B", "d1")), "id", "day")
    assert content(spark, path) == rows(frame(spark, (1, "B", "d1"), (2, "b", "d1"), (3, "c", "d2"), (4, "back", "d1"), (5, "new", "d9"), (None, "n", "d1"), (None, "m", "d2")))
    assert keyindex.KeyIndex(spark, path, "id", "day").misplaced(spark.read.parquet(path)).isEmpty()


def test_partitions_without_a_key_of_the_batch_are_not_read(spark, tmp_path):
    path = f"{tmp_path}/t"
    frame(spark, (1, "a", "d1"), (2, "b", "d2"), (3, "c", "d3")).write.partitionBy("day").parquet(path)
    keyindex.KeyIndex(spark, path, "id", "day").build(spark.read.parquet(path))
    for f in (tmp_path / "t" / "day=d3").glob("*.parquet"):
        f.write_bytes(b"no parquet file")
    for f in (tmp_path / "t" / "day=d3").glob(".*.crc"):
        f.unlink()
    shape = spark.read.schema("id long, v string, day string")
    with pytest.raises(Exception):
        shape.parquet(path).collect()
    keyindex.merge_keyed(path, frame(spark, (1, "A", "d2")), "id", "day")
    assert keyindex.insert_keyed(path, frame(spark, (2, "x", "d1"), (7, "y", "d1")), "id", "day").count() == 1
    assert rows(shape.parquet(path).filter("day <> 'd3'")) == [(1, "A", "d2"), (2, "b", "d2"), (7, "y", "d1")]


def test_many_random_loads_equal_a_dictionary(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyindex, "COMPACT_AFTER", 3)
    rng, path, want = random.Random(2), f"{tmp_path}/t", {}
    shape = "a long, b string, v long, day string"
    for n in range(7):
        batch = {(rng.randrange(12), rng.choice("xy")): (n * 100 + k, f"d{rng.randrange(4)}") for k in range(8)}
        df = frame(spark, *[(a, b, v, d) for (a, b), (v, d) in batch.items()], shape=shape)
        if n == 0:
            df.write.partitionBy("day").parquet(path)
            want |= batch
        elif n % 3:
            index = keyindex.KeyIndex(spark, path, ["a", "b"], "day", compact_after=3)
            keyindex.merge_keyed(path, df, ["a", "b"], "day")
            want |= batch
            index.compact() if len(index.segments()) > 3 else None
        else:
            keyindex.insert_keyed(path, df, ["a", "b"], "day")
            want = batch | want
        got = {(r["a"], r["b"]): (r["v"], r["day"]) for r in spark.read.parquet(path).collect()}
        assert got == want and spark.read.parquet(path).count() == len(want)
    index = keyindex.KeyIndex(spark, path, ["a", "b"], "day")
    assert index.misplaced(spark.read.parquet(path)).isEmpty()
    index.compact()
    assert list(index.segments().values()) == [True] and index.misplaced(spark.read.parquet(path)).isEmpty()


class Stopped(Exception):
    pass


@pytest.mark.parametrize("where", ["before the note", "after the note", "half the partitions", "before the index"])
def test_a_load_cut_short_is_finished_by_the_next(spark, tmp_path, monkeypatch, where):
    path = f"{tmp_path}/t"
    frame(spark, (1, "a", "d1"), (2, "b", "d2"), (3, "c", "d3")).write.partitionBy("day").parquet(path)
    keyindex.KeyIndex(spark, path, "id", "day").build(spark.read.parquet(path))

    def stop(*_, **__):
        raise Stopped

    overwrite = tables.overwrite_partitions
    with monkeypatch.context() as m:
        if where == "before the note":
            m.setattr(tables.store, "put", stop)
        elif where == "after the note":
            m.setattr(tables, "_put_in_place", stop)
        elif where == "half the partitions":
            m.setattr(tables, "overwrite_partitions", lambda df, p, c: (overwrite(df.filter("day = 'd2'"), p, c), stop()))
        else:
            m.setattr(keyindex.KeyIndex, "done", stop)
        with pytest.raises(Stopped):
            keyindex.merge_keyed(path, frame(spark, (1, "A", "d2"), (3, "C", "d1")), "id", "day")
    finished = tables.finish_publishing(spark, path)
    assert finished == (where in ("after the note", "half the partitions"))
    moved = [(1, "A", "d2"), (2, "b", "d2"), (3, "C", "d1")]
    assert content(spark, path) == ([(1, "a", "d1"), (2, "b", "d2"), (3, "c", "d3")] if where == "before the note" else moved)
    keyindex.merge_keyed(path, frame(spark, (1, "Z", "d7"), (3, "Z", "d7")), "id", "day")
    assert content(spark, path) == [(1, "Z", "d7"), (2, "b", "d2"), (3, "Z", "d7")]
    assert tables.finish_publishing(spark, path) == 0 and store.names(spark, tables.staging(path)) == []


def test_a_row_in_two_places_gives_way_to_the_new_one(spark, tmp_path):
    path = f"{tmp_path}/t"
    frame(spark, (1, "a", "d1"), (1, "a", "d2"), (2, "b", "d2")).write.partitionBy("day").parquet(path)
    keyindex.merge_keyed(path, frame(spark, (1, "A", "d3")), "id", "day")
    assert content(spark, path) == [(1, "A", "d3"), (2, "b", "d2")]


def test_synced_tables_keep_one_row_of_a_key(spark, tmp_path):
    path, log, now = f"{tmp_path}/t", f"{tmp_path}/log", datetime(2024, 3, 1)
    rule = sync.SyncRule("public", "t", load_method="merge", key_field="id")
    run = lambda r, *items: sync.sync_table(r, frame(spark, *items), path, log, "day", now)
    run(rule, (1, "10", "2024-01"), (2, "20", "2024-01"))
    run(rule, (1, "11", "2024-02"))
    assert content(spark, path) == [(1, "11", "2024-02"), (2, "20", "2024-01")]
    run(rule.with_(load_method="insert-only"), (1, "12", "2024-03"), (3, "30", "2024-03"))
    run(rule.with_(load_method="truncate-insert"), (1, "13", "2024-04"), (4, "40", "2024-04"))
    run(rule, (4, "41", "2024-05"))
    assert content(spark, path) == [(1, "13", "2024-04"), (4, "41", "2024-05")]
    run(rule.with_(load_method="truncate-insert", key_field=None), (9, "90", "2024-04"))
    assert content(spark, path) == [(9, "90", "2024-04")]


@pytest.mark.parametrize("sql", [
    "SELECT s.* FROM {source} s JOIN secrets ON true", "SELECT *, (SELECT max(x) FROM secrets) FROM {source}", "SELECT * FROM {source} WHERE id IN (SELECT x FROM secrets)",
    "SELECT * FROM {source} UNION ALL SELECT * FROM parquet.`/tmp/x`", "WITH a AS (SELECT * FROM secrets) SELECT a.* FROM a, {source}", "SELECT * FROM range(5), {source}",
    "SELECT * FROM IDENTIFIER('secrets'), {source}", "INSERT INTO secrets SELECT id FROM {source}", "CREATE TABLE y AS SELECT * FROM {source}",
    "SELECT * FROM {source} WHERE EXISTS (WITH b AS (SELECT x FROM secrets) SELECT * FROM b)", "SELECT * FROM {source}, global_temp.secrets", "DROP TABLE {source}",
    "WITH a AS (SELECT * FROM b), b AS (SELECT * FROM {source}) SELECT * FROM a", "SELECT transform(id) USING 'cat' FROM {source}"])
def test_a_rule_reads_nothing_but_its_source(spark, sql):
    spark.range(3).withColumnRenamed("id", "x").createOrReplaceTempView("secrets")
    batch = frame(spark, (1, "a", "d1"))
    with pytest.raises(ValueError, match="may read from"):
        sync.projected(sync.SyncRule("public", "t", sql=sql), batch)


@pytest.mark.parametrize("sql", [
    "SELECT id, v, day FROM {source}", "WITH a AS (SELECT * FROM {source}), b AS (SELECT * FROM a) SELECT b.* FROM b JOIN a USING (id)",
    "SELECT * FROM {source} WHERE id = (SELECT max(id) FROM {source})", "SELECT s.* FROM {source} s JOIN (VALUES (1), (2)) AS t(x) ON s.id = t.x",
    "SELECT * FROM (SELECT *, row_number() OVER (ORDER BY id) AS rn FROM {source}) WHERE rn < 9", "SELECT {source}.id FROM {source} LATERAL VIEW explode(array(1, 2)) e AS n WHERE n = 1"])
def test_a_rule_may_use_its_source_freely(spark, sql):
    batch = frame(spark, (1, "a", "d1"))
    assert sync.projected(sync.SyncRule("public", "t", sql=sql), batch).count() == 1


def test_a_replaced_table_is_there_at_every_step(spark, monkeypatch):
    tables.replace_table(spark, spark.range(3), "whole")
    seen = []
    sql = type(spark).sql

    def watched(self, text, *a, **b):
        if text.startswith("ALTER"):
            seen.append(spark.table("whole").count())
        return sql(self, text, *a, **b)

    monkeypatch.setattr(type(spark), "sql", watched)
    reader = spark.table("whole")
    reader.count()
    tables.replace_table(spark, spark.range(5), "whole")
    assert seen == [3] and spark.table("whole").count() == 5 and reader.count() in (3, 5)
    with pytest.raises(ValueError, match="other columns"):
        tables.replace_table(spark, spark.range(5).withColumn("x", F.lit(1)), "whole")
    # a run that ends before the switch leaves the old table, and the next one clears what it left
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **b: (_ for _ in ()).throw(Stopped()) if text.startswith("ALTER") else sql(self, text, *a, **b))
    with pytest.raises(Stopped):
        tables.replace_table(spark, spark.range(9), "whole")
    monkeypatch.setattr(type(spark), "sql", sql)
    assert spark.table("whole").count() == 5
    tables.replace_table(spark, spark.range(7), "whole")
    assert spark.table("whole").count() == 7 and len(store.names(spark, tables.version_folder(spark, "whole"))) == 2


def test_a_managed_table_is_replaced_too(spark):
    spark.range(4).write.mode("overwrite").saveAsTable("managed")
    tables.replace_table(spark, spark.range(6), "managed")
    tables.replace_table(spark, spark.table("managed").filter("id > 0"), "managed")
    assert spark.table("managed").count() == 5


def test_partitions_are_switched_one_by_one(spark, monkeypatch):
    spark.sql("DROP TABLE IF EXISTS parts")
    frame(spark, (1, "a", "d1"), (2, "b", "d2"), (3, "c", "x'y"), (4, "d", None)).write.mode("overwrite").partitionBy("day").format("parquet").saveAsTable("parts")
    new = frame(spark, (1, "A", "d1"), (9, "n", "d9"), (3, "C", "x'y"))
    sql, calls = type(spark).sql, []

    def failing(self, text, *a, **b):
        if text.startswith("ALTER"):
            calls.append(text)
            if len(calls) == 4:
                raise Stopped
        return sql(self, text, *a, **b)

    monkeypatch.setattr(type(spark), "sql", failing)
    with pytest.raises(Stopped):
        versions.replace_partitions(spark, new, "parts", "day", ["d1", "d2", "d9", "x'y"])
    monkeypatch.setattr(type(spark), "sql", sql)
    assert spark.table("parts").filter("day = 'd2'").count() == 1  # nothing is missing half-way
    assert versions.finish_replacing(spark, "parts") == 1
    assert rows(spark.table("parts"), "id", "v", "day") == rows(frame(spark, (1, "A", "d1"), (3, "C", "x'y"), (4, "d", None), (9, "n", "d9")))
    versions.replace_partitions(spark, frame(spark, (1, "B", "d1")), "parts", "day", ["d1", "d9", "x'y"])
    assert rows(spark.table("parts"), "id", "v", "day") == rows(frame(spark, (1, "B", "d1"), (4, "d", None)))
    assert versions.forget_old_partitions(spark, "parts", "day") == 1 and spark.table("parts").count() == 2
    with pytest.raises(ValueError, match="other partitions"):
        versions.replace_partitions(spark, frame(spark, (1, "B", "d7")), "parts", "day", ["d1"])


def test_conditional_upsert_by_partition(spark, tmp_path):
    path = f"{tmp_path}/t"
    frame(spark, (1, "open", "d1"), (2, "shut", "d1"), (3, "open", "d2")).write.partitionBy("day").parquet(path)
    tables.upsert_partitions(path, frame(spark, (1, "x", "d1"), (2, "x", "d1"), (4, "x", "d1")), "id", "day", ["v"], "v = 'open'")
    assert content(spark, path) == [(1, "x", "d1"), (2, "shut", "d1"), (3, "open", "d2"), (4, "x", "d1")]
    with pytest.raises(ValueError, match="cannot be moved"):
        tables.upsert_partitions(path, frame(spark, (1, "x", "d1")), "id", "day", ["v", "day"], "true")
