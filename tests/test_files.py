from datetime import date, datetime

from tests.conftest import SMALL, rows
from tidemark.sinks import exports, tables
from tidemark.sources import files
from tidemark.sources.tables import read_table
from tidemark.sources.ticks import flatten_ticks


def test_utf16_file_with_renamed_columns(spark, tmp_path):
    text = "TransactionDate,Amount,FullName\n2022-01-18 10:11:12.123456,5,Ann\n2022-01-18,6,Žofie\n"
    (tmp_path / "a.csv").write_bytes(text.encode("utf-16-le"))
    df = files.read_renamed_csv(spark, str(tmp_path / "a.csv"), {"TransactionDate": "transaction_date", "Amount": "amount", "FullName": "full_name"},
                                trim_times=["transaction_date"])
    assert rows(df) == [("2022-01-18 10:11:12.123", "5", "Ann"), ("2022-01-18", "6", "Žofie")]


def test_folder_of_csv_files_is_appended(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("id,v\n1,x\n")
    (src / "b.csv").write_text("id,v\n2,y\n")
    (src / "c.txt").write_text("id,v\n3,z\n")
    for _ in range(2):
        files.append_csv_folder(spark, str(src), str(tmp_path / "table"), "id int, v string")
    assert rows(spark.read.parquet(str(tmp_path / "table"))) == [(1, "x"), (1, "x"), (2, "y"), (2, "y")]


def test_event_files_of_two_days(spark, tmp_path):
    for day, n in (("2024/01/01", 1), ("2024/01/02", 2), ("2024/01/03", 3)):
        spark.createDataFrame([(n,)], "id long").coalesce(1).write.parquet(f"{tmp_path}/buy.events/{day}/x")
    days = files.dated_prefixes(date(2024, 1, 3))
    assert days == ["2024/01/02", "2024/01/03"]
    df = files.load_events(spark, f"{tmp_path}/buy.events", days, r"^.*buy\.events.*$", "id long", "2024-01-03 05:00:00")
    assert rows(df, "id", "dw_created_at") == [(2, datetime(2024, 1, 3, 5)), (3, datetime(2024, 1, 3, 5))]
    assert files.load_events(spark, f"{tmp_path}/buy.events", ["2024/01/03", "2024/01/04"], "no such", "id long").count() == 0
    assert rows(files.load_events(spark, f"{tmp_path}/buy.events", ["2024/01/03", "2024/01/04"], schema="id long"), "id") == [(3,)]


def test_exports_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi"\tnow', None), (2, "b\\c", "x")], "id int, a string, b string")
    at = datetime(2023, 9, 30, 1, 2, 3)
    folder = exports.write_csv(df.drop("a"), str(tmp_path), "banks_", at)
    assert folder.endswith("/2023/09/banks_20230930010203.csv")
    assert rows(spark.read.option("header", "true").schema("id int, b string").csv(folder)) == [(1, None), (2, "x")]
    exports.write_tsv(df, f"{tmp_path}/t")
    back = spark.read.option("header", "true").option("sep", "\t").option("escape", "\\").schema("id int, a string, b string").csv(f"{tmp_path}/t")
    assert rows(back) == rows(df)
    exports.write_json(df, f"{tmp_path}/j")
    assert rows(spark.read.schema("id int, a string, b string").json(f"{tmp_path}/j")) == rows(df)
    exports.write_extract(df.drop("b"), f"{tmp_path}/e")
    assert rows(spark.read.option("escape", '"').schema("id int, a string").csv(f"{tmp_path}/e")) == rows(df.drop("b"))


def test_replace_table_and_failed_replacement(spark):
    first, second = spark.range(3), spark.range(5)
    tables.replace_table(spark, first, "numbers")
    tables.replace_table(spark, second, "numbers")
    assert spark.table("numbers").count() == 5
    broken = spark.range(4).selectExpr("id", "raise_error('no') AS x")
    try:
        tables.replace_table(spark, broken, "numbers")
    except Exception:
        pass
    assert spark.table("numbers").count() == 5


def test_replace_table_from_itself(spark):
    tables.replace_table(spark, spark.range(3), "selfish")
    tables.replace_table(spark, spark.table("selfish").filter("id > 0"), "selfish")
    assert rows(spark.table("selfish")) == [(1,), (2,)]


def test_only_named_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(1, "a"), (2, "b")], "v int, day string").write.partitionBy("day").parquet(path)
    tables.overwrite_partitions(spark.createDataFrame([(9, "b")], "v int, day string"), path, "day")
    assert rows(spark.read.parquet(path), "v", "day") == [(1, "a"), (9, "b")]


def test_merge_touches_only_the_partitions_of_the_batch(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.createDataFrame([(1, "x", "a"), (2, "y", "b"), (3, "z", "c")], "id int, v string, day string").write.partitionBy("day").parquet(path)
    untouched = sorted((tmp_path / "m" / "day=a").iterdir())
    tables.merge_partitions(path, spark.createDataFrame([(2, "new", "b"), (4, "n", "d")], "id int, v string, day string"), "id", "day")
    assert rows(spark.read.parquet(path), "id", "v", "day") == [(1, "x", "a"), (2, "new", "b"), (3, "z", "c"), (4, "n", "d")]
    assert sorted((tmp_path / "m" / "day=a").iterdir()) == untouched


def test_read_table_prunes_and_pushes_down(spark, capsys):
    read_table(spark, f"{SMALL}/orders.parquet", ["o_orderkey"], "o_custkey = 5").explain("formatted")
    plan = capsys.readouterr().out
    assert "EqualTo(o_custkey,5)" in plan and "o_totalprice" not in plan


def test_ticks_with_empty_list(spark):
    df = spark.createDataFrame([('[{"pair":"btcusd","data":[]},{"pair":"ethusd","data":[{"time":0,"close":1.5}]}]',), (None,), ("junk",)], "p string")
    assert rows(flatten_ticks(df, "p")) == [("ethusd", 1.5, "1970-01-01 00:00:00")]
