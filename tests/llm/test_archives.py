"""WARC archives: round trips, the sidecar, revisits, damaged files."""

import base64
import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tidemark.llm import archives

SHAPE = "page_id long, url string, html string"


def write(spark, rows, folder, **how):
    df = spark.createDataFrame(rows, SHAPE).withColumns({"archive": F.lit("clash"), "seq": F.lit(1), "digest": F.lit("x")}).repartition(3)
    records = archives.kept(archives.monolithic(df, f"{folder}/crawl", **how))
    index = archives.kept(archives.normalised(archives.with_first_seen(records), f"{folder}/crawl", f"{folder}/out"))
    return records, index


def rows_of(folder):
    long = "é<p>" * 60_000
    return ([(i, f"http://a/{i}", f"<p>{i}</p>\r\n\r\nWARC/1.1\r\n") for i in range(30)] + [(100 + i, f"http://c/{i}", "same ünder") for i in range(25)]
            + [(200, None, None), (201, "x\r\ny z ", ""), (202, " ", ""), (300, "u", long), (301, "u", long + "!"), (None, "n", "only"), (None, "n", "<p>3</p>\r\n\r\nWARC/1.1\r\n"),
               (400, "t", "twice"), (400, "t", "twice")])


def test_the_query_gives_every_page_with_its_response(spark, tmp_path):
    rows = rows_of(tmp_path)
    spark.createDataFrame(rows, SHAPE).repartition(4).write.parquet(f"{tmp_path}/pages.parquet")
    got = [tuple(r) for r in archives.op12_warc_normaliser(spark, str(tmp_path)).collect()]
    bodies = {}
    for page, _, html in rows:
        bodies.setdefault(html or "", []).append(page)
    want = []
    for body, ids in bodies.items():
        raw = body.encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        ids = sorted(ids, key=lambda i: (i is not None, i or 0))
        want += [(i, len(raw), digest, "revisit", ids[-1]) for i in ids[:-1]] + [(ids[-1], len(raw), digest, "response", None)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_members_stand_alone_and_the_sidecar_finds_them(spark, tmp_path):
    records, index = write(spark, rows_of(tmp_path), tmp_path, archive_bytes=2000)
    per = {r[0]: r[1] for r in records.groupBy("archive").count().collect()}
    assert len(per) > 3
    places = index.collect()
    crawl = list((tmp_path / "crawl").glob("*.warc.gz"))
    assert {f.name for f in crawl} >= set(per)
    for f in crawl:  # one stream with many records
        assert gzip.decompress(f.read_bytes()).count(b"WARC-Record-ID: ") == per[f.name]
    for f in (tmp_path / "out").glob("*.warc.gz"):
        side = [json.loads(x) for x in (f.parent / f"{f.name}.idx").read_text().splitlines()]
        raw = f.read_bytes()
        assert sum(x["length"] for x in side) == len(raw) and [x["offset"] for x in side] == sorted(x["offset"] for x in side)
        for x in side:
            member = gzip.decompress(raw[x["offset"]:x["offset"] + x["length"]])
            assert member.startswith(b"WARC/1.1\r\n") and x["record_id"].encode() in member and member.endswith(b"\r\n\r\n")
    assert len({p["record_id"] for p in places}) == len(places) == 64
    back = {(r["page"], r["record_id"]): r for r in archives.read_back(index, f"{tmp_path}/out").collect()}
    bodies = {p: (h or "").encode() for p, _, h in rows_of(tmp_path) if p is not None}
    responses = {i: r for (_, i), r in back.items() if r["record_type"] == "response"}
    for (page, _), r in back.items():
        assert page is None or r["record_type"] == "revisit" and r["payload"] is None and bodies[r["refers_to"]] == bodies[page] or bytes(r["payload"]) == bodies[page]
    assert {r["url"] for r in back.values() if r["page"] in (200, 201, 202)} == {None, "x%0D%0Ay%20z%20", "%20"} and len(responses) == 36
    again = archives.normalised_files(spark.createDataFrame([(str(f),) for f in (tmp_path / "out").glob("*.gz")], "f string"), f"{tmp_path}/again")
    kept = archives.kept(again)  # archives of many members are read as well
    assert archives.read_back(kept, f"{tmp_path}/again").select("record_id", "payload_digest", "record_type").exceptAll(
        archives.read_back(index, f"{tmp_path}/out").select("record_id", "payload_digest", "record_type")).isEmpty()


def test_small_payloads_may_stay_and_empty_tables_write_nothing(spark, tmp_path):
    records, index = write(spark, [(1, "a", "xy"), (2, "a", "xy"), (3, "a", "long enough"), (4, "b", "long enough")], tmp_path)
    first = archives.with_first_seen(records, 5).where("refers_archive is not null")
    assert [r["refers_page"] for r in first.collect()] == [4] and index.where("record_type = 'revisit'").count() == 2
    records, index = write(spark, [], tmp_path / "none")
    assert records.count() == index.count() == 0


def test_cut_or_changed_archives_raise(spark, tmp_path):
    fields, block = archives.response("a", 0, 7, "u", b"body", "1970-01-01T00:00:00Z")
    whole = gzip.compress(archives.record(fields, block) * 3)
    (tmp_path / "ok.warc.gz").write_bytes(whole)
    same = archives.rewritten(str(tmp_path / "ok.warc.gz"), str(tmp_path / "new.warc.gz"), lambda _, f, b: (f, b))
    assert [r["record_type"] for r in same] == ["response"] * 3
    for name, raw in {"cut": whole[:-20], "odd": gzip.compress(b"HTTP/1.1 200\r\n\r\n"), "half": gzip.compress(archives.record(fields, block)[:-9])}.items():
        (tmp_path / name).write_bytes(raw)
        with pytest.raises(ValueError):
            list(archives.rewritten(str(tmp_path / name), str(tmp_path / "x"), lambda _, f, b: (f, b)))
    wrong, _ = archives.response("a", 0, 7, "u", b"bodY", "1970-01-01T00:00:00Z")
    (tmp_path / "wrong.warc.gz").write_bytes(gzip.compress(archives.record(wrong, block)))
    index = spark.createDataFrame([("wrong.warc.gz", 0, 10_000)], "archive string, offset long, length long")
    with pytest.raises(Exception, match="not the one written"):
        archives.read_back(index, str(tmp_path)).collect()
