"""Operator 12, WARC archives: a normaliser for monolithic gzip, with revisits for equal payloads.

A crawl is written as archives that are one gzip stream each, which nobody can seek in.  The normaliser inflates
such a stream once, from start to end, and rewrites every record as a gzip member of its own; the place of each member goes to
a sidecar file beside the archive (``.idx``, one JSON object a line) and to the index it returns.  Records are
then read by their places, in parallel.

Which records are revisits is found between the two steps from digests alone: the largest page of each payload digest,
by a map-side combined aggregate, joined back to the records.  Payloads are never shuffled.

Archives are written by the tasks straight into the shared folder, one name for each attempt; only
the names that a finished task has returned are ever read, so lost executors leave unused files and
nothing else.  An archive is closed after ``archive_bytes`` of records.

Defined results: a null payload is an empty one; a null id is smaller than any other; of equal rows with the largest id one
is the response; a null url has no target; line ends and control characters in a url are percent-encoded in the header; an empty table gives no
archive and no rows.  Other columns, whatever their names, are left out.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import kept, register, table, work_folder

#: Bytes of records after which an archive is closed, and those read from a file at once.
ARCHIVE_BYTES, CHUNK = 256 << 20, 1 << 18
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_GZIP, _LEVEL = 31, 6


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(archive: str, seq: int) -> str:
    return f"urn:uuid:{uuid.UUID(bytes=hashlib.sha1(f'{archive}#{seq}'.encode()).digest()[:16], version=5)}"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a name; any store that pyarrow knows."""
    return fs.FileSystem.from_uri(path)


def header_value(text: str) -> str:
    """The text on one line: control characters and blanks at its ends percent-encoded."""
    kept_text = "".join(ch if ch >= " " and ch != "\x7f" else f"%{ord(ch):02X}" for ch in text)
    return kept_text if kept_text == kept_text.strip() else kept_text.replace(" ", "%20")


def record(fields: dict[str, str], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in {**fields, "Content-Length": str(len(block))}.items())
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def response(archive: str, seq: int, page: int | None, url: str | None, payload: bytes, date: str) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a response record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = {"WARC-Type": "response", "WARC-Record-ID": f"<{record_id(archive, seq)}>", "WARC-Date": date}
    if url is not None:
        fields["WARC-Target-URI"] = header_value(url)
    fields["WARC-Payload-Digest"] = f"sha1:{payload_digest(payload)}"
    if page is not None:
        fields["Page-ID"] = str(page)
    return fields | {"Content-Type": "application/http; msgtype=response"}, http + payload


class Records:
    """The records of a gzip stream of one or more members, inflated once from start to end."""

    def __init__(self, source):
        self.source, self.inflate, self.held, self.over = source, zlib.decompressobj(_GZIP), bytearray(), False

    def _more(self) -> bool:
        raw = self.inflate.unconsumed_tail or self.inflate.unused_data or self.source.read(CHUNK)
        if self.inflate.eof:
            if not raw:
                self.over = True
                return False
            self.inflate = zlib.decompressobj(_GZIP)
        out = self.inflate.decompress(raw, CHUNK << 2)
        if not raw and not out and not self.inflate.eof:  # the last input may be taken before all output is given
            raise ValueError("an archive ends within a member")
        self.held += out
        return True

    def _take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self._more():
                raise ValueError("an archive ends within a record")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def _head(self) -> bytes | None:
        start = 0
        while (at := self.held.find(b"\r\n\r\n", start)) < 0:
            start = max(0, len(self.held) - 3)
            if not self._more():
                if self.held.strip():
                    raise ValueError("an archive ends within a header")
                return None
        return self._take(at + 4)

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        while (head := self._head()) is not None:
            version, *lines = head.decode().strip("\r\n").split("\r\n")
            if not version.startswith("WARC/"):
                raise ValueError(f"not a WARC record: {version[:40]!r}")
            fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
            yield fields, self._take(int(fields.pop("Content-Length")))
            self._take(4)


def as_revisit(fields: dict[str, str], block: bytes, refers_to: str, page: int | None) -> tuple[dict[str, str], bytes]:
    """The record without its payload, which another record holds; the HTTP header stays."""
    http, _, _ = block.partition(b"\r\n\r\n")
    more = {"WARC-Type": "revisit", "WARC-Profile": PROFILE, "WARC-Refers-To": f"<{refers_to}>"}
    return fields | more | ({} if page is None else {"Refers-To-Page-ID": str(page)}), http + b"\r\n\r\n"


def rewritten(source: str, target: str, change: Callable[[int, dict[str, str], bytes], tuple[dict[str, str], bytes]]) -> Iterator[dict]:
    """Every record of ``source`` as its own member of ``target``, with the sidecar beside it; yields the index."""
    store, path = opened(source)
    out_store, out_path = opened(target)
    offset = 0
    with store.open_input_stream(path, compression=None) as raw, out_store.open_output_stream(out_path, compression=None) as out, \
            out_store.open_output_stream(f"{out_path}.idx", compression=None) as side:
        for seq, (fields, block) in enumerate(Records(raw)):
            fields, block = change(seq, fields, block)
            pack = zlib.compressobj(_LEVEL, zlib.DEFLATED, _GZIP)
            member = pack.compress(record(fields, block)) + pack.flush()
            out.write(member)
            row = {"archive": target.rpartition("/")[2], "offset": offset, "length": len(member), "record_id": fields["WARC-Record-ID"].strip("<>"),
                   "record_type": fields["WARC-Type"], "url": fields.get("WARC-Target-URI"), "payload_digest": fields.get("WARC-Payload-Digest")}
            side.write(json.dumps(row).encode() + b"\n")
            offset += len(member)
            yield row


INDEX = "archive string, offset bigint, length bigint, record_id string, record_type string, url string, payload_digest string"
_INDEX = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_id", pa.string()),
                    ("record_type", pa.string()), ("url", pa.string()), ("payload_digest", pa.string())])


def _in_batches(rows: Iterator[dict], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def monolithic(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
               archive_bytes: int = ARCHIVE_BYTES, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write every row as a response record; each task fills archives of one gzip stream.

    Returns (archive, seq, page, payload_bytes, digest).  Written on evaluation: keep the result before using it.
    """
    rows = pages.select(F.col(key).cast("long"), F.col(url).cast("string"), F.coalesce(F.col(payload).cast("binary"), F.lit(b"")))
    schema = pa.schema([("archive", pa.string()), ("seq", pa.int64()), ("page", pa.int64()), ("payload_bytes", pa.int64()), ("digest", pa.string())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(folder)
        store.create_dir(base, recursive=True)
        name, out, pack, seq, size = "", None, None, 0, 0
        for b in batches:
            said = []
            for page, target, body in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if out is None:
                    name, seq, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out, pack = store.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(_LEVEL, zlib.DEFLATED, _GZIP)
                fields, block = response(name, seq, page, target, body, date)
                whole = record(fields, block)
                out.write(pack.compress(whole))
                said.append((name, seq, page, len(body), fields["WARC-Payload-Digest"][5:]))
                seq, size = seq + 1, size + len(whole)
                if size >= archive_bytes:
                    out.write(pack.flush())
                    out.close()
                    out = None
            if said:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*said, strict=True), schema, strict=True)], schema=schema)
        if out is not None:
            out.write(pack.flush())
            out.close()

    return rows.mapInArrow(write, "archive string, seq bigint, page bigint, payload_bytes bigint, digest string")


def with_first_seen(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Each record with the one it revisits: (archive, seq, refers_archive, refers_seq, refers_page), nulls for responses."""
    whole = F.struct(F.coalesce("page", F.lit(-1 << 63)).alias("order"), "archive", "seq", "page")
    tops = kept(records.where(F.col("payload_bytes") >= min_bytes).groupBy("digest").agg(F.max(whole).alias("top"), F.count("*").alias("n"))
                .where("n > 1").select("digest", "top"))
    other = (F.col("top.archive") != F.col("archive")) | (F.col("top.seq") != F.col("seq"))
    return records.join(tops, "digest", "left").select(
        "archive", "seq", *[F.when(other, F.col(f"top.{c}")).alias(f"refers_{c}") for c in ("archive", "seq", "page")])


def normalised(records: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrite the archives that ``records`` names, each in one task and one pass, revisits without their payload.

    ``records`` are the rows of ``with_first_seen``, or of any table (archive, seq, refers_archive, refers_seq, refers_page)
    that has every record of an archive.  Returns the index.  Written on evaluation: keep the result before using it.
    """
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(target)
        store.create_dir(base, recursive=True)
        rows = (r for b in batches for r in zip(*[c.to_pylist() for c in b.columns], strict=True))

        def all_rows() -> Iterator[dict]:
            for archive, verdicts in groupby(rows, key=lambda r: r[0]):
                def change(seq: int, fields: dict[str, str], block: bytes, verdicts=verdicts) -> tuple[dict[str, str], bytes]:
                    _, place, refers, at, page = next(verdicts)
                    if place != seq:
                        raise ValueError(f"record {seq} of {archive} is not in the table")
                    return (fields, block) if refers is None else as_revisit(fields, block, record_id(refers, at), page)

                yield from rewritten(f"{source}/{archive}", f"{target}/{archive.removesuffix('.warc.gz')}-{uuid.uuid4().hex[:8]}.warc.gz", change)

        yield from _in_batches(all_rows(), _INDEX)

    columns = ["archive", "seq", "refers_archive", "refers_seq", "refers_page"]
    return _by_archive(records.select(*columns), "seq").mapInArrow(rewrite, INDEX)


def _by_archive(rows: DataFrame, order: str) -> DataFrame:
    """Rows in order, about one partition for each archive: the rows are few and small, the archives they stand for are not."""
    n = rows.select("archive").distinct().count()
    return rows.repartition(max(1, n), "archive").sortWithinPartitions("archive", order)


def normalised_files(files: DataFrame, target: str) -> DataFrame:
    """Rewrite gzipped WARC files of any origin, named by the one column of ``files``, record for record; returns the index."""
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(target)
        store.create_dir(base, recursive=True)
        names = (n for b in batches for n in b.column(0).to_pylist())
        yield from _in_batches((r for n in names for r in rewritten(n, f"{target}/{uuid.uuid4().hex}.warc.gz", lambda _, f, b: (f, b))), _INDEX)

    return files.mapInArrow(rewrite, INDEX)


_READ = pa.schema([("page", pa.int64()), ("url", pa.string()), ("record_id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def read_back(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records at the places of an index: (page, url, record_id, payload_bytes, payload_digest, record_type, refers_to, payload).

    Bytes and digest are those of the whole payload, for revisits too, which hold none.  A response whose payload does not have its digest raises.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(folder)

        def all_rows() -> Iterator[dict]:
            places = ((a, o, n) for b in batches for a, o, n in zip(*[b.column(i).to_pylist() for i in range(3)], strict=True))
            for archive, own in groupby(places, key=lambda p: p[0]):
                with store.open_input_file(f"{base}/{archive}") as file:
                    for _, offset, length in own:
                        file.seek(offset)
                        [(fields, block)] = Records(pa.BufferReader(file.read(length)))
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                        digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
                        if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
                            raise ValueError(f"{archive} at {offset}: the payload is not the one written")
                        yield {"page": int(fields["Page-ID"]) if "Page-ID" in fields else None, "url": fields.get("WARC-Target-URI"),
                               "record_id": fields["WARC-Record-ID"].strip("<>"), "payload_bytes": size, "payload_digest": digest, "record_type": kind,
                               "refers_to": int(fields["Refers-To-Page-ID"]) if "Refers-To-Page-ID" in fields else None,
                               "payload": payload if payloads and kind == "response" else None}

        yield from _in_batches(all_rows(), _READ, 256 if payloads else 4096)

    kinds = {"int64": "bigint", "string": "string", "binary": "binary"}
    return _by_archive(index.select("archive", "offset", "length"), "offset").mapInArrow(read, ", ".join(f"{f.name} {kinds[str(f.type)]}" for f in _READ))


_ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, unhex(sha1(h))::BIT::VARCHAR AS bits, max(page_id) OVER (PARTITION BY h) AS top,
  row_number() OVER (PARTITION BY h ORDER BY page_id DESC NULLS LAST) AS place FROM p)
SELECT page_id, payload_bytes,
  list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT
    + 4 * substr(bits, 5 * i + 3, 1)::INT + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT, 1) FOR i IN range(32)], 'string_agg', '') AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN top END AS refers_to FROM d"""


@register("op12_warc_normaliser", _ORACLE)
def op12_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark)
    records = kept(monolithic(table(spark, sf_dir, "pages"), f"{folder}/crawl"))
    index = kept(normalised(with_first_seen(records), f"{folder}/crawl", f"{folder}/archives"))
    found = read_back(index, f"{folder}/archives", payloads=False)
    return found.select(F.col("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")
