"""Operator 2, substring de-duplication by a relative Lempel-Ziv parse against all documents.

Every window of ``size`` words of every document belongs to the reference, which lies as
hash blocks over the cluster.  A document is parsed against it: a factor is a longest run of
consecutive windows that all start in smaller documents, so it has ``size`` words at least;
where a factor ends, the next window is looked up anew, so that windows across the boundary
of two factors are checked too.  The words of the factors are the duplicate spans.

A window is looked up only if it can be found.  Its anchor is the smallest hash among its
runs of ``gram`` words, which depends on the window's words alone; equal windows have equal
anchors, and neighbours mostly share theirs, so there is about one anchor for five words.
Pass 1 finds the anchors of two documents or more, pass 2 looks up the windows with such an
anchor, pass 3 cuts the texts.  Passes 2 and 3 read the same exchange of the texts.

A batch of a task first settles what it can by itself: of the documents in it that share an
anchor or a window, all but the smallest are done, and only the smallest goes through the
exchange.  A passage of a third of all documents so meets as one row of each batch.

Defined results: a null or blank text has no words and nothing is removed; a document of fewer
words than a window loses nothing; equal texts under one id are judged alike and never
against each other; a null id is larger than any other; an empty table gives no rows.
Hashes have 64 bits and are keyed by position.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import register, table

#: Bytes of text that a Python worker hashes at once.
AT_ONCE = 12 << 20
_ODD = np.random.default_rng(20).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LAST = (1 << 63) - 1  # stands for a null id
_BLANKS = str.maketrans("\t\n\x0b\x0c\r", "     ")


def slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``AT_ONCE`` bytes of the given text column."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        edges = [0, *(np.flatnonzero(np.diff(ends // AT_ONCE)) + 1), b.num_rows]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            if hi > lo:
                yield b.slice(lo, hi - lo)


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of each word, and the row of each."""
    lists = pc.split_pattern_regex(texts.fill_null("").cast(pa.large_string()), "[\x20\x09-\x0d]+")
    row = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    coded = pc.dictionary_encode(lists.flatten())
    words = coded.dictionary.to_pylist()
    each = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    real = np.fromiter((w != "" for w in words), bool, len(words))
    at = coded.indices.to_numpy()
    keep = real[at]
    return each[at][keep], row[keep]


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` consecutive words."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for j in range(n):
        out += hashes[j:j + m] * _ODD[j]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(29))


def anchored(texts: pa.Array, size: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every window within one row: its anchor, row, first word within the row, and place; the words' hashes."""
    hashes, row = hashed_words(texts)
    small = runs(hashes, gram)
    m = max(0, len(hashes) - size + 1)
    anchor = small[:m].copy()
    for j in range(1, size - gram + 1):
        np.minimum(anchor, small[j:j + m], out=anchor)
    place = np.flatnonzero(row[:m] == row[size - 1:size - 1 + m]) if m else np.zeros(0, np.int64)
    first = np.searchsorted(row, np.arange(len(texts)))
    return anchor[place], row[place], place - first[row[place]], place, hashes


def _settled(key: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by (key, id): whether the id is the smallest of its key, whether the key has others."""
    start = np.r_[True, key[1:] != key[:-1]]
    group = np.cumsum(start) - 1
    at = np.flatnonzero(start)
    lowest, highest = ids[at], ids[np.r_[at[1:], len(key)] - 1]
    return ids == lowest[group], (lowest != highest)[group]


def factored(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 13, gram: int = 5) -> DataFrame:
    """One row for each of ``docs``: the key, ``n_words``, ``n_removed``, ``spans`` (first word, words) and ``kept``."""
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_LAST)).alias("id"), F.xxhash64(text).alias("copy"), F.col(text).alias("text"))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            ids = b.column(0).to_numpy()
            anchor, row, *_ = anchored(b.column(1), size, gram)
            if not len(anchor):
                continue
            order = np.lexsort((row, anchor))
            anchor, row = anchor[order], row[order]
            once = np.r_[True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])]
            anchor, row = anchor[once], row[once]
            order = np.lexsort((ids[row], anchor))
            anchor, row = anchor[order], row[order]
            _, shared = _settled(anchor, ids[row])
            # what the batch has settled needs no meeting, but the smallest still has to meet other batches
            lowest = np.r_[True, anchor[1:] != anchor[:-1]]
            send = np.flatnonzero(lowest | shared)
            anchor, row, shared, lowest = anchor[send], row[send], shared[send], lowest[send]
            k = np.where(lowest, anchor, anchor ^ (ids[row].astype(np.uint64) * _ODD[40]))
            yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(ids[row]),
                                              pa.array(anchor.view(np.int64), mask=~shared)], ["k", "id", "anchor"])

    meeting = Window.partitionBy("k")
    found = (rows.select("id", "text").mapInArrow(anchors, "k bigint, id bigint, anchor bigint")
             .select("id", F.coalesce("anchor", "k").alias("anchor"), F.col("anchor").isNotNull().alias("shared"), F.min("id").over(meeting).alias("lo"), F.max("id").over(meeting).alias("hi"))
             .where("shared or lo < hi").groupBy("id").agg(F.collect_set("anchor").alias("anchors")))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2):
            ids, copies = b.column(0).to_numpy(), b.column(1).to_numpy()
            anchor, row, at, place, hashes = anchored(b.column(2), size, gram)
            wanted = np.flatnonzero(np.isin(anchor.view(np.int64), np.unique(b.column(3).flatten().to_numpy())))
            if not len(wanted):
                continue
            row, at, anchor, window = row[wanted], at[wanted], anchor[wanted], runs(hashes, size)[place[wanted]]
            order = np.lexsort((ids[row], window))
            lowest = np.empty(len(order), bool)
            lowest[order], _ = _settled(window[order], ids[row][order])
            # windows that have to meet other batches, in runs of neighbours under one anchor
            ask = np.flatnonzero(lowest)
            edge = np.flatnonzero(np.r_[True, (np.diff(at[ask]) != 1) | (np.diff(row[ask]) != 0) | (np.diff(anchor[ask].view(np.int64)) != 0)])
            own = ask[edge]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[own].view(np.int64)), pa.array(ids[row[own]]), pa.array(copies[row[own]]), pa.array(at[own].astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(np.r_[edge, len(ask)].astype(np.int32)), pa.array(window[ask].view(np.int64))),
                 pa.nulls(len(own), pa.list_(pa.int32()))], names)
            done = np.flatnonzero(~lowest)
            if len(done):
                edge = np.flatnonzero(np.r_[True, np.diff(row[done]) != 0])
                own = row[done][edge]
                k = ids[own].astype(np.uint64) * _ODD[41] ^ copies[own].view(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k.view(np.int64)), pa.array(ids[own]), pa.array(copies[own]), pa.array(np.zeros(len(own), np.int32)),
                     pa.nulls(len(own), pa.list_(pa.int64())),
                     pa.ListArray.from_arrays(pa.array(np.r_[edge, len(done)].astype(np.int32)), pa.array(at[done].astype(np.int32)))], names)

    names = ["k", "id", "copy", "at", "windows", "done"]
    equal = Window.partitionBy("k", "window")  # equal windows have equal anchors
    hits = (rows.join(found, "id").select("id", "copy", "text", "anchors")
            .mapInArrow(windows, "k bigint, id bigint, copy bigint, at int, windows array<bigint>, done array<int>").repartition("k")
            .select("k", "id", "copy", "at", "done", F.posexplode_outer("windows").alias("place", "window"))
            .select("id", "copy", "at", "place", "done", F.min("id").over(equal).alias("lo"))
            .where("done is not null or lo < id")
            .groupBy("id", "copy").agg(F.array_distinct(F.flatten(F.collect_list(F.coalesce("done", F.array(F.col("at") + F.col("place")))))).alias("at"))
            .groupBy("id").agg(F.collect_list(F.struct("copy", "at")).alias("at")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            n, removed, spans, left = [], [], [], []
            for t, at in zip(b.column(1), b.column(2), strict=True):
                words = [w for w in (t.as_py() or "").translate(_BLANKS).split(" ") if w]
                n.append(len(words))
                own = []
                if at.is_valid:
                    starts = np.sort(at.values.to_numpy())
                    new = np.flatnonzero(np.r_[True, starts[1:] > starts[:-1] + size])  # a gap between factors
                    ends = starts[np.r_[new[1:] - 1, len(starts) - 1]] + size
                    own = list(zip(starts[new].tolist(), (ends - starts[new]).tolist(), strict=True))
                    for s, length in reversed(own):
                        del words[s:s + length]
                removed.append(sum(x[1] for x in own))
                spans.append([{"first": s, "words": length} for s, length in own])
                left.append(" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32())]))), pa.array(left, pa.string())],
                ["id", "n_words", "n_removed", "spans", "kept"])

    kind = docs.schema[key].dataType.simpleString()
    # both joins read the texts by the same columns and key, so there is one exchange of them
    return (rows.join(hits, "id", "left").select("id", "text", F.transform(F.filter("at", lambda x: x["copy"] == F.col("copy")), lambda x: x["at"])
                                                 .alias("at"))
            .select("id", "text", F.get("at", F.lit(0)).alias("at"))
            .mapInArrow(cut, "id bigint, n_words bigint, n_removed bigint, spans array<struct<first:int,words:int>>, kept string")
            .select(F.when(F.col("id") < _LAST, F.col("id")).cast(kind).alias(key), "n_words", "n_removed", "spans", "kept"))


#: A window is compared as its text: words hold no blanks.
SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS (SELECT doc_id, p, array_to_string(words[p:p + 12], ' ') AS g
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS p FROM w WHERE len(words) >= 13)),
h AS (SELECT doc_id, p FROM g QUALIFY min(doc_id) OVER (PARTITION BY g) < doc_id),
c AS (SELECT DISTINCT doc_id, p + k AS p FROM h, (SELECT unnest(range(0, 13)) AS k)),
r AS (SELECT doc_id, list(p) AS gone FROM c GROUP BY doc_id),
k AS (SELECT w.doc_id, words, coalesce(len(gone), 0) AS n_removed,
             CASE WHEN gone IS NULL THEN words
                  ELSE list_transform(list_filter(list_zip(words, range(1, len(words) + 1)), lambda x: NOT list_contains(gone, x[2])), lambda x: x[1]) END AS kept
      FROM w LEFT JOIN r ON r.doc_id = w.doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k"""


@register("op2_substring_dedup", SQL)
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factored(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
