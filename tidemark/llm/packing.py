"""Operator 9, best-fit packing by vectors: tokens, documents and attention cost of a sequence.

A piece asks for its tokens, one document and the square of its tokens; a sequence has room
for so many of each.  Pieces go, largest first, to the open sequence that fits best under
all three: the one with the smallest weighted norm of what stays free (``rule="norm"``), or
the largest weighted dot product of asked and free (``rule="dot"``).  With the default limits documents and
cost never bind: pieces within the tokens cannot reach them.  The pipeline limits the documents of a sequence; the cost cannot
bind while a piece may fill a sequence, as its square is the largest sum of squares within the tokens.

Pieces of one length are interchangeable, so the plan needs only how many there are of each
length: at most ``size`` numbers, counted on Spark over all pieces.  The plan states which
ranks of a length go to which sequences; Spark numbers the pieces of each length and looks
their places up.

Defined results: a null text is an empty one and gives a single piece holding the end id;
only documents longer than ``size`` are cut; repeated rows are packed each for itself; rows
with a null key are packed too; an empty table gives no rows; clashing columns raise.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import kept, register, table

SIZE = 4096
#: Documents that a sequence of the pipeline may hold; the query has no such limit, as its contract asks for the fewest sequences.
MOST_DOCS = 16
#: Words whose ids a Python worker remembers, and characters of text it works on at once.
REMEMBERED, AT_ONCE = 1 << 20, 8 << 20


@functools.cache
def _words(path: str) -> _Words:
    """One for each Python worker, which runs many tasks."""
    return _Words(path)


class _Words:
    """Ids of words.  The tokenizer drops white space and never merges across it."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.ids, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def places(self, words: list[str]) -> np.ndarray:
        if len(self.at) > REMEMBERED:
            self.forget()
        new = [w for w in words if w not in self.at]
        if new:
            ids, lengths = [], []
            for lo in range(0, len(new), 1000):  # a line of words at a time: a call for each costs more than its merges
                part = new[lo:lo + 1000]
                line = self.tokenizer.encode("\n".join(part), add_special_tokens=False)
                ids += line.ids
                starts = np.cumsum([0, *(len(w) + 1 for w in part)])
                at = np.fromiter((a for a, _ in line.offsets), np.int64, len(line.ids))
                lengths.append(np.diff(np.searchsorted(at, starts)))
            for w in new:
                self.at[w] = len(self.at)
            self.ids = np.concatenate([self.ids, np.array(ids, np.uint32)])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate(lengths))])
        return np.fromiter((self.at[w] for w in words), np.int64, len(words))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text ends."""
        texts = texts.fill_null("").cast(pa.large_string())
        for blank in "\t\r\n":
            texts = pc.replace_substring(texts, blank, " ")
        lists = pc.split_pattern(texts, " ")
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        coded = pc.dictionary_encode(lists.flatten())
        place = self.places(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        start, length = self.starts[place], self.starts[place + 1] - self.starts[place]
        ends = np.concatenate(([0], np.cumsum(length)))
        ids = self.ids[np.repeat(start - ends[:-1], length) + np.arange(ends[-1])]
        return ids, ends[bounds[1:]]


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, end_id: int = 1,
           size: int = SIZE) -> DataFrame:
    """Token ids of every document and the end id, cut to ``size``: key, piece, start, length, ids.

    ``ids`` is binary: unsigned 32-bit numbers, lowest byte first.
    """
    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(path)
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            group = np.cumsum(lengths, dtype=np.int64) // AT_ONCE
            edges = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [len(lengths)])) if len(lengths) else [0]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                ids, ends = words.encode(batch.column(1).slice(lo, hi - lo))
                rows, piece, start, length, blobs, last = [], [], [], [], [], 0
                for i, e in enumerate(ends):
                    own = np.append(ids[last:e], np.uint32(end_id)).astype("<u4")
                    last = e
                    for p, at in enumerate(range(0, len(own), size)):
                        part = own[at:at + size]
                        rows.append(lo + i), piece.append(p), start.append(at), length.append(len(part)), blobs.append(part.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(blobs, pa.binary())], ["k", "piece", "start", "length", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return (docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
            .mapInArrow(cut, f"k {kind}, piece int, start bigint, length bigint, ids binary").withColumnRenamed("k", key))


def plan(counts: dict[int, int], size: int = SIZE, max_docs: int | None = None, max_cost: int | None = None,
         weights: tuple[float, float, float] = (1.0, 0.02, 0.02), rule: str = "norm") -> np.ndarray:
    """Places for the pieces of every length: rows (length, first rank, ranks, first sequence, offset).

    Sequences in the same state (what is free of each kind) are handled together.  Documents and
    cost are whole numbers; a limit that no pieces within the tokens can reach is left out of the state.
    """
    docs_room, cost_room = max_docs or size, max_cost or size * size
    binds = np.array([True, docs_room < size, cost_room < size * size])
    room = np.array([size, docs_room, cost_room], np.int64)[binds]
    scale = np.array(weights)[binds] / np.maximum(room, 1).astype(np.float64) ** 2
    states: dict[tuple[int, ...], list[list[int]]] = {}
    index: list[tuple[int, ...]] = []
    free = np.zeros((64, len(room)), np.int64)
    alive = np.zeros(64, bool)
    where: dict[tuple[int, ...], int] = {}
    out, next_sequence = [], 0

    def put(state: tuple[int, ...], first: int, n: int) -> None:
        nonlocal free, alive
        if 0 in state:
            return
        if state not in where:
            if len(index) == len(free):
                free, alive = np.concatenate([free, np.zeros_like(free)]), np.concatenate([alive, np.zeros_like(alive)])
            where[state] = len(index)
            index.append(state)
            free[where[state]] = state
            states[state] = []
        alive[where[state]] = True
        states[state].append([first, n])

    for length in sorted(counts, reverse=True):
        ask = np.array([length, 1, length * length], np.int64)[binds]
        if length > size or (ask > room).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        left, rank = counts[length], 0
        while left:
            fits = np.flatnonzero(alive[:len(index)] & (free[:len(index)] >= ask).all(axis=1))
            if len(fits):
                f = free[fits].astype(np.float64)
                score = -(((f - ask) ** 2) * scale).sum(axis=1) if rule == "norm" else (f * ask * scale).sum(axis=1)
                state = index[fits[int(np.argmax(score))]]
                each = int((np.array(state) // ask).min())
                spans = states[state]
                first, n = spans[-1]
                takes, each = (min(n, left // each), each) if left >= each else (1, left)
                if takes == n:
                    spans.pop()
                    if not spans:
                        alive[where[state]] = False
                else:
                    spans[-1] = [first + takes, n - takes]
            else:
                state = tuple(int(x) for x in room)
                each = int((room // ask).min())
                takes, each = (left // each, each) if left >= each else (1, left)
                first = next_sequence
                next_sequence += takes
            for k in range(each):
                out.append((length, rank, takes, first, size - state[0] + k * length))
                rank += takes
            left -= takes * each
            put(tuple(int(x) for x in np.array(state) - each * ask), first, takes)
    return np.array(out, np.int64).reshape(-1, 5)


#: Pieces of a bucket, within which the pieces of one length are numbered, and the least number of buckets.
IN_BUCKET, BUCKETS = 1 << 20, 256


def packed(parts: DataFrame, key: str = "doc_id", size: int = SIZE, **rules) -> DataFrame:
    """``parts`` (key, piece, length and anything else) with ``sequence_id`` and ``offset``.

    The rows are written first, each with a number of its own, by which they are dealt into buckets: equal pieces, however
    many, lie in all of them.
    """
    if clash := {"sequence_id", "offset", "_bucket", "_rank", "_row", "_at", "_before"} & set(parts.columns):
        raise ValueError(f"columns of the input clash with results: {sorted(clash)}")
    spark = parts.sparkSession
    ties = [c for c in parts.columns if c not in (key, "piece", "length")]
    tag = F.xxhash64(key, "piece", *ties)
    numbered = kept(parts.select("*", F.monotonically_increasing_id().alias("_row")))
    buckets = max(BUCKETS, numbered.count() // IN_BUCKET)
    spread = numbered.select("*", F.pmod(F.xxhash64("_row"), F.lit(buckets)).alias("_bucket"))
    per = spread.groupBy("length", "_bucket").count()
    counts = {r[0]: r[1] for r in per.groupBy("length").agg(F.sum("count")).collect()}  # at most `size` rows
    placed = plan(counts, size, **rules)
    places = spark.sparkContext.broadcast(placed[np.lexsort((placed[:, 1], placed[:, 0]))])

    upto = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = per.select("length", "_bucket", F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_bucket").orderBy(F.col(key), "piece", tag)
    ranked = (spread.select("*", F.row_number().over(within).alias("_at")).join(before, ["length", "_bucket"])
              .select(*parts.columns, (F.col("_before") + F.col("_at") - 1).cast("long").alias("_rank")))
    names, at = ranked.columns, parts.columns.index("length")

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = places.value
        keys = p[:, 0] * (1 << 44) + p[:, 1]
        for b in batches:
            length, rank = b.column(at).to_numpy(zero_copy_only=False), b.column(len(names) - 1).to_numpy(zero_copy_only=False)
            row = p[np.searchsorted(keys, length * (1 << 44) + rank, side="right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(row[:, 3] + rank - row[:, 1], pa.int64()), pa.array(row[:, 4], pa.int64())],
                [*names[:-1], "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields)
    return ranked.mapInArrow(look_up, f"{kinds}, sequence_id bigint, offset bigint")


def packed_documents(docs: DataFrame) -> DataFrame:
    """Pieces of all documents with a checksum of their ids in place of the ids, packed."""
    return packed(pieces(docs).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the packed pieces with their token ids, ``MOST_DOCS`` at most to a sequence.

    Only the places go through the packing, the ids join them at the end.
    """
    cut = kept(pieces(docs).withColumn("number", F.monotonically_increasing_id()))
    placed = packed(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "number"), max_docs=MOST_DOCS)
    return placed.join(cut.select("number", "ids"), "number").drop("number")


@register("op9_best_fit_packing")
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))
