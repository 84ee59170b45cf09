"""Operator 13, ranked lexical search by range-maximum tables over posting lists.

The index is one row for each block of ``block`` documents: their ids and lengths, the block's terms, and a posting list for each
term (places in the block, ascending, and counts).  A search gives every posting its impact, the score
that its term adds to its document, and lays a sparse table over each list that is wanted, so that the largest impact between
two postings is the larger of two cells.

For an item, an interval of a block's documents is bounded by the sum of its terms' largest impacts there.  The best intervals
are taken first and split at the document of the largest single impact: left part, the document alone, right part.  The bound
of one document is its score.  Intervals below the item's tenth score so far are dropped; the
search of a block ends when none is left.  The best of all blocks searched before in the same task are kept, so later blocks start with
their tenth score.  All arithmetic of scores is exact in 64-bit integers.

The index is made in one pass without an exchange and written with a block a file, since Parquet's writer and its readers hold many rows
of a file at once; so what a task holds is a block, however much of the table it reads.  Document frequencies are one map-side combined aggregate, and a block is
searched where it lies; from each task come ten rows an item at most.  Items go to the tasks ``ITEMS`` at a time, so what is
sent is bounded, and further items make further runs over the index.

Terms are the runs of characters that are no ASCII but digits and letters, with A-Z lower-cased.
Defined results: a null or empty text has no terms; a document or item without terms is in no result; equal rows are
documents or items of their own; a null doc_id comes last among equal scores; an empty table gives no rows.  Other columns, whatever
their names, are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import kept, register, table
from tidemark.llm.substrings import slices

#: Documents of a block, items sent to the tasks at once, intervals of an item that are split at once.
DOCUMENTS, ITEMS, AT_ONCE = 4096, 1024, 256
#: Terms times places up to which a block counts its postings in a table; beyond it they are found by bisection.
CELLS = 24 << 20
_LAST = (1 << 63) - 1  # stands for a null id
#: Bytes of a term stay, A-Z in lower case; all others become blanks.
_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_BYTES).split(b" ")


def _block(ids: list[np.ndarray], texts: list[pa.Array]) -> pa.RecordBatch:
    """One row: the posting lists of some documents, in the order of their ids."""
    ids = np.concatenate(ids)
    order = np.argsort(ids, kind="stable")
    known: dict[bytes, int] = {}
    lengths, found = np.zeros(len(ids), np.int64), []
    raw = [t for a in texts for t in a.to_pylist()]
    for place, i in enumerate(order.tolist()):
        own = [known.setdefault(t, len(known)) for t in terms_of(raw[i]) if t] if raw[i] else []
        lengths[place] = len(own)
        raw[i] = None
        if own:
            term, tf = np.unique(np.array(own, np.int64), return_counts=True)
            found.append((term, np.full(len(term), place, np.int32), tf))
    term, at, tf = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    by_term = np.argsort(term, kind="stable")
    df = np.bincount(term, minlength=len(known)).astype(np.int32)
    columns = [(ids[order], pa.int64()), (lengths, pa.int64()), (list(known), pa.binary()), (df, pa.int32()),
               (at[by_term].astype(np.int32), pa.int32()), (tf[by_term].astype(np.int64), pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array([c], pa.list_(k)) for c, k in columns], ["ids", "lengths", "terms", "dfs", "places", "tfs"])


def indexed(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = DOCUMENTS, block_bytes: int = 64 << 20) -> DataFrame:
    """The index of all ``docs``: a row a block, closed by its number of documents or bytes."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, n, size = [], [], 0, 0
        for b in slices(batches, 1):
            for lo in range(0, b.num_rows, block):
                part = b.slice(lo, block)
                if n and n + part.num_rows > block:
                    yield _block(ids, texts)
                    ids, texts, n, size = [], [], 0, 0
                ids.append(part.column(0).to_numpy())
                texts.append(part.column(1))
                n, size = n + part.num_rows, size + part.column(1).nbytes
                if size >= block_bytes:
                    yield _block(ids, texts)
                    ids, texts, n, size = [], [], 0, 0
        if n:
            yield _block(ids, texts)

    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_LAST)), F.col(text).cast("binary"))
    return rows.mapInArrow(build, "ids array<bigint>, lengths array<bigint>, terms array<binary>, dfs array<int>, places array<int>, tfs array<bigint>")


def stored(index: DataFrame) -> DataFrame:
    """The index written and read again, a block a file."""
    return kept(index, maxRecordsPerFile=1)


class Tables:
    """The wanted posting lists of one block, with a sparse table of maxima over each."""

    def __init__(self, row: dict[str, np.ndarray], wanted: dict[bytes, int], weight: np.ndarray, total: tuple[int, int]):
        """``weight`` by term number; ``total`` are the documents and the terms of the whole index."""
        documents, length = total
        self.ids, self.size = row["ids"], len(row["ids"])
        own = np.array([wanted.get(t, -1) for t in row["terms"]], np.int64)
        ends = np.cumsum(row["dfs"], dtype=np.int64)
        here = np.flatnonzero(own >= 0)
        count = row["dfs"][here].astype(np.int64)
        start = np.cumsum(count) - count
        take = np.repeat(ends[here] - row["dfs"][here] - start, count) + np.arange(int(count.sum()))
        at, tf = row["places"][take].astype(np.int64), row["tfs"][take]
        m = 10 + 90 * row["lengths"] * documents // length
        impact = np.repeat(weight[own[here]], count) * (1_000_000_000 * tf // (1000 * tf + 8 * m[at]))
        self.row = {int(t): i for i, t in enumerate(own[here])}
        self.start, self.at = start, at
        in_row = np.repeat(np.arange(len(here)), count)
        self.before = self.keys = None
        if len(here) * (self.size + 1) <= CELLS:  # postings of each term before each place
            self.before = np.zeros((len(here), self.size + 1), np.int32)
            self.before[in_row, at + 1] = 1
            np.cumsum(self.before, axis=1, out=self.before)
        else:
            self.keys = in_row * (self.size + 1) + at
        # level k: the place in the list of the largest impact of 2**k postings from each on; of equal ones the first
        best = np.arange(len(impact), dtype=np.int32)
        self.impact, self.levels = impact, [best]
        last = np.repeat(start + count, count)
        while len(impact) and 2 << (len(self.levels) - 1) <= count.max():
            step = 1 << (len(self.levels) - 1)
            other = best[np.minimum(np.arange(len(best)) + step, last - 1)]
            best = np.where(impact[other] > impact[best], other, best)
            self.levels.append(best)
        self.levels = np.stack(self.levels) if len(impact) else np.zeros((1, 0), np.int64)
        self.log = np.log2(np.maximum(1, np.arange(self.size + 1))).astype(np.int64)

    def _upto(self, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Postings of each term before each place."""
        if self.before is not None:
            return self.before[rows[:, None], places]
        return np.searchsorted(self.keys, rows[:, None] * (self.size + 1) + places) - self.start[rows][:, None]

    def bounds(self, rows: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For intervals [lo, hi) of the block: the sum of the terms' largest impacts, the place of the largest of them."""
        first, end = self._upto(rows, lo), self._upto(rows, hi)
        n = end - first
        level = self.log[n]
        first, end = self.start[rows][:, None] + first, self.start[rows][:, None] + end
        some = n > 0
        x = self.levels[level, np.where(some, first, 0)]
        y = self.levels[level, np.where(some, end - (1 << level), 0)]
        high_x, high_y = self.impact[x], self.impact[y]
        best = np.where(some, np.maximum(high_x, high_y), 0)
        top = np.argmax(best, axis=0)
        each = np.arange(len(lo))
        place = self.at[np.where(high_y > high_x, y, x)[top, each]]
        return best.sum(axis=0), place

    def search(self, terms: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The best ``k`` of those given and this block's, highest first, then smallest id; and the bounds computed."""
        rows = np.array([self.row[t] for t in terms.tolist() if t in self.row], np.int64)
        if not len(rows):
            return scores, ids, 0
        lo, hi = np.zeros(1, np.int64), np.full(1, self.size)
        bound, place = self.bounds(rows, lo, hi)
        spent = 1
        while len(lo):
            least = scores[k - 1] if len(scores) >= k else 1
            keep = bound >= least
            lo, hi, bound, place = lo[keep], hi[keep], bound[keep], place[keep]
            if not len(lo):
                break
            if len(lo) > AT_ONCE:
                order = np.argpartition(-bound, AT_ONCE)
                now, later = order[:AT_ONCE], order[AT_ONCE:]
            else:
                now, later = np.arange(len(lo)), np.zeros(0, np.int64)
            p = place[now]
            new_lo, new_hi = np.concatenate([lo[now], p + 1, p]), np.concatenate([p, hi[now], p + 1])
            alone = np.arange(len(new_lo)) >= 2 * len(p)
            real = new_lo < new_hi
            new_lo, new_hi, alone = new_lo[real], new_hi[real], alone[real]
            value, at = self.bounds(rows, new_lo, new_hi)
            spent += len(value)
            alone |= new_hi - new_lo == 1
            scores, ids = best_of(np.concatenate([scores, value[alone]]), np.concatenate([ids, self.ids[new_lo[alone]]]), k)
            rest = ~alone
            lo, hi = np.concatenate([lo[later], new_lo[rest]]), np.concatenate([hi[later], new_hi[rest]])
            bound, place = np.concatenate([bound[later], value[rest]]), np.concatenate([place[later], at[rest]])
        return scores, ids, spent


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    real = scores > 0
    scores, ids = scores[real], ids[real]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _columns(b: pa.RecordBatch, i: int) -> dict[str, np.ndarray]:
    return {name: np.array(v.as_py(), object) if name == "terms" else v.values.to_numpy(zero_copy_only=False)
            for name, v in ((n, b.column(j)[i]) for j, n in enumerate(b.schema.names))}


def _items(items: DataFrame, key: str, text: str) -> DataFrame:
    """Numbered items with their different terms: (number, item, term)."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [sorted({t for t in terms_of(x) if t}) if x else [] for x in b.column(2).to_pylist()]
            at = pa.array(np.repeat(np.arange(len(own)), [len(o) for o in own]))
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array([t for o in own for t in o], pa.binary())],
                                             ["number", "item", "term"])

    rows = items.select(F.monotonically_increasing_id(), F.col(key).cast("long"), F.col(text).cast("binary"))
    return kept(rows.mapInArrow(split, "number bigint, item bigint, term binary"))


def ranked(index: DataFrame, items: DataFrame, key: str = "item_id", text: str = "text", k: int = 10, at_once: int = ITEMS) -> DataFrame:
    """(item, rank, doc, score): the ``k`` best documents of an index for each item."""
    spark = index.sparkSession
    total = index.select(F.explode("lengths").alias("n")).agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    total = int(total[0]), int(total[1] or 0)
    asked = _items(items, key, text)
    of_term = (index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.dfs").alias("df"))
               .join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df")))
    weighed = kept(asked.join(of_term, "term"))
    numbers = [r[0] for r in weighed.select("number").distinct().orderBy("number").collect()] if total[1] else []
    shape = "number bigint, doc bigint, score bigint"
    parts = [_searched(index, weighed.where(F.col("number").between(numbers[i], numbers[min(i + at_once, len(numbers)) - 1])), total, k, shape)
             for i in range(0, len(numbers), at_once)]
    found = parts[0] if parts else spark.createDataFrame([], shape)
    for p in parts[1:]:
        found = found.unionByName(p)
    names = asked.select("number", "item").distinct()
    place = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score"), "doc"))
    top = found.select("*", place.alias("rank")).where(F.col("rank") <= k).join(names, "number")
    return top.select("item", "rank", F.when(F.col("doc") < _LAST, F.col("doc")).alias("doc"), "score")


def _searched(index: DataFrame, weighed: DataFrame, total: tuple[int, int], k: int, shape: str) -> DataFrame:
    """The best ``k`` of each task for the given items, of which there are few."""
    wanted: dict[bytes, int] = {}
    weight: list[int] = []
    of_item: dict[int, list[int]] = {}
    for number, term, df in weighed.select("number", "term", "df").toLocalIterator():
        t = wanted.setdefault(bytes(term), len(wanted))
        if t == len(weight):
            weight.append(math.floor(1000 * math.log((2 * total[0] + 2) / (2 * df + 1))))
        of_item.setdefault(number, []).append(t)
    sent = index.sparkSession.sparkContext.broadcast((wanted, np.array(weight, np.int64), {n: np.array(t) for n, t in of_item.items()}))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weights, asked = sent.value
        best = {n: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for n in asked}
        for b in batches:
            for i in range(b.num_rows):
                tables = Tables(_columns(b, i), terms, weights, total)
                for n, own in asked.items():
                    best[n] = tables.search(own, *best[n], k)[:2]
        rows = [(n, *pair) for n, (scores, ids) in best.items() for pair in zip(ids.tolist(), scores.tolist(), strict=True)]
        for lo in range(0, len(rows), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[lo:lo + (1 << 16)], strict=True)], ["number", "doc", "score"])

    return index.mapInArrow(search, shape)


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS number, doc_id, {_TERMS} AS terms FROM documents),
totals AS (SELECT count(*) FILTER (len(terms) > 0) AS docs, sum(len(terms))::BIGINT AS words FROM d),
post AS (SELECT number, doc_id, len(terms) AS n, unnest(terms) AS term FROM d),
tf AS (SELECT number, doc_id, n, term, count(*) AS tf FROM post GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
item AS (SELECT number, item_id, unnest(list_distinct(terms)) AS term FROM (SELECT row_number() OVER () AS number, item_id, {_TERMS} AS terms FROM benchmark)),
scored AS (SELECT i.number, i.item_id, tf.number AS doc, tf.doc_id,
  sum(floor(1000 * ln((2 * docs + 2) / (2 * df + 1)::DOUBLE))::BIGINT * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))))::BIGINT AS score
  FROM item i JOIN df USING (term) JOIN tf USING (term), totals GROUP BY ALL)
SELECT item_id, (row_number() OVER best)::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
WINDOW best AS (PARTITION BY number ORDER BY score DESC, doc_id NULLS LAST) QUALIFY row_number() OVER best <= 10"""


@register("op13_ranked_search", _ORACLE)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = stored(indexed(table(spark, sf_dir, "documents")))
    found = ranked(index, table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")
