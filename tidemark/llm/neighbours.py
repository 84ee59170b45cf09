"""Operator 1, nearest neighbours by learned partitions.

A neighbour graph over a bounded sample is cut into balanced parts with few edges between
them; a small classifier learns which parts a vector's neighbours lie in.  Every vector is
indexed under its most probable part; a query goes to several most probable parts, and all
vectors there are ranked by their distance to it, in double precision.

Parts are cut into blocks of rows and the queries into blocks as well, so that one task holds
one pair of blocks whatever a part's size; a vector that a third of the rows share fills many
blocks of its part.  Each pair of blocks gives at most ``k`` rows for a query.

Parameters of the index: ``sample`` vectors (16,384 at most, by the order of a hash) fit graph
and classifier, and that is all the driver sees; all rows are indexed.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take
no part, nor do rows without id or vectors of another dimension than most; the row of a query
itself (by id) is no candidate; ties go to the smaller id; repeated rows of an id count once, the
smallest vector standing for it; with too few rows for two parts the search is exact; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import register, table


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): one row per id, v without null, non-finite or only zero components."""
    v = F.col(vector).cast("array<double>")
    good = (vectors.select(F.col(key).cast("long").alias("id"), v.alias("v"))
            .where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
            .where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
            .where(F.exists("v", lambda x: x != 0)))
    return good.groupBy("id").agg(F.min("v").alias("v"))


def graph(sample: DataFrame, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` nearest of the sample to each of its rows, found on the executors."""
    shared = sample.sparkSession.sparkContext.broadcast(rows.astype(np.float32))  # at most `sample` vectors

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = shared.value
        square = (x * x).sum(1)
        for b in batches:
            at = b.column(0).to_numpy()
            for lo in range(0, len(at), 512):
                own = at[lo:lo + 512]
                d = square - 2 * (x[own] @ x.T)
                d[np.arange(len(own)), own] = np.inf
                kk = min(k, len(x) - 1)
                best = np.argpartition(d, kk - 1, axis=1)[:, :kk]
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(list(best.astype(np.int32)))], ["at", "near"])

    spark = sample.sparkSession
    got = spark.range(0, len(rows), 1, 16).mapInArrow(near, "at bigint, near array<int>").toPandas()
    return got["at"].to_numpy(), np.stack(got["near"].to_numpy())


def balanced_parts(x: np.ndarray, left: np.ndarray, right: np.ndarray, parts: int, slack: float = 1.05, rounds: int = 30) -> np.ndarray:
    """A part for each row: equal halves by the main direction first, then moves that cut fewer edges."""
    part = np.zeros(len(x), np.int64)

    def halve(rows: np.ndarray, first: int, n: int) -> None:
        if n == 1:
            part[rows] = first
            return
        own = x[rows] - x[rows].mean(0)
        main = np.linalg.svd(own[:4096], full_matrices=False)[2][0]
        order = np.argsort(own @ main, kind="stable")
        cut = len(rows) * (n // 2) // n
        halve(rows[order[:cut]], first, n // 2)
        halve(rows[order[cut:]], first + n // 2, n - n // 2)

    halve(np.arange(len(x)), 0, parts)
    most, least = int(np.ceil(len(x) / parts * slack)), int(len(x) / parts / slack)
    sizes = np.bincount(part, minlength=parts)
    for _ in range(rounds):
        near = np.zeros((len(x), parts), np.int32)
        np.add.at(near, (left, part[right]), 1)
        np.add.at(near, (right, part[left]), 1)
        own = near[np.arange(len(x)), part]
        gain = near - own[:, None]
        wish = gain.argmax(1)
        best = gain[np.arange(len(x)), wish]
        moved = 0
        for i in np.argsort(-best, kind="stable"):
            if best[i] <= 0:
                break
            a, b = part[i], wish[i]
            if sizes[b] < most and sizes[a] > least:
                part[i], moved = b, moved + 1
                sizes[a] -= 1
                sizes[b] += 1
        if not moved:
            break
    return part


class Router:
    """A classifier with one hidden layer, trained on the parts of each row's neighbours."""

    def __init__(self, x: np.ndarray, goal: np.ndarray, hidden: int = 128, epochs: int = 40, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std() + 1e-12
        x = ((x - self.mean) / self.scale).astype(np.float32)
        shapes = [(x.shape[1], hidden), (hidden,), (hidden, goal.shape[1]), (goal.shape[1],)]
        self.w = [(rng.normal(0, (2 / s[0]) ** 0.5, s) if len(s) == 2 else np.zeros(s)).astype(np.float32) for s in shapes]
        m, v, step = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        for epoch in range(epochs):
            order, rate = rng.permutation(len(x)), 3e-3 * (1 - epoch / epochs) + 1e-4
            for lo in range(0, len(x), 256):
                own = order[lo:lo + 256]
                h = np.maximum(x[own] @ self.w[0] + self.w[1], 0)
                p = self._softmax(h @ self.w[2] + self.w[3])
                d = (p - goal[own]) / len(own)
                back = (d @ self.w[2].T) * (h > 0)
                step += 1
                for i, g in enumerate((x[own].T @ back, back.sum(0), h.T @ d, d.sum(0))):
                    g = g + 1e-4 * self.w[i]
                    m[i] += 0.1 * (g - m[i])
                    v[i] += 0.001 * (g * g - v[i])
                    self.w[i] -= rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """Parts of each row, the most probable first."""
        h = np.maximum(((x - self.mean) / self.scale).astype(np.float32) @ self.w[0] + self.w[1], 0)
        return np.argsort(-(h @ self.w[2] + self.w[3]), axis=1, kind="stable")


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", parts: int = 32,
            probes: int = 24, sample: int = 16_384, graph_k: int = 10, block: int = 4096) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest found for every row that ``is_query`` holds for.

    ``is_query`` is a column over ``id``.  ``probes`` of ``parts`` are searched for each query.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector)
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return spark.createDataFrame([], "query_id bigint, rank int, id bigint, score double")
    dimension, n = common
    rows = rows.where(F.size("v") == dimension)
    parts = max(1, min(parts, n // 128))
    router = None
    if parts > 1:
        picked = rows.orderBy(F.xxhash64(F.lit(1), "id")).limit(sample)
        x = np.array([r[0] for r in picked.select("v").collect()])  # at most `sample` vectors
        at, near = graph(picked, x, graph_k)
        left, right = np.repeat(at, near.shape[1]), near.ravel()
        part = balanced_parts(x, left, right, parts)
        goal = np.zeros((len(x), parts), np.float32)
        np.add.at(goal, (left, part[right]), 1)
        goal[np.arange(len(x)), part] += 1
        router = spark.sparkContext.broadcast(Router(x, goal / goal.sum(1, keepdims=True)))
    blocks, query_blocks = max(1, -(-n // (parts * block))), max(1, -(-n // (100 * block)))

    def routed(take: int):
        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                best = router.value.ranked(_matrix(b.column(1)))[:, :take] if router else np.zeros((b.num_rows, 1), np.int64)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(best.astype(np.int32)))], ["id", "v", "parts"])
        return route

    schema = "id bigint, v array<double>, parts array<int>"
    placed = rows.mapInArrow(routed(1), schema)
    index = placed.select("id", "v", F.get("parts", F.lit(0)).alias("part"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("b"),
                          F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("q"))
    asked = rows.where(is_query).mapInArrow(routed(min(probes, parts)), schema)
    queries = (asked.select("id", "v", F.explode("parts").alias("part"), F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(query_blocks)).cast("int").alias("q"))
               .select("id", "v", "part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"), "q"))

    def rank(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(candidates) and len(queries):
            c = np.stack(candidates["v"].to_numpy())
            ids = candidates["id"].to_numpy()
            by_id = np.argsort(ids, kind="stable")
            c, ids = c[by_id], ids[by_id]
            for q, v in zip(queries["id"].to_numpy(), queries["v"].to_numpy(), strict=True):
                d = c - v
                d = np.sqrt(np.einsum("ij,ij->i", d, d))
                d[ids == q] = np.inf
                if len(d) > k:
                    edge = np.partition(d, k - 1)[k - 1]
                    near = np.flatnonzero(d <= edge)
                    near = near[np.argsort(d[near], kind="stable")[:k]]
                else:
                    near = np.argsort(d, kind="stable")
                near = near[np.isfinite(d[near])]
                out.append(pd.DataFrame({"query_id": q, "id": ids[near], "score": d[near]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "id": [], "score": []}).astype({"query_id": "int64", "id": "int64"})

    tile = ["part", "b", "q"]
    found = index.groupBy(*tile).cogroup(queries.groupBy(*tile)).applyInPandas(rank, "query_id bigint, id bigint, score double")
    order = Window.partitionBy("query_id").orderBy("score", "id")
    return found.select("query_id", F.row_number().over(order).alias("rank"), "id", "score").where(F.col("rank") <= k)


@register("op1_learned_partition_search")
def op1_learned_partition_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
