"""Operator 6, sharding: a uniform shuffle with exact shard sizes by a communication matrix.

The rows lie in blocks (by a hash of their content and of their number among equal rows, so that a recomputed task finds the
same blocks and equal rows go their own ways).  How many rows of each block go to each shard is drawn from the multivariate
hypergeometric distribution, which is what a uniform permutation of all rows would do; the
shard sizes are exact by construction.  Inside a block the rows are put in random order and
cut at the drawn counts, then they are exchanged, and each shard is put in random order again.

Only block counts reach the driver: one number for about ``rows_per_block`` rows or ``bytes_per_block`` bytes, and never
more than ``MAX_BLOCKS`` of them.

Defined results: nulls are values like others; equal rows are interchangeable, each keeps a
slot of its own; an empty table gives no rows; with fewer rows than shards some shards are
empty; result columns that the input already has raise.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import kept, register, table

MAX_BLOCKS = 1 << 16


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Good ones among ``draws`` without replacement, by inversion around the mode.

    Values beyond twelve standard deviations are below the rounding of a double.
    """
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    total = good + bad
    share = good / total
    spread = math.sqrt(max(draws * share * (1 - share) * (total - draws) / max(total - 1, 1), 1e-9))
    mode = (draws + 1) * (good + 1) // (total + 2)
    reach = math.ceil(12 * spread) + 20
    k = np.arange(max(low, mode - reach), min(high, mode + reach) + 1, dtype=np.float64)
    up = np.log((good - k[:-1]) * (draws - k[:-1])) - np.log((k[:-1] + 1) * (bad - draws + k[:-1] + 1))
    log_p = np.concatenate(([0.0], np.cumsum(up)))
    p = np.cumsum(np.exp(log_p - log_p.max()))
    return int(k[np.searchsorted(p, rng.random() * p[-1], side="right").clip(0, len(k) - 1)])


def matrix(counts: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """Rows of each block for each shard: row sums are ``counts``, column sums ``sizes``."""
    rng, left, out = np.random.default_rng(seed), list(sizes), []
    for n in counts:
        row, rest, todo = [], sum(left), n
        for room in left:
            rest -= room
            got = hypergeometric(rng, room, rest, todo)
            row.append(got)
            todo -= got
        left = [a - b for a, b in zip(left, row, strict=True)]
        out.append(row)
    return out


#: Copies of one row that a task hands out at once.
AT_ONCE = 100_000


def told_apart(rows: DataFrame, columns: list[str], tag: str) -> DataFrame:
    """``rows`` with ``tag``, a hash of ``columns`` and of the row's number among its equals.

    Equal rows are interchangeable, so they are counted, map-side first, and handed out again with numbers; other rows are not
    touched.  Rows that are equal in ``columns`` but hold a value that cannot be grouped (a map, a variant) are numbered as they come.
    """
    same = rows.withColumn("__same", F.xxhash64(*columns))
    again = kept(same.groupBy("__same").agg(F.count("*").alias("n")).where("n > 1").select("__same"))
    if again.isEmpty():
        return same.withColumn(tag, F.xxhash64("__same", F.lit(0).cast("long"))).drop("__same")
    once = same.join(again, "__same", "left_anti").withColumn("__nth", F.lit(0).cast("long"))
    many = same.join(again, "__same", "left_semi")
    if set(columns) == set(rows.columns):
        counted = many.groupBy(*many.columns).agg(F.count("*").alias("__n"))
        parts = counted.withColumn("__from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, F.lit(AT_ONCE).cast("long"))))
        parts = parts.repartition("__same", "__from")
        numbered = parts.withColumn("__nth", F.explode(F.sequence("__from", F.least(F.col("__n"), F.col("__from") + AT_ONCE) - 1))).drop("__n", "__from")
    else:
        numbered = many.withColumn("__nth", F.row_number().over(Window.partitionBy("__same").orderBy("__same")).cast("long") - 1)
    return once.unionByName(numbered).withColumn(tag, F.xxhash64("__same", "__nth")).drop("__same", "__nth")


def shuffled_shards(rows: DataFrame, shards: int = 16, key: str = "doc_id", seed: int = 7, rows_per_block: int = 500_000,
                    bytes_per_block: int = 64 << 20, least_blocks: int = 64) -> DataFrame:
    """All ``rows`` with ``shard`` and a gapless ``slot`` in it; shard sizes differ by one at most."""
    if clash := {"shard", "slot"} & set(rows.columns):
        raise ValueError(f"columns of the input clash with results: {sorted(clash)}")
    spark, names = rows.sparkSession, rows.columns
    own = [f"__c{i}" for i in range(len(names))]  # so that no name of the input meets one of these here
    fields = rows.schema.fields
    hashable = [o for o, f in zip(own, fields, strict=True) if "map<" not in f.dataType.simpleString() and f.dataType != T.VariantType()]
    sized = [F.octet_length(F.col(o)) for o, f in zip(own, fields, strict=True) if f.dataType in (T.StringType(), T.BinaryType())]
    rows = rows.toDF(*own)
    n, size = rows.agg(F.count("*"), F.sum(sum((F.coalesce(x, F.lit(0)).cast("long") for x in sized), F.lit(8 * len(own)).cast("long")))).first()
    hashed = told_apart(rows, hashable, "__own")
    tagged = hashed.withColumn("_tag", F.xxhash64(F.lit(seed), "__own")).drop("__own")
    blocks = min(MAX_BLOCKS, max(least_blocks, n // rows_per_block, (size or 0) // bytes_per_block))
    blocked = tagged.select("*", F.pmod(F.xxhash64(F.lit(seed + 1), "_tag"), F.lit(blocks)).cast("int").alias("_block"))
    counted = {r[0]: r[1] for r in blocked.groupBy("_block").count().collect()}  # at most MAX_BLOCKS rows
    order = sorted(counted)
    n = sum(counted.values())
    sizes = [n // shards + (i < n % shards) for i in range(shards)]
    drawn = matrix([counted[b] for b in order], sizes, seed)
    cuts = spark.createDataFrame([(b, np.cumsum(row).tolist()) for b, row in zip(order, drawn, strict=True)],
                                 "_block int, _cuts array<bigint>")

    local = Window.partitionBy("_block").orderBy(F.xxhash64(F.lit(seed + 2), "_tag"), "_tag")
    placed = (blocked.select("*", F.row_number().over(local).alias("_at")).join(cuts, "_block")
              .select(*own, "_tag", F.size(F.filter("_cuts", lambda c: c < F.col("_at"))).alias("shard")))
    # the second permutation, by parts of each shard so that no shard is one task's sort
    parts = max(1, math.ceil(blocks / shards))
    mixed = F.xxhash64(F.lit(seed + 3), "_tag")
    placed = placed.select("*", mixed.alias("_mix"), F.pmod(F.xxhash64(F.lit(seed + 4), "_tag"), F.lit(parts)).alias("_part"))
    ends = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy("shard", "_part").count().select(
        "shard", "_part", F.coalesce(F.sum("count").over(ends), F.lit(0)).alias("_before"))
    within = Window.partitionBy("shard", "_part").orderBy("_mix", "_tag")
    return (placed.select("*", F.row_number().over(within).alias("_at")).join(before, ["shard", "_part"])
            .select(*[F.col(o).alias(c) for o, c in zip(own, names, strict=True)], "shard", (F.col("_before") + F.col("_at") - 1).cast("long").alias("slot")))


@register("op6_sharding")
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return shuffled_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
