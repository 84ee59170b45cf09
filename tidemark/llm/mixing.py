"""Operator 7, mixing sources to target weights by iterative proportional fitting.

Tokens are counted per cell (source, language, topic).  The cells are raked: in turn, the weights of
all cells with one value of a dimension are scaled so that their tokens have the target's share,
until all three margins hold.  A document's probability is its cell's raked tokens over
its cell's tokens, scaled and cut off at 1 where that touches 2% of the tokens at most; it stays if a hash of its id, read
as a number from 0 to 1, is below its probability.  So every row is decided by itself, again the same way
if a task is repeated.

A document's topic is read from its words (``topics``), as the tables name none.  What is read from a text, its topic and its tokens, is read
once where the result has nothing else of the text (``op7_mixing``).

A value that a target does not name falls to ``REST``, whose share is what the named ones leave.  Cells
are therefore at most the product of the targets' sizes (plus one each): that bounds what the
driver rakes, whatever the data.  Cells without tokens stay empty; targets of values that have
no tokens are spread over the others in proportion.

Defined results: null source or language, and a text about no topic, count as ``REST``; a null or blank text has no tokens
and takes its cell's probability; a null id is one value of its own; repeated rows of one id are
kept or dropped together unless their texts differ; an empty table gives no rows; the result has the
input's columns, and ``probability`` if asked for.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import BLANK, kept, register, table
from tidemark.llm.topics import WORDS, topic

REST = "*"

#: The mix the queries and the pipeline aim at: shares of tokens.  No source is asked for a multiple of an even
#: share, as all others would then be dropped down to it: most of the documents stay, however the sources are sized.
TARGETS: dict[str, dict[str, float]] = {
    "source": {"src1": 0.038, "src2": 0.036, "src3": 0.036, REST: 0.89},
    "lang": {"en": 0.60, "de": 0.15, "fr": 0.15, REST: 0.10},
    "topic": {**dict.fromkeys(WORDS, 0.1), REST: 0.4},
}


def tokens(text: Column) -> Column:
    """White-space tokens of a text."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{BLANK}+|{BLANK}+$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, BLANK + "+"))).cast("long")


def rake(cells: Mapping[tuple[str, ...], float], targets: Mapping[str, Mapping[str, float]], tolerance: float = 1e-10,
         rounds: int = 2000) -> dict[tuple[str, ...], float]:
    """The raked share of each cell; margins of values with tokens meet their targets."""
    keys = sorted(k for k, v in cells.items() if v > 0)
    if not keys:
        return {}
    w = np.array([cells[k] for k in keys], float)
    w /= w.sum()
    margins = []
    for d, goal in enumerate(targets.values()):
        values = sorted({k[d] for k in keys})
        share = np.array([goal.get(v, 0.0) for v in values])
        if share.sum() <= 0:
            raise ValueError("a target names no value that the data has")
        margins.append((np.array([values.index(k[d]) for k in keys]), share / share.sum()))
    for _ in range(rounds):
        off = 0.0
        for index, share in margins:
            have = np.bincount(index, w, len(share))
            off = max(off, float(np.abs(have - share).max()))
            w *= np.divide(share, have, out=np.zeros_like(have), where=have > 0)[index]
        if off < tolerance:
            break
    else:
        warnings.warn(f"raking ended after {rounds} rounds with a margin {off:.2g} off its target", stacklevel=2)
    return dict(zip(keys, (w / w.sum()).tolist(), strict=True))


def probabilities(cells: Mapping[tuple[str, ...], float], targets: Mapping[str, Mapping[str, float]], slack: float = 0.02) -> dict[tuple[str, ...], float]:
    """Of each cell, the probability of its documents: raked over counted tokens, scaled and at most 1.

    The scale is the largest sample in which the cells cut off at 1 hold no more than ``slack`` of the
    raked tokens; one tiny cell with a large target so does not shrink the whole sample.
    """
    shares = rake(cells, targets)
    ratio = {k: v / cells[k] for k, v in shares.items()}
    above, top = 0.0, 1.0
    for k in sorted(ratio, key=ratio.get, reverse=True):
        top = ratio[k]
        if above + shares[k] > slack:
            break
        above += shares[k]
    return {k: min(1.0, ratio[k] / top) if k in ratio else 1.0 for k in cells}


def chance(key: Column, text: Column, seed: int = 11) -> Column:
    """A number from 0 to 1 of a document: 53 bits of a keyed hash of its id, or of its text if it has none."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), key, F.when(key.isNull(), text)), 11) / F.lit(float(1 << 53))


def mixed(docs: DataFrame, dimensions: Mapping[str, Column], targets: Mapping[str, Mapping[str, float]] = TARGETS,
          key: str = "doc_id", text: str = "text", seed: int = 11, with_probability: bool = False,
          measures: tuple[Column, Column] | None = None) -> DataFrame:
    """The sampled rows of ``docs``.  ``dimensions`` gives the column of every target; ``measures`` the tokens and the chance of a
    document, which else come from ``key`` and ``text``."""
    if clash := ({"probability"} if with_probability else set()) & set(docs.columns):
        raise ValueError(f"columns of the input clash with results: {sorted(clash)}")
    size, drawn = measures or (tokens(F.col(text)), chance(F.col(key), F.col(text), seed))
    own = "_" * (1 + max(map(len, docs.columns)))  # longer than any name of the input
    names, rate = [f"{own}{i}" for i in range(len(targets))], f"{own}p"
    spark = docs.sparkSession
    cell = [F.when(dimensions[t].isin(*[v for v in goal if v != REST]), dimensions[t]).otherwise(F.lit(REST)).alias(n)
            for n, (t, goal) in zip(names, targets.items(), strict=True)]
    counted = docs.select(*cell, size.alias("n")).groupBy(*names).agg(F.sum("n").alias("n")).collect()
    have = {tuple(r[:-1]): float(r[-1] or 0) for r in counted}  # at most the product of the targets' sizes
    rates = spark.createDataFrame([(*k, p) for k, p in probabilities(have, targets).items()] or [(*[REST] * len(names), 1.0)],
                                  ", ".join(f"{n} string" for n in names) + f", {rate} double")
    out = (docs.select("*", *cell).join(F.broadcast(rates), names)  # bounded by the targets
           .where(drawn < F.col(rate)))
    return out.select(*docs.columns, *([F.col(rate).alias("probability")] if with_probability else []))


def mixed_documents(docs: DataFrame, **more) -> DataFrame:
    return mixed(docs, {"source": F.col("source"), "lang": F.col("lang"), "topic": topic(F.col("text"))}, **more)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the sampled documents."""
    return mixed_documents(docs)


@register("op7_mixing")
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    read = kept(table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", topic(text).alias("topic"), tokens(text).alias("n_tokens"), chance(F.col("doc_id"), text).alias("chance")))
    return mixed(read, {d: F.col(d) for d in TARGETS}, with_probability=True, measures=(F.col("n_tokens"), F.col("chance"))).drop("chance")
