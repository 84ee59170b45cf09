"""Ranked search against the score of every document."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """For each item its scores and ids, highest first."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    big_n, big_l = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = {}
    for item, text in items:
        found = []
        for i, b, n in bags:
            m = 10 + 90 * n * big_n // big_l
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * b[t]) // (1000 * b[t] + 8 * m)) for t in set(terms(text)) if t in b)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out[item] = [(r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return out


def corpus(seed, n):
    rng = np.random.default_rng(seed)
    words = ["the", "The", "naïve", "Ünder", "x1", "42", "a", "ſ", "K", "日本", *[f"w{i}" for i in range(60)]]
    share = 1 / np.arange(1, len(words) + 1)
    marks = [" ", ", ", "\n", "--", " ", "_", "\x00"]
    docs = []
    for i in range(n):
        picked = rng.choice(words, rng.integers(0, 40), p=share / share.sum())
        docs.append((i * 7 % n, "".join(str(w) + marks[rng.integers(len(marks))] for w in picked)))
    docs += [(n + 1, None), (n + 2, ""), (n + 3, " ,;!"), (None, "the w1 w2"), (n + 4, "w5 " * 30_000 + "w6"), (n + 5, "the w9"), (n + 5, "the w9 w9")]
    docs += [(n + 10 + j, "equal w3 w4") for j in range(15)]
    items = [(j, " ".join(str(w) for w in rng.choice(words, 12, p=share / share.sum()))) for j in range(12)]
    items += [(50, None), (51, "..."), (52, "nowhere"), (53, "w3, W4 w3"), (54, "THE"), (55, " ".join(words) * 3), (56, "w5")]
    return docs, items


@pytest.mark.parametrize("block, size", [(4096, 64 << 20), (7, 64 << 20), (300, 2000)])
def test_ranks_equal_those_of_all_scores(spark, block, size):
    docs, items = corpus(2, 400)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"ids": F.lit("clash"), "terms": F.lit(1)}).repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({"number": F.lit("clash"), "score": F.lit(1)})
    index = lexical.kept(lexical.indexed(df, block=block, block_bytes=size))
    got = {}
    for r in lexical.ranked(index, asked, at_once=5).orderBy("item", "rank").collect():
        got.setdefault(r["item"], []).append((r["rank"], r["doc"], r["score"]))
    assert got == {i: found for i, found in brute(docs, items).items() if found}


def test_equal_items_are_each_answered_and_empty_tables_give_nothing(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "b c"), (3, "c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a"), (1, "a"), (None, "c")], "item_id long, text string")
    index = lexical.indexed(docs)
    assert [tuple(r)[:3] for r in lexical.ranked(index, items).orderBy("item", "rank", "doc").collect()] == [(None, 1, 3), (None, 2, 2), (1, 1, 1), (1, 1, 1)]
    assert lexical.ranked(index, items.limit(0)).count() == lexical.ranked(lexical.indexed(docs.limit(0)), items).count() == 0
    assert lexical.ranked(lexical.indexed(docs.select("doc_id", F.lit(None).cast("string").alias("text"))), items).count() == 0


@pytest.mark.parametrize("cells, at_once", [(lexical.CELLS, lexical.AT_ONCE), (0, 8)])
def test_bounds_are_the_largest_impacts_and_spare_work(monkeypatch, cells, at_once):
    monkeypatch.setattr(lexical, "AT_ONCE", at_once)
    monkeypatch.setattr(lexical, "CELLS", cells)
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.4, 60) % 500) for _ in range(3000)]
    block = lexical._block([np.arange(3000)], [pa.array([t.encode() for t in texts])])
    row = lexical._columns(block, 0)
    wanted = {f"w{i}".encode(): i for i in range(40, 52)}
    df = dict(zip(row["terms"].tolist(), row["dfs"].tolist(), strict=True))
    weight = np.array([0] * 40 + [math.floor(1000 * math.log(6002 / (2 * df[f"w{i}".encode()] + 1))) for i in range(40, 52)])
    tables = lexical.Tables(row, wanted, weight, (3000, int(row["lengths"].sum())))
    rows = np.array([tables.row[i] for i in wanted.values()])
    alone = np.zeros((len(rows), 3000), np.int64)
    for j, r in enumerate(rows):
        s, e = tables.start[r], tables.start[r] + df[f"w{40 + j}".encode()]
        alone[j, tables.at[s:e]] = tables.impact[s:e]
    for lo, hi in [(0, 3000), (5, 6), (17, 400), (2000, 2999), (9, 9)]:
        bound, place = tables.bounds(rows, np.array([lo]), np.array([hi]))
        assert bound[0] == (alone[:, lo:hi].max(axis=1).sum() if hi > lo else 0)
        assert hi == lo or alone[:, place[0]].max() == alone[:, lo:hi].max()
    none = np.zeros(0, np.int64)
    scores, ids, spent = tables.search(np.array(list(wanted.values())), none, none, 10)
    assert sorted(scores.tolist()) == sorted(alone.sum(axis=0))[-10:] and spent < 3000 * 3


def test_the_index_lies_a_block_a_file(spark):
    docs = spark.range(0, 700, 1, 1).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("common"), F.concat(F.lit("w"), F.col("id") % 9)).alias("text"))
    index = lexical.stored(lexical.indexed(docs, block=100))
    assert index.count() == len(index.inputFiles()) == 7
    items = spark.createDataFrame([(1, "w3 none"), (2, "w5")], "item_id long, text string")
    got = [(r.item, r.doc) for r in lexical.ranked(index, items).orderBy("item", "rank").collect()]
    assert got == [(1, 3 + 9 * i) for i in range(10)] + [(2, 5 + 9 * i) for i in range(10)]
