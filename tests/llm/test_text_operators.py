"""Operators on texts against plain Python, and the rows that are easy to get wrong."""

import hashlib
import itertools
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import check
from tests.conftest import SMALL
from tidemark.llm import lines, nearcopies, packing, quality, sharding, substrings

DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string"
EDGES = [(None, "a null id with some words of its own here and there"), (2, None), (3, ""), (4, " \t\n\x0b "), (5, "one"), (5, "one"), (5, "two"), (6, "x" * 50_000)]


def words(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "e") for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def corpus(spark):
    """Random prose with copies, near copies, shared passages and repeated lines."""
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(300)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, texts = prose(30), []
    for i in range(60):
        w = prose(rng.randint(3, 200))
        if i % 4 == 0:
            at = rng.randint(0, len(w))
            w[at:at] = passage[rng.randint(0, 12):]
        lines_ = [" ".join(w[j:j + 12]) for j in range(0, len(w), 12)]
        if i % 5 == 0:
            lines_.insert(0, "the same line stands at the head of many of these texts")
        texts.append("\n".join(lines_))
    for i in range(0, 60, 3):
        w = texts[i].split(" ")
        for _ in range(1 + len(w) // 60):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        texts.append(" ".join(w))
        if i % 6 == 0:
            texts.append(texts[i])
    rng.shuffle(texts)
    return [*[(100 + i, t) for i, t in enumerate(texts)], *EDGES]


@pytest.mark.parametrize("name", ["op5_quality_rules", "op2_substring_dedup"])
def test_query_agrees_with_sql(spark, name):
    diff, n = check.compare(entry.queries()[name](spark, SMALL), check.oracle_connection(SMALL), entry.oracle_sql()[name])
    assert diff is None and n == 200, diff


def test_quality_measures(spark, corpus):
    got = quality.judged(frame(spark, corpus)).collect()
    assert len(got) == len(corpus)
    for r in got:
        w = words(r.text)
        windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        seen = Counter(windows)
        covered = {i + k for i, x in enumerate(windows) if seen[x] > 1 for k in range(5)}
        own = [x for x in (r.text or "").split("\n") if words(x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words, r.n_dup_lines) == (len(w), sum(map(len, w)), len(covered), len(own) - len(set(own)))
        assert r.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
        assert not (r.kept and r.base_failed) and r.kept == (not r.base_failed and not r.failed_rules)


def test_quality_rules_and_clashes(spark):
    clean = "The house of the river was in the north and it is a place that we like to be at with a friend"
    rows = [(1, clean), (2, clean.replace(" ", "#### ")), (3, "\n".join([clean] * 5)), (4, "a b c d e f " * 9)]
    kept = {r.doc_id: r.kept for r in quality.judged(frame(spark, rows)).collect()}
    assert kept == {1: True, 2: False, 3: False, 4: False}
    assert quality.stage(spark, frame(spark, rows), "").columns == [c.split()[0] for c in DOCS.split(", ")]
    assert quality.judged(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        quality.judged(frame(spark, rows).withColumnRenamed("extra", "kept"))


def brute_windows(rows, size=13):
    first = {}
    order = [(float("inf") if i is None else i, t) for i, t in rows]
    for i, t in order:
        w = words(t)
        for p in range(len(w) - size + 1):
            g = tuple(w[p:p + size])
            first[g] = min(first.get(g, float("inf")), i)
    out = Counter()
    for (i, t), (key, _) in zip(order, rows, strict=True):
        w = words(t)
        gone = {p + k for p in range(len(w) - size + 1) if first[tuple(w[p:p + size])] < i for k in range(size)}
        out[(key, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone))] += 1
    return out


@pytest.mark.parametrize("at_once", [12 << 20, 400])
def test_substrings_are_all_windows_of_smaller_documents(spark, corpus, at_once, monkeypatch):
    monkeypatch.setattr(substrings, "AT_ONCE", at_once)
    long = " ".join(f"w{i % 997}" for i in range(20_000))
    rows = [*corpus, (7, long), (8, "head " + long), (9, "a b " * 40), (10, "a b " * 41)]
    df = frame(spark, rows).repartition(5)
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.factored(df).collect())
    assert got == brute_windows(rows)
    for r in substrings.factored(df).where("n_removed > 0").collect():
        assert sum(s["words"] for s in r.spans) == r.n_removed and all(s["words"] >= 13 for s in r.spans)
    assert substrings.factored(frame(spark, [])).count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = list(itertools.accumulate(range(1, len(b) + 1), lambda left, j: min(left + 1, row[j] + 1, row[j - 1] + (x != b[j - 1])), initial=i))
    return row[-1]


def test_near_lines_are_all_pairs_within_the_threshold(spark):
    rng = random.Random(8)
    base = ["".join(rng.choices("abcde fgh", k=rng.randint(27, 60))).strip() + "x" for _ in range(25)]
    near = []
    for x in base * 6:
        y = list(x)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(y))
            y[at:at + rng.randint(0, 1)] = rng.choice(["", "q", "é"])
        near.append("".join(y))
    distinct = sorted(set(base + near))
    df = lines.lines_of(frame(spark, list(enumerate(distinct))), "doc_id", "text")
    name = {r.h: r.line for r in df.collect()}
    got = [frozenset((name[r.a], name[r.b])) for r in lines.near_lines(df).collect()]
    want = {frozenset(p) for p in itertools.combinations(distinct, 2) if max(map(len, p)) >= 30 and abs(len(p[0]) - len(p[1])) <= 2 and edits(*p) <= 2}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 50


def test_near_lines_of_lengths_about_the_counted_ends(spark):
    rng = random.Random(9)
    distinct = set()
    for n in [*range(93, 104), 60, 120, 150]:
        line = "".join(rng.choices("enatrisodhl xyz", k=n)).strip() + "q"
        for _ in range(4):
            y = list(line)
            for _ in range(rng.randint(0, 3)):
                at = rng.choice([0, 20, 46, 47, 48, 49, len(y) - 49, len(y) - 48, len(y) - 47, len(y) - 2])
                y[at:at + rng.randint(0, 1)] = rng.choice(["", "e", "é"])
            distinct.add("".join(y))
    distinct = sorted(distinct)
    df = lines.lines_of(frame(spark, list(enumerate(distinct))), "doc_id", "text")
    name = {r.h: r.line for r in df.collect()}
    got = {frozenset((name[r.a], name[r.b])) for r in lines.near_lines(df).collect()}
    assert got == {frozenset(p) for p in itertools.combinations(distinct, 2) if abs(len(p[0]) - len(p[1])) <= 2 and edits(*p) <= 2} and len(got) > 20


def test_lines_made_from_one_by_other_words_are_not_listed_in_pairs(spark):
    rng = random.Random(10)
    words = ["".join(rng.choices("enatrisodhlu", k=rng.randint(2, 6))) for _ in range(16)]
    lists = [[*words[:at], "".join(rng.choices("enatrisodhlu", k=rng.randint(1, 4))), *words[at + 1:]] for at in range(16) for _ in range(12)]
    distinct = sorted({" ".join(x) for x in lists} | {" ".join(words), " ".join(words) + "s", " ".join(words)[1:]})
    df = lines.lines_of(frame(spark, list(enumerate(distinct * 2))), "doc_id", "text")
    name = {r.h: r.line for r in df.collect()}
    got = Counter(frozenset((name[r.a], name[r.b])) for r in lines.near_lines(df).collect())
    assert got == Counter(frozenset(p) for p in itertools.combinations(distinct, 2) if abs(len(p[0]) - len(p[1])) <= 2 and edits(*p) <= 2) and len(got) > 20
    # a line has 12 substrings to look up; the pairs of lines that share one are 13,994 here
    assert lines._met(df, 2, 30).count() <= 12 * len(distinct)


def test_repeated_lines_go_and_first_ones_stay(spark):
    long = "this is a rather long line of a text, number one"
    rows = [(1, f"{long}\n\nshort\nshort"), (2, f"short\nother\n{long}!"), (None, "short\nmine"), *EDGES[1:]]
    df = frame(spark, rows)
    out = lines.without_repeats(df)
    assert out.columns == df.columns
    got = {r.doc_id: r.text for r in out.collect() if r.doc_id in (1, None)}
    assert got == {1: f"{long}\n\nshort", None: "mine"}
    assert {r.text for r in out.where("doc_id = 2").collect()} == {"other", None}
    assert out.count() == len(rows) and lines.without_repeats(frame(spark, [])).count() == 0


def test_documents_of_null_and_repeated_ids_lose_their_own_repeats_only(spark):
    rows = [(1, "head\nsecond"), (None, "x1\nsecond\nx3"), (None, "y1\ny2\ny3\nx3"), (None, "z1\nz2\nx3"), (7, "a1\nsecond\na3"), (7, "b1\nb2\na3")]
    got = Counter(x for r in lines.without_repeats(frame(spark, rows)).collect() for x in r.text.split("\n"))
    assert got == Counter({x for _, t in rows for x in t.split("\n")})


def test_near_copies_of_null_and_repeated_ids(spark):
    text = lambda k: " ".join(f"{k}w{i}" for i in range(60))
    rows = [(None, text("a")), (None, text("b")), (None, text("a") + " end"), (4, text("c")), (4, text("d")), (5, text("c") + " end"), (6, text("d") + " end")]
    got = Counter((r.doc_id, r.class_id, r.class_size) for r in nearcopies.classes(frame(spark, rows)).collect())
    assert got == Counter([(None, None, 2), (None, None, 1), (None, None, 2), (4, 4, 2), (4, 4, 2), (5, 4, 2), (6, 4, 2)])
    named = {(r.class_id, r.class_copy) for r in nearcopies.classes(frame(spark, rows)).collect()}
    assert len(named) == 4


def test_the_stage_loses_no_text_of_a_repeated_id(spark):
    text = lambda k: " ".join(f"{k}w{i}" for i in range(60))
    rows = [(1, text("a")), (1, text("b")), (2, text("b")), (3, text("c")), (4, text("c")), (None, text("d")), (None, text("d")), (None, text("e")), (None, text("a")), (7, None), (None, None), (1, text("a"))]
    df = frame(spark, rows)
    stay = [(r.doc_id, None if r.text is None else r.text[0]) for r in nearcopies.stage(spark, df, "").collect()]
    assert Counter(stay) == Counter([(1, "a"), (1, "b"), (3, "c"), (None, "d"), (None, "e"), (7, None), (None, None)])


def alike(a, b):
    def grams(t):
        w = words(t)
        return [tuple(w[i:i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else [])
    x, y = grams(a), grams(b)
    row = [0] * (len(y) + 1)
    for g in x:
        new = [0]
        for j, h in enumerate(y):
            new.append(max(new[-1], row[j + 1], row[j] + (g == h)))
        row = new
    return bool(x and y) and 5 * row[-1] >= 4 * (len(x) + len(y) - row[-1])


def test_near_copies_are_the_components_of_all_alike_pairs(spark, corpus):
    rows = [r for r in corpus if r[0] not in (2, 6)]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = rows[i][1], rows[j][1]
        if a is not None and b is not None and (a == b or alike(a, b)):
            parent[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i][0])
    want = Counter((k, min((x for x in g if x is not None), default=None), len(g)) for g in groups.values() for k in g)
    got = Counter((r.doc_id, r.class_id, r.class_size) for r in nearcopies.classes(frame(spark, rows).repartition(4)).collect())
    assert got == want
    df = frame(spark, rows)
    stay = nearcopies.stage(spark, df, "")
    assert stay.columns == df.columns
    assert stay.count() == len(groups)
    assert nearcopies.classes(frame(spark, [])).count() == 0


def test_copies_that_are_alike_to_their_base_only_are_one_class(spark):
    rng, rows, size = random.Random(12), [], {}
    for group, n in enumerate([3, 20, 120, 1000]):
        base = [f"g{group}w{rng.randrange(10**6)}" for _ in range(400)]
        for i in range(n):
            w = list(base)
            for at in rng.sample(range(4, 396, 7), 8) if i != n // 2 else []:  # the base has a middle id
                w[at] = f"new{rng.randrange(10**9)}"
            rows.append((1000 * group + i, " ".join(w)))
        size[1000 * group] = n
    assert not alike(rows[0][1], rows[2][1]) and alike(rows[0][1], rows[1][1])
    got = nearcopies.classes(frame(spark, rows).repartition(4)).collect()
    assert {(r.doc_id, r.class_id, r.class_size) for r in got} == {(i, i // 1000 * 1000, size[i // 1000 * 1000]) for i, _ in rows}


def test_texts_of_the_pivots_component_meet_under_what_the_texts_outside_leave_open(spark):
    rng, percent = random.Random(5), 80
    need = lambda n, m: -(-percent * (n + m) // (100 + percent))
    pivot, pool, met = set(range(100)), range(1000, 1030), []
    for i in range(160):  # half of them like the pivot; the groups have texts outside of different distance
        inside, far = i % 2 == 0, i >= 80
        of_pivot = rng.randint(91, 97) if inside else rng.randint(20, 40) if far else rng.randint(78, 88)
        met.append((int(far), i, inside, set(rng.sample(range(100), of_pivot)) | set(rng.sample(pool, rng.randint(2, 100 - of_pivot if of_pivot > 88 else 12)))))
    rows = []
    for a, b, inside, own in met:
        o, n = len(own & pivot), len(own)
        outside = max((100 + percent) * len(x & pivot) - percent * len(x) for g, _, i, x in met if g == a and not i)
        lacks = need(n, -(-percent * n // 100)) - o
        rest = sorted(own - pivot)
        rows.append((a, b, n, o, 0 if inside else b, 0, rest[:max(0, len(rest) - max(lacks, 1) + 1)], lacks <= 0, outside))
    df = spark.createDataFrame(rows, "a long, b long, n int, o int, root long, aroot long, others array<long>, tight boolean, outside long")
    got = {r.b: r for r in nearcopies._needed(df, percent).collect()}
    assert all(got[b].others == others and got[b].tight == tight for _, b, _, _, root, _, others, tight, _ in rows if root)
    assert not any(got[b].others or got[b].tight for a, b, inside, _ in met if a and inside)
    pairs = [(b, c) for (g, b, i, x), (h, c, j, y) in itertools.product(met, met) if g == h and i and not j and len(x & y) >= need(len(x), len(y))]
    assert len(pairs) > 50
    assert all(set(got[b].others) & set(got[c].others) or got[b].tight and got[c].tight for b, c in pairs)


def test_few_texts_outside_do_not_make_all_copies_meet_again(spark, monkeypatch):
    rng, rows, written = random.Random(6), [], []
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    for i in range(400):
        w = list(base)
        for at in rng.sample(range(4, 296, 7), 3):
            w[at] = f"new{rng.randrange(10**9)}"
        rows.append((i, " ".join(w)))
    for i in range(400, 440):  # these share a passage only
        rows.append((i, " ".join(base[:150] + [f"own{rng.randrange(10**9)}" for _ in range(100)])))
    kept = nearcopies.kept

    def seen(df):
        out = kept(df)
        if {"others", "c"} <= set(out.columns):
            written.append(out.where("root = aroot").agg(F.count("*"), F.sum(F.size("others"))).first())
        return out

    monkeypatch.setattr(nearcopies, "kept", seen)
    got = nearcopies.classes(frame(spark, rows).repartition(4)).collect()
    assert {(r.doc_id, r.class_id, r.class_size) for r in got} == {(i, 0, 400) if i < 400 else (i, i, 1) for i, _ in rows}
    assert written[0][0] > 300 and not any(r[1] for r in written)


def seen(monkeypatch, columns):
    """The numbers of rows of the kept tables that have these columns."""
    kept, counts = nearcopies.kept, []

    def counted(df):
        out = kept(df)
        if set(columns) <= set(out.columns):
            counts.append(out.count())
        return out

    monkeypatch.setattr(nearcopies, "kept", counted)
    return counts


def test_texts_with_passages_in_common_do_not_meet_under_their_other_kmers(spark, monkeypatch):
    rng, rows = random.Random(8), []
    passages = [[f"p{p}w{rng.randrange(10**6)}" for _ in range(60)] for p in range(6)]
    for i in range(400):  # one passage of all and two of a few others, and as many words of their own
        w = passages[0] + passages[1 + i % 5] + passages[1 + (i + 1 + i // 5 % 4) % 5]
        rows.append((i, " ".join(w + [f"own{rng.randrange(10**9)}" for _ in range(150)])))
    under, judged = seen(monkeypatch, ["g", "id", "n", "w"]), seen(monkeypatch, ["ok", "tight"])
    got = nearcopies.classes(frame(spark, rows).repartition(4)).collect()
    assert {(r.doc_id, r.class_id, r.class_size) for r in got} == {(i, i, 1) for i, _ in rows}
    assert judged and sum(judged) < 25 * len(rows) and max(under[2:]) < len(rows)


def test_buckets_of_the_same_texts_are_one(spark, monkeypatch):
    rng, rows = random.Random(9), []
    for i in range(0, 200, 2):
        w = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        rows += [(i, " ".join(w)), (i + 1, " ".join([*w[:100], "new", *w[100:]]))]
    buckets = seen(monkeypatch, ["g", "id", "n", "w"])
    got = nearcopies.classes(frame(spark, rows).repartition(4)).collect()
    assert {(r.doc_id, r.class_id, r.class_size) for r in got} == {(i, i // 2 * 2, 2) for i, _ in rows}
    assert buckets[0] <= 1.2 * len(rows)


@pytest.mark.parametrize("at_once", [3, 1000])
def test_crowded_kmers_are_those_of_texts_of_two_components(spark, at_once, monkeypatch):
    rng, few = random.Random(10), [-7, 1 << 62, 5]
    monkeypatch.setattr(nearcopies, "PART", 20)
    rows = [(a, 1000 * a + i, 50, i, rng.choice([1, 2, 1000 * a + i]), c, sorted({*rng.sample(range(-300, 300), rng.randint(0, 12)), *few[:rng.randint(0, 3)]}))
            for a, c in ((1, 90), (2, 7), (3, 1)) for i in range(c)]
    df = spark.createDataFrame(rows, "a long, b long, n int, w long, root long, c long, others array<long>").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", at_once)
    try:
        parts = df.mapInArrow(nearcopies.dealt, nearcopies._PARTS)
        got = Counter((r.g, r.id, r.n, r.w) for r in parts.repartition("a", "part").sortWithinPartitions("a", "part")
                      .mapInArrow(nearcopies.crowded, "g long, id long, n int, w long").collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    roots = {}
    for a, b, _, _, root, _, others in rows:
        for x in others:
            roots.setdefault((a, x), []).append((b, root))
    want = Counter(frozenset(b for b, _ in m) for m in roots.values() if len({r for _, r in m}) > 1)
    buckets = {}
    for g, b, _, _ in got:
        buckets.setdefault(g, set()).add(b)
    assert Counter(map(frozenset, buckets.values())) == want and max(got.values()) == 1
    assert max(map(len, want)) > 3 * 20


def test_the_order_of_common_kmers_changes_no_class(spark, corpus, monkeypatch):
    rows = [r for r in corpus if r[0] not in (2, 6)]
    of = lambda: Counter((r.doc_id, r.class_id, r.class_size) for r in nearcopies.classes(frame(spark, rows).repartition(4)).collect())
    want = of()
    monkeypatch.setattr(nearcopies, "FEW", 1)
    monkeypatch.setattr(nearcopies, "SAMPLE", 4)
    assert of() == want


def test_common_length_is_the_longest_common_subsequence():
    rng = np.random.default_rng(4)
    for _ in range(60):
        a, b = rng.integers(0, 6, rng.integers(0, 40)), rng.integers(0, 6, rng.integers(0, 40))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(max(new[-1], row[j + 1], row[j] + (x == y)))
            row = new
        assert nearcopies.common_length(a.astype(np.uint64), b.astype(np.uint64), 80) == row[-1]


def test_shards_are_exact_and_gapless(spark, corpus):
    df = frame(spark, corpus)
    got = sharding.shuffled_shards(df, shards=7, least_blocks=5)
    rows = got.collect()
    assert Counter(r.text for r in rows) == Counter(t for _, t in corpus)
    per = Counter(r.shard for r in rows)
    assert max(per.values()) - min(per.values()) <= 1 and len(per) == 7
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(per[s])) for s in per)
    assert sharding.shuffled_shards(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        sharding.shuffled_shards(df.withColumnRenamed("extra", "slot"))


def test_matrix_draws_like_a_permutation():
    counts, sizes = [40, 25, 35], [50, 30, 20]
    drawn = np.array([sharding.matrix(counts, sizes, s) for s in range(3000)])
    assert (drawn.sum(2) == counts).all() and (drawn.sum(1) == sizes).all()
    mean, n = drawn.mean(0), 100
    for i, j in itertools.product(range(3), range(3)):
        p = sizes[j] / n
        variance = counts[i] * p * (1 - p) * (n - counts[i]) / (n - 1)
        assert abs(mean[i, j] - counts[i] * p) < 5 * (variance / 3000) ** 0.5
        assert abs(drawn[:, i, j].var() / variance - 1) < 0.15


def test_pieces_are_the_tokenizers_ids_and_fit(spark, corpus):
    odd = [(20, "Ünïcode ÉCLAIR no-break   é <|endoftext|> it's 12,5\r\nend"), (21, "ä " * 3000), (22, "word " * 9000)]
    rows = [*corpus, *odd]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for i, t in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        for p, at in enumerate(range(0, len(ids), 4096)):
            want[(i, p, at, len(ids[at:at + 4096]), zlib.crc32(ids[at:at + 4096].tobytes()))] += 1
    got = packing.packed_documents(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    fill = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 4096 and len(fill) <= -(-sum(fill.values()) // 4096) + 1
    assert packing.packed_documents(frame(spark, [])).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_plan_keeps_every_limit(rule):
    rng = np.random.default_rng(2)
    counts = Counter(rng.integers(1, 100, 3000).tolist())
    plan = packing.plan(
        {k: v for k, v in counts.items() if k <= 50}, size=100, max_docs=4, max_cost=3000, rule=rule)
    bins, got = {}, Counter()
    for length, rank, n, first, offset in plan.tolist():
        got[length] += n
        for s in range(first, first + n):
            bins.setdefault(s, []).append((offset, length))
    assert got == {k: v for k, v in counts.items() if k <= 50}
    for own in bins.values():
        own.sort()
        assert all(a + b == c for (a, b), (c, _) in itertools.pairwise(own)) and own[0][0] == 0
        assert sum(x for _, x in own) <= 100 and len(own) <= 4 and sum(x * x for _, x in own) <= 3000


@pytest.mark.parametrize("counts", [{1: 40_960}, {5: 8190}, {i: 3000 for i in range(1, 17)}, {4090: 10, 4000: 10, 1: 1020}])
def test_plan_wastes_no_sequence_on_short_pieces(counts):
    plan = packing.plan(counts)
    got, last = Counter(), 0
    for length, _, n, first, offset in plan.tolist():
        got[length] += n
        last = max(last, first + n)
        assert offset + length <= 4096
    least = -(-8190 // 819) if counts == {5: 8190} else -(-sum(k * v for k, v in counts.items()) // 4096)
    assert got == counts and last == least


def test_short_texts_are_packed_by_their_tokens(spark):
    rows = [(i, None if i % 2 else "") for i in range(9000)]
    assert packing.packed_documents(frame(spark, rows)).select("sequence_id").distinct().count() == 3


def test_sha_is_of_the_kept_words(spark):
    r = entry.queries()["op2_substring_dedup"](spark, SMALL).where(F.col("n_removed") == 0).first()
    text = duckdb.connect().execute(f"SELECT text FROM '{SMALL}/documents.parquet' WHERE doc_id = {r.doc_id}").fetchall()[0][0]
    assert r.kept_sha256 == hashlib.sha256(" ".join(words(text)).encode()).hexdigest()


def test_equal_pieces_lie_in_all_buckets(spark):
    rows = [(None, "")] * 3000 + [(1, "a b c"), (2, None)]
    out = packing.packed_documents(frame(spark, rows).repartition(4))
    assert out.count() == 3002 and out.groupBy("sequence_id", "offset").count().where("count > 1").isEmpty()
    assert out.select("sequence_id").distinct().count() == 1  # 3,005 tokens
    shares = [r["count"] for r in out.where("length = 1").groupBy((F.col("offset") / 300).cast("int")).count().collect()]
    assert len(shares) >= 10


def test_equal_rows_are_shuffled_like_others(spark):
    rows = [(i, f"text {i}") for i in range(2000)] + [(-1, "the same")] * 500 + [(None, None)] * 100
    df = frame(spark, rows).selectExpr("doc_id", "text", "1 AS _at", "2 AS _tag", "3 AS _block", "4 AS _part", "5 AS __c0").repartition(3)
    out = sharding.shuffled_shards(df)
    assert out.columns == [*df.columns, "shard", "slot"] and out.drop("shard", "slot").exceptAll(df).isEmpty() and out.count() == 2600
    got = out.select("doc_id", "shard", "slot").collect()
    per = Counter(r.shard for r in got)
    assert set(per.values()) <= {162, 163} and all(sorted(r.slot for r in got if r.shard == s) == list(range(per[s])) for s in per)
    copies = Counter(r.shard for r in got if r.doc_id == -1)
    assert min(copies.values()) >= 14 and max(copies.values()) <= 52  # 31 are due to each
    runs = sum(a + 1 == b for s in per for a, b in itertools.pairwise(sorted(r.slot for r in got if r.doc_id == -1 and r.shard == s)))
    assert 50 <= runs <= 150  # 500 * 500 / 2600 in a random order


def test_rows_with_maps_are_sharded(spark):
    df = spark.range(40).selectExpr("id % 5 AS doc_id", "map('a', id) AS m")
    out = sharding.shuffled_shards(df, shards=4).collect()
    assert sorted(r.m["a"] for r in out) == list(range(40)) and len({(r.shard, r.slot) for r in out}) == 40


def test_words_and_sketches_are_those_of_a_plain_reading():
    import re

    import pyarrow as pa

    rng = np.random.default_rng(3)
    texts = ["", None, "a", " a\tb\n", "x" * 200 + " é " + "y" * 64 + " " + "y" * 65, "a", "b c", None, "é", "a\x0bb\x0cc\rd", "a\xa0b", " "]
    texts += [" ".join(rng.choice(["on", "the", "thereafter", "of", "é" * 9, "or"], n)) for n in (3, 40, 300)]
    for lo, hi in ((0, len(texts)), (3, 9), (1, 2), (4, 4)):
        own = pa.array(texts, pa.string()).slice(lo, hi - lo)
        words, row = nearcopies.hashed_words(own)
        want = [(w, i) for i, t in enumerate(texts[lo:hi]) for w in re.split("[ \t-\r]+", t or "") if w]
        assert row.tolist() == [i for _, i in want] and len(words) == len(want)
        assert len(set(words.tolist())) == len({w for w, _ in want}) == len(set(zip(words.tolist(), (w for w, _ in want))))
    kmers, row = nearcopies.shingles(pa.array(texts), 2)
    x = nearcopies.labelled(kmers, row)
    came, plain = Counter(), []
    for k, r in zip(kmers.tolist(), row.tolist()):
        plain.append((r, k, came[r, k]))
        came[r, k] += 1
    assert len(set(zip(x.tolist(), row.tolist()))) == len(set(plain)) == len(plain) == len(x)
    rows, which, _ = nearcopies.sketch(x, row, len(texts), 6, 4)
    assert sorted(zip(rows.tolist(), which.tolist())) == [(r, e) for r in sorted(set(row.tolist())) for e in range(6)]
    # a text of many k-mers is sketched alike beside any others, and in its order
    alone = nearcopies.sketch(x[row == len(texts) - 1], np.zeros(int((row == len(texts) - 1).sum()), np.int64), 1, 6, 4)[2]
    assert alone.tolist() == nearcopies.sketch(x, row, len(texts), 6, 4)[2][rows == len(texts) - 1].tolist()


def test_words_are_hashed_without_a_call_for_each(monkeypatch):
    import pyarrow as pa
    import xxhash

    calls = []
    monkeypatch.setattr(xxhash, "xxh3_64_intdigest", lambda b: calls.append(b) or 7)
    words, _ = nearcopies.hashed_words(pa.array([" ".join(map(str, range(100_000))) + " " + "z" * 65]))
    assert len(set(words.tolist())) == 100_001 and len(calls) == 1  # of the long word
