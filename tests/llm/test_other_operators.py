"""Search, mixing, extraction, conversations and the pipeline."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SMALL
from tidemark.llm import common as components
from tidemark.llm import mixing, neighbours, quotations
from tidemark.llm.extraction import extracted, main_text
from tidemark.llm.packing import SIZE

OLD = "/root/testdata/sf0.01"


def brute(rows, queries, k=10):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        d[ids == q] = np.inf
        out[q] = [(int(ids[i]), float(d[i])) for i in np.lexsort((ids, d))[:k] if np.isfinite(d[i])]
    return out


def test_search_is_exact_with_one_part_and_skips_bad_vectors(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.normal(size=8).tolist()) for i in range(40)] + [(100, [1.0] * 8), (41, [1.0] * 8), (42, [1.0] * 8)]
    bad = [(200, None), (300, [0.0] * 8), (400, [math.nan] * 8), (500, [1.0, None] * 4), (600, [math.inf] * 8), (700, []), (800, [1.0] * 3), (None, [2.0] * 8)]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    got = {}
    for r in neighbours.nearest(df, F.col("id") % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.id, r.score))
    want = brute(good, [0, 100])
    assert set(got) == {0, 100} and all([a for a, _ in got[q]] == [a for a, _ in want[q]] for q in got)
    assert all(abs(a - b) < 1e-12 for q in got for (_, a), (_, b) in zip(got[q], want[q], strict=True)) and got[100][0][0] == 41
    assert neighbours.nearest(df.limit(0), F.col("id") % 100 == 0).count() == 0


def test_search_by_parts_finds_most_neighbours(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute(rows, [i for i, _ in rows if i % 100 == 0])
    found = neighbours.nearest(df, F.col("id") % 100 == 0, parts=12, probes=9, block=64).collect()
    assert max(Counter(r.query_id for r in found).values()) == 10
    hits = sum(r.id in {a for a, _ in want[r.query_id]} for r in found)
    assert hits / sum(map(len, want.values())) >= 0.85


def test_balanced_parts_are_balanced():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(640, 6)) + rng.integers(0, 4, (640, 1)) * 3
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, 1)[:, :8]
    left, right = np.repeat(np.arange(640), 8), near.ravel()
    part = neighbours.balanced_parts(x, left, right, 8)
    assert np.bincount(part).max() <= 84 and (part[left] == part[right]).mean() > 0.4


def test_raking_meets_all_margins():
    rng = np.random.default_rng(5)
    cells = {(a, b, c): float(rng.integers(1, 900)) for a in "pqr" for b in "xy" for c in "kl"}
    targets = {"a": {"p": 0.5, "q": 0.2, "r": 0.3}, "b": {"x": 0.9, "y": 0.1}, "c": {"k": 0.4, "l": 0.6}}
    got = mixing.rake(cells, targets)
    for d, goal in enumerate(targets.values()):
        for v, share in goal.items():
            assert abs(sum(s for k, s in got.items() if k[d] == v) - share) < 1e-8
    # the odds ratios of the counts stay as they are
    ratio = lambda t, c: t[("p", "x", c)] * t[("q", "y", c)] / t[("p", "y", c)] / t[("q", "x", c)]
    assert abs(ratio(got, "k") / ratio(cells, "k") - 1) < 1e-6
    assert mixing.rake({}, targets) == {}


def test_raking_tells_of_margins_that_cannot_be_met():
    with pytest.warns(UserWarning, match="off its target"):
        mixing.rake({("p", "x"): 5.0, ("q", "y"): 5.0}, {"a": {"p": 0.9, "q": 0.1}, "b": {"x": 0.5, "y": 0.5}})


def test_mixing_samples_with_calibrated_probabilities(spark):
    docs = spark.read.parquet(f"{OLD}/documents.parquet")
    got = mixing.mixed_documents(docs, with_probability=True)
    assert got.columns == [*docs.columns, "probability"]
    every = docs.select("doc_id", "source", "lang", mixing.topic(F.col("text")).alias("topic"), mixing.tokens(F.col("text")).alias("n")).collect()
    cell = lambda r: tuple(v if v in mixing.TARGETS[t] else mixing.REST for t, v in (("source", r.source), ("lang", r.lang), ("topic", r.topic)))
    have = Counter()
    for r in every:
        have[cell(r)] += r.n
    chance = mixing.probabilities(have, mixing.TARGETS)
    shares = mixing.rake(have, mixing.TARGETS)
    assert sum(shares[k] for k in shares if chance[k] == 1.0) - max(shares[k] for k in shares if chance[k] == 1.0) <= 0.02
    ratio = {k: shares[k] / have[k] / chance[k] for k in shares if chance[k] < 1.0}
    assert max(ratio.values()) / min(ratio.values()) < 1 + 1e-9  # one scale for all that is not cut off
    by_id, rows = {r.doc_id: r for r in every}, got.collect()
    assert all(abs(r.probability - chance[cell(by_id[r.doc_id])]) < 1e-9 for r in rows)
    expected = sum(chance[cell(r)] for r in every)
    assert abs(len(rows) - expected) < 5 * expected ** 0.5 and len({r.doc_id for r in rows}) == len(rows)
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "src0", 0), (1, "", "en", "src0", 0)], docs.schema)
    assert mixing.mixed_documents(odd).columns == docs.columns and mixing.mixed_documents(odd).count() in (0, 1, 2, 3)
    assert mixing.mixed_documents(docs.limit(0)).count() == 0


def test_extraction_of_every_page_of_the_table(spark):
    import re
    from html import unescape

    pages = spark.read.parquet(f"{OLD}/pages.parquet")
    for r in extracted(pages).join(pages, ["page_id", "url"]).collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:h1|p)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("just text &amp; more", "just text & more"), ("<p>a<p>b  c<br>d", "a\n\nb c d"), ("1 < 2 <b>x</b>", "1 < 2 x"), ("<", "<"),
    ("<!-- <p>no</p> --><script>var a = '</p>';</script><style>p{}</style>", ""),
    ("<body><ul class='nav-menu'><li><a href=/>Home</a></ul><div><h2>Head</h2><p>A long paragraph of the article, it goes on.<p>And a second one."
     "</div><div id='comments'><p>First! A comment that is long as well, I think.</div><form>Name <input></form></body>",
     "Head\n\nA long paragraph of the article, it goes on.\n\nAnd a second one."),
    ("<header>Site</header><main><header><h1>T</h1></header><p>x<aside>y</aside>z</p><table><tr><td>1<td>2</table></main><footer>f</footer>", "T\n\nx\n\nz\n\n1\n\n2"),
    ("<div data-x='a > b'><p>in</p></div>", "in"), ("<p>" + "long " * 20_000 + "</p>", ("long " * 20_000).strip())])
def test_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(("page", "text"), [
    ('<body style="overflow: hidden"><article style=\'overflow: hidden\'><p>in</p></article></body>', "in"),
    ('<p>see <a href=/x title="Hidden gems">hidden gems</a> here</p>', "see hidden gems here"), ('<div aria-label="hidden"><p>in</p></div>', "in"),
    ('<div data-x="a id=comments class=ad"><p>in</p></div>', "in"),
    ("<p>in</p><p hidden>out</p><p HIDDEN=''>out</p><p data-x='1'hidden>out</p><p title=a class=ad>out</p><p class = 'x ad'>out</p>", "in")])
def test_attributes_count_by_their_own_name(page, text):
    assert main_text(page) == text


def test_extraction_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([(1, None, "e"), (1, None, "e"), (None, "<p>x", "e")], "page_id long, html string, extra string")
    assert sorted((r.extra, r.text, r.n_chars) for r in extracted(df).collect()) == [("e", "", 0), ("e", "", 0), ("e", "x", 1)]
    with pytest.raises(ValueError):
        extracted(df.withColumnRenamed("extra", "text"))


def test_quotations_give_threads_in_reply_order(spark):
    rows = [(1, 0, "u", "Hello there, how do I bake the bread today?"),
            (1, 1, "a", "> Hello there, how do I bake the bread today?\nYou need flour and water.\nThen wait for two hours please."),
            (1, 2, "u", ">> Hello there, how do I BAKE the bread today?\n> You need flour and water.\n\nThanks, but how much?"),
            (2, 0, "u", "> Then wait  for two hours, please.\nThat is far too long for me."), (3, 0, "u", None), (3, 0, "u", None),
            (3, None, "u", "> matches nothing that anybody wrote"), (None, 0, "x", "y"), (4, 0, "u", "You need flour and water."), (5, 0, "u", "> short\nfine")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("level", F.lit("clash"))
    got = quotations.linked(df)
    assert got.columns[:5] == df.columns
    by = {(r.conv_id, r.turn): r for r in got.collect()}
    assert got.count() == len(rows)
    assert [by[k].text for k in ((1, 1), (1, 2), (2, 0))] == ["You need flour and water.\nThen wait for two hours please.", "Thanks, but how much?", "That is far too long for me."]
    parents = {k: (r.parent_conv, r.parent_turn) for k, r in by.items()}
    assert parents[1, 1] == (1, 0) and parents[1, 2] == (1, 1) and parents[2, 0] == (1, 1) and parents[4, 0] == parents[5, 0] == (None, None)
    assert by[2, 0].thread_id == 1 and by[2, 0].position == 4 and by[3, None].parent_turn == 0 and by[3, None].text == ""
    assert (by[1, 2].n_quotes, by[1, 2].n_linked, by[3, None].n_linked) == (2, 2, 0)
    for t in {r.thread_id for r in by.values()}:
        assert sorted(r.position for r in got.collect() if r.thread_id == t) == list(range(1, got.where(F.col("thread_id").eqNullSafe(t)).count() + 1))
    assert quotations.linked(df.limit(0)).count() == 0


def test_short_passages_are_linked_within_their_conversation(spark):
    rows = [(1, 0, "What about Monday?"), (1, 1, "Or rather Tuesday?\nI am free."), (1, 2, "Fine."), (1, 3, "> what about Monday?\nNo."), (1, 4, "> I am free.\nGood."),
            (1, 5, "> \u5468\u4e00\u600e\u4e48\u6837\nYes."), (2, 0, "\u5468\u4e00\u600e\u4e48\u6837"), (2, 1, "Hm."), (2, 2, "> \u5468\u4e00\u600e\u4e48\u6837\nYes."), (3, 0, "> What about Monday?\nx")]
    got = {(r.conv_id, r.turn): (r.parent_conv, r.parent_turn, r.n_linked) for r in quotations.linked(
        spark.createDataFrame(rows, "conv_id long, turn long, text string")).collect()}
    assert (got[1, 3], got[1, 4], got[2, 2]) == ((1, 0, 1), (1, 1, 1), (2, 0, 1))
    assert (got[1, 5], got[3, 0]) == ((1, 4, 0), (None, None, 0))  # short ones name no text of another conversation


def test_conversations_without_quotations_stay_as_they_are(spark):
    got = entry.queries()["op4_quotation_linking"](spark, SMALL)
    before = {(r.conv_id, r.turn): r.text for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()}
    for r in got.collect():
        assert r.thread_id == r.conv_id and r.text == before.pop((r.conv_id, r.turn)).strip() and r.parent_turn == (r.turn - 1 if r.turn else None)
    assert not before


def test_components_are_those_of_a_union_find(spark):
    rng = np.random.default_rng(6)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 200, (150, 2))] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, i) for i in range(2001, 2100)]
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in pairs:
        if a != b:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    got = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: root(i) for i in parent}


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = components.kept(stage(spark, before, SMALL))
        assert after.columns == names
        kept, had = {r.doc_id: r for r in after.collect()}, {r.doc_id: r for r in before.collect()}
        assert len(kept) == after.count() and set(kept) <= set(had)
        if name == "line_dedup":
            lines = [x for r in kept.values() for x in r.text.split("\n") if x.strip()]
            assert set(kept) == set(had) and len(lines) == len(set(lines)) and all(r.n_chars == len(r.text) for r in kept.values())
        else:
            assert all(kept[i] == had[i] for i in kept)
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SMALL)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in before.collect()}
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where(F.col("n") > SIZE).isEmpty()
    run = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(tuple, run.select("doc_id", "piece", "ids_crc32").collect())) == sorted(map(tuple, packed.select("doc_id", "piece", "ids_crc32").collect()))


def test_mixing_takes_columns_of_any_name(spark):
    df = spark.createDataFrame([(i, "a b c", "s", "en") for i in range(50)], "doc_id long, text string, source string, lang string")
    odd = df.withColumns({"probability": F.lit("p"), "_d0": F.lit(1), "_d1": F.lit(2), "__p": F.lit(3), "topic": F.lit("t")})
    assert mixing.mixed_documents(odd).columns == odd.columns
    assert sorted(r.doc_id for r in mixing.mixed_documents(odd).collect()) == sorted(r.doc_id for r in mixing.mixed_documents(df).collect())
    with pytest.raises(ValueError, match="probability"):
        mixing.mixed_documents(odd, with_probability=True)


def test_the_pipeline_takes_odd_tables(spark, tmp_path):
    text = lambda k, n=80: " ".join(f"{k}word{i}" for i in range(n)) + "."
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, text("a")), (1, text("b")), (2, text("b")), (3, None), (None, None), (None, text("c")), (None, text("c")), (None, text("d")), (5, ""), (6, text("e", 6000))]
    for name, own in (("odd", rows), ("none", [])):
        frame = spark.createDataFrame([(i, t, None if i == 2 else "en", "src0" if i else None, None if t is None else len(t)) for i, t in own], shape)
        frame.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        docs = spark.read.parquet(f"{tmp_path}/{name}/documents.parquet")
        for stage, fn in corpus_pipeline.STAGES:
            before = docs
            docs = components.kept(fn(spark, docs, f"{tmp_path}/{name}"))
            if stage != "best_fit_packing":
                assert docs.columns == before.columns, stage
        if not own:
            assert docs.isEmpty()
            continue
        from tidemark.llm import packing
        want = {(r.doc_id, r.piece): (r.length, bytes(r.ids)) for r in packing.pieces(before.where("doc_id is not null")).collect()}
        got = {(r.doc_id, r.piece): (r.length, bytes(r.ids)) for r in docs.where("doc_id is not null").collect()}
        assert got == want and docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).where(F.col("n") > SIZE).isEmpty()


def test_mixing_keeps_most_of_evenly_sourced_documents(spark):
    langs = ["en"] * 12 + ["de"] * 3 + ["fr"] * 3 + ["es"] * 2
    rows = [(i, " ".join(["wordy"] * (900 if i % 5 == 0 else 190 if i % 5 < 4 else 20)), langs[i // 20 % 20], f"src{i % 20}", 0) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    assert mixing.mixed_documents(docs).count() > 2000


def test_the_pipeline_limits_the_documents_of_a_sequence(spark):
    from tidemark.llm import packing

    rows = [(i, " ".join(["the"] * (3500 if i % 40 == 0 else 3)), "en", "s", 0) for i in range(200)]
    out = packing.stage(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int"), "")
    per = out.groupBy("sequence_id").agg(F.count("*").alias("n"), F.sum("length").alias("length"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert sum(r.n for r in per) == out.count() >= 200 and all(r.length == r.end <= packing.SIZE for r in per)
    assert max(r.n for r in per) == packing.MOST_DOCS
