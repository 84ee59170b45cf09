"""Topics of texts, and mixing by them."""

from collections import Counter

from pyspark.sql import functions as F
from tidemark.llm import mixing, topics

ABOUT = {
    "science": "The physicist and a chemist saw atoms and electrons in the laboratory.",
    "economy": "Die Banken und die Börse sehen Inflation, Zölle und eine Rezession.",
    "politics": "Le gouvernement et le parlement attendent les élections.",
    "sport": "El entrenador y los jugadores del campeonato salen del estadio.",
    "health": "DOCTORS, nurses: the hospital’s patients had symptoms!",
    "technology": "Software, servers and databases - and algorithms.",
    "other": "They went home and had some tea with a doctor.",
}


def test_a_topic_is_what_a_text_is_about_and_not_its_length(spark):
    rows = [(t, text + more) for t, text in ABOUT.items() for more in ("", " so we and they did" * 30)]
    rows += [("other", None), ("other", ""), ("other", " \n")]
    rows += [("other", ABOUT["sport"] + " and so on then" * 400)]  # four words of sport among 1,600
    rows += [("sport", " ".join([ABOUT["sport"]] * 200))]
    got = spark.createDataFrame(rows, "want string, text string").select("want", "text", mixing.topic(F.col("text")).alias("topic")).collect()
    assert [(r.topic, r.text) for r in got] == [(r.want, r.text) for r in got]


def test_no_word_is_of_two_topics():
    every = Counter(w for words in topics.WORDS.values() for w in words)
    assert max(every.values()) == 1 and all(w == w.lower() for w in every)


def test_topics_are_mixed_to_their_targets(spark, tmp_path):
    names = list(ABOUT)
    rows = [(i, ABOUT[names[0] if i % 10 < 4 else names[i % 7]], "en", "s", 0) for i in range(7000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    got = Counter(r.topic for r in mixing.mixed_documents(docs).select(mixing.topic(F.col("text")).alias("topic")).collect())
    tokens = {t: got[t] * len(ABOUT[t].split()) for t in names}
    for t in names:
        want = mixing.TARGETS["topic"].get(t, mixing.TARGETS["topic"][mixing.REST])
        assert abs(tokens[t] / sum(tokens.values()) - want) < 0.04, (t, tokens)
    # the query reads a text once, and draws the same documents
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = mixing.op7_mixing(spark, str(tmp_path)).collect()
    assert Counter(r.topic for r in out) == got and {r.topic for r in out} == set(names)
    by_id = {r[0]: r for r in rows}
    assert all(r.n_tokens == len(by_id[r.doc_id][1].split()) for r in out)
