"""Operator 3, line de-duplication by a segment-partition edit join.

Lines are near copies if at most ``threshold`` edits lie between them.  A line is cut into
``threshold + 1`` segments of equal length; of two near copies at least one segment of the
shorter is a substring of the longer, at one of few places that the lengths and the segment's number
allow.  So every distinct line is indexed by its segments (number, length of the line, text)
and probes with the substrings at those places for each length it can meet.  Pairs that meet are
verified by the edit distance.  Near copies form classes; the first line of a class in the order
(document, line) stays and the others go, as do exact repeats of any line with a word.

A segment of more than ``FEW`` lines, as lines made from one by other words share many of, gives no pairs: the lines that meet
there are listed once each, and compared in a join by their counts of characters and then their text, which yields
the near copies alone.  Its comparisons grow with the square of such a crowd, its rows and memory do not.

The verification is Spark's ``levenshtein`` with a threshold, which is banded; SQL has no bit
vectors of a line's length, so it is not the bit-parallel form.  The counts are of ASCII characters in the whole line,
modulo 4 in two bits each: one edit changes two counts by one.
Index and probes carry hashes; the texts are read again for the lines that meet, and for no others.

Defined results: a null text has no lines; lines without a word are never compared and stay; lines
shorter than ``min_chars`` are compared exactly only; a document is an id and a text, in this order, so rows of
one id with other texts, or of null ids, are documents of their own and equal rows are one; a null id is
larger than any other; distinct lines are named by a 64-bit hash; an empty table gives no rows.
Everything on the way is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_CHARACTER, components, kept, register, table

_LAST = (1 << 63) - 1
_COUNTED = " enatrisodhlucmfgpwbvk"
#: Lines of a segment whose pairs are listed.
FEW = 8


def _segment(n: Column, i: Column, segments: int) -> tuple[Column, Column]:
    """First place (from 1) and length of segment ``i`` (from 0) of a line of ``n`` characters."""
    short = F.lit(segments) - n % segments  # the later segments have one more
    base = F.floor(n / segments)
    return (base * i + F.greatest(F.lit(0), i - short) + 1).cast("int"), (base + (i >= short).cast("int")).cast("int")


def _counts(line: Column) -> Column:
    """Two bits for each counted character: how often it occurs, modulo 4; each is taken out before the next is counted."""
    rest, out = line, F.lit(0).cast("long")
    for i, c in enumerate(_COUNTED):
        left = F.replace(rest, F.lit(c), F.lit(""))
        out = out + F.shiftleft(((F.octet_length(rest) - F.octet_length(left)) % 4).cast("long"), 2 * i)
        rest = left
    return out


def _keyed(lined: DataFrame, tries: list[tuple[int, int, int]], segments: int) -> DataFrame:
    """``lined`` once for each try (segment, characters that the other line is shorter by, shift) with the hash of that substring.

    The tries are rows of a constant, not columns side by side: one small expression, which the JVM compiles.
    """
    each = lined.withColumn("t", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(d).alias("d"), F.lit(s).alias("s")) for i, d, s in tries])))
    other = F.col("n") - F.col("t.d")
    at, size = _segment(other, F.col("t.i"), segments)
    return each.select("h", F.col("t.d").alias("d"), F.col("t.s").alias("s"), F.xxhash64("t.i", other, F.substring(F.col("line"), at + F.col("t.s"), size)).alias("key"))


def _difference(a: Column, b: Column) -> Column:
    """A lower bound of the sum of the differences of all counts."""
    low = sum(1 << (2 * i) for i in range(len(_COUNTED)))
    x = a.bitwiseXOR(b)
    # per pair of bits: 0 apart, odd xor is 1 or 3 (one step around), even and not 0 is two steps
    some = x.bitwiseOR(F.shiftright(x, 1)).bitwiseAND(F.lit(low))
    two = F.shiftright(x, 1).bitwiseAND(F.bitwise_not(x)).bitwiseAND(F.lit(low))
    return F.bit_count(some) + F.bit_count(two)


def _document(key: str, text: str) -> list[Column]:
    """What names a document: its id and a hash of its text."""
    return [F.coalesce(F.col(key).cast("long"), F.lit(_LAST)).alias("id"), F.xxhash64(text).alias("copy")]


def lines_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, copy, at, line, h): the lines with a word, their place and hash."""
    return (docs.select(*_document(key, text), F.posexplode(F.split(text, "\n")).alias("at", "line"))
            .where(F.col("line").rlike(WORD_CHARACTER)).select("id", "copy", "at", "line", F.xxhash64("line").alias("h")))


def _met(lines: DataFrame, threshold: int, min_chars: int) -> DataFrame:
    """(a, b, key, same, own): lines b that share a segment with a, being as long or longer; or, of a segment of many lines, without a, b that have it.

    ``same`` tells lines of one length, ``own`` that the segment is in its place.
    """
    segments = threshold + 1
    lined = (lines.select("h", "line", F.char_length("line").alias("n")).where(F.col("n") >= max(min_chars, segments) - threshold))
    index = [(i, 0, 0) for i in range(segments)]
    probes = [(i, d, s) for i in range(segments) for d in range(threshold + 1)  # the probed line is shorter by d
              for s in range(max(-i, d - (threshold - i)), min(i, d + (threshold - i)) + 1)]
    # a line of several documents is one; neither the counts nor the join need another exchange
    indexed = _keyed(lined, index, segments).select(F.col("h").alias("a"), "key").repartition("key").distinct()
    asked = _keyed(lined, probes, segments).select(F.col("h").alias("b"), (F.col("d") == 0).alias("same"), ((F.col("d") == 0) & (F.col("s") == 0)).alias("own"),
                                                   "key").repartition("key").distinct()
    of_key = Window.partitionBy("key")
    few = F.col("many") <= FEW
    indexed = (indexed.withColumn("nth", F.row_number().over(of_key.orderBy("a"))).withColumn("many", F.count("*").over(of_key))
               .where(few | (F.col("nth") == 1)).select("key", F.when(few, F.col("a")).alias("a")))
    return (indexed.join(asked, (indexed["key"] == asked["key"]) & (F.col("a").isNull() | (F.col("a") != F.col("b")) & (~F.col("same") | (F.col("a") < F.col("b")))))
            .select("a", "b", indexed["key"], "same", "own"))


def near_lines(lines: DataFrame, threshold: int = 2, min_chars: int = 30) -> DataFrame:
    """(a, b): hashes of all pairs of distinct lines with one to ``threshold`` edits between them."""
    met = kept(_met(lines, threshold, min_chars))
    min_chars = max(min_chars, threshold + 1)
    wanted = kept(met.select(F.explode(F.array("a", "b")).alias("h")).where("h is not null").distinct())
    # always by an exchange: the lines that meet grow with the table, beyond what can be broadcast
    texts = kept(lines.select("h", "line").join(wanted.hint("merge"), "h", "left_semi").groupBy("h").agg(F.max("line").alias("line")))
    one = texts.select(F.col("h").alias("a"), F.col("line").alias("la"))
    two = texts.select(F.col("h").alias("b"), F.col("line").alias("lb"))
    near = (((F.char_length("la") >= min_chars) | (F.char_length("lb") >= min_chars)) & (F.levenshtein("la", "lb", threshold) >= 0))
    listed = met.where("a is not null").select("a", "b").distinct().join(one, "a").join(two, "b").where(near).select("a", "b")
    crowd = kept(met.where("a is null").select("key", "b", "same", "own").join(two, "b").withColumn("c", _counts(F.col("lb"))))
    pivots = crowd.where("own").select(F.col("key").alias("k"), F.col("b").alias("a"), F.col("c").alias("ca"), F.col("lb").alias("la"))
    crowded = pivots.join(crowd, (F.col("k") == F.col("key")) & (F.col("a") != F.col("b")) & (~F.col("same") | (F.col("a") < F.col("b")))
                          & (_difference(F.col("ca"), F.col("c")) <= 2 * threshold) & near).select("a", "b")
    return listed.unionByName(crowded).distinct()


def line_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """(id, copy, at, class_id, first, links) for every line with a word.

    ``class_id`` names the class, ``first`` is the (id, copy, at) of its first line, ``links`` the number of near
    copies among the distinct lines.
    """
    lines = lines_of(docs, key, text)
    links = kept(near_lines(lines, **how))
    places = kept(lines.select("id", "copy", "at", "h"))
    firsts = places.groupBy("h").agg(F.min(F.struct("id", "copy", "at")).alias("first"))
    roots = kept(components(links).select(F.col("node").alias("h"), "root"))
    degree = links.select(F.explode(F.array("a", "b")).alias("h")).groupBy("h").agg(F.count("*").alias("links"))
    linked = kept(firsts.join(roots, "h").join(degree, "h"))
    of_class = linked.groupBy("root").agg(F.min("first").alias("first"))
    linked = linked.select("h", "root", "links").join(of_class, "root")
    # written, so that the lines' side is a plain exchange whose hot lines can be split
    known = kept(firsts.join(linked.select("h", "root", "links", F.col("first").alias("earlier")), "h", "left").select(
        "h", F.coalesce("root", "h").alias("class_id"), F.coalesce("earlier", "first").alias("first"), F.coalesce("links", F.lit(0)).alias("links")))
    return places.join(known, "h").select("id", "copy", "at", "class_id", "first", "links")


def _gone() -> Column:
    return (F.col("first.id") != F.col("id")) | (F.col("first.copy") != F.col("copy")) | (F.col("first.at") != F.col("at"))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` with the repeated lines taken out of the text; ``n_chars`` follows if there is one."""
    if clash := {"_id", "_copy", "_gone"} & set(docs.columns):
        raise ValueError(f"columns of the input clash with results: {sorted(clash)}")
    gone = (line_classes(docs, key, text, **how).where(_gone()).groupBy(F.col("id").alias("_id"), F.col("copy").alias("_copy"))
            .agg(F.collect_set("at").alias("_gone")))
    left = F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains("_gone", i)), "\n")
    out = docs.select("*", *[c.alias(n) for c, n in zip(_document(key, text), ("_id", "_copy"), strict=True)]).join(gone, ["_id", "_copy"], "left")
    out = out.withColumn(text, F.when(F.col("_gone").isNull(), F.col(text)).otherwise(left))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_gone").isNull(), F.col("n_chars")).otherwise(
            F.char_length(text)).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all documents, without the lines that repeat earlier ones."""
    return without_repeats(docs)


@register("op3_line_dedup")
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # a set, as equal rows are one document
    line = F.struct("at", "class_id", "links", _gone().alias("gone"))
    per = line_classes(docs).groupBy("id", "copy").agg(F.collect_set(line).alias("own")).select(
        "id", "copy", F.size("own").cast("long").alias("n_lines"), F.size(F.filter("own", lambda x: x["gone"])).cast("long").alias("n_removed"),
        F.aggregate("own", F.lit(0).cast("long"), lambda a, x: a + x["links"]).alias("n_links"),
        F.size(F.array_distinct(F.col("own.class_id"))).cast("long").alias("n_classes"),
        F.array_sort(F.transform(F.filter("own", lambda x: x["gone"]), lambda x: x["at"])).alias("removed"))
    ids = docs.select("doc_id", *_document("doc_id", "text"))
    zero = F.lit(0).cast("long")
    return ids.join(per, ["id", "copy"], "left").select(
        "doc_id", *[F.coalesce(c, zero).alias(c) for c in ("n_lines", "n_removed", "n_links", "n_classes")],
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))
