"""Operator 4, quotation linking: conversations in reply order, without their quotations.

A line's quote level is the number of ``>`` it starts with.  Consecutive lines of one level
are a passage.  A passage is normalised (letters and digits of any script in lower case, all else one blank) and
hashed; a message offers hashes of its own unquoted text as a whole, of each of its passages and
of each of its lines, and looks up its quoted passages and their lines.  A
hash names one original: the first message that offers it, of the same conversation if that has one, and
only if it comes before the message that quotes it.  A message answers the original of
its shallowest linked quotation, the longest and latest of them; without one, the turn before it in its
conversation.  Conversations that answer each other are one thread.

Offers are reduced to one message per hash before the join, so that a phrase in every message makes no pairs.

Messages are ordered by (conversation, turn), nulls last; a message answers earlier ones only, so a
thread in this order is in reply order.  Defined results: a null text is empty; a message of quotations only
has an empty text and stays; passages and lines of fewer than ``min_chars`` normalised characters are
linked within their conversation only, and those without a letter or digit are not, but all are taken out; repeated rows of one (conversation, turn) are kept, and named as one message;
an empty table gives no rows.  Everything on the way is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import components, kept, register, table

_LAST = (1 << 63) - 1
_MARKS = r"^((?:[ \t]*>)+)[ \t]?"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def passages(messages: DataFrame) -> DataFrame:
    """(conv, turn, copy, level, first, text): runs of lines of one quote level, in order of ``first``."""
    marks = F.regexp_extract("line", _MARKS, 1)
    lines = (messages.select("conv", "turn", "copy", F.posexplode(F.split("text", "\r?\n")).alias("at", "line"))
             .select("conv", "turn", "copy", "at", F.char_length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
                     F.regexp_replace("line", _MARKS, "").alias("line")))
    message = Window.partitionBy("conv", "turn", "copy").orderBy("at")
    fresh = F.coalesce(F.lag("level").over(message) != F.col("level"), F.lit(True))
    return (lines.select("*", F.when(fresh, F.col("at")).alias("start"))
            .select("*", F.max("start").over(message).alias("first"))
            .groupBy("conv", "turn", "copy", "level", "first")
            .agg(F.array_sort(F.collect_list(F.struct("at", "line"))).alias("lines"))
            .select("conv", "turn", "copy", "level", "first", F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("text")))


def _hashes(text: Column) -> Column:
    """(hash, characters) of the whole text and of its lines."""
    whole = F.array(normalised(text))
    each = F.transform(F.split(text, "\n"), normalised)
    some = F.filter(F.array_distinct(F.concat(whole, each)), lambda x: x != "")
    return F.transform(some, lambda x: F.struct(F.xxhash64(x).alias("h"), F.char_length(x).alias("chars")))


def linked(messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", text: str = "text",
           min_chars: int = 20) -> DataFrame:
    """All columns of ``messages`` with the text freed of quotations, and thread_id, position, parent_conv, parent_turn,
    n_quotes and n_linked."""
    new = {"thread_id", "position", "parent_conv", "parent_turn", "n_quotes", "n_linked", "conv", "copy"}
    if clash := new & set(messages.columns):
        raise ValueError(f"columns of the input clash with results: {sorted(clash)}")
    at = [F.coalesce(F.col(c).cast("long"), F.lit(_LAST)) for c in (conversation, turn)]
    body = F.coalesce(F.col(text), F.lit(""))
    rows = messages.select(at[0].alias("conv"), at[1].alias("turn"), F.xxhash64(body).alias("copy"), body.alias("text"))
    parts = kept(passages(rows.distinct()))
    me = ["conv", "turn"]

    own = (parts.where("level = 0").groupBy(*me, "copy").agg(F.array_sort(F.collect_list(F.struct("first", "text"))).alias("p"))
           .select(*me, "copy", F.transform("p", lambda x: x["text"]).alias("p")))
    own = own.select(*me, "copy", F.trim(F.regexp_replace(F.array_join("p", "\n"), r"\n{3,}", "\n\n"), F.lit(" \n\t")).alias("text"), "p")
    offered = (own.select(*me, F.explode(F.array_distinct(F.flatten(F.concat(
        F.array(_hashes(F.col("text"))), F.transform("p", _hashes))))).alias("o"))
        .select("o.h", "o.chars", F.struct(*me).alias("m")))
    # one message per hash, overall and within each conversation; a short text does not tell conversations apart
    anywhere = kept(offered.where(F.col("chars") >= min_chars).groupBy("h").agg(F.min("m").alias("everywhere")))
    within = kept(offered.groupBy("h", F.col("m.conv").alias("conv")).agg(F.min("m").alias("here")))
    asked = parts.where("level > 0").select(*me, "level", "first", F.explode(_hashes(F.col("text"))).alias("o")).select(
        *me, "level", "first", "o.h", "o.chars")
    before = lambda c: F.when(F.col(c) < F.struct(*me), F.col(c))
    long = asked.where(F.col("chars") >= min_chars).join(anywhere, "h").join(within, ["h", "conv"], "left")
    short = asked.where(F.col("chars") < min_chars).join(within, ["h", "conv"])
    found = kept(long.select(*me, "level", "first", "chars", F.coalesce(before("here"), before("everywhere")).alias("m"))
                 .unionByName(short.select(*me, "level", "first", "chars", before("here").alias("m"))).where("m is not null"))
    answer = (found.groupBy(*me).agg(F.max(F.struct(-F.col("level"), "chars", "m")).alias("best"), F.countDistinct("first").alias("n_linked"))
              .select(*me, F.col("best.m").alias("m"), "n_linked"))
    quotes = parts.where("level > 0").groupBy(*me, "copy").agg(F.count("*").alias("n_quotes"))

    turns = rows.select(*me).distinct()
    previous = turns.select(*me, F.lag("turn").over(Window.partitionBy("conv").orderBy("turn")).alias("previous"))
    parents = kept(previous.join(answer, me, "left").select(
        *me, F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.coalesce("m.conv", F.when(F.col("previous").isNotNull(), F.col("conv"))).alias("parent_conv"),
        F.coalesce("m.turn", "previous").alias("parent_turn")))
    across = parents.where("parent_conv <> conv").select(F.col("parent_conv").alias("a"), F.col("conv").alias("b")).distinct()
    threads = components(across).select(F.col("node").alias("conv"), "root")
    # places: those of the thread's earlier conversations, then the turn's place in its own
    sizes = rows.groupBy("conv").agg(F.count("*").alias("n")).join(threads, "conv", "left").select(
        "conv", "n", F.coalesce("root", "conv").alias("thread_id"))
    earlier = Window.partitionBy("thread_id").orderBy("conv").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("conv", "thread_id", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    keyed = messages.select(*[c for c in messages.columns if c != text], at[0].alias("_c"), at[1].alias("_t"), F.xxhash64(body).alias("copy"))
    mine = F.row_number().over(Window.partitionBy("_c").orderBy("_t", "copy"))
    free = own.select(F.col("conv").alias("_c"), F.col("turn").alias("_t"), "copy", F.col("text").alias("_text"))
    out = (keyed.select("*", mine.alias("_n")).join(free, ["_c", "_t", "copy"], "left")
           .join(quotes.withColumnsRenamed({"conv": "_c", "turn": "_t"}), ["_c", "_t", "copy"], "left")
           .join(parents.withColumnsRenamed({"conv": "_c", "turn": "_t"}), ["_c", "_t"])
           .join(offsets.withColumnRenamed("conv", "_c"), "_c"))
    named = lambda c: F.when(F.col(c) < _LAST, F.col(c))
    return out.select(*[F.coalesce("_text", F.lit("")).alias(text) if c == text else F.col(c) for c in messages.columns],
                      named("thread_id").alias("thread_id"), (F.col("offset") + F.col("_n")).alias("position"),
                      named("parent_conv").alias("parent_conv"), named("parent_turn").alias("parent_turn"),
                      F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"), "n_linked")


@register("op4_quotation_linking")
def op4_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "conversations"))
