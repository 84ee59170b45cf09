"""Operator 5, quality rules: a threshold table compiled into one projection.

The measures of a text are built-in functions and higher-order functions over the array of
its words; every rule is a ratio of two measures with a lowest and a highest allowed value.
All rules become columns of one projection, so a text is read and split once and no row is
shuffled.

Defined results: a null text has no words and fails (too few words), as does an empty or
blank one; a ratio with denominator 0 passes its rule; rows are judged one by one, so
repeated rows and rows with null ids get their own verdicts; an empty table stays empty;
input columns are passed through untouched, and a clash with a result column raises.
Texts of any length are measured whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_CHARACTER, letting, register, table, words_of

#: Frequent function words of the four languages; a text is compared with all of them.
STOP_WORDS: tuple[str, ...] = (
    "the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on", "with", "as", "by", "be", "this", "are", "at", "from",
    "de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "pour", "est", "dans", "qui", "par", "sur", "pas", "au", "avec",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als",
    "el", "y", "los", "se", "las", "del", "por", "con", "no", "una", "su", "para", "al", "es", "lo",
)

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """``low <= over / under <= high`` for two measures by name; None leaves a side open."""

    name: str
    over: str
    under: str
    low: float | None = None
    high: float | None = None


#: The threshold table.  Figures follow the usual published filters for web text.
RULES: tuple[Rule, ...] = (
    Rule("word_length", "word_chars", "n_words", 2.0, 12.0),
    Rule("symbol_ratio", "n_symbols", "n_words", None, 0.1),
    Rule("exclamation_ratio", "n_exclaims", "n_words", None, 0.1),
    Rule("stop_word_ratio", "n_stop_words", "n_words", 0.02, None),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", None, 0.5),
)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_exclaims", "n_stop_words", "n_lines", "n_dup_lines", "n_repeat_words")


def _count(text: Column, characters: str) -> Column:
    """Characters of a set; most texts have none, which a search for the first one tells."""
    inside = "[" + "".join("\\" + c for c in characters) + "]"
    return F.when(text.rlike(inside), F.char_length(text) - F.char_length(F.translate(text, characters, ""))).otherwise(0)


def repeated_words(words: Column, size: int = 5) -> Column:
    """Words inside windows of ``size`` words found twice or more in the array, first included.

    A window is the 64-bit hash of its words' hashes.  Only a text with an equal pair of
    windows sorts them; the covered words are the gaps between the starts of repeated
    windows, each at most ``size``.
    """
    def covered(windows: Column) -> Column:
        at = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            same = lambda x, j: F.coalesce(F.get(s, j).getField("h") == x.getField("h"), F.lit(False))
            return F.sort_array(F.transform(F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x.getField("i")))

        def total(p: Column) -> Column:
            gaps = F.transform(p, lambda x, i: F.least(F.lit(size), F.coalesce(F.get(p, i + 1), x + size) - x))
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, g: acc + g)

        return letting(letting(at, starts), total)

    def of_hashes(h: Column) -> Column:
        each = F.transform(F.slice(h, 1, F.size(h) - (size - 1)),
                           lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, size)]))
        return letting(each, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(covered(w)))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= size, F.lit(0).cast("long")).otherwise(letting(hashes, of_hashes))


def measured(docs: DataFrame, text: str = "text", stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """``docs`` with all measures (long)."""
    t = F.coalesce(F.col(text), F.lit(""))
    words, lines = F.col("_words"), F.col("_lines")
    split = docs.select("*", words_of(F.col(text)).alias("_words"),
                        F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD_CHARACTER)).alias("_lines"))
    is_stop = lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?"))).isin(*dict.fromkeys(stop_words))
    values = {
        "n_words": F.size(words),
        "word_chars": F.char_length(F.array_join(words, "")),
        "n_symbols": _count(t, SYMBOLS),
        "n_exclaims": _count(t, "!"),
        "n_stop_words": F.size(F.filter(words, is_stop)),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": repeated_words(words),
    }
    return split.select(*docs.columns, *[v.cast("long").alias(k) for k, v in values.items()])


def compiled(rules: Sequence[Rule]) -> dict[str, Column]:
    """Each rule as a boolean column over the measures: true if the text passes."""
    out = {}
    for r in rules:
        over, under = F.col(r.over), F.col(r.under)
        ratio = F.when(under > 0, over / under)
        ok = F.lit(True)
        if r.low is not None:
            ok = ok & F.coalesce(ratio >= r.low, F.lit(True))
        if r.high is not None:
            ok = ok & F.coalesce(ratio <= r.high, F.lit(True))
        out[r.name] = ok
    return out


def judged(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, min_words: int = 10,
           max_repeat_percent: int = 20) -> DataFrame:
    """``docs`` plus the measures, ``base_failed``, ``failed_rules`` and ``kept``."""
    clash = {*MEASURES, "base_failed", "failed_rules", "kept", "_words", "_lines"} & set(docs.columns)
    if clash:
        raise ValueError(f"columns of the input clash with results: {sorted(clash)}")
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    failed = F.filter(F.array(*[F.when(~ok, F.lit(name)) for name, ok in compiled(rules).items()]), lambda x: x.isNotNull())
    return (measured(docs, text).select("*", base.alias("base_failed"), failed.alias("failed_rules"))
            .select("*", (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that pass, with their own columns only."""
    return judged(docs).where("kept").select(*docs.columns)


def _sql() -> str:
    """The same rows in DuckDB's SQL."""
    stops = ", ".join("'" + w + "'" for w in dict.fromkeys(STOP_WORDS))
    tests = []
    for r in RULES:
        ratio = f"({r.over}::DOUBLE / {r.under})"
        if r.low is not None:
            tests.append(f"({r.under} = 0 OR {ratio} >= {r.low})")
        if r.high is not None:
            tests.append(f"({r.under} = 0 OR {ratio} <= {r.high})")
    return rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
g AS (SELECT doc_id, p, words[p:p + 4] AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS p FROM w WHERE len(words) >= 5)),
r AS (SELECT doc_id, p FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
c AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM r, (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(words)::BIGINT AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (length(text) - length(replace(text, '!', '')))::BIGINT AS n_exclaims,
             len(list_filter(words, lambda x: lower(regexp_replace(x, '[.,;:!?]+$', '')) IN ({stops})))::BIGINT AS n_stop_words,
             len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(c.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN c ON c.doc_id = w.doc_id),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {' AND '.join(tests)} AS kept FROM b"""


@register("op5_quality_rules", _sql())
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
