"""Treatment of personal data as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.jsonops import edit, text_at

# Fixed value: what counts as an e-mail address.
EMAIL_PATTERN = r"^\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\b$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def email_token(c: Column | str, pepper: str, salt: str = "") -> Column:
    """Keyed pseudonym of an e-mail address: the same address gives the same token.

    ``sha256(sha256(salt) || address || pepper)``, or without the first part when no
    salt is used.  NULL stays NULL.
    """
    text = _col(c)
    parts = [text, F.lit(pepper)]
    if salt:
        parts.insert(0, F.sha2(F.lit(salt), 256))
    return F.sha2(F.concat(*parts), 256)


def pseudonymise(c: Column | str, pepper: str, salt: str = "") -> Column:
    """Replace values that hold an ``@`` by their token; keep all others."""
    text = _col(c)
    return F.when(text.contains("@"), email_token(text, pepper, salt)).otherwise(text)


def pseudonymise_in_json(c: Column | str, path: Sequence[str], pepper: str, salt: str = "") -> Column:
    """Replace the address found at a JSON path by its token, at that path only.

    The value is read and put back as JSON, so it may be written with escapes; other
    texts that happen to hold the same letters stay as they are.
    """
    text = _col(c)
    mail = text_at(text, *path)
    quoted = F.concat(F.lit('"'), email_token(mail, pepper, salt), F.lit('"'))
    return F.when(mail.contains("@"), edit(text, put={tuple(path): quoted})).otherwise(text)


def pseudonymise_columns(df: DataFrame, columns: str | Sequence[str], pepper: str, salt: str = "") -> DataFrame:
    """Treat several columns, given as a list or comma list; ``col->a->b`` names a JSON path."""
    names = columns.split(",") if isinstance(columns, str) else list(columns)
    for item in names:
        head, *path = [p.strip() for p in item.split("->")]
        done = pseudonymise_in_json(head, path, pepper, salt) if path else pseudonymise(head, pepper, salt)
        df = df.withColumn(head, done)
    return df


def is_email(c: Column | str) -> Column:
    """Syntax check: the empty string passes, NULL fails."""
    text = _col(c)
    return F.coalesce((text == "") | text.rlike(EMAIL_PATTERN), F.lit(False))


def mask_text(c: Column | str, keep: int = 0) -> Column:
    """Keep the first ``keep`` characters, star the rest."""
    text = _col(c)
    head = F.substring(text, 1, keep) if keep else F.lit("")
    return F.when(text.isNotNull(), F.concat(head, F.repeat(F.lit("*"), F.greatest(F.length(text) - keep, F.lit(0)))))


def mask_date(c: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    """First day of the year of a date text; what does not parse becomes NULL."""
    parsed = F.try_to_timestamp(_col(c).cast("string"), F.lit(fmt)).cast("date")
    return F.trunc(parsed, "year")


def hash_text(c: Column | str) -> Column:
    """One-way hash of a text."""
    return F.sha2(_col(c).cast("string"), 256)


def new_tokens(token_map: DataFrame, df: DataFrame, column: str, pepper: str, salt: str = "") -> DataFrame:
    """Rows to append to a stored ``(email, token)`` map: addresses not seen before.

    First writer wins: known addresses keep their token even if pepper or salt change.
    The addresses are made distinct before anything is joined.
    """
    seen = df.filter(F.col(column).contains("@")).select(F.col(column).alias("email")).distinct()
    fresh = seen.join(token_map.select("email"), "email", "left_anti")
    return fresh.select("email", email_token("email", pepper, salt).alias("token"))


def store_tokens(tokens: DataFrame, table: str, buckets: int = 256) -> None:
    """Append ``(email, token)`` rows to a stored map, a table of the catalog bucketed by address.

    With at least as many buckets as shuffle partitions, joins by address read the map where it lies: it is not
    shuffled again however large it has grown, only what is looked up is.  One file a bucket and load.
    """
    (tokens.select("email", "token").repartition(buckets, "email").write.bucketBy(buckets, "email").sortBy("email").format("parquet")
     .mode("append").saveAsTable(table))


def extend_stored_map(df: DataFrame, column: str, table: str, pepper: str, salt: str = "", buckets: int = 256) -> DataFrame:
    """Add the addresses of a batch that the stored map does not know; returns the map.  One load at a time may extend it."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        store_tokens(spark.createDataFrame([], "email string, token string"), table, buckets)
    fresh = new_tokens(spark.table(table), df, column, pepper, salt)
    store_tokens(fresh, table, buckets)
    spark.catalog.refreshTable(table)
    return spark.table(table)


def apply_tokens(df: DataFrame, token_map: DataFrame, column: str) -> DataFrame:
    """Replace addresses by their stored token; values without one are kept."""
    lookup = token_map.select(F.col("email").alias("__email"), F.col("token").alias("__token"))
    return (
        df.join(lookup, F.col(column) == F.col("__email"), "left")
        .withColumn(column, F.coalesce("__token", column))
        .drop("__email", "__token")
    )
