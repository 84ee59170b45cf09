"""Load methods as pure functions of (target, source).

Every function gives the table as it should look afterwards; writing it is the
caller's step (see ``tidemark.sinks.tables``).  Two plans exist for key matching:

* ``plan="full_outer"`` reads both sides once and shuffles both by key.
* ``plan="lookup"`` is for a batch much smaller than the table.  The joins carry no
  hint: Spark broadcasts the batch while its size is under the session's limit, so
  the table is not shuffled at all, and sorts both sides beyond it.  Stage the batch
  first (``sinks.tables.stage``) so that its true size is known to the planner.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.temporal import ntz, trunc_ntz
from tidemark.operators.latest import latest_per_key, newest_where_keyed

LOAD_METHODS = ("merge", "insert-only", "truncate-insert")


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def loaded_columns(target: DataFrame, defaults: Sequence[str] = ()) -> list[str]:
    """Columns a load writes: all but those the table fills by default."""
    return [c for c in target.columns if c not in set(defaults)]


def _matching(target: DataFrame, source: DataFrame, keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & (target[k] == source[k])
    return cond


def _prepared(source: DataFrame, columns: Sequence[str], keys: list[str], newest_by: Sequence[str] | None) -> DataFrame:
    if newest_by:
        source = newest_where_keyed(source, keys, newest_by)
    return source.select(*[c for c in columns if c in source.columns])


def _put(target: DataFrame, source: DataFrame, keys: list[str], set_columns: list[str], inserted: list[str],
         defaults: dict[str, Column], on_update: dict[str, Column], update_where: str | None, plan: str) -> DataFrame:
    """Common body of the key-matching loads.

    ``set_columns`` are taken from the source on a match, ``inserted`` on an insert.
    """
    if plan not in ("full_outer", "lookup"):
        raise ValueError(f"plan is not recognized: {plan}")
    t = target.withColumns({"__t": F.lit(True), "__hit": F.expr(update_where) if update_where else F.lit(True)})
    s = source.select(*[F.col(c).alias(f"__s_{c}") for c in source.columns]).withColumn("__s", F.lit(True))
    on = [F.col(k) == F.col(f"__s_{k}") for k in keys]
    old, new = F.col("__t").isNotNull(), F.col("__s").isNotNull()
    change = old & new & F.coalesce(F.col("__hit"), F.lit(False))

    def value(c: str) -> Column:
        fresh = F.col(f"__s_{c}") if c in inserted else defaults.get(c, F.lit(None).cast(target.schema[c].dataType))
        kept = F.col(c)
        if c in set_columns:
            kept = F.when(change, F.col(f"__s_{c}")).otherwise(F.col(c))
        elif c in on_update:
            kept = F.when(change, on_update[c]).otherwise(F.col(c))
        return F.when(old, kept).otherwise(fresh).cast(target.schema[c].dataType).alias(c)

    columns = [value(c) for c in target.columns]

    def put_in(rows: DataFrame) -> DataFrame:
        return rows.select(*[
            (F.col(c) if c in inserted else defaults.get(c, F.lit(None))).cast(target.schema[c].dataType).alias(c)
            for c in target.columns])

    if plan == "full_outer":
        # rows with a NULL key match nothing and would all meet in one task of the join
        keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        s_keyed = reduce(lambda a, b: a & b, [F.col(f"__s_{k}").isNotNull() for k in keys])
        matched = t.filter(keyed).join(s.filter(s_keyed), on, "full_outer").select(*columns)
        return matched.unionByName(target.filter(~keyed)).unionByName(put_in(source.filter(~keyed)))

    matched_keys = target.select(*keys).join(
        source.select(*[F.col(k).alias(f"__s_{k}") for k in keys]), on, "left_semi")
    fresh = source.join(matched_keys, keys, "left_anti")
    return t.join(s, on, "left").select(*columns).unionByName(put_in(fresh))


def merge(target: DataFrame, source: DataFrame, key: str | Sequence[str], *, defaults: Sequence[str] = (),
          newest_by: Sequence[str] | None = None, created_column: str | None = None,
          updated_column: str | None = None, now: object = None, plan: str = "full_outer") -> DataFrame:
    """Upsert: matched rows take every non-key, non-default column, the rest is inserted.

    NULLs of the source overwrite as well.  A NULL key matches nothing.  With
    ``newest_by`` only the newest row per key of the batch counts; without it the
    batch must hold each key once.  ``created_column`` is set on insert and
    ``updated_column`` on update, both to ``now``.
    """
    keys = _names(key)
    moment = F.current_timestamp() if now is None else ntz(now)
    audit = {c for c in (created_column, updated_column) if c}
    columns = [c for c in loaded_columns(target, [*defaults, *audit]) if c in source.columns]
    src = _prepared(source, columns, keys, newest_by)
    return _put(
        target, src, keys,
        set_columns=[c for c in columns if c not in keys], inserted=columns,
        defaults={created_column: moment} if created_column else {},
        on_update={updated_column: moment} if updated_column else {},
        update_where=None, plan=plan)


def new_rows(target: DataFrame, source: DataFrame, key: str | Sequence[str], *,
             newest_by: Sequence[str] | None = None) -> DataFrame:
    """Rows of the batch whose key is not in the table: what an append has to write.

    Only the key column of the table is read.  It is first cut down to the keys that
    the batch holds, which is a broadcast for a small batch.
    """
    keys = _names(key)
    src = _prepared(source, [c for c in target.columns if c in source.columns], keys, newest_by)
    present = target.select(*keys).join(src.select(*keys), keys, "left_semi")
    return src.join(present, keys, "left_anti")


def insert_only(target: DataFrame, source: DataFrame, key: str | Sequence[str], *,
                newest_by: Sequence[str] | None = None) -> DataFrame:
    """Add rows with new keys; rows already there are never touched."""
    return target.unionByName(new_rows(target, source, key, newest_by=newest_by), allowMissingColumns=True)


def truncate_insert(target: DataFrame, source: DataFrame) -> DataFrame:
    """Full replacement in the target's column order; missing columns become NULL."""
    return source.select(*[
        (F.col(c) if c in source.columns else F.lit(None)).cast(target.schema[c].dataType).alias(c)
        for c in target.columns])


def conditional_upsert(target: DataFrame, source: DataFrame, key: str | Sequence[str], set_columns: Sequence[str],
                       update_where: str, *, newest_by: Sequence[str] | None = None,
                       plan: str = "full_outer") -> DataFrame:
    """Insert new keys; on a known key change only some columns, and only if the row
    already in the table meets ``update_where`` (SQL over the table's columns)."""
    keys = _names(key)
    columns = [c for c in target.columns if c in source.columns]
    src = _prepared(source, columns, keys, newest_by)
    return _put(target, src, keys, list(set_columns), columns, {}, {}, update_where, plan)


def load(method: str, target: DataFrame, source: DataFrame, key: str | Sequence[str] | None = None,
         newest_by: Sequence[str] | None = None, plan: str = "full_outer") -> DataFrame:
    """One of the load methods by name."""
    if method == "merge":
        return merge(target, source, key, newest_by=newest_by, plan=plan)
    if method == "insert-only":
        return insert_only(target, source, key, newest_by=newest_by)
    if method == "truncate-insert":
        return truncate_insert(target, source)
    raise ValueError(f"load_method is not recognized: {method}")


def merge_into_catalog(source: DataFrame, table: str, key: str, columns: Sequence[str] | None = None) -> None:
    """Upsert in place, for catalogs whose tables support row-level operations."""
    names = [c for c in (columns or source.columns) if c != key]
    (source.alias("s").mergeInto(table, F.col(f"{table}.{key}") == F.col(f"s.{key}"))
     .whenMatched().update({c: F.col(f"s.{c}") for c in names})
     .whenNotMatched().insert({c: F.col(f"s.{c}") for c in [key, *names]})
     .merge())


# --- time windows -----------------------------------------------------------------

def in_window(ts: str, start: object, end: object) -> Column:
    """Half-open window ``(start, end]``."""
    return (F.col(ts) > ntz(start)) & (F.col(ts) <= ntz(end))


def overwrite_window(target: DataFrame, source: DataFrame, ts: str, start: object, end: object) -> DataFrame:
    """Replace the rows of ``(start, end]``.  Running it twice changes nothing more.

    Rows of the source outside the window are left out; rows of the target without a
    time are kept.
    """
    kept = target.filter((F.col(ts) <= ntz(start)) | (F.col(ts) > ntz(end)) | F.col(ts).isNull())
    return kept.unionByName(source.filter(in_window(ts, start, end)), allowMissingColumns=True)


def rebuild_trailing(target: DataFrame, source: DataFrame, ts: str, today: object, days: int) -> DataFrame:
    """Replace everything later than ``today - days`` by the source's rows of that time."""
    since = ntz(today) - F.expr(f"interval {int(days)} day")
    kept = target.filter((F.col(ts) <= since) | F.col(ts).isNull())
    return kept.unionByName(source.filter(F.col(ts) > since))


def dedupe_recent(df: DataFrame, key: str, loaded_at: str, since: object, tie_break: Sequence[str] = ()) -> DataFrame:
    """Keep the newest copy per key among rows loaded since a time.

    Older rows and rows without a key pass through and are not shuffled.
    """
    recent = df.filter((F.col(loaded_at) >= ntz(since)) & F.col(key).isNotNull())
    rest = df.filter((F.col(loaded_at) < ntz(since)) | F.col(loaded_at).isNull() | F.col(key).isNull())
    return latest_per_key(recent, key, [loaded_at, *tie_break]).unionByName(rest)


# --- watermarks -------------------------------------------------------------------

def watermark(target: DataFrame, order_field: str | None, now: object = None) -> DataFrame:
    """One row: the largest order value (NULL for an empty table) and the row count."""
    if order_field is None:
        moment = F.current_timestamp() if now is None else ntz(now)
        return target.agg(F.count(F.lit(1)).alias("table_count")).select(moment.alias("max_order"), "table_count")
    return target.agg(F.max(order_field).alias("max_order"), F.count(F.lit(1)).alias("table_count"))


# Order fields that count as times for the look-back.
TIME_FIELDS = ("created_at", "inserted_at", "updated_at", "valid_until")


def watermark_with_lookback(target: DataFrame, order_field: str, period: str, now: object,
                            lookback_from: str | None = None, time_fields: Sequence[str] = TIME_FIELDS) -> DataFrame:
    """The watermark moved back by ``period`` so that late changes are read again.

    ``lookback_from='max'`` gives ``max - period``, ``'now'`` gives the earlier of the
    maximum and ``now - period``.  When not given, a period written in days counts
    from now and any other from the maximum.  Fields that are not times do not look
    back.  An empty table gives the start of 1970.
    """
    if order_field.lower() not in time_fields:
        return watermark(target, order_field)
    mode = lookback_from or ("now" if "days" in period else "max")
    base = watermark(target, order_field)
    top = F.coalesce(F.col("max_order").cast("timestamp_ntz"), ntz("1970-01-01 00:00:00"))
    step = F.expr(f"interval {period}")
    moved = F.least(top, ntz(now) - step) if mode == "now" else \
        F.when(F.col("max_order").isNull(), top).otherwise(top - step)
    return base.select(moved.alias("max_order"), "table_count")


def hour_lookback(target: DataFrame, ts: str, hours: int = 12) -> DataFrame:
    """One row: the hour ``hours`` before the newest row; the start of 1970 if there is none."""
    newest = F.max(F.col(ts).cast("timestamp_ntz"))
    return target.agg(
        F.coalesce(trunc_ntz("hour", newest - F.expr(f"interval {int(hours)} hour")),
                   ntz("1970-01-01 00:00:00")).alias("since"))


def reread_since(source: DataFrame, target: DataFrame, ts: str, hours: int = 12) -> DataFrame:
    """Source rows later than the table's hour look-back.  Collects that one value."""
    since = hour_lookback(target, ts, hours).first()["since"]
    return source.filter(F.col(ts) > ntz(since))
