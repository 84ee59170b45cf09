"""Keep one table in step with its source, by rule."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, fields, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.pii import pseudonymise_columns
from tidemark.functions.sqlnames import register_functions
from tidemark.functions.temporal import ntz
from tidemark.operators import loads
from tidemark.operators.latest import latest_per_key
from tidemark.sinks import store
from tidemark.sinks.keyindex import insert_keyed, merge_keyed, replace_keyed
from tidemark.sinks.tables import finish_publishing, parked, partition_values, publish_partitions
from tidemark.sources.batches import incremental_extract


@dataclass(frozen=True)
class SyncRule:
    """How one table is kept in step.  Names and defaults are those of the rule files."""

    schema_name: str
    table_name: str
    load_method: str = "insert-only"
    order_field: str | None = None
    key_field: str | None = None
    batch_max_rows: int | None = None
    volume: str = "medium"
    sql_condition: str = ""
    columns_to_hash: str | None = None
    backward_update_period: str | None = None
    lookback_from: str | None = None
    target_schema_name: str | None = None
    target_table_name: str | None = None
    prefix: str = ""
    suffix: str = ""
    sql: str | None = None

    @property
    def target(self) -> str:
        """Full name of the table that is loaded; one name for staging and merging."""
        return (f"{self.target_schema_name or self.schema_name}."
                f"{self.prefix}{self.target_table_name or self.table_name}{self.suffix}")

    @classmethod
    def from_json(cls, text: str) -> SyncRule:
        """A rule from its JSON file: the first entry of ``rules`` over the outer keys."""
        raw = json.loads(text)
        flat = {**{k: v for k, v in raw.items() if k != "rules"}, **(raw.get("rules") or [{}])[0]}
        known = {f.name for f in fields(cls)}
        return cls(**{k: v for k, v in flat.items() if k in known})

    def with_(self, **changes) -> SyncRule:
        return replace(self, **changes)


def _condition(rule: SyncRule) -> str | None:
    """The extra predicate, with or without its leading AND."""
    text = rule.sql_condition.strip()
    return (text[4:] if text[:4].upper() == "AND " else text) or None


def start_of_batch(rule: SyncRule, target: DataFrame, now: object) -> object:
    """The value the next batch starts after.  Runs one small aggregate on the target."""
    if rule.order_field is None:
        return None
    if rule.backward_update_period:
        mark = loads.watermark_with_lookback(target, rule.order_field, rule.backward_update_period, now, rule.lookback_from)
    else:
        mark = loads.watermark(target, rule.order_field)
    return mark.select(F.col("max_order").cast("string")).first()[0]


def next_batch(rule: SyncRule, source: DataFrame, target: DataFrame, now: object, pepper: str = "", salt: str = "") -> DataFrame:
    """The rows to load: past the watermark, within the cap, projected, personal columns treated.

    A truncate-insert replaces the table, so its batch is the whole source: only the extra
    predicate holds for it.
    """
    if rule.columns_to_hash and not pepper:
        raise ValueError(f"{rule.target}: columns are to be hashed, so a pepper is needed")
    if rule.load_method == "truncate-insert":
        batch = incremental_extract(source, None, condition=_condition(rule))
    else:
        batch = incremental_extract(source, rule.order_field, start_of_batch(rule, target, now), rule.batch_max_rows,
                                    _condition(rule), rule.volume)
    batch = projected(rule, batch)
    return pseudonymise_columns(batch, rule.columns_to_hash, pepper, salt) if rule.columns_to_hash else batch


#: What a rule's SELECT may start from besides its source: rows it spells out itself.
_OWN_ROWS = ("OneRowRelation", "UnresolvedInlineTable", "LocalRelation")


def _parts(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def foreign_relations(spark: SparkSession, sql: str, source: str) -> list[str]:
    """What a statement reads or does besides selecting from ``source`` and its own common tables.

    Found in the parsed statement, subqueries in expressions included, before anything is looked up.  Whatever
    is not known to be harmless is named: tables, paths, table functions, names made from expressions, commands.
    """
    is_a = spark._jvm.py4j.reflection.TypeUtil.isInstanceOf
    plans, found, common = [(spark._jsparkSession.sessionState().sqlParser().parsePlan(sql), frozenset())], [], "UnresolvedWith"
    while plans:
        plan, names = plans.pop()
        kind = plan.getClass().getSimpleName()
        inner = _parts(plan.children())
        if kind == common:
            for cte in _parts(plan.cteRelations()):
                plans.append((cte._2(), names))  # may name those before it
                names = names | {cte._1().lower()}
        if kind == "UnresolvedRelation":
            name = plan.tableName().replace("`", "").lower()
            if name != source.lower() and name not in names:
                found.append(name)
        elif not inner and kind not in _OWN_ROWS:
            found.append(kind)
        elif kind.endswith(("Statement", "Command")) or "Identifier" in kind or "TimeTravel" in kind or "Script" in kind:
            found.append(kind)
        plans += [(p, names) for p in inner]
        expressions = _parts(plan.expressions())
        while expressions:
            e = expressions.pop()
            if is_a("org.apache.spark.sql.catalyst.expressions.PlanExpression", e):
                plans.append((e.plan(), names))
            elif "Identifier" in e.getClass().getSimpleName():
                found.append(e.getClass().getSimpleName())
            expressions += _parts(e.children())
    return found


def projected(rule: SyncRule, batch: DataFrame) -> DataFrame:
    """The rule's own SELECT over the batch, if it has one.

    ``rule.sql`` is Spark SQL that reads from ``{source}`` and may call the functions of
    ``functions.sqlnames``.  Other tables, views, paths and unknown functions raise, so that no rule reads
    a column around its treatment and a mask that is not understood never lets one pass.
    """
    if not rule.sql:
        return batch
    if "{source}" not in rule.sql:
        raise ValueError(f"{rule.target}: the rule's SQL has to read from {{source}}")
    spark, view = batch.sparkSession, f"sync_source_{uuid.uuid4().hex}"
    sql = rule.sql.replace("{source}", view)
    if foreign := foreign_relations(spark, sql, view):
        raise ValueError(f"{rule.target}: the rule's SQL may read from {{source}} only, not from {', '.join(sorted(set(foreign)))}")
    register_functions(spark)
    batch.createOrReplaceTempView(view)
    try:
        return spark.sql(sql)
    finally:
        spark.catalog.dropTempView(view)


def run_sync(rule: SyncRule, source: DataFrame, target: DataFrame, now: object, pepper: str = "", salt: str = "") -> DataFrame:
    """The target after one run of the rule.

    The batch is parked first, as the source's rows must not be read twice and its size
    decides how the key is matched.  Of several versions of a key the newest counts.
    """
    if rule.load_method not in loads.LOAD_METHODS:
        raise ValueError(f"load_method is not recognized: {rule.load_method}")
    batch = next_batch(rule, source, target, now, pepper, salt)
    if rule.load_method == "truncate-insert":
        return loads.truncate_insert(target, batch)
    newest_by = [rule.order_field] if rule.order_field else None
    return loads.load(rule.load_method, target, parked(batch), rule.key_field, newest_by, plan="lookup")


def rows_to_append(rule: SyncRule, source: DataFrame, target: DataFrame, now: object, pepper: str = "", salt: str = "") -> DataFrame:
    """For insert-only rules: only the new rows, so that a run appends instead of rewriting."""
    if rule.load_method != "insert-only":
        raise ValueError("only insert-only rules can append")
    batch = parked(next_batch(rule, source, target, now, pepper, salt))
    newest_by = [rule.order_field] if rule.order_field else None
    return loads.new_rows(target, batch, rule.key_field, newest_by=newest_by)


def sync_table(rule: SyncRule, source: DataFrame, path: str, log_path: str, partition: str, now: datetime, pepper: str = "",
               salt: str = "") -> int:
    """One run of a rule on a Parquet table partitioned by ``partition``, with its run log.

    Insert-only appends, merge rewrites the partitions that hold a key of the batch or get one, truncate-insert puts all
    partitions in place and removes those without rows.  An index of keys beside the table (``sinks.keyindex``) says
    where a key is, so a row whose update falls into another partition leaves its old one.  What an interrupted run has left
    is finished first.  The log gets STARTED and then COMPLETED or FAILED.  Returns the number of rows loaded.
    """
    spark = source.sparkSession

    def log(status: str, **more) -> None:
        log_entry(spark, rule, status, now, **more).write.mode("append").parquet(log_path)

    log("STARTED")
    try:
        if rule.load_method not in loads.LOAD_METHODS:
            raise ValueError(f"load_method is not recognized: {rule.load_method}")
        finish_publishing(spark, path)
        there = store.exists(spark, path)
        target = spark.read.parquet(path) if there else projected(rule, source.limit(0))
        newest_by = [rule.order_field] if rule.order_field else None
        batch = parked(next_batch(rule, source, target, now, pepper, salt))
        if rule.load_method == "truncate-insert" and rule.key_field:
            replace_keyed(path, batch, rule.key_field, partition)
        elif rule.load_method == "truncate-insert":
            old = partition_values(target, partition) if there else []
            publish_partitions(path, batch, partition, list({*old, *partition_values(batch, partition)}))
        elif rule.load_method == "merge" and there:
            merge_keyed(path, batch, rule.key_field, partition, newest_by)
        else:
            insert_keyed(path, batch, rule.key_field, partition, newest_by)
        count = batch.count()
    except Exception as e:
        log("FAILED", error=str(e)[:1000])
        raise
    log("COMPLETED", records=count)
    return count


# --- run log --------------------------------------------------------------------------

LOG_SCHEMA = ("connection_id string, schema_name string, table_name string, dag_name string, filename_key string, "
              "event_ts timestamp_ntz, status string, error_message string, records long")


def log_entry(spark: SparkSession, rule: SyncRule, status: str, at: datetime, job: str = "", connection: str = "",
              error: str | None = None, files: str | None = None, records: int | None = None) -> DataFrame:
    """One row for the run log, to be appended by the caller."""
    row = (connection, rule.schema_name, rule.table_name, job, files, at, status, error, records)
    return spark.createDataFrame([row], LOG_SCHEMA)


def latest_run_status(log: DataFrame, skip: Sequence[str] = ("dummy_source",)) -> DataFrame:
    """Latest status per table."""
    newest = latest_per_key(log.filter(~F.col("table_name").isin(*skip)), ["schema_name", "table_name"], ["event_ts"])
    return newest.select("schema_name", "table_name", F.col("event_ts").alias("latest_event_time"),
                         F.col("status").alias("latest_status"), "error_message")


def failed_entry(log: DataFrame, schema_and_table: str, error: str, at: object) -> DataFrame:
    """A FAILED row made from the newest STARTED row of a table."""
    started = log.filter(
        (F.col("status") == "STARTED") & (F.concat_ws("_", "schema_name", "table_name") == schema_and_table))
    return latest_per_key(started, ["schema_name", "table_name"], ["event_ts"]).withColumns({
        "event_ts": ntz(at), "status": F.lit("FAILED"), "error_message": F.lit(error.replace("'", ""))})


# --- change log -----------------------------------------------------------------------

def pull_changes(source: DataFrame, loaded: DataFrame, key: str = "Id", modified: str = "LastModifiedDate",
                 now: object = None) -> DataFrame:
    """Upsert every record changed at or after the newest loaded change (epoch milliseconds).

    The bound is inclusive, so the newest records are read again, which changes nothing.
    An empty log loads everything.
    """
    since = loaded.agg(F.coalesce(F.max(modified), F.lit(0).cast("long")).alias("m")).first()["m"]
    changed = parked(source.filter(F.col(modified) >= F.lit(since)))
    return loads.merge(loaded, changed, key, newest_by=[modified], created_column="DW_CREATED_AT", updated_column="DW_UPDATED_AT",
                       now=now, plan="lookup")
