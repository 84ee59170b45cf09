"""Event files under dated prefixes, and text files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import trim_fraction


def dated_prefixes(today: date, days_back: int = 1, fmt: str = "%Y/%m/%d") -> list[str]:
    """Prefixes of the days to read: yesterday and today unless told otherwise."""
    return [(today - timedelta(days=d)).strftime(fmt) for d in range(days_back, -1, -1)]


def with_origin(df: DataFrame, loaded_at: object = None) -> DataFrame:
    """Add the file a row came from and the time it was loaded."""
    now = F.current_timestamp() if loaded_at is None else F.lit(str(loaded_at)).cast("timestamp_ntz")
    return df.select("*", F.col("_metadata.file_path").alias("source_file"), now.alias("dw_created_at"))


def with_origin_of_none(spark: SparkSession, schema: T.StructType | str, loaded_at: object = None) -> DataFrame:
    """No rows, with the columns that ``with_origin`` gives."""
    now = F.current_timestamp() if loaded_at is None else F.lit(str(loaded_at)).cast("timestamp_ntz")
    return spark.createDataFrame([], schema).select("*", F.lit(None).cast("string").alias("source_file"), now.alias("dw_created_at"))


def load_events(spark: SparkSession, root: str, days: Sequence[str], pattern: str = ".*",
                schema: T.StructType | str | None = None, loaded_at: object = None) -> DataFrame:
    """Event files of some days whose path matches a regular expression.

    Only the named prefixes are listed.  Days without files give no rows; if there is none at
    all, the schema has to be given.
    """
    root = root.rstrip("/")
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    days = [d for d in days if (p := hadoop.Path(f"{root}/{d}")).getFileSystem(conf).exists(p)]
    if not days and schema is not None:
        return with_origin_of_none(spark, schema, loaded_at)
    reader = spark.read.option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    raw = reader.parquet(*[f"{root}/{d}" for d in days])
    return with_origin(raw, loaded_at).filter(F.col("source_file").rlike(pattern))


def read_renamed_csv(spark: SparkSession, path: str, rename: Mapping[str, str], encoding: str = "UTF-16LE",
                     trim_times: Sequence[str] = ()) -> DataFrame:
    """A CSV file with header in another encoding, its columns renamed.

    ``trim_times`` are (new) names of time columns whose fraction is cut to milliseconds.
    """
    df = (
        spark.read.option("header", "true").option("encoding", encoding).option("lineSep", "\n").csv(path)
        .withColumnsRenamed(dict(rename))
    )
    return df.withColumns({c: trim_fraction(c) for c in trim_times})


def append_csv_folder(spark: SparkSession, folder: str, table_path: str, schema: T.StructType | str) -> None:
    """Append every ``*.csv`` of a folder to one Parquet table."""
    (spark.read.option("header", "true").option("pathGlobFilter", "*.csv").schema(schema).csv(folder)
     .write.mode("append").parquet(table_path))
