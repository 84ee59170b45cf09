"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE sizes the shuffles, turns sort-merge joins into broadcast joins once a side
# is measured to be small, and splits skewed join partitions, so it has to be on.
SETTINGS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def local_session(cores: str | int = 8, app: str = "tidemark", shuffle_partitions: int = 8,
                  memory: str = "8g", folder: str | None = None) -> SparkSession:
    """A local session for tests and measurements; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    if folder:
        builder = builder.config("spark.checkpoint.dir", folder)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A folder every executor can reach, for this application's intermediate tables.

    Below ``spark.checkpoint.dir``; a session without that setting gets one below its warehouse,
    which drivers and executors share as well.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/tidemark/{spark.sparkContext.applicationId}"


def forget_intermediates(spark: SparkSession) -> None:
    """Delete what this application has put aside; no DataFrame that reads it may be used afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
