"""Tables and relational sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None, where: str | None = None) -> DataFrame:
    """A Parquet table; the filter and the columns reach the scan."""
    df = spark.read.parquet(path)
    if where:
        df = df.filter(F.expr(where))
    return df.select(*columns) if columns else df


def read_query(spark: SparkSession, url: str, query: str, partition_column: str | None = None,
               lower: object = None, upper: object = None, partitions: int = 1, **options: str) -> DataFrame:
    """A query on a relational source over JDBC.

    With a partition column the query is read in ``partitions`` ranges by as many tasks.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) q").options(**options)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower)).option("upperBound", str(upper))
            .option("numPartitions", partitions)
        )
    return reader.load()
