"""Files of whatever store Spark writes to: looking, reading and deleting by Hadoop's file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    store, p = _at(spark, path)
    return store.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, sorted; none if it is not there."""
    store, p = _at(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(p)) if store.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    store, p = _at(spark, path)
    store.delete(p, True)


def put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, complete under its name or not at all."""
    store, p = _at(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.aside")
    out = store.create(aside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    store.delete(p, False)
    if not store.rename(aside, p):
        raise OSError(f"cannot write {path}")


def get(spark: SparkSession, path: str) -> str:
    store, p = _at(spark, path)
    stream = store.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def partition_folder(spark: SparkSession, partition: str, value: object) -> str:
    """The name of a partition's folder, as Spark's writers choose it."""
    known = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    name = known.DEFAULT_PARTITION_NAME() if value is None or value == "" else known.escapePathName(str(value))
    return f"{known.escapePathName(partition)}={name}"
