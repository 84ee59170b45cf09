"""Text exports.  Spark writes one file per partition; nothing passes the driver."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def export_folder(root: str, name: str, at: datetime) -> str:
    """Dated folder of an export: ``root/YYYY/MM/nameYYYYmmddHHMMSS.csv``."""
    return f"{root.rstrip('/')}/{at:%Y/%m}/{name}{at:%Y%m%d%H%M%S}.csv"


def write_csv(df: DataFrame, root: str, name: str, at: datetime) -> str:
    """CSV with header under a dated folder; gives back the folder."""
    folder = export_folder(root, name, at)
    df.write.mode("overwrite").option("header", "true").csv(folder)
    return folder


def write_extract(df: DataFrame, folder: str) -> None:
    """Bulk text extract: CSV without header, double quotes."""
    df.write.mode("overwrite").option("header", "false").option("quote", '"').option("escape", '"').csv(folder)


def write_tsv(df: DataFrame, folder: str) -> None:
    """Tab separated with header, the empty string for NULL, backslash as escape."""
    (df.write.mode("overwrite").option("header", "true").option("sep", "\t")
     .option("nullValue", "").option("emptyValue", '""').option("escape", "\\").csv(folder))


def write_json(df: DataFrame, folder: str) -> None:
    """One JSON record per row, NULLs kept."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(folder)


def json_record(df: DataFrame) -> Column:
    """The row as a JSON record, NULLs kept."""
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})


def csv_record(df: DataFrame, sep: str = ",") -> Column:
    """The row as a line of delimited text, the empty string for NULL."""
    return F.to_csv(F.struct(*df.columns), {"sep": sep, "nullValue": ""})
