import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tidemark.session import SETTINGS  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    base = tmp_path_factory.mktemp("spark")
    b = (SparkSession.builder.master("local[8]").appName("tests").config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "6g").config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.warehouse.dir", str(base / "warehouse")).config("spark.checkpoint.dir", str(base / "shared")))
    for k, v in SETTINGS.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *order):
    return sorted((tuple(r) for r in df.select(*(order or df.columns)).collect()), key=repr)
