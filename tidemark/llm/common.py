"""What the operators share: words, kept intermediate tables, connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters that end a word, and those that make one, as classes for regular expressions.
BLANK = r"[\x20\x09-\x0D]"
WORD_CHARACTER = r"[^\x20\x09-\x0D]"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def work_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor reaches.

    Only a session with a local master may leave the setting out (tests); its driver and
    executors are one process, so a temporary folder serves.
    """
    conf = spark.sparkContext.getConf()
    base = conf.get("spark.checkpoint.dir", None)
    if not base:
        if not conf.get("spark.master", "").startswith("local[") and conf.get("spark.master", "") != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base.rstrip('/')}/llm/{uuid.uuid4().hex}"


def kept(df: DataFrame, **options: object) -> DataFrame:
    """Write once to the shared folder and read back: lineage ends here and sizes are known.  ``options`` are the writer's."""
    folder = work_folder(df.sparkSession)
    df.write.option("compression", "zstd").options(**options).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def forget(*frames: DataFrame | None) -> None:
    """Delete the files of kept tables that nothing will read again: neither they nor anything computed from them that is not kept itself."""
    for df in frames:
        for file in df.inputFiles()[:1] if df is not None else []:
            spark, folder = df.sparkSession, file.rpartition("/")[0]
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            if path.getParent().getName() == "llm":
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def words_of(text: Column) -> Column:
    """Maximal runs of other characters than the blanks; no words for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK + "+"), "")


def letting(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``use``; higher-order functions would repeat it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def components(links: DataFrame, left: str = "a", right: str = "b", rounds: int = 40) -> DataFrame:
    """Connected components: (node, root), root being the smallest node; one row per linked node.

    Alternates the large-star and small-star steps.  Every step is a min per node and
    one join, each round is written to the shared folder, and nothing is collected but the
    two numbers that tell whether a round changed anything.  A star of any size is one
    min per node, so a hot node costs its number of links.
    """
    a, b = F.least(left, right), F.greatest(left, right)
    edges = kept(links.select(a.alias("lo"), b.alias("hi")).where("lo <> hi").distinct())

    def sign(e: DataFrame):
        return tuple(e.select(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first())

    before = sign(edges)
    for _ in range(rounds):
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(
            edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        # kept, so that both sides of the join are plain shuffles, which adaptive execution can split
        least = kept(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = (both.where("v > u").join(least, "u").where("v <> m")
                 .select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct())
        # small star: each node hands its smallest neighbour to its other smaller ones
        down = large.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        low = kept(down.groupBy("u").agg(F.min("v").alias("m")))
        small = (down.join(low, "u").select(F.col("m").alias("lo"), F.explode(F.array("u", "v")).alias("hi"))
                 .where("lo <> hi").distinct())
        last, edges = edges, kept(small)
        forget(last, least, low)
        after = sign(edges)
        if after == before:
            return edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root")).unionByName(
                edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
        before = after
    raise RuntimeError(f"components did not settle within {rounds} rounds")
