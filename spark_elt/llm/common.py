"""Reading tables, cutting lineage and connected components for this package."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_elt.session import ship_code


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a given table."""
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def _checkpoints(spark: SparkSession) -> str:
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and (not context.master.startswith("local") or context.master.startswith("local-cluster")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="llm-checkpoints-"))
    return context.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Store ``df`` in the shared checkpoint folder and cut its lineage.

    The folder is the one the session names (``spark.checkpoint.dir``). Only a local
    session without one, as in tests, gets a folder of its own."""
    _checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def tidy(spark: SparkSession) -> None:
    """Let Spark remove the shuffles and checkpoints that no frame refers to any more. It
    does so when the driver collects garbage, which in a job of many steps may otherwise
    be long after their files have filled the disks."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder, and read again."""
    spark = df.sparkSession
    path = f"{_checkpoints(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (node, root), root the smallest
    node of its component, for every node that has an edge.

    Rounds of star operations: each node joins its larger neighbours to the smallest
    node it knows, then its smaller ones, until all components are stars. A round is one
    aggregation and one join on the edges left; a hot node's rows pre-aggregate, and
    its join partition can be split."""
    links = settle(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    while not _stars(links):
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("k"), F.least("a", "m").alias("m")
        )
        wide = both.join(least, both.a == least.k).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = wide.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k")
        near = wide.join(least, wide.a == least.k)
        links = settle(
            near.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select(F.col("k").alias("a"), F.col("m").alias("b")))
            .distinct()
        )
        tidy(edges.sparkSession)
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _stars(links: DataFrame) -> bool:
    """Whether every node ``a`` has one ``b``, and no ``b`` has one itself."""
    again = links.groupBy("a").agg(F.count("*").alias("n")).where("n > 1")
    return again.isEmpty() and links.select(F.col("b").alias("a")).join(links.select("a"), "a", "left_semi").isEmpty()


def joined_components(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """``components`` after more ``edges`` (a, b) come to a graph whose ``roots`` are known:
    only the graph between its components is searched. Nodes need not have a root yet."""
    def of(side: str):
        return roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))

    between = settle(
        edges.join(of("a"), "a", "left").join(of("b"), "b", "left")
        .select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")).where("a <> b").distinct()
    )
    if between.isEmpty():
        return roots
    merged = components(between).select(F.col("node").alias("old"), F.col("root").alias("new"))
    known = roots.join(merged, F.col("root") == F.col("old"), "left").select("node", F.coalesce("new", "root").alias("root"))
    alone = merged.join(roots.select("node"), F.col("old") == F.col("node"), "left_anti")
    return known.union(alone.select(F.col("old").alias("node"), F.col("new").alias("root")))
