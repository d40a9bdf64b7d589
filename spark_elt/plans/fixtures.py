"""Run-log, state and DAG tables derived from the driver tables.

The driver data has no run log, so ``events`` plays it: each event is one node run
of a pipeline run of its user. Every frame here is a lazy DataFrame over
the parquet scans, so its work grows with the input and Catalyst prunes what a query
does not use. Definitions are listed in FIXTURES.md §3.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spark_elt.functions.paths import empty_path
from spark_elt.session import table


def events_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def node_run_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a node run (``nr0``). A path that a user repeats belongs to that
    user's next run, so every event is one (run_id, node_path)."""
    e = events_k(spark, sf_dir)
    eid = F.col("event_id")
    path = (
        F.when(eid % 50 == 0, empty_path())
        .when(eid % 5 == 1, F.array("event_type"))
        .otherwise(F.array(F.col("event_type"), F.concat(F.lit("task_"), (F.col("k") % 12).cast("string"))))
    )
    finished = eid % 97 != 0
    end = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("value").cast("decimal(18,6)"))
    turn = F.row_number().over(Window.partitionBy("user_id", "node_path").orderBy("event_id"))
    return e.withColumn("node_path", path).select(
        eid.alias("node_run_id"),
        (F.col("user_id") * 1000 + turn).alias("run_id"),
        "node_path",
        F.col("ts").alias("start_time"),
        F.when(finished, end).alias("end_time"),
        F.when(finished, F.col("k") % 10 != 0).alias("succeeded"),
        ((eid % 50 == 0) | (eid % 5 == 1)).alias("is_pipeline"),
        F.col("k"),
        F.col("event_type"),
        F.col("props"),
    )


NODE_RUN_COLS = ["node_run_id", "run_id", "node_path", "start_time", "end_time", "succeeded", "is_pipeline"]


def node_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``node_run``: one row per (run_id, node_path)."""
    return node_run_all(spark, sf_dir).select(*NODE_RUN_COLS)


def node_run_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``node_run`` written once into the checkpoint folder, for queries that read the
    run table several times (as a stored run table would be read)."""
    from spark_elt.session import checkpoint_root

    checkpoint_root(spark)
    return node_run(spark, sf_dir).checkpoint(eager=True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``run``: one row per run with the root path; every tenth run is still open."""
    closed = F.col("run_id") % 10 != 3
    return (
        node_run(spark, sf_dir)
        .groupBy("run_id")
        .agg(
            F.min("start_time").alias("start_time"),
            F.max(F.coalesce("end_time", "start_time")).alias("last"),
            F.count_if(F.col("succeeded") == F.lit(False)).alias("failed"),
        )
        .select("run_id", empty_path().alias("node_path"), "start_time", F.when(closed, F.col("last")).alias("end_time"),
                F.when(closed, F.col("failed") == 0).alias("succeeded"))
    )


def node_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``node_output``: one to five lines per node run."""
    j = F.col("j")
    kind = (F.col("node_run_id") + F.floor(j / 2)) % 3
    lines = node_run_all(spark, sf_dir).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("k") % 5)))
    return lines.select(
        (F.col("node_run_id") * 10 + j).alias("node_output_id"),
        "node_run_id",
        (F.col("start_time") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), j.cast("decimal(18,6)"))).alias("timestamp"),
        F.concat("event_type", F.lit(" "), "props", F.lit("  "), F.when(j == 2, "\n").otherwise("")).alias("message"),
        F.when(kind == 0, "standard").when(kind == 1, "verbatim").otherwise("italics").alias("format"),
        ((F.col("k") + j) % 4 == 0).alias("is_error"),
    )


def system_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``system_statistics``: one sample per event; every tenth has the sentinel run -1."""
    e = events_k(spark, sf_dir)
    k = F.col("k").cast("double")
    return e.select(
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_id") % 10 == 0, F.lit(-1).cast("bigint")).otherwise(F.col("user_id") * 1000 + 1).alias("run_id"),
        k.alias("disc_read"),
        (k * 2).alias("disc_write"),
        (F.col("k") % 10).cast("double").alias("net_recv"),
        F.lit(None).cast("double").alias("net_sent"),
        F.col("value").alias("cpu_usage"),
        k.alias("mem_usage"),
        F.lit(None).cast("double").alias("swap_usage"),
        F.lit(None).cast("double").alias("iowait"),
    )


def counter_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative byte counters per run (input of the counter→rate step); the running
    sum is the distributed one (no run is gathered into one task)."""
    from spark_elt.operators.ordered import ordered_scan

    e = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), "ts", "event_id", F.round(F.col("value") * 1000).cast("bigint").alias("b")
    )
    return ordered_scan(e, ["run_id"], ["ts", "event_id"], sums=["b"]).select(
        "run_id", "ts", "event_id", F.col("b_cum").alias("read_bytes")
    )


def dag_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").where(F.col("p_partkey") > 0).select(
        F.col("p_partkey").alias("node"), F.col("p_size").cast("double").alias("cost")
    )


def edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DAG edges u→v for v in (2u, 3u, 6u) among the parts; the 6u edge is redundant.

    Built as an equi-join on an exploded key, never a theta join."""
    p = table(spark, sf_dir, "part").select("p_partkey")
    a = p.where(F.col("p_partkey") > 0).select(
        F.col("p_partkey").alias("u"),
        F.explode(F.array(F.col("p_partkey") * 2, F.col("p_partkey") * 3, F.col("p_partkey") * 6)).alias("v"),
    )
    return a.join(p.withColumnRenamed("p_partkey", "v"), "v").select("u", "v")


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long event form of the run log: RunStarted, RunFinished (closed runs only),
    NodeStarted, NodeFinished (finished nodes only), Output."""
    cols = ["run_id", "node_path", "event", "ts", "is_pipeline", "succeeded", "message", "format", "is_error", "seq"]
    kinds = {"is_pipeline": "boolean", "succeeded": "boolean", "message": "string", "format": "string", "is_error": "boolean", "seq": "bigint"}

    def event(df: DataFrame, name: str, ts: str, **own: str) -> DataFrame:
        fill = [F.col(own[c]).alias(c) if c in own else F.lit(None).cast(kinds[c]).alias(c) for c in cols[4:]]
        return df.select("run_id", "node_path", F.lit(name).alias("event"), F.col(ts).alias("ts"), *fill)

    runs, nr = run(spark, sf_dir), node_run(spark, sf_dir)
    out = node_output(spark, sf_dir).join(nr.select("node_run_id", "run_id", "node_path"), "node_run_id")
    parts = [
        event(runs, "RunStarted", "start_time"),
        event(runs.where(F.col("end_time").isNotNull()), "RunFinished", "end_time", succeeded="succeeded"),
        event(nr, "NodeStarted", "start_time", is_pipeline="is_pipeline", seq="node_run_id"),
        event(nr.where(F.col("end_time").isNotNull()), "NodeFinished", "end_time", is_pipeline="is_pipeline",
              succeeded="succeeded", seq="node_run_id"),
        event(out, "Output", "timestamp", message="message", format="format", is_error="is_error", seq="node_output_id"),
    ]
    return reduce(DataFrame.unionByName, parts)


def orders_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First snapshot of ``orders`` (full load)."""
    return table(spark, sf_dir, "orders").where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))


def orders_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second snapshot: all orders, every seventh one repriced."""
    o = table(spark, sf_dir, "orders")
    return o.withColumn(
        "o_totalprice",
        F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") * 1.1).otherwise(F.col("o_totalprice")),
    )
