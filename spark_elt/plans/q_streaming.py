"""Registered streaming queries (I12, I13, I16–I18). Each runs its stream twice with
``availableNow`` over input files that Spark writes from the driver tables (new
files arrive between the runs) and returns the final table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from spark_elt.plans import fixtures as fx
from spark_elt.plans.oracle_views import with_views
from spark_elt.plans.q_files import SCHEMA, TS_FMT, _events
from spark_elt.plans.q_incremental import _ORD, _ord
from spark_elt.plans.registry import register
from spark_elt.session import scratch_dir
from spark_elt.streaming.ingest import ingest_new_files, stream_fold_node_runs, stream_upsert
from spark_elt.streaming.runlog import CLOSED, stream_node_output, stream_open_runs


@register("stream_only_new", "SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_only_new(spark, sf_dir):
    """Days 1–15 arrive, the stream loads them; days 16+ arrive, the second
    run loads only those. Every event is loaded exactly once."""
    src, sink, ck = (scratch_dir(spark, n) for n in ("stream_src", "stream_sink", "stream_ck"))
    e = _events(spark, sf_dir)

    def drop(df):
        (df.withColumn("d", F.date_format("ts", "dd")).repartitionByRange("ts").write.mode("append").partitionBy("d")
         .option("timestampNTZFormat", TS_FMT).csv(src))

    drop(e.where(F.dayofmonth("ts") <= 15))
    ingest_new_files(spark, src, SCHEMA, sink, ck, timestampNTZFormat=TS_FMT)
    drop(e.where(F.dayofmonth("ts") > 15))
    ingest_new_files(spark, src, SCHEMA, sink, ck, max_files_per_trigger=8, timestampNTZFormat=TS_FMT)
    return spark.read.schema(SCHEMA).parquet(sink)


_UPSERT_D = with_views(
    ["orders_v1", "orders_v2"],
    f"""SELECT {_ORD} FROM orders_v1 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_v2 WHERE o_orderkey % 7 = 0)
UNION ALL SELECT {_ORD} FROM orders_v2 WHERE o_orderkey % 7 = 0""",
)


@register("stream_upsert", _UPSERT_D)
def stream_upsert_q(spark, sf_dir):
    """The first snapshot arrives as one batch, the repriced orders (with
    an older copy of each, to be deduplicated by version) as the next. The target is
    partitioned by order year, so the second batch rewrites only the years it touches."""
    return _two_snapshots(spark, sf_dir, partition_by=["o_year"])


@register("stream_upsert_indexed", _UPSERT_D)
def stream_upsert_indexed(spark, sf_dir):
    """I13 as above into a target without partitions: a batch replaces the files that may
    hold its keys, by the target's key index."""
    return _two_snapshots(spark, sf_dir, indexed=True)


def _two_snapshots(spark, sf_dir, **how):
    src, tgt, ck, stg = (scratch_dir(spark, n) for n in ("upsert_src", "upsert_tgt", "upsert_ck", "upsert_stg"))
    year = lambda df: df.withColumn("o_year", F.year("o_orderdate"))
    year(fx.orders_v1(spark, sf_dir)).withColumn("version", F.lit(1)).write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema

    def run():
        stream_upsert(spark, spark.readStream.schema(schema).parquet(src), tgt, ["o_orderkey"], "version", ck, stg, **how)

    run()
    changed = year(fx.orders_v2(spark, sf_dir).where(F.col("o_orderkey") % 7 == 0))
    older = year(fx.orders_v1(spark, sf_dir).where(F.col("o_orderkey") % 7 == 0))
    changed.withColumn("version", F.lit(3)).unionByName(older.withColumn("version", F.lit(2))).write.mode("append").parquet(src)
    run()
    return _ord(spark.read.parquet(tgt))


NODE_RUN_SCHEMA = StructType([
    StructField("node_run_id", LongType()), StructField("run_id", LongType()), StructField("path_key", StringType()),
    StructField("start_time", TimestampNTZType()), StructField("end_time", TimestampNTZType()),
    StructField("succeeded", BooleanType()), StructField("is_pipeline", BooleanType()),
])


@register(
    "stream_fold_node_runs",
    with_views(["node_run"], """SELECT node_run_id, run_id, array_to_string(node_path, '/') AS node_path, start_time,
       end_time, succeeded, is_pipeline FROM node_run"""),
)
def stream_fold_node_runs_q(spark, sf_dir):
    """Node events arrive in two parts (before / after 2024-01-15, by event
    time); the final folded table equals the batch fold."""
    src, tgt, ck, stg = (scratch_dir(spark, n) for n in ("fold_src", "fold_tgt", "fold_ck", "fold_stg"))
    ev = fx.run_events(spark, sf_dir).where(F.col("event") != "Output").withColumn(
        "path_key", F.array_join("node_path", "/")
    ).drop("node_path", "message", "format", "is_error")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    ev.where(F.col("ts") < cut).write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    stream_fold_node_runs(spark, spark.readStream.schema(schema).parquet(src), tgt, ck, stg, runs_per_partition=20_000)
    ev.where(F.col("ts") >= cut).write.mode("append").parquet(src)
    stream_fold_node_runs(spark, spark.readStream.schema(schema).parquet(src), tgt, ck, stg, runs_per_partition=20_000)
    return spark.read.parquet(tgt).select(*NODE_RUN_SCHEMA.fieldNames()).withColumnRenamed("path_key", "node_path")


def _arrivals(spark, sf_dir, run, *kinds):
    """Run the stream ``run(events)`` on the events before 2024-01-15, and again when the
    later ones have come; a file holds the events of some days, in the order of time."""
    src, kept = scratch_dir(spark, "run_events"), scratch_dir(spark, "run_events_kept")
    ev = fx.run_events(spark, sf_dir).where(F.col("event").isin(*kinds)).withColumn("path_key", F.array_join("node_path", "/"))
    # made once: both parts, and the ranges of each, are read from it
    ev.drop("node_path").write.parquet(kept)
    ev = spark.read.schema(ev.drop("node_path").schema).parquet(kept)
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    for part in (ev.where(F.col("ts") < cut), ev.where(F.col("ts") >= cut)):
        part.repartitionByRange("ts").write.mode("append").parquet(src)
        schema = spark.read.parquet(src).schema
        run(spark.readStream.schema(schema).parquet(src))


@register(
    "stream_fold_output",
    with_views(["node_run", "node_output"], """SELECT o.* FROM node_output o JOIN node_run n ON n.node_run_id = o.node_run_id
WHERE n.end_time IS NOT NULL"""),
)
def stream_fold_output(spark, sf_dir):
    """I16: output lines are stored when their node finishes, those of unfinished nodes never."""
    sink, ck = scratch_dir(spark, "output_sink"), scratch_dir(spark, "output_ck")
    _arrivals(spark, sf_dir, lambda ev: stream_node_output(spark, ev, sink, ck, state_partitions=8), "Output", "NodeStarted", "NodeFinished")
    return spark.read.schema(
        "node_output_id long, node_run_id long, timestamp timestamp_ntz, message string, format string, is_error boolean"
    ).parquet(sink)


SILENCE = dt.timedelta(days=3)

_CLOSE_D = with_views(
    ["run", "node_run"],
    """SELECT 'node_run' AS kind, run_id, path_key, node_run_id, start_time,
  CASE WHEN closed THEN last + INTERVAL 3 DAYS ELSE end_time END AS end_time,
  CASE WHEN closed THEN FALSE ELSE succeeded END AS succeeded, is_pipeline, closed AS timed_out
FROM (SELECT n.*, array_to_string(n.node_path, '/') AS path_key, s.last,
        coalesce(f.stretch <> s.stretch, TRUE) AS closed, s.over
      FROM node_run n JOIN stretches s ON s.run_id = n.run_id AND n.start_time BETWEEN s.first AND s.last
      LEFT JOIN stretches f ON f.run_id = n.run_id AND n.end_time BETWEEN f.first AND f.last)
WHERE NOT closed OR over
UNION ALL
SELECT 'run', r.run_id, NULL, NULL, r.start_time,
  CASE WHEN closed THEN last + INTERVAL 3 DAYS ELSE end_time END, CASE WHEN closed THEN FALSE ELSE succeeded END, NULL, closed
FROM (SELECT r.*, s.last, s.over, coalesce(f.stretch <> s.stretch, TRUE) AS closed
      FROM run r JOIN stretches s ON s.run_id = r.run_id AND r.start_time BETWEEN s.first AND s.last
      LEFT JOIN stretches f ON f.run_id = r.run_id AND r.end_time BETWEEN f.first AND f.last) r
WHERE NOT closed OR over
UNION ALL
SELECT 'run', r.run_id, NULL, NULL, NULL, r.end_time, r.succeeded, NULL, FALSE
FROM run r JOIN stretches s ON s.run_id = r.run_id AND r.start_time BETWEEN s.first AND s.last
  JOIN stretches f ON f.run_id = r.run_id AND r.end_time BETWEEN f.first AND f.last AND f.stretch <> s.stretch""",
    [
        ("heard", """SELECT run_id, start_time AS ts FROM run UNION ALL SELECT run_id, end_time FROM run WHERE end_time IS NOT NULL
UNION ALL SELECT run_id, start_time FROM node_run UNION ALL SELECT run_id, end_time FROM node_run WHERE end_time IS NOT NULL"""),
        ("stretched", """SELECT run_id, ts, sum(CASE WHEN ts > before + INTERVAL 3 DAYS THEN 1 ELSE 0 END)
  OVER (PARTITION BY run_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stretch
FROM (SELECT *, lag(ts) OVER (PARTITION BY run_id ORDER BY ts) AS before FROM heard)"""),
        ("stretches", """SELECT run_id, stretch, min(ts) AS first, max(ts) AS last,
  max(ts) + INTERVAL 3 DAYS < (SELECT max(ts) FROM heard) - INTERVAL 1 HOUR
    OR stretch < max(stretch) OVER (PARTITION BY run_id) AS over
FROM (SELECT run_id, ts, max(stretch) OVER (PARTITION BY run_id, ts) AS stretch FROM stretched) GROUP BY run_id, stretch"""),
    ],
)


@register("stream_close_open_runs", _CLOSE_D)
def stream_close_open_runs(spark, sf_dir):
    """Finished node runs and runs leave the state; what is open in a run of which
    nothing is heard for three days is closed as failed by the run's timer."""
    sink, ck = scratch_dir(spark, "open_sink"), scratch_dir(spark, "open_ck")
    kinds = ("RunStarted", "RunFinished", "NodeStarted", "NodeFinished")
    _arrivals(spark, sf_dir, lambda ev: stream_open_runs(spark, ev, sink, ck, SILENCE, state_partitions=8), *kinds)
    return spark.read.schema(CLOSED).parquet(sink)
