"""Streaming forms: out-of-order node events, replays and new-file ingest."""

import datetime as dt

import pytest

from spark_elt.operators.key_index import data_files
from spark_elt.session import scratch_dir
from spark_elt.streaming.ingest import ingest_new_files, stream_fold_node_runs, stream_upsert

T = dt.datetime(2024, 1, 1)
EV = ("run_id long, path_key string, event string, ts timestamp_ntz, is_pipeline boolean, succeeded boolean, seq long")


def test_fold_handles_finish_before_start_and_unfinished(spark):
    src, tgt, ck, stg = (scratch_dir(spark, n) for n in ("t_src", "t_tgt", "t_ck", "t_stg"))
    b1 = [(1, "a", "NodeFinished", T + dt.timedelta(seconds=9), True, True, 10),
          (1, "b", "NodeStarted", T, False, None, 11)]
    b2 = [(1, "a", "NodeStarted", T, True, None, 10)]
    spark.createDataFrame(b1, EV).write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    stream_fold_node_runs(spark, spark.readStream.schema(schema).parquet(src), tgt, ck, stg)
    spark.createDataFrame(b2, EV).write.mode("append").parquet(src)
    stream_fold_node_runs(spark, spark.readStream.schema(schema).parquet(src), tgt, ck, stg)
    stream_fold_node_runs(spark, spark.readStream.schema(schema).parquet(src), tgt, ck, stg)  # nothing new
    rows = {r["path_key"]: r for r in spark.read.parquet(tgt).collect()}
    assert rows["a"]["start_time"] == T and rows["a"]["end_time"] == T + dt.timedelta(seconds=9)
    assert rows["a"]["succeeded"] is True and rows["a"]["node_run_id"] == 10
    assert rows["b"]["end_time"] is None and rows["b"]["succeeded"] is None


def test_stream_upsert_dedups_within_batch(spark):
    src, tgt, ck, stg = (scratch_dir(spark, n) for n in ("u_src", "u_tgt", "u_ck", "u_stg"))
    spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k long, v string, version int").write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    run = lambda: stream_upsert(spark, spark.readStream.schema(schema).parquet(src), tgt, ["k"], "version", ck, stg)
    run()
    spark.createDataFrame([(2, "x", 2), (2, "y", 3), (3, "c", 2)], "k long, v string, version int").write.mode(
        "append").parquet(src)
    run()
    assert sorted(tuple(r) for r in spark.read.parquet(tgt).select("k", "v").collect()) == [(1, "a"), (2, "y"), (3, "c")]


def test_ingest_new_files_once(spark, tmp_dir):
    import os

    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    sink, ck = scratch_dir(spark, "i_sink"), scratch_dir(spark, "i_ck")
    open(os.path.join(src, "a.csv"), "w").write("1,x\n")
    ingest_new_files(spark, src, "id int, v string", sink, ck)
    open(os.path.join(src, "b.csv"), "w").write("2,y\n")
    ingest_new_files(spark, src, "id int, v string", sink, ck)
    assert sorted(r["id"] for r in spark.read.parquet(sink).collect()) == [1, 2]


@pytest.fixture()
def _wide(spark):
    """Shuffles keep all their partitions, as those of large tables do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_fold_writes_few_files_a_block(spark, _wide):
    """Many run blocks, each with runs in every shuffle partition: one file a block, not one a task."""
    src, tgt, ck, stg = (scratch_dir(spark, n) for n in ("f_src", "f_tgt", "f_ck", "f_stg"))
    for event, later in (("NodeStarted", 0), ("NodeFinished", 5)):
        ev = [(r, "a", event, T + dt.timedelta(seconds=later), True, True, r) for r in range(300)] + [(None, "n", event, T, True, True, 300)]
        spark.createDataFrame(ev, EV).write.mode("append").parquet(src)
        schema = spark.read.parquet(src).schema
        stream_fold_node_runs(spark, spark.readStream.schema(schema).parquet(src), tgt, ck, stg, runs_per_partition=20)
    got = spark.read.parquet(tgt).where("run_id is not null")
    assert got.count() == 300 and got.where("end_time is null or start_time is null").count() == 0
    assert len(data_files(spark, tgt)) <= 2 * 16
