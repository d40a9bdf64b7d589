"""Writes and state that survive failures, odd keys and other writers."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from spark_elt.operators import incremental as inc
from spark_elt.session import local_path, scratch_dir
from spark_elt.sources import file_system
from spark_elt.streaming.ingest import stream_upsert

SCHEMA = "k long, v string, p string"
D = dt.datetime(2024, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def spoil(path):
    """Make the data files of a local table unreadable as Parquet."""
    names = [os.path.join(d, n) for d, _, ns in os.walk(local_path(path)) for n in ns if n.endswith(".parquet")]
    for n in names:
        crc = os.path.join(os.path.dirname(n), f".{os.path.basename(n)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
        with open(n, "wb") as f:
            f.write(b"not parquet")
    assert names
    return names


def test_unreadable_target_is_left_alone(spark):
    target, staging = scratch_dir(spark, "sp"), scratch_dir(spark, "sp_stg")
    st = inc.StateTable(spark, scratch_dir(spark, "sp_st"), inc.COPY_STATUS, ["node_path", "source_table"])
    src = frame(spark, [(1, "a", "x")])
    assert inc.copy_incrementally(spark, src, target, "k", ["k"], st, ["n"], "s", staging) == "full"
    names = spoil(target)
    with pytest.raises(Exception):  # noqa: B017
        inc.copy_incrementally(spark, frame(spark, [(2, "b", "x")]), target, "k", ["k"], st, ["n"], "s", staging)
    assert all(open(n, "rb").read() == b"not parquet" for n in names)
    with pytest.raises(Exception):  # noqa: B017
        inc.upsert(spark, target, src, ["k"], staging)
    assert all(os.path.exists(n) for n in names)


def test_broken_copy_is_finished_by_the_next_run(spark, monkeypatch):
    target, staging = scratch_dir(spark, "br"), scratch_dir(spark, "br_stg")
    st = inc.StateTable(spark, scratch_dir(spark, "br_st"), inc.COPY_STATUS, ["node_path", "source_table"])

    def copy(data):
        return inc.copy_incrementally(spark, frame(spark, data), target, "k", ["k"], st, ["n"], "s", staging, partition_by=["p"])

    copy([(1, "a", "x"), (2, "b", "y")])
    finish = inc.finish_staged

    def crash(*args):
        for name in os.listdir(local_path(target)):  # as a broken overwrite may leave it
            if name == "p=y":
                file_system.delete(spark, f"{target}/{name}")
        raise OSError("lost")

    monkeypatch.setattr(inc, "finish_staged", crash)
    with pytest.raises(OSError):
        copy([(2, "B", "y"), (3, "c", "y")])
    monkeypatch.setattr(inc, "finish_staged", finish)
    assert inc.get_last_value(st, ["n"], "s") == "2" and inc.staged(spark, staging)
    assert copy([(3, "c", "y")]) == "delta"
    assert rows(spark.read.parquet(target).select("k", "v", "p")) == [(1, "a", "x"), (2, "B", "y"), (3, "c", "y")]
    assert not file_system.exists(spark, staging)


def test_moved_keys_leave_one_row(spark):
    target = scratch_dir(spark, "mv")
    odd = "a b:c%/é"  # characters that paths escape
    frame(spark, [(1, "a", odd), (2, "b", "B"), (3, "c", "B"), (4, "d", None)]).write.partitionBy("p").parquet(target)
    inc.upsert(spark, target, frame(spark, [(1, "A", "B"), (2, "B", None), (5, "e", "C")]), ["k"], scratch_dir(spark, "mv_stg"), partition_by=["p"])
    want = [(1, "A", "B"), (2, "B", None), (3, "c", "B"), (4, "d", None), (5, "e", "C")]
    assert rows(spark.read.parquet(target).select("k", "v", "p")) == sorted(want, key=str)


def test_null_keys_stay_apart(spark):
    data = frame(spark, [(None, "a", "x"), (None, "b", "x"), (1, "c", "x"), (1, "d", "x")])
    assert rows(inc.latest_per_key(data, ["k"], "v").select("k", "v")) == [(1, "d"), (None, "a"), (None, "b")]
    inc.check_unique(frame(spark, [(1, None, "x"), (1, None, "x")]), ["k", "v"])
    with pytest.raises(ValueError):
        inc.check_unique(frame(spark, [(1, "a", "x"), (1, "a", "y")]), ["k", "v"])


def test_delta_is_read_once(spark):
    target = scratch_dir(spark, "once")
    frame(spark, [(1, "a", "x"), (2, "b", "x")]).write.parquet(target)
    # each evaluation gives other values; keys that are matched must also arrive
    delta = spark.range(1, 200).select(F.col("id").alias("k"), F.uuid().alias("v"), F.lit("x").alias("p"))
    inc.upsert(spark, target, delta.where("rand() < 0.5 or k < 3"), ["k"], scratch_dir(spark, "once_stg"))
    got = spark.read.parquet(target)
    assert got.where("k < 3").count() == 2 and got.count() == got.select("k").distinct().count()


def test_late_batch_does_not_replace_a_newer_row(spark):
    src, tgt, ck, stg = (scratch_dir(spark, n) for n in ("lb_src", "lb_tgt", "lb_ck", "lb_stg"))
    schema = "k long, v string, version int"

    def batch(data):
        frame(spark, data, schema).write.mode("append").parquet(src)
        stream_upsert(spark, spark.readStream.schema(schema).parquet(src), tgt, ["k"], "version", ck, stg)

    batch([(1, "five", 5), (2, "one", 1)])
    batch([(1, "three", 3), (2, "two", 2), (3, "new", 1)])
    assert rows(spark.read.parquet(tgt)) == [(1, "five", 5), (2, "two", 2), (3, "new", 1)]
    assert file_system.children(spark, stg) == []
    spoil(tgt)
    with pytest.raises(Exception):  # noqa: B017
        batch([(9, "x", 1)])
    assert not any(n.startswith("_temporary") for n in os.listdir(local_path(tgt))) and os.listdir(local_path(tgt))


def test_state_writers(spark):
    path = scratch_dir(spark, "two")
    one, two = (inc.StateTable(spark, path, inc.COPY_STATUS, ["node_path", "source_table"]) for _ in range(2))
    inc.set_last_value(one, ["a"], "s", "1")
    inc.set_last_value(two, ["b"], "s", "2")  # sees the first writer's version
    assert rows(one.read().select("last_comparison_value")) == [("1",), ("2",)]
    base = one.version()
    rows_ = two.read()
    inc.set_last_value(one, ["c"], "s", "3")
    with pytest.raises(inc.StateChanged):
        two._write(rows_, base)
    assert one.read().count() == 3
    for k in range(4):
        inc.set_last_value(one, ["d"], "s", str(k))
    assert len(one.versions()) == 2
    one.delete_where(F.col("last_comparison_value") == F.lit(None))
    assert one.read().count() == 4


def test_sql_source(spark):
    spark.createDataFrame([(1, "a", "it's"), (2, "b", "it's"), (3, "c", "jt")], SCHEMA).createOrReplaceTempView("safety_src")
    target, staging = scratch_dir(spark, "sq"), scratch_dir(spark, "sq_stg")
    st = inc.StateTable(spark, scratch_dir(spark, "sq_st"), inc.COPY_STATUS, ["node_path", "source_table"])
    src = inc.sql_source(spark, "SELECT * FROM safety_src WHERE @@comparison@@ AND k < 3")
    assert inc.copy_incrementally(spark, src, target, "p", ["k"], st, ["n"], "s", staging) == "full"
    spark.createDataFrame([(1, "a2", "a"), (2, "b2", "it's")], SCHEMA).createOrReplaceTempView("safety_src")
    assert inc.copy_incrementally(spark, src, target, "p", ["k"], st, ["n"], "s", staging) == "delta"
    assert rows(spark.read.parquet(target).select("k", "v")) == [(1, "a"), (2, "b2")]
    with pytest.raises(ValueError):
        inc.sql_source(spark, "SELECT 1")


def _copier(spark, staging=None):
    target, stg = scratch_dir(spark, "cp"), staging or scratch_dir(spark, "cp_stg")
    st = inc.StateTable(spark, scratch_dir(spark, "cp_st"), inc.COPY_STATUS, ["node_path", "source_table"])

    def copy(src, expr="k", **more):
        return inc.copy_incrementally(spark, src, target, expr, ["k"], st, ["n"], "s", stg, **more)

    return target, st, copy


def test_full_load_refuses_duplicate_keys(spark):
    target, st, copy = _copier(spark)
    twice = frame(spark, [(1, "a", "x"), (1, "b", "y"), (2, "c", "x")])
    with pytest.raises(ValueError, match="duplicate keys"):
        copy(twice)
    assert not file_system.has_data(spark, target) and inc.get_last_value(st, ["n"], "s") is None
    assert copy(twice, dedup_by="v") == "full"
    assert rows(spark.read.parquet(target)) == [(1, "b", "y"), (2, "c", "x")]
    assert copy(frame(spark, [(2, "d", "x"), (2, "e", "x")]), dedup_by="v") == "delta"
    assert rows(spark.read.parquet(target)) == [(1, "b", "y"), (2, "e", "x")]
    # without a stored value a full load replaces what is there, once it is checked
    inc.delete_last_value(st, ["n"], "s")
    with pytest.raises(ValueError, match="duplicate keys"):
        copy(twice)
    assert rows(spark.read.parquet(target)) == [(1, "b", "y"), (2, "e", "x")]
    _, _, explicit = _copier(spark)
    assert explicit(twice, explicit=True) == "full"  # a target without a unique key


@pytest.mark.parametrize("parts", [None, ["p"]])
def test_failing_full_load_leaves_the_target(spark, monkeypatch, parts):
    target, st, copy = _copier(spark)
    copy(frame(spark, [(1, "a", "x"), (2, "b", "y")]), partition_by=parts)
    inc.delete_last_value(st, ["n"], "s")
    fails = spark.range(5, 9).select(F.col("id").alias("k"), F.when(F.col("id") < 8, "v").otherwise(F.raise_error(F.lit("gone"))).alias("v"), F.lit("x").alias("p"))
    with pytest.raises(Exception, match="gone"):
        copy(fails, partition_by=parts)
    assert rows(spark.read.parquet(target).select("k", "v", "p")) == [(1, "a", "x"), (2, "b", "y")]
    finish = inc.finish_staged

    def crash(*args):
        raise OSError("lost")

    monkeypatch.setattr(inc, "finish_staged", crash)
    with pytest.raises(OSError):
        copy(frame(spark, [(3, "c", "x")]), partition_by=parts)
    monkeypatch.setattr(inc, "finish_staged", finish)
    assert copy(frame(spark, [(3, "c", "x")]), partition_by=parts) == "full"
    assert rows(spark.read.parquet(target).select("k", "v", "p")) == [(3, "c", "x")]


def test_instants_are_stored_with_their_offset(spark):
    target, st, copy = _copier(spark)
    zone = spark.conf.get("spark.sql.session.timeZone")

    def source(*times):
        return spark.createDataFrame([(i, t) for i, t in times], "k long, text string").select("k", F.to_timestamp("text").alias("m"))

    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert copy(source((1, "2024-05-01 10:00:00.000001+00:00")), "m") == "full"
        assert inc.get_last_value(st, ["n"], "s") == "2024-05-01 10:00:00.000001+00:00"
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert copy(source((1, "2024-05-01 10:00:00.000001+00:00"), (2, "2024-05-01 12:00:00+00:00")), "m") == "delta"
        assert spark.read.parquet(target).count() == 2
        assert inc.get_last_value(st, ["n"], "s") == "2024-05-01 12:00:00+00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_plain_retry_keeps_the_whole_copy(spark, monkeypatch):
    """A target that a broken copy left without its data is whole after any later upsert
    with the same staging."""
    target, staging = scratch_dir(spark, "rt"), scratch_dir(spark, "rt_stg")
    frame(spark, [(1, "a", "x"), (2, "b", "x")]).write.parquet(target)
    finish = inc.finish_staged

    def crash(*args):
        file_system.delete(spark, target)
        raise OSError("lost")

    monkeypatch.setattr(inc, "finish_staged", crash)
    with pytest.raises(OSError):
        inc.upsert(spark, target, frame(spark, [(2, "B", "x")]), ["k"], staging)
    monkeypatch.setattr(inc, "finish_staged", finish)
    inc.upsert(spark, target, frame(spark, [(3, "c", "x")]), ["k"], staging)
    assert rows(spark.read.parquet(target)) == [(1, "a", "x"), (2, "B", "x"), (3, "c", "x")]
    assert not file_system.exists(spark, staging)
