"""Upserts by the key index: equal to the plain upsert, reading what the delta may touch."""

import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spark_elt.operators import incremental as inc
from spark_elt.operators import key_index as ki
from spark_elt.session import scratch_dir
from spark_elt.sources import file_system


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@given(st.lists(st.integers(-(2**63), 2**63 - 1), max_size=200), st.lists(st.integers(-(2**63), 2**63 - 1), max_size=50))
@settings(max_examples=100, deadline=None)
def test_filters_lose_no_key(held, others):
    bits = ki.bloom(np.array(held, np.int64))
    assert ki.may_hold(bits, np.array(held, np.int64)).all()
    assert len(ki.may_hold(bits, np.array(others, np.int64))) == len(others)


def test_filters_turn_others_away():
    rng = np.random.default_rng(1)
    held, others = rng.integers(-(2**63), 2**63 - 1, (2, 20_000))
    assert ki.may_hold(ki.bloom(held), others).mean() < 0.03


@given(st.lists(st.tuples(st.integers(-50, 50), st.integers(0, 40)), max_size=12), st.lists(st.one_of(st.none(), st.integers(-60, 100)), max_size=12))
@settings(max_examples=200, deadline=None)
def test_ranges(ranges, places):
    import pyarrow as pa

    files = sorted((lo, lo + n, f"f{i}") for i, (lo, n) in enumerate(ranges))
    low, high = (np.array([f[i] for f in files], np.int64) for i in (0, 1))
    batch = pa.record_batch([pa.array(places, pa.int64()), pa.array(range(len(places)), pa.int64())], ["place", "hash"])
    got = sorted((f, h) for b in ki._meet(iter([batch]), [f[2] for f in files], low, high) for f, h in zip(*(c.to_pylist() for c in b.columns)))
    assert got == sorted((f, h) for h, p in enumerate(places) for lo, hi, f in files if p is None or lo <= p <= hi)


def serial(spark, n, files):
    return spark.range(0, n, 1, files).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"), (F.col("id") % 3).alias("p"))


def test_reads_what_the_delta_may_touch(spark):
    target, staging = scratch_dir(spark, "ki a b%c"), scratch_dir(spark, "ki_stg")
    serial(spark, 4000, 40).write.parquet(target)
    before = set(ki.data_files(spark, target))
    delta = spark.createDataFrame([(k, "new", 0) for k in (5, 7, 1250, 9999)], "k long, v string, p long")
    assert len(ki.touched_files(spark, target, delta, ["k"])) == 2
    ki.upsert_indexed(spark, target, delta, ["k"], staging)
    after = set(ki.data_files(spark, target))
    assert len(before - after) == 2 and not file_system.exists(spark, staging)
    old = {r.k: r.v for r in spark.read.parquet(target).collect()}
    assert old == {**{k: f"v{k}" for k in range(4000)}, 5: "new", 7: "new", 1250: "new", 9999: "new"}
    # the index has a row for each file, and another delta finds the new ones
    listed, files = ki.index(spark, target, ["k"])
    assert sorted(r.file for r in listed.collect()) == sorted(files)
    assert len(ki.touched_files(spark, target, delta, ["k"])) <= 4


def test_filters_without_ranges(spark):
    """Text keys have no ranges; the filters alone leave few files."""
    target = scratch_dir(spark, "ki_text")
    spark.range(0, 2000, 1, 20).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), "id").write.parquet(target)
    delta = spark.range(3).select(F.sha2((F.col("id") * 600).cast("string"), 256).alias("k"), F.lit(-1).cast("long").alias("id"))
    assert 3 <= len(ki.touched_files(spark, target, delta, ["k"])) <= 6
    ki.upsert_indexed(spark, target, delta, ["k"], scratch_dir(spark, "ki_text_stg"))
    got = spark.read.parquet(target)
    assert got.count() == 2000 and got.where("id = -1").count() == 3


@pytest.mark.parametrize("parts", [None, ["p"]])
def test_equal_to_the_plain_upsert(spark, parts):
    rng = random.Random(7)
    schema = "k long, d date, v int, p string"
    one, two = scratch_dir(spark, "ki_one"), scratch_dir(spark, "ki_two")
    day = dt.date(2024, 1, 1)

    def some(n):
        keys = rng.sample(range(60), n)
        return [(k if k else None, day + dt.timedelta(k % 5), rng.randrange(100), rng.choice("xy z")) for k in keys]

    for _ in range(4):
        delta = spark.createDataFrame(some(12) + [(None, day, 1, None)], schema).repartition(3)
        ki.upsert_indexed(spark, one, delta, ["k", "d"], scratch_dir(spark, "s1"), partition_by=parts)
        inc.upsert(spark, two, delta, ["k", "d"], scratch_dir(spark, "s2"), partition_by=parts)
        assert rows(spark.read.parquet(one).select("k", "d", "v", "p")) == rows(spark.read.parquet(two).select("k", "d", "v", "p"))
    with pytest.raises(ValueError, match="duplicate keys"):
        ki.upsert_indexed(spark, one, spark.createDataFrame([(1, day, 1, "x")] * 2, schema), ["k", "d"], scratch_dir(spark, "s1"))


def test_index_survives_a_broken_write(spark, monkeypatch):
    target, staging = scratch_dir(spark, "ki_br"), scratch_dir(spark, "ki_br_stg")
    serial(spark, 400, 8).write.parquet(target)
    delta = spark.createDataFrame([(k, "new", 0) for k in (1, 399, 500)], "k long, v string, p long")
    want = {**{k: f"v{k}" for k in range(400)}, 1: "new", 399: "new", 500: "new"}
    real = {name: getattr(file_system, name) for name in ("move", "delete")}
    for name, calls in (("move", 1), ("delete", 1), ("delete", 2)):
        left = [calls]

        def breaks(*args, name=name, left=left):
            if name == "move" or not str(args[1]).endswith(("stg", "delta")) or "part-" in args[1]:
                left[0] -= 1
                if left[0] < 0:
                    raise OSError("lost")
            return real[name](*args)

        monkeypatch.setattr(file_system, name, breaks)
        try:
            ki.upsert_indexed(spark, target, delta, ["k"], staging)
        except OSError:
            pass
        monkeypatch.setattr(file_system, name, real[name])
        ki.upsert_indexed(spark, target, delta, ["k"], staging, resume=True)
        found = spark.read.parquet(target).collect()
        assert len(found) == len(want) and {r.k: r.v for r in found} == want
    # rows of files that are gone, or none at all, do no harm
    file_system.delete(spark, f"{target}/{ki.FOLDER}")
    serial(spark, 1, 1).select((F.col("k") + 700).alias("k"), "v", "p").write.mode("append").parquet(target)
    ki.upsert_indexed(spark, target, spark.createDataFrame([(700, "late", 0)], "k long, v string, p long"), ["k"], staging)
    assert {r.k: r.v for r in spark.read.parquet(target).collect()} == {**want, 700: "late"}


def test_late_rows_and_nothing(spark):
    target, staging = scratch_dir(spark, "ki_v"), scratch_dir(spark, "ki_v_stg")
    schema = "k long, v string, version int"

    def put(data):
        ki.upsert_indexed(spark, target, spark.createDataFrame(data, schema), ["k"], staging, version="version")

    put([(1, "five", 5), (2, "one", 1)])
    put([(1, "three", 3), (2, "two", 2)])
    put([])
    assert rows(spark.read.parquet(target)) == [(1, "five", 5), (2, "two", 2)]
