"""State tables, upsert and incremental copy on small handmade frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from spark_elt.operators import incremental as inc
from spark_elt.session import scratch_dir

SCHEMA = "k long, v string, ts timestamp_ntz"
D = dt.datetime(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_state_table_versions_and_empty(spark):
    st = inc.StateTable(spark, scratch_dir(spark, "t_state"), inc.COPY_STATUS, ["node_path", "source_table"])
    assert st.read().count() == 0
    inc.set_last_value(st, ["a"], "db.t", "1")
    inc.set_last_value(st, ["a", "b"], "db.t", "")
    inc.set_last_value(st, ["a"], "db.t", "2")
    assert inc.get_last_value(st, ["a"], "db.t") == "2"
    assert inc.get_last_value(st, ["a", "b"], "db.t") == ""
    inc.delete_last_value(st, ["a"], "db.t")
    inc.delete_last_value(st, ["a", "b"], "db.t")
    assert st.read().count() == 0  # an empty version is still a version
    assert st.version() == 5


def test_reset_prefix(spark):
    st = inc.StateTable(spark, scratch_dir(spark, "t_reset"), inc.COPY_STATUS, ["node_path", "source_table"])
    for p in (["a"], ["a", "b"], ["c"]):
        inc.set_last_value(st, p, "x", "1")
    summary = inc.reset_summary({"incremental copy statuses": st}, ["a"])
    assert sorted(tuple(r["node_path"]) for r in summary.collect()) == [("a",), ("a", "b")]
    inc.reset({"s": st}, ["a"])
    assert [tuple(r["node_path"]) for r in st.read().collect()] == [("c",)]


def test_upsert_rejects_duplicate_keys_unless_dedup(spark):
    target = scratch_dir(spark, "t_up")
    frame(spark, [(1, "a", D), (2, "b", D)]).write.parquet(target)
    delta = frame(spark, [(2, "x", D), (2, "y", D + dt.timedelta(1)), (3, "z", D)])
    with pytest.raises(ValueError):
        inc.upsert(spark, target, delta, ["k"], scratch_dir(spark, "stg"))
    inc.upsert(spark, target, delta, ["k"], scratch_dir(spark, "stg"), dedup_by="ts")
    assert rows(spark.read.parquet(target).select("k", "v")) == [(1, "a"), (2, "y"), (3, "z")]


def test_null_keys_are_inserted_again(spark):
    target = scratch_dir(spark, "t_null")
    frame(spark, [(None, "a", D), (1, "b", D)]).write.parquet(target)
    inc.upsert(spark, target, frame(spark, [(None, "c", D)]), ["k"], scratch_dir(spark, "stg"))
    assert rows(spark.read.parquet(target).select("k", "v")) == [(1, "b"), (None, "a"), (None, "c")]


def test_explicit_upsert_null_values_overwrite(spark):
    target = scratch_dir(spark, "t_expl")
    frame(spark, [(1, "a", D), (2, "b", D)]).write.parquet(target)
    inc.upsert(spark, target, frame(spark, [(1, None, D), (5, "e", D)]), ["k"], scratch_dir(spark, "stg"), explicit=True)
    assert rows(spark.read.parquet(target).select("k", "v")) == [(1, None), (2, "b"), (5, "e")]


def test_partitioned_upsert_rewrites_touched_partitions_only(spark):
    target = scratch_dir(spark, "t_part")
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k long, v string, day int")
    df.write.partitionBy("day").parquet(target)
    delta = spark.createDataFrame([(2, "B", 2), (3, "c", 2)], "k long, v string, day int")
    inc.upsert(spark, target, delta, ["k"], scratch_dir(spark, "stg"), partition_by=["day"])
    assert rows(spark.read.parquet(target).select("k", "v", "day")) == [(1, "a", 1), (2, "B", 2), (3, "c", 2)]


def _copy(spark, src, target, st, staging):
    return inc.copy_incrementally(spark, src, target, "ts", ["k"], st, ["copy"], "db.src", staging)


def test_copy_incrementally_modes(spark):
    target, staging = scratch_dir(spark, "t_copy"), scratch_dir(spark, "t_copy_stg")
    st = inc.StateTable(spark, scratch_dir(spark, "t_copy_st"), inc.COPY_STATUS, ["node_path", "source_table"])
    empty = frame(spark, []).where(F.lit(False))
    assert _copy(spark, empty, target, st, staging) == "empty"
    v1 = frame(spark, [(1, "a", D), (2, "b", D + dt.timedelta(1))])
    assert _copy(spark, v1, target, st, staging) == "full"
    assert inc.get_last_value(st, ["copy"], "db.src") == "2024-01-02 00:00:00"
    # older change (k=1) must not arrive; boundary row (k=2) and new row arrive
    v2 = frame(spark, [(1, "A", D), (2, "B", D + dt.timedelta(1)), (3, "c", D + dt.timedelta(2))])
    assert _copy(spark, v2, target, st, staging) == "delta"
    assert rows(spark.read.parquet(target).select("k", "v")) == [(1, "a"), (2, "B"), (3, "c")]
    # a stored empty string counts as no value: full load again
    inc.set_last_value(st, ["copy"], "db.src", "")
    assert _copy(spark, v2, target, st, staging) == "full"


def test_dependency_guard(spark):
    st = inc.StateTable(spark, scratch_dir(spark, "t_dep"), inc.FILE_DEPENDENCY, ["node_path", "dependency_type"])
    calls = []
    ran, _ = inc.run_if_changed(st, ["n"], "t", "h1", lambda: calls.append(1), D)
    assert ran and inc.is_modified(st, ["n"], "t", "h2") and not inc.is_modified(st, ["n"], "t", "h1")
    ran, _ = inc.run_if_changed(st, ["n"], "t", "h1", lambda: calls.append(1), D)
    assert not ran and calls == [1]
    with pytest.raises(RuntimeError):
        inc.run_if_changed(st, ["n"], "t", "h3", lambda: False, D)
    assert inc.is_modified(st, ["n"], "t", "h1")  # old hash deleted before the failed run


def test_dependency_hash_file_and_frame_agree(spark, tmp_dir):
    import os

    files = []
    for i, text in enumerate(["SELECT 1", "SELECT 2"]):
        p = os.path.join(tmp_dir, f"f{i}.sql")
        open(p, "w").write(text)
        files.append(p)
    h = inc.dependency_hash(files, dt.date(2000, 1, 1))
    assert inc.dependency_hash_frame(spark, files, dt.date(2000, 1, 1)).collect()[0]["hash"] == h


def test_state_saved_only_after_successful_load(spark):
    target, staging = scratch_dir(spark, "t_fail"), scratch_dir(spark, "t_fail_stg")
    st = inc.StateTable(spark, scratch_dir(spark, "t_fail_st"), inc.COPY_STATUS, ["node_path", "source_table"])
    good = frame(spark, [(1, "a", D)])
    assert _copy(spark, good, target, st, staging) == "full"
    bad = frame(spark, [(1, "a", D + dt.timedelta(1))]).withColumn(
        "v", F.when(F.col("k") == 1, F.raise_error(F.lit("boom"))).otherwise(F.col("v")).cast("string"))
    with pytest.raises(Exception):
        _copy(spark, bad, target, st, staging)
    assert inc.get_last_value(st, ["copy"], "db.src") == "2024-01-01 00:00:00"


def test_lookback_rereads_late_rows(spark):
    target, staging = scratch_dir(spark, "t_lb"), scratch_dir(spark, "t_lb_stg")
    st = inc.StateTable(spark, scratch_dir(spark, "t_lb_st"), inc.COPY_STATUS, ["node_path", "source_table"])
    v1 = frame(spark, [(1, "a", D), (2, "b", D + dt.timedelta(2))])
    inc.copy_incrementally(spark, v1, target, "ts", ["k"], st, ["c"], "s", staging)
    v2 = frame(spark, [(1, "A", D + dt.timedelta(1)), (2, "b", D + dt.timedelta(2))])
    inc.copy_incrementally(spark, v2, target, "ts", ["k"], st, ["c"], "s", scratch_dir(spark, "x"),
                           lookback="INTERVAL 1 DAY")
    assert rows(spark.read.parquet(target).select("k", "v")) == [(1, "A"), (2, "b")]


def test_catalog_insert_and_analyze(spark, tmp_dir):
    import uuid

    from spark_elt.operators import sinks

    name = f"t_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE TABLE {name} (k BIGINT, v STRING, day_id INT) USING parquet PARTITIONED BY (day_id) "
              f"LOCATION '{tmp_dir}/{name}'")
    try:
        sinks.insert_into(spark, spark.createDataFrame([(1, "a", 20240101)], "x long, y string, d int"), name)
        sinks.analyze(spark, name, {"day_id": 20240101})
        assert spark.table(name).count() == 1
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_copy_incrementally_partitioned_target(spark):
    target, staging = scratch_dir(spark, "t_pc"), scratch_dir(spark, "t_pc_stg")
    st = inc.StateTable(spark, scratch_dir(spark, "t_pc_st"), inc.COPY_STATUS, ["node_path", "source_table"])
    v1 = frame(spark, [(1, "a", D), (2, "b", D + dt.timedelta(1))]).withColumn("day", F.dayofmonth("ts"))
    inc.copy_incrementally(spark, v1, target, "ts", ["k"], st, ["c"], "s", staging, partition_by=["day"])
    v2 = frame(spark, [(2, "B", D + dt.timedelta(1)), (3, "c", D + dt.timedelta(1))]).withColumn("day", F.dayofmonth("ts"))
    assert inc.copy_incrementally(spark, v2, target, "ts", ["k"], st, ["c"], "s", scratch_dir(spark, "s2"),
                                  partition_by=["day"]) == "delta"
    assert rows(spark.read.parquet(target).select("k", "v", "day")) == [(1, "a", 1), (2, "B", 2), (3, "c", 2)]
