"""State as a log of changes: equal to the versioned table, small writes, nodes apart."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from spark_elt.functions.paths import path_has_prefix
from spark_elt.operators import incremental as inc
from spark_elt.operators.state_log import StateLog
from spark_elt.session import local_path, scratch_dir
from spark_elt.sources import file_system
from spark_elt.sources.loads import FileLoad, parallel_read_file
from spark_elt.sources.selection import ReadMode

KEYS = ["node_path", "file_name"]
T = dt.datetime(2024, 1, 1)


def log(spark, path=None):
    return StateLog(spark, path or scratch_dir(spark, "log"), inc.PROCESSED_FILE, KEYS)


def files(spark, node, names, hour=0):
    return spark.createDataFrame([(node, n, T + dt.timedelta(hours=hour)) for n in names], inc.PROCESSED_FILE)


def rows(state, node=None):
    return sorted((tuple(r.node_path), r.file_name, r.last_modified_timestamp) for r in state.read(node).collect())


def test_equal_to_the_table(spark, monkeypatch):
    monkeypatch.setattr("spark_elt.operators.state_log.COMPACT_EVERY", 2)
    rng = random.Random(4)
    one, two = log(spark), inc.StateTable(spark, scratch_dir(spark, "tab"), inc.PROCESSED_FILE, KEYS)
    assert one.version() is None and rows(one) == []
    for step in range(6):
        node = ["a", "b"][: rng.randint(1, 2)]
        change = files(spark, node, rng.sample("uvwxyz", 3), step)
        for st in (one, two):
            if step == 3:
                st.delete_where(path_has_prefix("node_path", ["a", "b"]))
            elif step == 4:
                st.replace(change)
            else:
                st.upsert(change)
        assert rows(one) == rows(two)
        assert rows(one, ["a"]) == rows(two, ["a"])


def test_a_load_writes_its_files_only(spark, tmp_dir):
    root = os.path.join(tmp_dir, "in")
    os.makedirs(root)
    state = log(spark)
    load = FileLoad(root, "*.csv", "id int", f"{tmp_dir}/out", ["n"], state=state, mode=ReadMode.ONLY_NEW)
    for part in (range(20), range(20, 22)):
        for i in part:
            with open(os.path.join(root, f"{i}.csv"), "w") as f:
                f.write(f"{i}\n")
        assert parallel_read_file(spark, load) == len(part)
    folder = state._folder(["n"])
    assert [spark.read.parquet(f"{folder}/change={n}").count() for n in (1, 2)] == [20, 2]
    assert inc.processed_files(state, ["n"]).count() == 22 and parallel_read_file(spark, load) == 0


def test_nodes_never_conflict(spark):
    path = scratch_dir(spark, "log2")
    one, two = log(spark, path), log(spark, path)
    one.upsert(files(spark, ["a"], "x"))
    assert one._claim(one._folder(["a"])) == 2  # a writer of node a is under way
    two.upsert(files(spark, ["b"], "x"))
    with pytest.raises(inc.StateChanged):
        two.upsert(files(spark, ["a"], "y"))
    assert [r[:2] for r in rows(one)] == [(("a",), "x"), (("b",), "x")]
    # the writer is gone: after a while its number is passed over
    claim = f"{local_path(one._folder(['a']))}/_claim-2"
    os.utime(claim, (1, 1))
    two.upsert(files(spark, ["a"], "z"))
    assert [r[1] for r in rows(two, ["a"])] == ["x", "z"]


def test_broken_changes_do_not_count(spark):
    state = log(spark)
    state.upsert(files(spark, ["a"], "xy"))
    folder = state._folder(["a"])
    files(spark, ["a"], "q").withColumn("_seq", F.lit(2).cast("long")).withColumn("_put", F.lit(True)).write.parquet(f"{folder}/change=2")
    file_system.delete(spark, f"{folder}/change=2/_SUCCESS")
    assert [r[1] for r in rows(state)] == ["x", "y"]


def test_readers_during_compaction(spark):
    state = log(spark)
    frames = []
    for step in range(4):
        state.upsert(files(spark, ["a"], "uvw"[step % 3], step))
        frames.append((state.read(), rows(state)))
        state.compact(["a"])
        # what was listed before the compaction is read after it
        assert sorted((tuple(r.node_path), r.file_name, r.last_modified_timestamp) for r in frames[-1][0].collect()) == frames[-1][1]
        assert rows(state) == frames[-1][1]
    folder = state._folder(["a"])
    assert state._numbers(folder, "base") == [3, 4] and state._numbers(folder, "change") == [4]
    state.compact(["a"])  # nothing new
    assert rows(state) == frames[-1][1] and state.version() == 4


def test_copy_status_in_a_log(spark):
    state = StateLog(spark, scratch_dir(spark, "cs"), inc.COPY_STATUS, ["node_path", "source_table"])
    assert inc.get_last_value(state, ["a"], "s") is None
    inc.set_last_value(state, ["a"], "s", "1")
    inc.set_last_value(state, ["a"], "s", "2")
    assert inc.get_last_value(state, ["a"], "s") == "2" and inc.get_last_value(state, ["b"], "s") is None
    inc.delete_last_value(state, ["a"], "s")
    assert inc.get_last_value(state, ["a"], "s") is None
