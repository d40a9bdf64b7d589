"""The stored run-log tables: equal to the frames' operators, all or nothing."""

import datetime as dt

import pytest

from spark_elt.operators import run_tables as rt
from spark_elt.operators.incremental import StateChanged
from spark_elt.operators.runlog import close_open_runs, retention_prune
from spark_elt.session import scratch_dir
from spark_elt.sources import file_system

T = dt.datetime(2024, 1, 1)
SCHEMAS = (
    "run_id long, start_time timestamp_ntz, end_time timestamp_ntz, succeeded boolean",
    "node_run_id long, run_id long, start_time timestamp_ntz, end_time timestamp_ntz, succeeded boolean",
    "node_output_id long, node_run_id long, message string",
    "timestamp timestamp_ntz, run_id long, cpu_usage double",
)


def h(hours):
    return T + dt.timedelta(hours=hours)


def log(runs):
    """Rows of the four tables; every third run is open, run 4 has no start, node 990 no run."""
    run = [(r, None if r == 4 else h(9 * r), None if r % 3 == 0 else h(9 * r + 30), None if r % 3 == 0 else True) for r in runs]
    node = [(10 * r + k, r, h(9 * r + 20 * k), None if r % 3 == 0 and k else h(9 * r + 25), True) for r in runs for k in range(2)]
    node += [(990, 99, h(1), None, None)] if 0 in runs else []
    out = [(10 * n + k, n, f"line {k}") for n, *_ in node for k in range(2)]
    stats = [(h(7 * r), r, 1.0) for r in runs] + [(None, -1, 2.0)]
    return run, node, out, stats


def frames(spark, data):
    return [spark.createDataFrame(d, s) for d, s in zip(data, SCHEMAS)]


def rows(dfs):
    return [sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=str) for df in dfs]


@pytest.fixture()
def stored(spark):
    tables = rt.RunTables(spark, scratch_dir(spark, "rt a"))
    first, second = log(range(6)), log(range(6, 14))
    # a node run and lines that come after their run
    late = first[1].pop(3)
    second[1].append(late)
    moved = [line for line in first[2] if line[1] == late[0]] + first[2][:1]
    second[2].extend(moved)
    first[2][:] = [line for line in first[2] if line not in moved]
    for data in (first, second):
        tables.append(*frames(spark, data))
    return tables, frames(spark, [a + b for a, b in zip(first, second)])


def test_append_and_retention(spark, stored, monkeypatch):
    tables, whole = stored
    assert rows(tables.read()) == rows(whole)
    assert rows(tables.read("run"))[0] == rows(whole)[0]
    written = []
    write = rt.RunTables._write
    monkeypatch.setattr(rt.RunTables, "_write", lambda self, t, df: written.append((t, df.count())) or write(self, t, df))
    now = h(100)  # 36 hours before it lies within a day
    tables.prune(2, now)
    want = rows(retention_prune(*whole, 2, now))
    assert rows(tables.read()) == want and len(want[0]) < 14
    # only the day of the limit is written again
    assert sum(n for _, n in written) < sum(map(len, want)) / 3
    tables.prune(2, now)
    assert rows(tables.read()) == want
    tables.clean()
    assert rows(tables.read()) == want
    with pytest.raises(ValueError, match="no rows yet"):
        rt.RunTables(spark, scratch_dir(spark, "rt0")).read()


def test_close_open_runs(stored):
    tables, whole = stored
    for run_id in (3, 1, 77):
        tables.close_open_runs(run_id, h(500))
        whole[:2] = [close_open_runs(df, run_id, h(500)) for df in whole[:2]]
        assert rows(tables.read()) == rows(whole)


@pytest.mark.parametrize("step", [0, 2, 3, 4, 5, 9])
def test_a_crash_leaves_all_old_or_all_new(stored, monkeypatch, step):
    tables, whole = stored
    before, after = rows(whole), rows(retention_prune(*whole, 2, h(100)))
    left = [step]

    def breaking(fn):
        def run(*args):
            left[0] -= 1
            if left[0] < 0:
                raise OSError("lost")
            return fn(*args)

        return run

    monkeypatch.setattr(rt.RunTables, "_write", breaking(rt.RunTables._write))
    for name in ("create_new", "write_text"):
        monkeypatch.setattr(file_system, name, breaking(getattr(file_system, name)))
    broken = False
    try:
        tables.prune(2, h(100))
    except OSError:
        broken = True
    monkeypatch.undo()
    assert rows(tables.read()) == (before if broken else after)
    assert broken == (step < 6)  # four tables, a claim and a manifest


def test_two_writers(stored):
    tables, _ = stored
    manifest = tables._manifest(2)
    tables.prune(2, h(100))
    with pytest.raises(StateChanged):
        tables._commit(2, manifest)
    file_system.create_new(tables.spark, f"{tables.path}/manifests/_claim-4")
    with pytest.raises(StateChanged):
        tables.prune(1, h(100))
