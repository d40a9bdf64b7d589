"""Run-log analytics on small handmade run tables (edge cases of FIXTURES.md)."""

import datetime as dt

from pyspark.sql import functions as F

from spark_elt.operators import analytics as an
from spark_elt.operators import runlog as rl

T = dt.datetime(2024, 1, 1)
NR_SCHEMA = ("node_run_id long, run_id long, node_path array<string>, start_time timestamp_ntz, "
             "end_time timestamp_ntz, succeeded boolean, is_pipeline boolean")


def s(sec):
    return T + dt.timedelta(seconds=sec)


def node_runs(spark):
    rows = [
        # run 1: root, pipeline a with tasks, task c
        (1, 1, [], s(0), s(100), True, True),
        (2, 1, ["a"], s(0), s(60), True, True),
        (3, 1, ["a", "t1"], s(0), s(20), True, False),
        (4, 1, ["a", "t2"], s(20), s(60), True, False),
        (5, 1, ["c"], s(60), s(100), True, False),
        # run 2: c fails, a unfinished, t2 did not run
        (6, 2, [], s(1000), None, None, True),
        (7, 2, ["a"], s(1000), None, None, True),
        (8, 2, ["a", "t1"], s(1000), s(1030), True, False),
        (9, 2, ["c"], s(1000), s(1010), False, False),
    ]
    return spark.createDataFrame(rows, NR_SCHEMA)


def test_node_durations_root_and_level(spark):
    nr = node_runs(spark)
    root = {tuple(r["node_path"]): (r["avg_duration"], r["avg_run_time"]) for r in an.node_durations(nr, []).collect()}
    # a: only run 1 succeeded (60s); its leaves avg: t1 (20+30)/2, t2 40 → 65
    assert root[("a",)] == (60.0, 65.0)
    assert root[("c",)] == (40.0, 40.0)  # failed run ignored
    child = {tuple(r["node_path"]): r["avg_duration"] for r in an.node_durations(nr, ["a"]).collect()}
    assert child == {("a", "t1"): 25.0, ("a", "t2"): 40.0}


def test_top_children_and_chart_null_slots(spark):
    nr = node_runs(spark)
    top = [(r["node_name"], r["rank"]) for r in an.top_children(nr, []).orderBy("rank").collect()]
    assert top == [("a", 1), ("c", 2)]  # a avg 60, c avg (40+10)/2
    chart = {r["run_id"]: r for r in an.run_time_chart(nr, []).collect()}
    assert chart[1]["child_names"] == ["a", "c"]
    # run 2: a is unfinished -> object with NULL fields; run 1 root data present
    assert chart[2]["child_runs"][0] == '{"duration":null,"succeeded":null}'
    assert chart[2]["node_run"] is None
    assert chart[1]["node_run"] == '{"succeeded":true,"duration":100.0}'


def test_chart_keeps_null_for_child_that_did_not_run(spark):
    nr = node_runs(spark).where(~((F.col("run_id") == 2) & (F.col("node_path") == F.array(F.lit("c")))))
    chart = {r["run_id"]: r for r in an.run_time_chart(nr, []).collect()}
    assert chart[2]["child_runs"][1] is None


def test_timeline_end_fallback(spark):
    nr = node_runs(spark)
    rows = {r["node_path"]: r for r in an.timeline(nr, [], 2).collect()}
    assert rows["a"]["status"] == "unfinished"
    assert rows["a"]["end"] == s(1031).isoformat()  # max end of the run + 1 s
    assert rows["a/t1"]["label"] == "a / t1"


def test_interval_join_has_no_nested_loop_and_matches_naive(spark):
    nr = node_runs(spark)
    stats = spark.createDataFrame(
        [(s(10), 1), (s(50), -1), (s(1005), 2), (s(1005), -1), (s(5000), -1)],
        "timestamp timestamp_ntz, run_id long",
    )
    for c in an.STAT_COLS:
        stats = stats.withColumn(c, F.lit(1.0))
    fast = an.interval_join_stats(nr, stats, bucket_seconds=60)
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan
    naive = nr.alias("n").join(
        stats.alias("s"),
        F.col("s.timestamp").between(F.col("n.start_time"), F.col("n.end_time"))
        & ((F.col("s.run_id") == F.col("n.run_id")) | (F.col("s.run_id") == -1)),
    ).select("n.node_run_id", "s.timestamp", "s.run_id")
    key = lambda df: sorted(tuple(r) for r in df.select("node_run_id", "timestamp", "run_id").collect())
    assert key(fast) == key(naive)


def test_interval_cells_cover_once(spark):
    import random

    rng = random.Random(3)
    pairs = [(lo, lo + rng.choice([0, 1, 5, 40, 3000])) for lo in (rng.randrange(-500, 500) for _ in range(200))] + [(5, 4), (-4, 3), (0, 63)]
    got = spark.createDataFrame(pairs, "lo long, hi long").withColumn("c", an.interval_cells("lo", "hi")).collect()
    for r in got:
        covered = sorted(n for c in r.c or [] for n in range(c.cell << 2 * c.level, (c.cell + 1) << 2 * c.level))
        assert covered == list(range(r.lo, r.hi + 1))
        assert len(r.c or []) <= 6 * max(1, (r.hi - r.lo + 1).bit_length() / 2 + 1)


def test_interval_join_from_seconds_to_years(spark):
    """Runs of seconds and of a year with many sentinel samples: few cells, few pairs."""
    day = 86_400
    starts = [(i, 1, s(i * 40 * day // 100), s(i * 40 * day // 100 + 3)) for i in range(100)]
    runs = [(1000, 1, s(0), s(365 * day)), (1001, 2, s(-3), s(40 * day + 1)), (1002, 2, s(7), s(7)), (1003, 1, s(9), s(8)), *starts]
    nr = spark.createDataFrame([(*r, ["n"]) for r in runs], "node_run_id long, run_id long, start_time timestamp_ntz, end_time timestamp_ntz, node_path array<string>")
    samples = [(s(i * 3571), -1 if i % 3 else i % 2 + 1) for i in range(1000)] + [(s(7), -1), (s(365 * day), 1)]
    stats = spark.createDataFrame(samples, "timestamp timestamp_ntz, run_id long")
    for c in an.STAT_COLS:
        stats = stats.withColumn(c, F.lit(1.0))
    got = sorted(tuple(r)[:3] for r in an.interval_join_stats(nr, stats).collect())
    want = sorted((n, t, r) for n, run, a, b in runs for t, r in samples if a <= t <= b and r in (run, -1))
    assert got == want
    year = nr.where("node_run_id = 1000").select(F.lit(0).cast("long").alias("lo"), F.lit(365 * day // 4).cast("long").alias("hi"))
    assert year.select(F.size(an.interval_cells("lo", "hi"))).first()[0] < 100


def test_min_rows_gate(spark):
    df = spark.createDataFrame([(1, i) for i in range(15)] + [(2, 1)], "k long, v long")
    assert sorted({r["k"] for r in an.min_rows(df, ["k"], 15).collect()}) == [1]


def _py_digest(events):
    """Python replay of the chat digest fold (Teams form) for the test."""
    output, last = "", ""
    for fmt, msg in events:
        if fmt == "verbatim":
            if last == fmt:
                output = output[: -len("</pre>")] + f"\n{msg}</pre>"
            else:
                output += f"\n<pre>{msg}</pre>"
        elif fmt == "italics":
            for line in msg.splitlines():
                output += "\n\n" + line.replace("_", "\\_")
        else:
            output = f"\n{msg}"
        last = fmt
    return output


def test_failure_digest_matches_python_fold(spark):
    nr = spark.createDataFrame([(1, 1, ["p", "my_task"], s(0), s(5), False, False)], NR_SCHEMA)
    outs = [
        ("verbatim", "v1"), ("verbatim", "v2"), ("italics", "it_a\nit_b"), ("standard", "std"),
        ("verbatim", "v3"), ("italics", "x"), ("verbatim", "v4"), ("verbatim", "v5"),
    ]
    errs = [("verbatim", "e1"), ("standard", "e2"), ("italics", "e_3")]
    rows = [(i, 1, s(i), m, f, False) for i, (f, m) in enumerate(outs)]
    rows += [(100 + i, 1, s(i), m, f, True) for i, (f, m) in enumerate(errs)]
    out = spark.createDataFrame(rows, "node_output_id long, node_run_id long, timestamp timestamp_ntz, message string, "
                                      "format string, is_error boolean")
    got = rl.failure_digest(nr, out).collect()[0]["message"]
    header = rl.HEADER + "p/my\\_task_](/p/my_task)"
    assert got == header + _py_digest(outs) + _py_digest(errs)


def test_failure_digest_truncates(spark):
    nr = spark.createDataFrame([(1, 1, ["t"], s(0), s(5), False, False)], NR_SCHEMA)
    rows = [(i, 1, s(i), "x" * 300, "verbatim", False) for i in range(20)]
    out = spark.createDataFrame(rows, "node_output_id long, node_run_id long, timestamp timestamp_ntz, message string, "
                                      "format string, is_error boolean")
    got = rl.failure_digest(nr, out).collect()[0]["message"]
    assert len(got) == 2000 + len("</pre>") and got.endswith("</pre>")


def test_folds_unfinished_and_no_output(spark):
    ev = spark.createDataFrame(
        [
            (1, [], "RunStarted", s(0), None, None, None, None, None, None),
            (2, [], "RunStarted", s(0), None, None, None, None, None, None),
            (2, [], "RunFinished", s(9), None, False, None, None, None, None),
            (1, ["a"], "NodeStarted", s(0), True, None, None, None, None, 10),
            (1, ["a"], "NodeFinished", s(5), True, True, None, None, None, 10),
            (1, ["b"], "NodeStarted", s(1), False, None, None, None, None, 11),
            (1, ["b"], "Output", s(2), None, None, "hi", "standard", False, 12),
        ],
        "run_id long, node_path array<string>, event string, ts timestamp_ntz, is_pipeline boolean, succeeded boolean, "
        "message string, format string, is_error boolean, seq long",
    )
    runs = {tuple(r["node_path"]): r for r in rl.fold_node_runs(ev).collect()}
    assert runs[("b",)]["end_time"] is None and runs[("b",)]["succeeded"] is None
    assert rl.fold_node_output(ev, rl.fold_node_runs(ev)).count() == 0  # b unfinished, a had no output
    run = {r["run_id"]: (r["start_time"], r["end_time"], r["succeeded"]) for r in rl.fold_runs(ev).collect()}
    assert run == {1: (s(0), None, None), 2: (s(0), s(9), False)}


def test_close_open_runs_and_retention(spark):
    nr = node_runs(spark)
    now = dt.datetime(2024, 2, 1)
    closed = {r["node_run_id"]: r for r in rl.close_open_runs(nr, 2, now).collect()}
    assert closed[7]["end_time"] == now and closed[7]["succeeded"] is False
    assert closed[8]["end_time"] == s(1030)
    run = nr.groupBy("run_id").agg(F.min("start_time").alias("start_time"))
    out = spark.createDataFrame([(1, 1), (2, 8)], "node_output_id long, node_run_id long")
    stats = spark.createDataFrame([(s(0),), (s(2000),)], "timestamp timestamp_ntz")
    cutoff = s(500) + dt.timedelta(days=1)
    r, n, o, st = rl.retention_prune(run, nr, out, stats, 1, cutoff)
    assert [x["run_id"] for x in r.collect()] == [2]
    assert {x["node_run_id"] for x in n.collect()} == {6, 7, 8, 9}
    assert [x["node_output_id"] for x in o.collect()] == [2]
    assert st.count() == 1


def test_failure_digest_line_breaks_at_the_end(spark):
    nr = spark.createDataFrame([(1, 1, ["p", "t"], s(0), s(5), False, False)], NR_SCHEMA)
    outs = [("italics", "a\n"), ("italics", "b\n\n"), ("italics", "\n"), ("italics", ""), ("italics", "c\r\nd\x0be"), ("verbatim", "v\n")]
    rows = [(i, 1, s(i), m, f, False) for i, (f, m) in enumerate(outs)]
    out = spark.createDataFrame(rows, "node_output_id long, node_run_id long, timestamp timestamp_ntz, message string, "
                                      "format string, is_error boolean")
    assert rl.failure_digest(nr, out).collect()[0]["message"] == rl.HEADER + "p/t_](/p/t)" + _py_digest(outs)


def test_retention_keeps_rows_without_time(spark):
    run = spark.createDataFrame([(1, None), (2, s(0))], "run_id long, start_time timestamp_ntz")
    nr = spark.createDataFrame([(10, 1), (20, 2)], "node_run_id long, run_id long")
    out = spark.createDataFrame([(100, 10), (200, 20)], "node_output_id long, node_run_id long")
    stats = spark.createDataFrame([(None,), (s(0),)], "timestamp timestamp_ntz")
    kept = rl.retention_prune(run, nr, out, stats, 1, dt.datetime(2030, 1, 1))
    keys = ("run_id", "node_run_id", "node_output_id", "timestamp")
    assert [[r[k] for r in df.collect()] for df, k in zip(kept, keys, strict=True)] == [[1], [10], [100], [None]]


def test_format_duration_rounds_ties_to_even(spark):
    from spark_elt.functions import format_duration

    got = spark.createDataFrame([(0.25,), (0.75,), (2.5,), (12.0,)], "x double").select(format_duration(F.col("x")).alias("t"))
    assert [r.t for r in got.collect()] == [f"{round(x, 1)}s" for x in (0.25, 0.75, 2.5, 12.0)]


def _samples(spark, rows):
    stats = spark.createDataFrame(rows, "timestamp timestamp_ntz, run_id long")
    for c in an.STAT_COLS:
        stats = stats.withColumn(c, F.lit(1.0))
    return stats


def test_samples_of_few_runs_are_not_shuffled(spark):
    """One run of a day with many samples: the samples meet it where they are, however large."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as for tables above it
    try:
        nr = spark.createDataFrame([(1, 5, s(0), s(86_400), ["n"])], "node_run_id long, run_id long, start_time timestamp_ntz, end_time timestamp_ntz, node_path array<string>")
        samples = [(s(i * 100), -1 if i % 2 else 5) for i in range(-50, 1000)]
        got = an.system_stats(nr, _samples(spark, samples), ["n"], 5)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "NestedLoop" not in plan
        want = sorted((1, t, r) for t, r in samples if s(0) <= t <= s(86_400))
        assert sorted(tuple(r)[:3] for r in got.collect()) == want and len(want) > 800
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_many_runs_have_few_cells(spark):
    """Shuffled runs of seconds to weeks: right pairs, and few rows for each run and sample."""
    import random

    rng = random.Random(4)
    runs = [(i, i % 7, s(a), s(a + rng.choice([0, 3, 16, 63, 64, 700, 5000, 10**6]))) for i, a in enumerate(rng.randrange(-5000, 100_000) for _ in range(an.FEW_RUNS + 200))]
    nr = spark.createDataFrame([(*r, ["n"]) for r in runs], "node_run_id long, run_id long, start_time timestamp_ntz, end_time timestamp_ntz, node_path array<string>")
    samples = [(s(rng.randrange(-6000, 300_000)), rng.choice([-1, 1, 2, 9])) for _ in range(300)]
    got = sorted(tuple(r)[:3] for r in an.interval_join_stats(nr, _samples(spark, samples)).collect())
    assert got == sorted((n, t, r) for n, run, a, b in runs for t, r in samples if a <= t <= b and r in (run, -1))
    ends = spark.createDataFrame([(lo, lo + n - 1) for lo in (-70_000, -1, 0, 5, 255) for n in (1, 3, 4, 15, 16, 63, 64, 65, 1023, 1024, 10**6)], "lo long, hi long")
    cells = ends.withColumn("l", an.length_level("lo", "hi")).selectExpr("shiftright(hi, 4 * l) - shiftright(lo, 4 * l) + 1 AS n", "l", "hi - lo + 1 AS size").collect()
    assert all(c.n <= 6 and 16**c.l <= 4 * c.size <= 16 ** (c.l + 1) for c in cells)
