"""SQL templating and DAG operators."""

import datetime as dt

import pytest

from spark_elt.operators import dag
from spark_elt.operators.sql import parallel_sql, render, run_sql, split_statements, task_id
from spark_elt.session import scratch_dir


def test_render_literal_ordered_and_callables():
    assert render("a.b $x", {"a.b": "1", "$x": lambda: 2}) == "1 2"
    assert render("ab", {"a": "b", "bb": "c"}) == "c"


def test_split_statements():
    assert split_statements("select ';'; -- c;\nselect 2;/* ; */") == ["select ';'", "select 2"]


def test_run_sql_needs_exactly_one_source(spark):
    with pytest.raises(ValueError):
        run_sql(spark)
    assert run_sql(spark, "SELECT 1 AS a; SELECT :x AS b", args={"x": 5}).collect()[0]["b"] == 5


def test_parallel_sql_validates_and_tags(spark):
    with pytest.raises(ValueError):
        parallel_sql(spark, "SELECT 1", ["@p@"], [1, 2])
    df = parallel_sql(spark, "SELECT '@p@' AS v", ["@p@"], [("A-b",), ("c d!",)])
    assert sorted((r["v"], r["task_id"]) for r in df.collect()) == [("A-b", "a_b"), ("c d!", "cd")]
    assert task_id(("X-1", 2)) == "x_1_2"


def _edges(spark, pairs):
    return spark.createDataFrame(pairs, "u long, v long")


def test_closure_cost_and_cycle(spark):
    e = _edges(spark, [(1, 2), (2, 3), (1, 3), (3, 4)])
    seeds = spark.createDataFrame([(3,)], "node long")
    assert sorted(r["node"] for r in dag.upstream_closure(e, seeds).collect()) == [1, 2, 3]
    nodes = spark.createDataFrame([(1, 1.0), (2, 5.0), (3, 1.0), (4, 2.0)], "node long, cost double")
    cost = {r["node"]: r["cost"] for r in dag.critical_path_cost(nodes, e).collect()}
    assert cost == {4: 2.0, 3: 3.0, 2: 8.0, 1: 9.0}
    red = {(r["u"], r["v"]): r["redundant"] for r in dag.redundant_edges(e).collect()}
    assert red[(1, 3)] and not red[(1, 2)] and not red[(3, 4)]
    cyc = _edges(spark, [(1, 2), (2, 1)])
    # a set closure still ends on a cycle; a cost never settles and fails
    assert sorted(r["node"] for r in dag.upstream_closure(cyc, spark.createDataFrame([(1,)], "node long")).collect()) == [1, 2]
    with pytest.raises(ValueError):
        dag.critical_path_cost(spark.createDataFrame([(1, 1.0), (2, 1.0)], "node long, cost double"), cyc)


def _remove_one_by_one(pairs, drop):
    edges = set(pairs)
    for n in drop:
        ups = {u for u, v in edges if v == n}
        downs = {v for u, v in edges if u == n}
        edges = {(u, v) for u, v in edges if n not in (u, v)} | {(u, d) for u in ups for d in downs}
    return edges


def test_remove_nodes_equals_one_by_one(spark):
    pairs = [(1, 2), (2, 3), (3, 4), (1, 5), (5, 3), (4, 6), (2, 6)]
    drop = [2, 3]
    e = _edges(spark, pairs)
    got = {(r["u"], r["v"]) for r in dag.remove_nodes(e, spark.createDataFrame([(n,) for n in drop], "node long")).collect()}
    assert got == _remove_one_by_one(pairs, drop)


def test_lanes(spark):
    t = dt.datetime(2024, 1, 1)
    h = lambda x: t + dt.timedelta(hours=x)
    df = spark.createDataFrame(
        [(1, 1, h(0), h(3)), (1, 2, h(1), h(2)), (1, 3, h(2), h(4)), (1, 4, h(3), h(5))],
        "run long, id long, s timestamp_ntz, e timestamp_ntz",
    )
    got = {r["id"]: r["lane"] for r in dag.lanes(df, ["run"], "s", "e", "id").collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 0}


def test_find_closest(spark):
    nodes = spark.createDataFrame([(["a"],), (["a", "b"],)], "node_path array<string>")
    req = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["a", "b"]), (3, ["x"])], "request_id long, path array<string>")
    got = {r["request_id"]: (r["found_path"], r["found"]) for r in dag.find_closest(nodes, req).collect()}
    assert got == {1: (["a", "b"], False), 2: (["a", "b"], True), 3: ([], False)}


def test_status_rollup_ignore_errors(spark):
    nr = spark.createDataFrame(
        [(1, ["p", "t"], False, False), (1, ["q", "t"], False, False), (1, ["q", "u"], True, False)],
        "run_id long, node_path array<string>, succeeded boolean, is_pipeline boolean",
    )
    flags = spark.createDataFrame([(["q"],)], "node_path array<string>")
    got = {tuple(r["pipeline"]): r["n_failed_tasks"] for r in dag.status_rollup(nr, flags).collect()}
    assert got == {(): 1, ("p",): 1}


def _first_fit(intervals):
    ends, out = [], {}
    for s, e, i in sorted(intervals, key=lambda x: (x[0], x[2])):
        lane = next((k for k, last in enumerate(ends) if last <= s), None)
        if lane is None:
            ends.append(e)
            lane = len(ends) - 1
        else:
            ends[lane] = e
        out[i] = lane
    return out


def test_lanes_equal_sequential_first_fit_with_quiet_points(spark):
    import random

    rnd = random.Random(7)
    t = dt.datetime(2024, 1, 1)
    rows, expect = [], {}
    for run in range(4):
        ivs, clock = [], 0
        for i in range(120):
            clock += rnd.choice([0, 1, 2, 30])  # sometimes a long gap: a quiet point
            s, e = clock, clock + rnd.randint(0, 10)
            ivs.append((s, e, run * 1000 + i))
        expect.update(_first_fit(ivs))
        rows += [(run, i, t + dt.timedelta(minutes=s), t + dt.timedelta(minutes=e)) for s, e, i in ivs]
    df = spark.createDataFrame(rows, "run long, id long, s timestamp_ntz, e timestamp_ntz")
    got = {r["id"]: r["lane"] for r in dag.lanes(df, ["run"], "s", "e", "id").collect()}
    assert got == expect


def test_redundant_edges_on_random_graphs(spark):
    import random
    from collections import defaultdict

    rnd = random.Random(3)
    edges = {tuple(sorted(rnd.sample(range(40), 2))) for _ in range(110)}
    out = defaultdict(set)
    for u, v in edges:
        out[u].add(v)

    def below(u):
        seen, todo = set(), [u]
        while todo:
            for y in out[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        return seen

    want = {(u, v): any(v in below(w) for w in out[u] - {v}) for u, v in edges}
    got = dag.redundant_edges(spark.createDataFrame(list(edges), "u long, v long"))
    assert {(r.u, r.v): r.redundant for r in got.collect()} == want


def test_cycle_fails_at_once(spark):
    nodes = spark.createDataFrame([(i, 1.0) for i in range(30)], "node long, cost double")
    with pytest.raises(ValueError, match="cycle"):
        dag.critical_path_cost(nodes, spark.createDataFrame([(1, 2), (2, 1), (3, 1)], "u long, v long"))
    with pytest.raises(ValueError, match="cycle"):
        dag.redundant_edges(spark.createDataFrame([(1, 2), (2, 1)], "u long, v long"))


def test_scripts_keep_hints_and_blocks():
    assert split_statements("SELECT /*+ BROADCAST(a) */ 1/*c*/+2 -- x\n; SELECT/*c*/3;") == ["SELECT /*+ BROADCAST(a) */ 1 +2", "SELECT 3"]
    block = "BEGIN DECLARE x INT; IF x > 1 THEN SELECT CASE WHEN x = 2 THEN 1 END; END IF; WHILE x < 3 DO SET x = x + 1; END WHILE; END"
    assert split_statements(f"SELECT 1; {block}; SELECT 'BEGIN; END'") == ["SELECT 1", block, "SELECT 'BEGIN; END'"]


def test_script_block_runs(spark):
    from spark_elt.operators.sql import run_sql

    got = run_sql(spark, "SELECT 1; BEGIN DECLARE x INT DEFAULT 2; SET x = x * 3; SELECT x AS x; END")
    assert [r[0] for r in got.collect()] == [6]


def _scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


@pytest.fixture(scope="module")
def measured(spark):
    path = scratch_dir(spark, "measured")
    spark.range(1000).selectExpr("id", "concat('k', id % 30) AS kind", "id % 7 AS n").write.parquet(path)
    return path


@pytest.mark.parametrize(
    "template, fits",
    [
        ("SELECT kind, count(*) AS c, sum(id) AS s FROM @t@ WHERE kind = '@k@' GROUP BY kind", True),
        ("SELECT count(*) AS c, max(id) AS s FROM @t@ WHERE kind = '@k@' AND n = @n@", True),  # a row also for no match
        ("SELECT id, n FROM @t@ WHERE id < 300 AND kind ='@k@'", True),
        ("SELECT a.id, b.n FROM @t@ a JOIN @t@ b ON a.id = b.id + 1 WHERE a.kind = '@k@'", True),
        ("SELECT id FROM @t@ WHERE kind <= '@k@' AND id < 50", False),
        ("SELECT id FROM @t@ WHERE kind = '@k@' OR id = 4", False),
        ("SELECT '@k@' AS k, count(*) AS c FROM @t@ WHERE kind = '@k@'", False),
        ("SELECT id FROM @t@ WHERE kind IN ('@k@') AND n = @n@", False),
    ],
)
def test_parallel_sql_joins_parameters(spark, measured, template, fits):
    names = [p for p in ("@k@", "@n@") if p in template]
    params = [(f"k{i}", i % 7)[: len(names)] for i in [*range(24), 77, 3]]  # 3 twice, 77 without rows
    rep = {"@t@": f"parquet.`{measured}`"}
    df = parallel_sql(spark, template, names, params, replace=rep)
    assert _scans(df) == (template.count("@t@") if fits else len(params) * template.count("@t@"))
    plain = [
        (*r, task_id(p)) for p in params for r in run_sql(spark, template, replace={**rep, **dict(zip(names, p))}).collect()
    ]
    assert sorted(map(repr, plain)) == sorted(repr(tuple(r)) for r in df.collect())


def test_parallel_sql_keeps_odd_values_rendered(spark, measured):
    """Values that a literal would read differently are rendered into the text, as before."""
    df = parallel_sql(spark, f"SELECT id FROM parquet.`{measured}` WHERE kind = '@k@'", ["@k@"], [("k1\\u0030",), ("k2",)])
    assert _scans(df) == 2 and {r[0] for r in df.collect()} == {i for i in range(1000) if i % 30 in (10, 2)}
