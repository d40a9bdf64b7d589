"""Graphs with long chains, and edges of initial and final nodes under inserts."""

import random

import pytest
from pyspark.sql import functions as F

from spark_elt.operators import dag


@pytest.fixture(autouse=True)
def _few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 2)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture()
def stores(monkeypatch):
    """How often a frame is stored."""
    cuts = []
    cut = dag._cut

    def counted(df):
        cuts.append(1)
        return cut(df)

    monkeypatch.setattr(dag, "_cut", counted)
    return cuts


def test_cost_of_a_long_chain(spark, stores):
    n = 100_000
    nodes = spark.range(n).select(F.col("id").alias("node"), (F.col("id") % 3 + 1).cast("double").alias("cost"))
    edges = spark.range(n - 1).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    got = dag.critical_path_cost(nodes, edges)
    # a frame for each of some 20 rounds of a level and of 17 doublings
    assert len(stores) < 60
    total = sum(i % 3 + 1 for i in range(n))
    ends = {r.node: r.cost for r in got.where(f"node IN (0, 1, 50000, {n - 1})").collect()}
    assert ends == {0: total, 1: total - 1, 50_000: sum(i % 3 + 1 for i in range(50_000, n)), n - 1: (n - 1) % 3 + 1}
    assert got.count() == n


def test_closure_of_a_long_chain(spark, stores):
    n = 100_000
    edges = spark.range(n - 1).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    seeds = spark.createDataFrame([(n - 1,), (70_000,)], "node long")
    assert dag.upstream_closure(edges, seeds).count() == n
    assert len(stores) < 80
    assert dag.upstream_closure(edges, spark.createDataFrame([(1234,)], "node long")).count() == 1235


def plain_cost(nodes, edges):
    down, done = {}, {}
    for u, v in edges:
        down.setdefault(u, set()).add(v)
    for n in sorted(nodes, reverse=True):
        done[n] = nodes[n] + max([done[v] for v in down.get(n, ()) if v in nodes], default=0)
    return done


@pytest.mark.parametrize("seed", [1])
def test_chains_with_branches(spark, monkeypatch, seed):
    monkeypatch.setattr(dag, "LEVELS", 2)
    rng = random.Random(seed)
    n = 90
    edges = {(i, i + 1) for i in range(n - 1) if rng.random() < 0.9}
    edges |= {tuple(sorted(rng.sample(range(n), 2))) for _ in range(12)}
    nodes = {i: float(rng.randrange(5)) for i in range(n)}
    edges |= {(5, 1000)}  # an unknown node
    node_df = spark.createDataFrame(list(nodes.items()), "node long, cost double")
    edge_df = spark.createDataFrame(list(edges), "u long, v long")
    got = {r.node: r.cost for r in dag.critical_path_cost(node_df, edge_df).collect()}
    assert got == plain_cost(nodes, edges)
    seeds = rng.sample(range(n), 3)
    want, todo = set(seeds), list(seeds)
    while todo:
        at = todo.pop()
        new = {u for u, v in edges if v == at} - want
        want |= new
        todo += new
    up = dag.upstream_closure(edge_df, spark.createDataFrame([(s,) for s in seeds], "node long"))
    assert {r.node for r in up.collect()} == want


@pytest.mark.parametrize("length", [3])
def test_cycles_behind_chains_fail(spark, monkeypatch, length):
    monkeypatch.setattr(dag, "LEVELS", 2)
    ring = [(i, (i + 1) % length) for i in range(length)]
    chain = [(i, i + 1) for i in range(100, 112)] + [(112, 0), (0, 50), (50, 51), (51, 52), (52, 53)]
    nodes = spark.createDataFrame([(i, 1.0) for i in {x for e in ring + chain for x in e}], "node long, cost double")
    with pytest.raises(ValueError, match="cycle"):
        dag.critical_path_cost(nodes, spark.createDataFrame(ring + chain, "u long, v long"))


def plain_ends(nodes, edges, initial, final):
    out = set(edges)
    for n in nodes:
        if initial is not None and not any(v == n for _, v in edges):
            out.add((initial, n))
        if final is not None and not any(u == n for u, _ in edges):
            out.add((n, final))
    if not nodes and None not in (initial, final):
        out.add((initial, final))
    return out


@pytest.mark.parametrize("seed", [1])
def test_inserts_in_any_order(spark, seed):
    rng = random.Random(seed)
    pipelines = {"p": (-1, -2), "q": (-1, None), "r": (None, -2), "e": (-1, -2)}
    nodes = [(p, n) for p in "pqr" for n in range(8)]
    edges = [(p, *sorted(rng.sample(range(8), 2))) for p in "pqr" for _ in range(7)]
    ends = spark.createDataFrame([(p, i, f) for p, (i, f) in pipelines.items()], "parent string, initial long, final long")
    of = "parent string, node long", "parent string, u long, v long"
    want = {(p, *e) for p, (i, f) in pipelines.items() for e in plain_ends([n for q, n in nodes if q == p], {e[1:] for e in edges if e[0] == p}, i, f)}
    whole = dag.with_initial_and_final(spark.createDataFrame(nodes, of[0]), spark.createDataFrame(edges, of[1]), ends)
    assert {tuple(r) for r in whole.collect()} == want and whole.count() == len(want)
    current = dag._cut(dag.with_initial_and_final(spark.createDataFrame([], of[0]), spark.createDataFrame([], of[1]), ends))
    items = [("n", n) for n in nodes] + [("e", e) for e in edges]
    rng.shuffle(items)
    for k in range(0, len(items), 12):
        part = items[k : k + 12]
        new_nodes = spark.createDataFrame([x for t, x in part if t == "n"], of[0])
        new_edges = spark.createDataFrame([x for t, x in part if t == "e"], of[1])
        current = dag._cut(dag.apply_changes(current, dag.edge_changes(current, ends, new_nodes, new_edges)))
    assert sorted(tuple(r) for r in current.collect()) == sorted(want)
