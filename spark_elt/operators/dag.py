"""DAG operators on node and edge tables.

A pipeline DAG is two DataFrames: nodes and edges ``(u, v)`` meaning u runs before
v. Graph searches are iterative frontier joins: each round joins only the new
frontier to the edge table, drops what is already known (anti join), and stops
when the frontier is empty. Rounds are bounded by the node count (a longer run
means a cycle and fails). A graph that is not done after ``LEVELS`` rounds may have
long chains, which are then shortened by pointer doubling, so that rounds grow with the
logarithm of a chain and not with its length. Lineage is cut every round with
``checkpoint()`` into the session's checkpoint folder, so a lost executor recomputes one
round only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_elt.functions.paths import empty_path
from spark_elt.operators.ordered import ordered_scan
from spark_elt.session import checkpoint_root, ship_code


# The known set is re-checkpointed every few rounds; each round's frontier always is.
CUT_EVERY = 4
# Rounds of a level each before chains are looked for.
LEVELS = 16


def _cut(df: DataFrame) -> DataFrame:
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def ancestors(df: DataFrame, path_col: str = "node_path", include_self: bool = False) -> DataFrame:
    """One row per ancestor of each path, root ``[]`` first (G01): adds
    ``ancestor`` and ``level`` (0 = root)."""
    n = F.size(path_col)
    upper = n if include_self else n - 1
    seq = F.when(upper >= 0, F.sequence(F.lit(0), upper)).otherwise(F.array().cast("array<int>"))
    return df.withColumn(
        "_a", F.explode(F.transform(seq, lambda i: F.struct(i.alias("level"), F.slice(F.col(path_col), 1, i).alias("ancestor"))))
    ).select("*", "_a.level", "_a.ancestor").drop("_a")


def upstream_closure(edges: DataFrame, seeds: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """The seeds and all their (transitive) upstreams (G02); ``seeds`` has ``node``.

    When the search goes on after ``LEVELS`` rounds, shortcuts along chains of nodes with one
    upstream are added to its edges, so the rounds left are about the logarithm of a chain."""
    rev = edges.select(F.col("v").alias("node"), F.col("u").alias("up"))
    known = _cut(seeds.select("node").distinct())
    frontier = known
    limit = max_rounds or edges.select("u").union(edges.select("v")).distinct().count() + 1
    for r in range(limit):
        if r == LEVELS:
            rev = _cut(rev.unionByName(_shortcuts(rev)))
            frontier = known  # nodes found before have shortcuts too
        nxt = frontier.join(rev, "node").select(F.col("up").alias("node")).distinct().join(known, "node", "left_anti")
        nxt = _cut(nxt)
        if nxt.isEmpty():
            return known
        known = known.unionByName(nxt)
        if r % CUT_EVERY == CUT_EVERY - 1:  # bound the lineage of the known set
            known = _cut(known)
        frontier = nxt
    raise ValueError("upstream closure did not converge: the graph has a cycle")


def _shortcuts(rev: DataFrame) -> DataFrame:
    """(node, up) over 2, 4, 8 … steps, of nodes with one upstream whose next steps have
    one each, too. A chain of n nodes gives them n log n; a cycle ends with the doubling."""
    once = rev.distinct().groupBy("node").agg(F.min("up").alias("up"), F.count("*").alias("n")).where("n = 1").select("node", "up")
    step = _cut(once)
    found = step.limit(0)
    for k in range(max(1, step.count()).bit_length() + 1):
        on = step.select(F.col("node").alias("up"), F.col("up").alias("further"))
        step = _cut(step.join(on, "up").select("node", F.col("further").alias("up")))
        if step.isEmpty():
            break
        found = found.unionByName(step)
    return found


def reach_pairs(edges: DataFrame, sources: DataFrame | None = None, through: DataFrame | None = None,
                max_rounds: int | None = None) -> DataFrame:
    """Pairs (src, dst) with a path of length >= 1 from src to dst. With
    ``sources`` only those starts; with ``through`` paths may only pass through
    those nodes (the end may be any node)."""
    e = edges.select("u", "v")
    start = e if sources is None else e.join(sources.select(F.col("node").alias("u")), "u", "left_semi")
    known = _cut(start.select(F.col("u").alias("src"), F.col("v").alias("dst")).distinct())
    frontier = known
    limit = max_rounds or e.select("u").union(e.select("v")).distinct().count() + 1
    for r in range(limit):
        f = frontier if through is None else frontier.join(through.select(F.col("node").alias("dst")), "dst", "left_semi")
        nxt = (
            f.join(e, f["dst"] == e["u"]).select("src", F.col("v").alias("dst")).distinct()
            .join(known, ["src", "dst"], "left_anti")
        )
        nxt = _cut(nxt)
        if nxt.isEmpty():
            return known
        known = known.unionByName(nxt)
        if r % CUT_EVERY == CUT_EVERY - 1:  # bound the lineage of the known set
            known = _cut(known)
        frontier = nxt
    raise ValueError("reachability did not converge: the graph has a cycle")


def _peel(edges: DataFrame, what: DataFrame) -> DataFrame:
    """Rounds over a DAG from its sinks: ``what`` (node, own, best, left) has for every node
    its own value, the greatest value of its downstreams so far, and the number of those it
    waits for. A node whose downstreams are all done is done with ``own + best``; it hands
    this value to its upstreams in the next round. Returns (node, value).

    An edge (u, v, a, w) hands on ``max(a, w + value of v)``; at first the value itself.
    After every ``LEVELS`` rounds the edges between waiting nodes are shortened along chains
    (``_contract``). Nodes that still wait when none gets done are on a cycle, or behind one."""
    edges = _cut(edges.select("u", "v", F.lit(float("-inf")).alias("a"), F.lit(0.0).alias("w")).distinct())
    waiting = _cut(what)
    done: list[DataFrame] = []
    rounds = 0
    while True:
        ready = waiting.where(F.col("left") == 0).select("node", (F.col("own") + F.col("best")).alias("value"))
        if ready.isEmpty():
            break
        done.append(ready)
        rounds += 1
        if rounds % CUT_EVERY == 0:
            done = [_cut(reduce(DataFrame.unionByName, done))]
        told = edges.join(ready.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(
            F.max(F.greatest("a", F.col("w") + F.col("value"))).alias("more"), F.count("*").alias("fewer")
        )
        rest = waiting.where(F.col("left") > 0).join(told, "node", "left")
        waiting = _cut(rest.select(
            "node", "own", F.greatest("best", "more").alias("best"), (F.col("left") - F.coalesce("fewer", F.lit(0))).alias("left")
        ))
        if rounds % LEVELS == 0:
            edges, waiting = _contract(edges, waiting)
    if not waiting.isEmpty():
        raise ValueError("the graph has a cycle")
    return reduce(DataFrame.unionByName, done) if done else waiting.select("node", F.lit(0.0).alias("value"))


def _contract(edges: DataFrame, waiting: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The graph of waiting nodes with its chains shortened; done nodes leave the edges.

    The value of a node that waits for one other is ``max(least, plus + value of that one)``, and so
    is what it hands on. So an edge to it can lead to the node behind it instead, for all such
    edges at once: a chain halves every round. Edges of one node that come to lead to the same
    one are one edge, and a node with one edge left joins a chain. Rounds end when no edge is
    shortened, or after those that the longest chain could need: then a cycle is left."""
    ids = waiting.select("node")
    edges = edges.join(ids.withColumnRenamed("node", "u"), "u", "left_semi").join(ids.withColumnRenamed("node", "v"), "v", "left_semi")
    # nodes to be done in the next round end a chain
    edges = _cut(edges.select("u", "v", "a", "w"))
    for _ in range(max(1, edges.count()).bit_length() + 1):
        single = edges.groupBy("u").agg(F.count("*").alias("n"), F.min("v").alias("to"), F.min("a").alias("a"), F.min("w").alias("w")).where("n = 1")
        single = single.join(waiting.withColumnRenamed("node", "u"), "u").select(
            F.col("u").alias("v"), "to", (F.col("own") + F.greatest("best", "a")).alias("least"), (F.col("own") + F.col("w")).alias("plus")
        )
        over = edges.join(single, "v", "left")
        shorter = over.select(
            "u", F.coalesce("to", "v").alias("v"),
            F.when(F.col("to").isNull(), F.col("a")).otherwise(F.greatest("a", F.col("w") + F.col("least"))).alias("a"),
            (F.col("w") + F.coalesce("plus", F.lit(0.0))).alias("w"), F.col("to").isNotNull().alias("cut"),
        )
        merged = _cut(shorter.groupBy("u", "v").agg(F.max("a").alias("a"), F.max("w").alias("w"), F.max("cut").alias("cut")))
        edges = merged.drop("cut")
        if merged.where("cut").isEmpty():
            break
    left = edges.groupBy(F.col("u").alias("node")).agg(F.count("*").alias("left"))
    return edges, _cut(waiting.drop("left").join(left, "node", "left").select("node", "own", "best", F.coalesce("left", F.lit(0)).alias("left")))


def _start(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, own, best, left) before the first round; edges to unknown nodes do not count."""
    known = nodes.select("node").distinct()
    inner = edges.select("u", "v").distinct().join(known.withColumnRenamed("node", "v"), "v", "left_semi")
    waits = inner.groupBy(F.col("u").alias("node")).agg(F.count("*").alias("left"))
    return nodes.join(waits, "node", "left").select(
        "node", F.coalesce(F.col("cost"), F.lit(0.0)).alias("own"), F.lit(0.0).alias("best"), F.coalesce("left", F.lit(0)).alias("left")
    )


def critical_path_cost(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """cost(n) = own(n) + max(cost of n's downstreams), 0 without downstreams.

    Nodes get their cost once all their downstreams have theirs. The rounds are the levels
    of the graph with its long chains shortened, and a cycle fails as soon as nothing more
    can be done."""
    return _peel(edges, _start(nodes, edges)).withColumnRenamed("value", "cost")


def heights(edges: DataFrame) -> DataFrame:
    """(node, height): edges on the longest path from each node down to a sink."""
    nodes = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct().withColumn("cost", F.lit(1.0))
    return critical_path_cost(nodes, edges).select("node", (F.col("cost") - 1).cast("int").alias("height"))


def remove_nodes(edges: DataFrame, drop: DataFrame) -> DataFrame:
    """Remove nodes and bridge their edges (G04): every remaining upstream of a
    removed node is connected to every remaining downstream reached through removed
    nodes only."""
    dropped = drop.select("node").distinct()
    kept_edges = edges.join(dropped.withColumnRenamed("node", "u"), "u", "left_anti").join(
        dropped.withColumnRenamed("node", "v"), "v", "left_anti"
    ).select("u", "v")
    starts = edges.join(dropped.withColumnRenamed("node", "u"), "u", "left_anti").select(F.col("u").alias("node")).distinct()
    into = reach_pairs(edges, starts, through=dropped)
    bridged = into.join(dropped.withColumnRenamed("node", "dst"), "dst", "left_anti").select(
        F.col("src").alias("u"), F.col("dst").alias("v")
    )
    return kept_edges.unionByName(bridged).distinct()


def redundant_edges(edges: DataFrame) -> DataFrame:
    """Edges u→v where v is also reachable from u by a path of two or more edges.

    Heights (longest path to a sink) fall along every edge, so a second way to v needs a
    first step w with ``height(w) > height(v)``, and its nodes stay above v. Each open
    edge searches level by level from such first steps through nodes above its v only,
    and leaves the search as soon as v is found. Searches of one start are shared: a
    state is (u, node, the lowest height that u still looks for), not a pair per edge."""
    e = _cut(edges.select("u", "v").distinct())
    h = _cut(heights(e))
    hv = h.select(F.col("node").alias("v"), F.col("height").alias("hv"))
    tall = _cut(e.join(hv, "v"))
    # an edge can only be redundant if u has a taller other child
    top = tall.groupBy("u").agg(F.max("hv").alias("top"))
    open_ = _cut(tall.join(top, "u").where("hv < top").select("u", "v", "hv", F.lit(False).alias("redundant")))
    lowest = open_.groupBy("u").agg(F.min("hv").alias("low"))
    frontier = _cut(tall.join(lowest, "u").where("hv > low").select(F.col("u").alias("src"), F.col("v").alias("node")))
    seen = frontier
    rounds = 0
    while not frontier.isEmpty():
        step = frontier.join(tall, frontier["node"] == tall["u"]).select("src", F.col("v").alias("node"), "hv").distinct()
        step = _cut(step)
        hit = step.select(F.col("src").alias("u"), F.col("node").alias("v"), F.lit(True).alias("hit"))
        open_ = _cut(open_.join(hit, ["u", "v"], "left").select(
            "u", "v", "hv", (F.col("redundant") | F.coalesce("hit", F.lit(False))).alias("redundant")
        ))
        lowest = open_.where("NOT redundant").groupBy(F.col("u").alias("src")).agg(F.min("hv").alias("low"))
        frontier = _cut(step.join(lowest, "src").where("hv > low").select("src", "node").join(seen, ["src", "node"], "left_anti"))
        seen = seen.unionByName(frontier)
        rounds += 1
        if rounds % CUT_EVERY == 0:
            # starts without an open edge search no more
            seen = _cut(seen.join(lowest.select("src"), "src", "left_semi"))
    return e.join(open_.where("redundant").select("u", "v", "redundant"), ["u", "v"], "left").select(
        "u", "v", F.coalesce("redundant", F.lit(False)).alias("redundant")
    )


def roots_and_leaves(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Per node: no upstreams (root) / no downstreams (leaf)."""
    has_up = edges.select(F.col("v").alias("node")).distinct().withColumn("_up", F.lit(True))
    has_down = edges.select(F.col("u").alias("node")).distinct().withColumn("_down", F.lit(True))
    return nodes.select("node").join(has_up, "node", "left").join(has_down, "node", "left").select(
        "node", F.col("_up").isNull().alias("is_root"), F.col("_down").isNull().alias("is_leaf")
    )


def _inner(edges: DataFrame, ends: DataFrame) -> DataFrame:
    """Edges other than from a pipeline's initial node or to its final one."""
    e = edges.join(ends, "parent", "left")
    outer = F.coalesce(F.col("u") == F.col("initial"), F.lit(False)) | F.coalesce(F.col("v") == F.col("final"), F.lit(False))
    return e.where(~outer).select("parent", "u", "v").distinct()


def with_initial_and_final(nodes: DataFrame, edges: DataFrame, ends: DataFrame) -> DataFrame:
    """Edges of pipelines whose initial node runs before every root and whose final one
    after every leaf (G06). ``nodes`` (parent, node), ``edges`` (parent, u, v) and ``ends``
    (parent, initial, final: null where a pipeline has none). A pipeline without other nodes
    has the edge from its initial to its final node."""
    inner = _inner(edges, ends)
    own = nodes.select("parent", "node").distinct().join(ends, "parent")
    own = own.where(~(F.col("node").eqNullSafe(F.col("initial")) | F.col("node").eqNullSafe(F.col("final"))))
    roots = own.join(inner.select("parent", F.col("v").alias("node")), ["parent", "node"], "left_anti").where("initial IS NOT NULL")
    leaves = own.join(inner.select("parent", F.col("u").alias("node")), ["parent", "node"], "left_anti").where("final IS NOT NULL")
    bare = ends.join(own.select("parent"), "parent", "left_anti").where("initial IS NOT NULL AND final IS NOT NULL")
    return (
        inner.unionByName(roots.select("parent", F.col("initial").alias("u"), F.col("node").alias("v")))
        .unionByName(leaves.select("parent", F.col("node").alias("u"), F.col("final").alias("v")))
        .unionByName(bare.select("parent", F.col("initial").alias("u"), F.col("final").alias("v")))
    )


def edge_changes(current: DataFrame, ends: DataFrame, new_nodes: DataFrame, new_edges: DataFrame) -> DataFrame:
    """What an insert of nodes and edges changes in ``current``, edges as
    ``with_initial_and_final`` gives them (G06): rows (parent, u, v, change), change being
    'add' or 'drop'. An edge drops the one from the initial node to its downstream and the
    one from its upstream to the final node; a node without other edges gets both.

    Only edges at the inserted nodes and ends of edges are looked up, so the work beyond one
    pass over ``current`` follows the insert. Inserts in any order lead to the same edges; an
    edge may come before its nodes."""
    inner = _inner(new_edges, ends).join(current, ["parent", "u", "v"], "left_anti")
    nodes = new_nodes.select("parent", "node").distinct().join(ends, "parent")
    nodes = nodes.where(~(F.col("node").eqNullSafe(F.col("initial")) | F.col("node").eqNullSafe(F.col("final"))))
    specific = _inner(current.join(new_nodes.select("parent").distinct(), "parent", "left_semi"), ends).unionByName(inner)
    roots = nodes.join(specific.select("parent", F.col("v").alias("node")), ["parent", "node"], "left_anti").where("initial IS NOT NULL")
    leaves = nodes.join(specific.select("parent", F.col("u").alias("node")), ["parent", "node"], "left_anti").where("final IS NOT NULL")
    added = (
        inner.unionByName(roots.select("parent", F.col("initial").alias("u"), F.col("node").alias("v")))
        .unionByName(leaves.select("parent", F.col("node").alias("u"), F.col("final").alias("v")))
        .join(current, ["parent", "u", "v"], "left_anti")
    )
    at = inner.join(ends, "parent")
    loose = (
        at.select("parent", F.col("initial").alias("u"), "v").unionByName(at.select("parent", "u", F.col("final").alias("v")))
        .unionByName(nodes.select("parent", F.col("initial").alias("u"), F.col("final").alias("v"))).distinct()
    )
    dropped = current.join(loose, ["parent", "u", "v"], "left_semi").select("parent", "u", "v")
    return added.withColumn("change", F.lit("add")).unionByName(dropped.withColumn("change", F.lit("drop")))


def apply_changes(current: DataFrame, changes: DataFrame) -> DataFrame:
    """``current`` edges after ``edge_changes``."""
    drop = changes.where("change = 'drop'").select("parent", "u", "v")
    return current.join(drop, ["parent", "u", "v"], "left_anti").select("parent", "u", "v").unionByName(
        changes.where("change = 'add'").select("parent", "u", "v")
    )


def neighbourhood(edges: DataFrame, centers: DataFrame) -> DataFrame:
    """Upstreams, the node itself and downstreams of each center."""
    c = centers.select("node")
    ups = edges.join(c.withColumnRenamed("node", "v"), "v").select(F.col("v").alias("center"), F.col("u").alias("neighbour"), F.lit("upstream").alias("role"))
    downs = edges.join(c.withColumnRenamed("node", "u"), "u").select(F.col("u").alias("center"), F.col("v").alias("neighbour"), F.lit("downstream").alias("role"))
    me = c.select(F.col("node").alias("center"), F.col("node").alias("neighbour"), F.lit("self").alias("role"))
    return ups.unionByName(me).unionByName(downs)


def duplicate_ids(nodes: DataFrame, parent: str = "parent", id_col: str = "id") -> DataFrame:
    """Ids used more than once inside one parent pipeline."""
    return nodes.groupBy(parent, id_col).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def dangling_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with an endpoint that is not a node (G11): which end is unknown."""
    n = nodes.select("node")
    bad_u = edges.join(n.withColumnRenamed("node", "u"), "u", "left_anti").withColumn("unknown", F.lit("upstream"))
    bad_v = edges.join(n.withColumnRenamed("node", "v"), "v", "left_anti").withColumn("unknown", F.lit("downstream"))
    return bad_u.unionByName(bad_v)


def unselected(nodes: DataFrame, selected: DataFrame) -> DataFrame:
    """Nodes that are not selected."""
    return nodes.join(selected.select("node"), "node", "left_anti")


def fully_processed(children: DataFrame, processed: DataFrame) -> DataFrame:
    """Parents all of whose children are processed (U03, relational division):
    ``children`` (parent, node), ``processed`` (node)."""
    total = children.groupBy("parent").agg(F.countDistinct("node").alias("n_children"))
    done = children.join(processed.select("node").distinct(), "node").groupBy("parent").agg(
        F.countDistinct("node").alias("n_done")
    )
    return total.join(done, "parent").where(F.col("n_done") == F.col("n_children")).select("parent", "n_children")


def find_closest(nodes: DataFrame, requests: DataFrame) -> DataFrame:
    """Longest-prefix lookup (J13): for each requested path the deepest known node
    on it (the root always exists) and whether the full path was found.
    ``nodes`` has ``node_path``; ``requests`` has ``request_id`` and ``path``."""
    pref = ancestors(requests.withColumnRenamed("path", "node_path"), include_self=True)
    known = nodes.select(F.col("node_path").alias("ancestor")).distinct().unionByName(
        requests.sparkSession.range(1).select(empty_path().alias("ancestor"))
    ).distinct()
    hit = pref.join(known, "ancestor")
    best = hit.groupBy("request_id").agg(F.max_by("ancestor", "level").alias("found_path"), F.max("level").alias("lvl"))
    return requests.join(best, "request_id").select(
        "request_id", "path", "found_path", (F.col("lvl") == F.size("path")).alias("found")
    )


def status_rollup(node_run: DataFrame, ignore_errors: DataFrame) -> DataFrame:
    """Pipelines (per run) that failed because a task below them failed (G07): a
    failed task fails every ancestor pipeline, root included, unless its direct
    parent has ``ignore_errors``. ``ignore_errors`` has ``node_path`` of the
    pipelines with that flag."""
    failed = node_run.where(~F.col("is_pipeline") & (F.col("succeeded") == F.lit(False))).withColumn(
        "parent", F.slice("node_path", 1, F.size("node_path") - 1)
    )
    flag = ignore_errors.select(F.col("node_path").alias("parent")).distinct()
    counted = failed.join(flag, "parent", "left_anti")
    anc = ancestors(counted.select("run_id", "node_path"))
    return anc.groupBy("run_id", "ancestor").agg(F.count(F.lit(1)).alias("n_failed_tasks")).withColumnRenamed(
        "ancestor", "pipeline"
    )


def lanes(df: DataFrame, group: Sequence[str], start: str, end: str, order_tie: str) -> DataFrame:
    """Timeline lanes (G12): within each group, intervals sorted by start (ties by
    ``order_tie``) take the first lane whose last interval ended at or before their
    start, else a new lane.

    First-fit is sequential, but it restarts at every quiet point: when all earlier
    intervals of the group have ended by an interval's start, every lane is free and
    the packing from there on is the same as for a fresh group. So each group is
    first cut into segments at quiet points (the maximum end of the earlier rows,
    from the distributed ordered scan, so a long run is not one task), and only a
    segment, a stretch of continuously overlapping work, is packed sequentially:
    rows are hash-partitioned by (group, segment), sorted, and walked once per
    partition by ``mapInPandas`` with two heaps (busy lanes by end, free lanes by
    index), state carried across Arrow batches and reset at each segment change."""
    ship_code(df.sparkSession)
    keys = list(group)
    base = df.select(*keys, order_tie, start, end)
    prev = F.col(f"{end}_prev_max")
    scanned = ordered_scan(base, keys, [start, order_tie], prev_max=[end])
    quiet = scanned.withColumn("_quiet", F.when(prev.isNull() | (prev <= F.col(start)), 1).otherwise(0)).drop("_idx", f"{end}_prev_max")
    seg = ordered_scan(quiet, keys, [start, order_tie], sums=["_quiet"]).withColumn("_seg", F.col("_quiet_cum"))
    seg = seg.select(*keys, order_tie, start, end, "_seg")
    pkeys = keys + ["_seg"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keys, order_tie).schema.fields)
    schema += ", lane long"
    sorted_df = seg.repartition(*[F.col(k) for k in pkeys]).sortWithinPartitions(*pkeys, start, order_tie)

    def run(batches):
        import heapq

        import numpy as np

        current = None
        busy: list = []
        free: list = []
        n_lanes = 0
        for pdf in batches:
            starts = pdf[start].to_numpy("datetime64[us]").astype(np.int64)
            ends = pdf[end].to_numpy("datetime64[us]").astype(np.int64)
            gkeys = list(zip(*[pdf[k].tolist() for k in pkeys]))
            out = np.empty(len(pdf), dtype=np.int64)
            for i in range(len(pdf)):
                if gkeys[i] != current:
                    current, busy, free, n_lanes = gkeys[i], [], [], 0
                s_i = starts[i]
                while busy and busy[0][0] <= s_i:
                    heapq.heappush(free, heapq.heappop(busy)[1])
                if free:
                    lane = heapq.heappop(free)
                else:
                    lane = n_lanes
                    n_lanes += 1
                out[i] = lane
                heapq.heappush(busy, (int(ends[i]), lane))
            res = pdf[keys + [order_tie]].copy()
            res["lane"] = out
            yield res

    return sorted_df.mapInPandas(run, schema)
