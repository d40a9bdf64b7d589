"""Registered DAG queries (G01–G12, C06, J13, U02, U03) on the ``part`` graph
(u → 2u, 3u, 6u) and on the run-log node paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spark_elt.functions import format_labels
from spark_elt.operators import analytics as an
from spark_elt.operators import dag
from spark_elt.plans import fixtures as fx
from spark_elt.plans.oracle_views import with_views
from spark_elt.plans.registry import register
from spark_elt.session import table

SEEDS_D = "SELECT node FROM dag_node WHERE cost = 1"


def _rec(names, ctes: str, body: str) -> str:
    """with_views + recursive CTEs (DuckDB wants RECURSIVE right after WITH)."""
    return with_views(names, "SELECT 1").replace("WITH ", "WITH RECURSIVE ", 1).replace("\nSELECT 1", ",\n" + ctes + "\n" + body)


def _seeds(spark, sf_dir) -> DataFrame:
    n = fx.dag_node(spark, sf_dir)
    return n.where(F.col("cost") == 1).select("node")


@register(
    "path_ancestors",
    with_views(["node_run"], """SELECT node_run_id, CAST(lvl AS BIGINT) AS level, array_to_string(node_path[1:lvl], '/') AS ancestor
FROM (SELECT node_run_id, node_path, unnest(generate_series(0, len(node_path) - 1)) AS lvl FROM node_run) t"""),
)
def path_ancestors(spark, sf_dir):
    nr = fx.node_run(spark, sf_dir).select("node_run_id", "node_path")
    a = dag.ancestors(nr)
    return a.select("node_run_id", F.col("level").cast("bigint").alias("level"), F.array_join("ancestor", "/").alias("ancestor"))


@register(
    "upstream_closure",
    _rec(["dag_node", "edge"], f"up(node) AS ({SEEDS_D} UNION SELECT e.u FROM up JOIN edge e ON e.v = up.node)",
         "SELECT node FROM up"),
)
def upstream_closure(spark, sf_dir):
    return dag.upstream_closure(fx.edge(spark, sf_dir), _seeds(spark, sf_dir))


@register(
    "unselected_nodes",
    _rec(["dag_node", "edge"], f"up(node) AS ({SEEDS_D} UNION SELECT e.u FROM up JOIN edge e ON e.v = up.node)",
         "SELECT node FROM dag_node WHERE node NOT IN (SELECT node FROM up)"),
)
def unselected_nodes(spark, sf_dir):
    sel = dag.upstream_closure(fx.edge(spark, sf_dir), _seeds(spark, sf_dir))
    return dag.unselected(fx.dag_node(spark, sf_dir), sel).select("node")


@register(
    "node_cost",
    _rec(["dag_node", "edge"], """paths(start, node, total) AS (
  SELECT node, node, cost FROM dag_node
  UNION ALL SELECT p.start, e.v, p.total + n.cost FROM paths p JOIN edge e ON e.u = p.node JOIN dag_node n ON n.node = e.v)""",
         "SELECT start AS node, max(total) AS cost FROM paths GROUP BY start"),
)
def node_cost(spark, sf_dir):
    return dag.critical_path_cost(fx.dag_node(spark, sf_dir), fx.edge(spark, sf_dir))


@register(
    "remove_nodes_bridge",
    _rec(["dag_node", "edge"], """dropped AS (SELECT node FROM dag_node WHERE node % 7 IN (2, 4, 6)),
r(src, dst) AS (
  SELECT u, v FROM edge WHERE u NOT IN (SELECT node FROM dropped)
  UNION SELECT r.src, e.v FROM r JOIN edge e ON e.u = r.dst WHERE r.dst IN (SELECT node FROM dropped))""",
         "SELECT DISTINCT src AS u, dst AS v FROM r WHERE dst NOT IN (SELECT node FROM dropped)"),
)
def remove_nodes_bridge(spark, sf_dir):
    n = fx.dag_node(spark, sf_dir)
    return dag.remove_nodes(fx.edge(spark, sf_dir), n.where((F.col("node") % 7).isin(2, 4, 6)))


@register(
    "redundant_edges",
    _rec(["dag_node", "edge"], "reach(src, dst) AS (SELECT u, v FROM edge UNION SELECT r.src, e.v FROM reach r JOIN edge e ON e.u = r.dst)",
         """SELECT e.u, e.v, EXISTS (SELECT 1 FROM edge e1 JOIN reach r ON r.src = e1.v
                           WHERE e1.u = e.u AND r.dst = e.v) AS redundant
FROM (SELECT DISTINCT u, v FROM edge) e"""),
)
def redundant_edges(spark, sf_dir):
    return dag.redundant_edges(fx.edge(spark, sf_dir))


@register(
    "dag_roots_leaves",
    with_views(["dag_node", "edge"], """SELECT node, node NOT IN (SELECT v FROM edge) AS is_root,
       node NOT IN (SELECT u FROM edge) AS is_leaf FROM dag_node"""),
)
def dag_roots_leaves(spark, sf_dir):
    return dag.roots_and_leaves(fx.dag_node(spark, sf_dir), fx.edge(spark, sf_dir))


_ENDS_D = with_views(
    ["edge"],
    """SELECT p.brand AS parent, u, v FROM inner_edge p
UNION ALL SELECT p_brand, -1, p_partkey FROM part WHERE p_partkey > 0 AND p_partkey NOT IN (SELECT v FROM inner_edge)
UNION ALL SELECT p_brand, p_partkey, -2 FROM part WHERE p_partkey > 0 AND p_partkey NOT IN (SELECT u FROM inner_edge)""",
    [("inner_edge", """SELECT a.p_brand AS brand, u, v FROM edge JOIN part a ON a.p_partkey = u JOIN part b ON b.p_partkey = v
WHERE a.p_brand = b.p_brand""")],
)


def _brands(spark, sf_dir):
    """A pipeline for each brand: its parts, the edges between them, an initial (-1) and a
    final node (-2)."""
    brand = table(spark, sf_dir, "part").where("p_partkey > 0").select(F.col("p_brand").alias("parent"), F.col("p_partkey").alias("node"))
    e = fx.edge(spark, sf_dir).join(brand.select("parent", F.col("node").alias("u")), "u")
    e = e.join(brand.select(F.col("parent").alias("to"), F.col("node").alias("v")), "v").where("parent = to").select("parent", "u", "v")
    first, last = F.lit(-1).cast("long").alias("initial"), F.lit(-2).cast("long").alias("final")
    return brand, e, brand.select("parent").distinct().select("parent", first, last)


@register("dag_initial_final", _ENDS_D)
def dag_initial_final(spark, sf_dir):
    """Edges from the initial node to every root and from every leaf to the final one."""
    return dag.with_initial_and_final(*_brands(spark, sf_dir))


@register("dag_insert_edges", _ENDS_D)
def dag_insert_edges(spark, sf_dir):
    """G06 under inserts: the parts and edges of odd upstreams come first, the others as a
    second insert, which drops the edges of the ends that more specific ones replace."""
    nodes, edges, ends = _brands(spark, sf_dir)
    current = dag.with_initial_and_final(nodes.where("node % 2 = 1"), edges.where("u % 2 = 1 AND v % 2 = 1"), ends)
    changes = dag.edge_changes(current, ends, nodes.where("node % 2 = 0"), edges.where("NOT (u % 2 = 1 AND v % 2 = 1)"))
    return dag.apply_changes(current, changes)


@register(
    "neighbourhood",
    with_views(["dag_node", "edge"], """, c AS (SELECT node FROM dag_node WHERE cost = 1)
SELECT e.v AS center, e.u AS neighbour, 'upstream' AS role FROM edge e JOIN c ON e.v = c.node
UNION ALL SELECT node, node, 'self' FROM c
UNION ALL SELECT e.u, e.v, 'downstream' FROM edge e JOIN c ON e.u = c.node""").replace("\n, c AS", ",\nc AS"),
)
def neighbourhood(spark, sf_dir):
    centers = fx.dag_node(spark, sf_dir).where(F.col("cost") == 1)
    return dag.neighbourhood(fx.edge(spark, sf_dir), centers)


@register(
    "duplicate_ids",
    """SELECT p_brand AS parent, list_last(string_split(lower(p_type), ' ')) AS id, CAST(count(*) AS BIGINT) AS n
FROM part GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicate_ids(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("parent"), F.element_at(F.split(F.lower("p_type"), " "), -1).alias("id")
    )
    return dag.duplicate_ids(p)


@register(
    "dangling_edges",
    """SELECT u, v, 'downstream' AS unknown FROM (
  SELECT p_partkey AS u, unnest([2 * p_partkey, 3 * p_partkey, 6 * p_partkey]) AS v FROM part WHERE p_partkey > 0) t
WHERE v NOT IN (SELECT p_partkey FROM part WHERE p_partkey > 0)""",
)
def dangling_edges(spark, sf_dir):
    p = table(spark, sf_dir, "part").where(F.col("p_partkey") > 0)
    cand = p.select(F.col("p_partkey").alias("u"), F.explode(F.array(
        F.col("p_partkey") * 2, F.col("p_partkey") * 3, F.col("p_partkey") * 6)).alias("v"))
    return dag.dangling_edges(cand, fx.dag_node(spark, sf_dir))


@register(
    "fully_processed_parents",
    with_views(["node_run"], """, ch AS (SELECT DISTINCT array_to_string(node_path[1:1], '/') AS parent, node_path FROM node_run WHERE len(node_path) = 2),
done AS (SELECT DISTINCT node_path FROM node_run WHERE succeeded AND start_time < TIMESTAMP '2024-01-03')
SELECT parent, CAST(count(*) AS BIGINT) AS n_children FROM ch GROUP BY parent
HAVING count(*) = count(*) FILTER (WHERE node_path IN (SELECT node_path FROM done))""").replace("\n, ch AS", ",\nch AS"),
)
def fully_processed_parents(spark, sf_dir):
    nr = fx.node_run(spark, sf_dir)
    ch = nr.where(F.size("node_path") == 2).select(
        F.array_join(F.slice("node_path", 1, 1), "/").alias("parent"), F.array_join("node_path", "/").alias("node")
    ).distinct()
    done = nr.where(F.col("succeeded") & (F.col("start_time") < F.lit("2024-01-03").cast("timestamp_ntz"))).select(
        F.array_join("node_path", "/").alias("node")
    )
    return dag.fully_processed(ch, done).select("parent", F.col("n_children").cast("bigint").alias("n_children"))


@register(
    "find_closest_node",
    with_views(["node_run"], """, known AS (SELECT DISTINCT node_path FROM node_run UNION SELECT CAST([] AS VARCHAR[])),
req AS (
  SELECT array_to_string(node_path, '/') || '+x' AS request_id, list_append(node_path, 'x') AS path FROM (SELECT DISTINCT node_path FROM node_run WHERE len(node_path) = 2) a
  UNION ALL SELECT array_to_string(node_path, '/') || '+ok', node_path FROM (SELECT DISTINCT node_path FROM node_run WHERE len(node_path) = 2) b
  UNION ALL SELECT node_path[1] || '+task_9', [node_path[1], 'task_9'] FROM (SELECT DISTINCT node_path FROM node_run WHERE len(node_path) = 1) c),
pref AS (SELECT request_id, path, lvl, path[1:lvl] AS anc FROM (SELECT *, unnest(generate_series(0, len(path))) AS lvl FROM req) t)
SELECT request_id, array_to_string(path, '/') AS path, array_to_string(arg_max(anc, lvl), '/') AS found_path,
       max(lvl) = len(path) AS found
FROM pref JOIN known ON pref.anc = known.node_path GROUP BY request_id, path""").replace("\n, known AS", ",\nknown AS"),
)
def find_closest_node(spark, sf_dir):
    nr = fx.node_run(spark, sf_dir).select("node_path").distinct()
    two = nr.where(F.size("node_path") == 2)
    one = nr.where(F.size("node_path") == 1)
    req = (
        two.select(F.concat(F.array_join("node_path", "/"), F.lit("+x")).alias("request_id"),
                   F.concat("node_path", F.array(F.lit("x"))).alias("path"))
        .unionByName(two.select(F.concat(F.array_join("node_path", "/"), F.lit("+ok")).alias("request_id"),
                                F.col("node_path").alias("path")))
        .unionByName(one.select(F.concat(F.element_at("node_path", 1), F.lit("+task_9")).alias("request_id"),
                                F.array(F.element_at("node_path", 1), F.lit("task_9")).alias("path")))
    )
    out = dag.find_closest(nr, req)
    return out.select("request_id", F.array_join("path", "/").alias("path"),
                      F.array_join("found_path", "/").alias("found_path"), "found")


@register(
    "status_rollup",
    with_views(["node_run"], """SELECT run_id, array_to_string(node_path[1:lvl], '/') AS pipeline, CAST(count(*) AS BIGINT) AS n_failed_tasks
FROM (SELECT run_id, node_path, unnest(generate_series(0, len(node_path) - 1)) AS lvl FROM node_run
      WHERE NOT is_pipeline AND succeeded = FALSE AND node_path[1:len(node_path) - 1] <> ['error']) t
GROUP BY 1, 2"""),
)
def status_rollup(spark, sf_dir):
    """G07 with the ``error`` pipeline flagged ``ignore_errors``."""
    nr = fx.node_run(spark, sf_dir)
    flags = spark.range(1).select(F.array(F.lit("error")).alias("node_path"))
    out = dag.status_rollup(nr, flags)
    return out.select("run_id", F.array_join("pipeline", "/").alias("pipeline"),
                      F.col("n_failed_tasks").cast("bigint").alias("n_failed_tasks"))


_LANES_D = """, iv AS (
  SELECT run_id, CASE WHEN is_pipeline THEN 'pipeline' ELSE 'task' END AS kind, node_run_id, start_time AS s,
         coalesce(end_time, start_time) + INTERVAL 6 HOUR AS e,
         row_number() OVER (PARTITION BY run_id, is_pipeline ORDER BY start_time, node_run_id) AS i
  FROM node_run),
pack(run_id, kind, i, node_run_id, lane, ends) AS (
  SELECT run_id, kind, i, node_run_id, 0, [e] FROM iv WHERE i = 1
  UNION ALL
  SELECT p.run_id, p.kind, iv.i, iv.node_run_id,
         coalesce(nullif(list_position(list_transform(p.ends, lambda x: x <= iv.s), true), 0), len(p.ends) + 1) - 1,
         CASE WHEN coalesce(list_position(list_transform(p.ends, lambda x: x <= iv.s), true), 0) = 0 THEN list_append(p.ends, iv.e)
              ELSE list_transform(generate_series(1, len(p.ends)), lambda j: CASE WHEN j = list_position(list_transform(p.ends, lambda x: x <= iv.s), true) THEN iv.e ELSE p.ends[j] END) END
  FROM pack p JOIN iv ON iv.run_id = p.run_id AND iv.kind = p.kind AND iv.i = p.i + 1)
SELECT run_id, kind, node_run_id, CAST(lane AS BIGINT) AS lane FROM pack"""


@register("timeline_lanes", with_views(["node_run"], "SELECT 1").replace("WITH ", "WITH RECURSIVE ", 1).replace("\nSELECT 1", _LANES_D.replace("\n, iv AS", ",\niv AS")))
def timeline_lanes(spark, sf_dir):
    """G12 with bars stretched by six hours so that runs overlap."""
    nr = fx.node_run(spark, sf_dir).select(
        "run_id", F.when(F.col("is_pipeline"), "pipeline").otherwise("task").alias("kind"), "node_run_id", "start_time",
        (F.coalesce("end_time", "start_time") + F.expr("INTERVAL 6 HOURS")).alias("end_x"),
    )
    return dag.lanes(nr, ["run_id", "kind"], "start_time", "end_x", "node_run_id").select(
        "run_id", "kind", "node_run_id", F.col("lane").cast("bigint").alias("lane")
    )


@register(
    "pipeline_children_table",
    with_views(["node_run"], """SELECT id, 'Pipeline ' || id AS description, 'kind: ''pipeline''' AS labels, avg_duration, avg_run_time,
       round(sum(avg_run_time) OVER (ORDER BY id DESC), 6) AS cost
FROM (SELECT k.id, round(coalesce((SELECT avg(date_diff('microsecond', o.start_time, o.end_time) / 1e6) FROM node_run o
                                   WHERE o.node_path = [k.id] AND o.succeeded), 0), 1) AS avg_duration,
             round(coalesce(sum(t.mean), 0), 1) AS avg_run_time
      FROM (SELECT DISTINCT node_path[1] AS id FROM node_run WHERE len(node_path) = 1) k
      LEFT JOIN (SELECT node_path[1] AS id, avg(date_diff('microsecond', start_time, end_time) / 1e6) AS mean
                 FROM node_run WHERE succeeded AND NOT is_pipeline GROUP BY node_path) t ON t.id = k.id
      GROUP BY k.id) c"""),
)
def pipeline_children_table(spark, sf_dir):
    """Children of the root with durations (A01, default 0 when never run) and
    critical-path cost (G03); each child runs before the next one by name."""
    nr = fx.node_run(spark, sf_dir)
    durs = an.node_durations(nr, [])
    kids = nr.where(F.size("node_path") == 1).select("node_path").distinct()
    table_ = kids.join(durs, "node_path", "left").select(
        F.element_at("node_path", 1).alias("id"),
        F.concat(F.lit("Pipeline "), F.element_at("node_path", 1)).alias("description"),
        format_labels(F.create_map(F.lit("kind"), F.lit("pipeline"))).alias("labels"),
        F.coalesce("avg_duration", F.lit(0.0)).alias("avg_duration"),
        F.coalesce("avg_run_time", F.lit(0.0)).alias("avg_run_time"),
    )
    nodes = table_.select(F.col("id").alias("node"), F.col("avg_run_time").alias("cost"))
    # the next child by name: a window over the children of one pipeline
    edges = nodes.select(F.col("node").alias("u"), F.lead("node").over(Window.orderBy("node")).alias("v")).where("v is not null")
    cost = dag.critical_path_cost(nodes, edges).withColumnRenamed("node", "id")
    return table_.join(cost, "id").withColumn("cost", F.round("cost", 6))
