"""Registered SQL-templating queries (Q01–Q05). The driver tables are addressed as
``parquet.`<dir>/<table>.parquet``` through a placeholder, so no catalog state is
needed and Catalyst still prunes columns and pushes filters into the scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from spark_elt.operators.sql import parallel_sql, run_sql
from spark_elt.plans.registry import register
from spark_elt.session import TABLES


def tables(sf_dir: str) -> dict[str, str]:
    return {f"@{t}@": f"parquet.`{sf_dir.rstrip('/')}/{t}.parquet`" for t in TABLES}


PRICING_SUMMARY = """
SELECT l_returnflag, l_linestatus,
       round(sum(l_quantity), 2) AS sum_qty,
       round(sum(l_extendedprice), 2) AS sum_base_price,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
       round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge,
       round(avg(l_quantity), 6) AS avg_qty,
       round(avg(l_discount), 6) AS avg_disc,
       count(*) AS count_order
FROM {lineitem}
WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00'
GROUP BY l_returnflag, l_linestatus"""


@register("run_sql", PRICING_SUMMARY.format(lineitem="lineitem"))
def run_sql_q(spark, sf_dir):
    return run_sql(spark, PRICING_SUMMARY.format(lineitem="@lineitem@"), replace=tables(sf_dir))


@register("sql_pricing_summary", PRICING_SUMMARY.format(lineitem="lineitem"))
def sql_pricing_summary(spark, sf_dir):
    """Same statement read from a script with a setup statement in front."""
    script = "SELECT 1;\n-- pricing summary; the first statement is a no-op\n" + PRICING_SUMMARY.format(lineitem="@lineitem@") + ";"
    return run_sql(spark, lambda: script, replace=tables(sf_dir))


REPLACE_SQL = """
SELECT o_orderpriority, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
FROM {orders} WHERE o_orderstatus = '{status}' AND o_orderdate >= TIMESTAMP '{since}'
GROUP BY o_orderpriority"""


@register("run_sql_replace", REPLACE_SQL.format(orders="orders", status="F", since="1996-01-01 00:00:00"))
def run_sql_replace(spark, sf_dir):
    rep = tables(sf_dir)
    rep.update({"@status@": "F", "@since@": lambda: "1996-01-01 00:00:00"})
    return run_sql(spark, REPLACE_SQL.format(orders="@orders@", status="@status@", since="@since@"), replace=rep)


@register(
    "parallel_execute_sql",
    """SELECT r_name, count(*) AS n_customers, round(sum(c_acctbal), 2) AS acctbal,
       regexp_replace(replace(lower(r_name), '-', '_'), '[^0-9a-z\\-_]+', '', 'g') AS task_id
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name""",
)
def parallel_execute_sql(spark, sf_dir):
    """One SELECT per region (parameter list read from the region table)."""
    rep = tables(sf_dir)
    template = """SELECT r_name, count(*) AS n_customers, round(sum(c_acctbal), 2) AS acctbal
FROM @customer@ JOIN @nation@ ON c_nationkey = n_nationkey JOIN @region@ ON n_regionkey = r_regionkey
WHERE r_name = '@region_name@' GROUP BY r_name"""
    # the parameter list is the region list: a handful of names, bounded by the dimension
    names = [(r["r_name"],) for r in spark.read.parquet(f"{sf_dir}/region.parquet").select("r_name").collect()]
    return parallel_sql(spark, template, ["@region_name@"], names, replace=rep)


@register(
    "parallel_execute_sql_joined",
    """SELECT n_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total, CAST(n_nationkey AS VARCHAR) AS task_id
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name, n_nationkey""",
)
def parallel_execute_sql_joined(spark, sf_dir):
    """One SELECT per nation, by number; each table is scanned once for all of them."""
    template = """SELECT n_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
FROM @orders@ JOIN @customer@ ON o_custkey = c_custkey JOIN @nation@ ON c_nationkey = n_nationkey
WHERE n_nationkey = @nation_key@ GROUP BY n_name"""
    # the parameter list is the nation list, bounded by the dimension
    keys = [(r["n_nationkey"],) for r in spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey").collect()]
    return parallel_sql(spark, template, ["@nation_key@"], keys, replace=tables(sf_dir))


@register(
    "sql_join_revenue",
    """SELECT n_name, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS n_orders,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
WHERE c_nationkey = s_nationkey AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
GROUP BY n_name""",
)
def sql_join_revenue(spark, sf_dir):
    return run_sql(
        spark,
        """SELECT n_name, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS n_orders,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM @customer@ JOIN @orders@ ON c_custkey = o_custkey JOIN @lineitem@ ON l_orderkey = o_orderkey
  JOIN @supplier@ ON l_suppkey = s_suppkey JOIN @nation@ ON s_nationkey = n_nationkey
WHERE c_nationkey = s_nationkey AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
GROUP BY n_name""",
        replace=tables(sf_dir),
    )


SEMI_ANTI = """
SELECT 'with_orders' AS kind, c_mktsegment, count(*) AS n FROM {customer} c
WHERE EXISTS (SELECT 1 FROM {orders} o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'O')
GROUP BY c_mktsegment
UNION ALL
SELECT 'without_orders' AS kind, c_mktsegment, count(*) AS n FROM {customer} c
WHERE NOT EXISTS (SELECT 1 FROM {orders} o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'O')
GROUP BY c_mktsegment"""


@register("sql_semi_anti", SEMI_ANTI.format(customer="customer", orders="orders"))
def sql_semi_anti(spark, sf_dir):
    return run_sql(spark, SEMI_ANTI.format(customer="@customer@", orders="@orders@"), replace=tables(sf_dir))


GROUPING = """
SELECT l_returnflag, l_linestatus, CAST(grouping_id(l_returnflag, l_linestatus) AS BIGINT) AS gid,
       count(*) AS n, round(sum(l_quantity), 2) AS qty
FROM {lineitem}
GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())"""

GROUPING_D = GROUPING.replace("grouping_id(", "grouping(")


@register("sql_grouping_sets", GROUPING_D.format(lineitem="lineitem"))
def sql_grouping_sets(spark, sf_dir):
    return run_sql(spark, GROUPING.format(lineitem="@lineitem@"), replace=tables(sf_dir))


WINDOW_RANK = """
SELECT o_custkey, o_orderkey, round(o_totalprice, 2) AS o_totalprice,
       CAST(rn AS BIGINT) AS rn, CAST(rk AS BIGINT) AS rk, round(running, 2) AS running
FROM (SELECT o_custkey, o_orderkey, o_totalprice,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn,
             rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS rk,
             sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
      FROM {orders}) t
WHERE rn <= 3"""


@register("sql_window_rank", WINDOW_RANK.format(orders="orders"))
def sql_window_rank(spark, sf_dir):
    return run_sql(spark, WINDOW_RANK.format(orders="@orders@"), replace=tables(sf_dir))


SET_OPS = """
SELECT 'union' AS op, count(*) AS n FROM (
  SELECT c_nationkey AS k FROM {customer} UNION SELECT s_nationkey FROM {supplier}) a
UNION ALL SELECT 'intersect', count(*) FROM (
  SELECT o_custkey FROM {orders} WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM {orders} WHERE o_orderstatus = 'O') b
UNION ALL SELECT 'except', count(*) FROM (
  SELECT c_custkey FROM {customer} EXCEPT SELECT o_custkey FROM {orders}) c
UNION ALL SELECT 'union_all', count(*) FROM (
  SELECT p_partkey FROM {part} UNION ALL SELECT l_partkey FROM {lineitem}) d"""


@register("sql_set_ops", SET_OPS.format(customer="customer", supplier="supplier", orders="orders", part="part",
                                         lineitem="lineitem"))
def sql_set_ops(spark, sf_dir):
    return run_sql(
        spark,
        SET_OPS.format(customer="@customer@", supplier="@supplier@", orders="@orders@", part="@part@",
                       lineitem="@lineitem@"),
        replace=tables(sf_dir),
    )


@register(
    "dynamic_sql",
    """SELECT o_orderpriority, count(*) AS n_orders FROM orders GROUP BY o_orderpriority""",
)
def dynamic_sql(spark, sf_dir):
    """The statement list is made at run time from a table (one statement per
    distinct priority, a small dimension), then run and combined."""
    prios = [r[0] for r in spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderpriority").distinct().collect()]
    rep = tables(sf_dir)
    stmts = [
        f"SELECT o_orderpriority, count(*) AS n_orders FROM @orders@ WHERE o_orderpriority = '{p}' GROUP BY o_orderpriority"
        for p in sorted(prios)
    ]
    frames = [run_sql(spark, s, replace=rep) for s in stmts]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.select("o_orderpriority", F.col("n_orders").cast("bigint").alias("n_orders"))
