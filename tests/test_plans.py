"""Plan checks: pushdown and pruning reach the scans, no nested-loop joins."""

from pyspark.sql import functions as F

from spark_elt.operators import analytics as an
from spark_elt.plans import fixtures as fx

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_delta_predicate_is_pushed_to_the_scan(spark):
    src = fx.orders_v2(spark, SF)
    p = plan(src.where(F.col("o_orderdate") >= F.lit("1999-12-31").cast("timestamp_ntz")))
    assert "GreaterThanOrEqual(o_orderdate" in p


def test_projection_prunes_columns(spark):
    p = plan(fx.dag_node(spark, SF).select("node", "cost"))
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in p
    assert "GreaterThan(p_partkey,0)" in p


def test_interval_join_plan_uses_equi_joins(spark):
    j = an.interval_join_stats(fx.node_run(spark, SF), fx.system_statistics(spark, SF))
    p = plan(j)
    assert "NestedLoop" not in p and ("HashJoin" in p or "SortMergeJoin" in p)


def test_top_k_is_take_ordered(spark):
    t = fx.node_run(spark, SF).orderBy(F.desc("start_time")).limit(8)
    assert "TakeOrderedAndProject" in plan(t)


def test_run_output_limited_is_top_k(spark):
    nr = fx.node_run(spark, SF)
    out = an.run_output_limited(nr, fx.node_output(spark, SF), [], an.latest_run_id(nr, []))
    assert "TakeOrderedAndProject" in plan(out) or "Limit" in plan(out)


def test_file_dates_of_loaded_rows_need_no_shuffle(spark):
    from spark_elt.plans.q_files import parallel_read_files_all

    p = plan(parallel_read_files_all(spark, SF))
    assert "Exchange" not in p and "Join" not in p


def test_chart_reads_once_without_nested_loop(spark):
    p = plan(an.run_time_chart(fx.node_run(spark, SF), ["view"]))
    assert "NestedLoop" not in p and "Cartesian" not in p and p.count("FileScan") <= 2


def test_ordered_operators_have_no_window_over_groups(spark):
    from spark_elt.operators import dag, runlog

    rates = plan(runlog.counter_rates(fx.counter_samples(spark, SF), ["run_id"], "ts", ["read_bytes"], tie="event_id"))
    digest = plan(runlog.failure_digest(fx.node_run(spark, SF), fx.node_output(spark, SF)))
    bars = fx.node_run(spark, SF).select("run_id", "node_run_id", "start_time", F.coalesce("end_time", "start_time").alias("e"))
    lanes = plan(dag.lanes(bars, ["run_id"], "start_time", "e", "node_run_id"))
    for p in (rates, digest, lanes):
        assert "NestedLoop" not in p
        # windows are over the first and last rows of the partitions only
        assert all("_g#" in line for line in p.splitlines() if "Window [" in line)
