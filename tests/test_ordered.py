"""Ordered per-group values equal the window results, also when one group holds most rows
and spans many partitions and Arrow batches."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from spark_elt.operators.ordered import ordered_scan

T0 = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("partitions", [1, 3, 16])
@pytest.mark.parametrize("batch", [7, 10_000])
def test_values_on_skewed_groups(spark, partitions, batch):
    hot = [(1, i, float(i % 7), T0 + dt.timedelta(minutes=(i * 37) % 101)) for i in range(1200)]
    cold = [(g, i, float(i) if i % 3 else None, None if i == 2 else T0 + dt.timedelta(minutes=i)) for g in range(2, 40) for i in range(5)]
    null = [(None, i, 1.0, T0) for i in range(9)]
    df = spark.createDataFrame(hot + cold + null, "g long, o long, x double, t timestamp_ntz").withColumn("a", F.array("g", "o"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = ordered_scan(df, ["g"], ["o"], sums=["x"], prev_max=["t", "x"], lag=["x", "a"], lead=["x", "t"], partitions=partitions).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    w = Window.partitionBy("g").orderBy("o")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    want = df.select(
        "*",
        F.row_number().over(w).cast("bigint").alias("_idx"),
        F.sum(F.coalesce("x", F.lit(0.0))).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("x_cum"),
        F.max("t").over(before).alias("t_prev_max"),
        F.max("x").over(before).alias("x_prev_max"),
        F.lag("x").over(w).alias("lag_x"),
        F.lag("a").over(w).alias("lag_a"),
        F.lead("x").over(w).alias("lead_x"),
        F.lead("t").over(w).alias("lead_t"),
    )
    assert sorted(map(str, got)) == sorted(map(str, want.collect()))


def test_no_rows(spark):
    df = spark.createDataFrame([], "g long, o long, x double")
    assert ordered_scan(df, ["g"], ["o"], sums=["x"], lag=["x"]).count() == 0


def test_one_range_shuffle_and_no_window_over_the_rows(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("o"))
    plan = ordered_scan(df, ["g"], ["o"], lag=["o"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "rangepartitioning" not in plan
