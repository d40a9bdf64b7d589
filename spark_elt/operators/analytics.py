"""Run-log analytics.

Every function takes run-log DataFrames (schemas of SURVEY §1.3) and returns a lazy
DataFrame. Paths are ``array<string>``; ``path`` arguments are Python lists.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spark_elt.functions import (
    epoch_seconds,
    format_duration,
    iso_timestamp,
    last_name,
    path_has_prefix,
    relative_label,
    status_text,
)
from spark_elt.functions.paths import path_literal

def duration():
    return epoch_seconds("start_time", "end_time")


def node_durations(node_run: DataFrame, path: Sequence[str]) -> DataFrame:
    """Average duration and run time of the children of ``path``.

    Inner level: per full descendant path the average duration of direct children
    and the average of non-pipeline descendants. Outer level: per child the rounded
    average of the first and the rounded sum of the second.
    Both levels are hash aggregates with map-side partial aggregation."""
    level = len(path)
    child = F.slice("node_path", 1, level + 1)
    inner = (
        node_run.where(path_has_prefix("node_path", path, strict=True) & (F.col("succeeded") == F.lit(True)))
        .groupBy("node_path")
        .agg(
            F.avg(F.when(F.size("node_path") == level + 1, duration())).alias("avg_duration"),
            F.avg(F.when(~F.col("is_pipeline"), duration())).alias("avg_run_time"),
        )
    )
    return inner.groupBy(child.alias("node_path")).agg(
        F.round(F.avg("avg_duration"), 1).alias("avg_duration"),
        F.round(F.sum("avg_run_time"), 1).alias("avg_run_time"),
    )


def latest_run_id(node_run: DataFrame, path: Sequence[str]) -> DataFrame:
    """``max(run_id)`` of the node at exactly ``path`` (A03/P05); one row, NULL if none."""
    return node_run.where(F.col("node_path") == path_literal(path)).agg(F.max("run_id").alias("run_id"))


def for_run(df: DataFrame, run_id: int | DataFrame) -> DataFrame:
    """Rows of one run. ``run_id`` is a number or a frame with a ``run_id`` column whose
    first row counts (e.g. ``latest_run_id``)."""
    if isinstance(run_id, DataFrame):
        return df.join(F.broadcast(run_id.select("run_id").limit(1)), "run_id", "left_semi")
    return df.where(F.col("run_id") == F.lit(run_id))


def run_output(node_run: DataFrame, node_output: DataFrame, path: Sequence[str], run_id) -> DataFrame:
    """Output lines of the node at ``path`` and all nodes below it in one run."""
    nr = for_run(node_run.where(path_has_prefix("node_path", path)), run_id).select("node_run_id", "node_path")
    return node_output.join(nr, "node_run_id").select(
        "node_path", "message", "format", "is_error", "timestamp", "node_output_id"
    )


def run_output_limited(
    node_run: DataFrame, node_output: DataFrame, path: Sequence[str], run_id, line_limit: int = 1000
) -> DataFrame:
    """First ``line_limit`` output lines by time plus a ``has_more`` flag.

    ``orderBy().limit()`` plans as a TakeOrderedAndProject: each task keeps its own
    top ``line_limit + 1`` rows, so no task ever holds the whole output."""
    lines = run_output(node_run, node_output, path, run_id).orderBy("timestamp", "node_output_id").limit(line_limit + 1)
    w = Window.orderBy("timestamp", "node_output_id")
    return (
        lines.withColumn("line_no", F.row_number().over(w).cast("bigint"))
        .withColumn("has_more", F.max("line_no").over(Window.partitionBy()) > line_limit)
        .where(F.col("line_no") <= line_limit)
    )


def last_runs(node_run: DataFrame, path: Sequence[str]) -> DataFrame:
    """Runs of one node, newest first, with start text, duration text and status."""
    d = duration()
    label = F.when(F.col("succeeded").isNull(), F.lit("unfinished")).otherwise(
        F.concat(format_duration(d), F.lit(", "), F.when(F.col("succeeded"), "succeeded").otherwise("failed"))
    )
    return (
        node_run.where(F.col("node_path") == path_literal(path))
        .select(
            "run_id",
            F.date_format("start_time", "MMM dd HH:mm").alias("start_time"),
            F.round(d, 6).alias("duration"),
            "succeeded",
            F.concat(F.date_format("start_time", "MMM dd HH:mm"), F.lit(" ("), label, F.lit(")")).alias("label"),
        )
        .orderBy(F.desc("run_id"))
    )


def timeline(node_run: DataFrame, path: Sequence[str], run_id) -> DataFrame:
    """Nodes below ``path`` in one run with label, status, type and bar ends.

    ``max(end_time) over ()`` runs after the run filter, so its single window
    partition holds one run only."""
    level = len(path)
    nr = for_run(node_run.where(path_has_prefix("node_path", path, strict=True)), run_id)
    # one run: its max end is a global aggregate (one row, broadcast), not a window
    max_end = nr.agg(F.max("end_time").alias("max_end_time"))
    end = F.coalesce(F.col("end_time"), F.coalesce(F.col("max_end_time"), F.col("start_time")) + F.expr("INTERVAL 1 SECOND"))
    return nr.join(F.broadcast(max_end), how="left", on=F.lit(True)).select(
        F.array_join("node_path", "/").alias("node_path"),
        relative_label("node_path", level).alias("label"),
        status_text("succeeded").alias("status"),
        F.when(F.col("is_pipeline"), "pipeline").otherwise("task").alias("type"),
        iso_timestamp("start_time").alias("start"),
        iso_timestamp(end).alias("end"),
    )


def top_children(node_run: DataFrame, path: Sequence[str], n: int = 8) -> DataFrame:
    """The ``n`` direct children of ``path`` with the highest average duration,
    ranked 1…n (A09, T01, W01). NULL averages sort first (descending), ties by name."""
    level = len(path)
    avg = (
        node_run.where(
            path_has_prefix("node_path", path)
            & (F.size("node_path") == level + 1)
            & F.col("succeeded").isNotNull()
        )
        .groupBy("node_path")
        .agg(F.avg(duration()).alias("average_duration"))
        .withColumn("node_name", last_name("node_path"))
    )
    order = [F.col("average_duration").desc_nulls_first(), F.col("node_name")]
    top = avg.orderBy(*order).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def _run_data(c_duration: Column, c_succeeded: Column, first: str) -> Column:
    """JSON-like text of one run's data (``{succeeded, duration}`` or reversed)."""
    dur = F.round(c_duration, 2)
    if first == "succeeded":
        return F.to_json(F.struct(c_succeeded.alias("succeeded"), dur.alias("duration")), {"ignoreNullFields": "false"})
    return F.to_json(F.struct(dur.alias("duration"), c_succeeded.alias("succeeded")), {"ignoreNullFields": "false"})


def run_time_chart(node_run: DataFrame, path: Sequence[str], n: int = 8) -> DataFrame:
    """Per run: first start, node name, own run data and the aligned run data of the
    top ``n`` children (C01). Children that did not run give NULL entries.

    The ranked children are at most ``n`` rows, read first; they go into the plan as a
    literal list. The node's own runs and the children's runs then come from one filtered
    scan and meet in one aggregate by run, in a slot per child."""
    children = [(r["node_path"], r["node_name"]) for r in top_children(node_run, path, n).orderBy("rank").collect()]
    p = path_literal(path)
    own = (F.col("node_path") == p) & F.col("succeeded").isNotNull()
    paths = F.array(*[path_literal(c) for c, _ in children]) if children else F.lit(None).cast("array<array<string>>")
    slot = F.coalesce(F.array_position(paths, F.col("node_path")), F.lit(0))
    data = F.when(own, _run_data(duration(), F.col("succeeded"), "succeeded")).otherwise(_run_data(duration(), F.col("succeeded"), "duration"))
    rows = node_run.where(own | (slot > 0)).select("run_id", "start_time", slot.cast("int").alias("slot"), data.alias("data"))
    runs = rows.groupBy("run_id").agg(
        F.coalesce(F.min(F.when(F.col("slot") == 0, F.col("start_time"))), F.min("start_time")).alias("time"),
        *[F.max(F.when(F.col("slot") == i, F.col("data"))).alias(f"_{i}") for i in range(len(children) + 1)],
    )
    none = F.lit(None).cast("array<string>")
    return runs.select(
        "run_id",
        "time",
        last_name(p).alias("node_name"),
        F.col("_0").alias("node_run"),
        (F.array(*[F.lit(name) for _, name in children]) if children else none).alias("child_names"),
        (F.array(*[F.col(f"_{i + 1}") for i in range(len(children))]) if children else none).alias("child_runs"),
    )


def system_stats(node_run: DataFrame, stats: DataFrame, path: Sequence[str], run_id, bucket_seconds: int = 4,
                 min_samples: int = 15) -> DataFrame:
    """Statistics samples taken while the node at ``path`` ran in run ``run_id``.

    The reference condition ``ts BETWEEN start AND end AND (stats.run_id = nr.run_id
    OR stats.run_id = -1)`` would plan as a nested-loop join; see ``interval_join_stats``.
    With ``min_samples`` the rows are returned only when there are that many (P07)."""
    return interval_join_stats(
        for_run(node_run.where(F.col("node_path") == path_literal(path)), run_id),
        stats,
        bucket_seconds,
        min_samples,
    )


STAT_COLS = ["disc_read", "disc_write", "net_recv", "net_sent", "cpu_usage", "mem_usage", "swap_usage", "iowait"]


def interval_cells(low: str, high: str) -> Column:
    """The fewest cells that make up the whole numbers from ``low`` to ``high`` (columns), as
    an array of (level, cell): a cell of level l has 4^l numbers and begins at a multiple of
    that. An interval of n numbers has at most six cells a level, on log4(n) levels.

    Level l has whole cells first..last; those that lie in whole cells of the next level are
    left to it, so what remains are up to three at each end."""
    def whole(level: str) -> tuple[str, str]:
        return f"-shiftright(-{low}, 2 * ({level}))", f"shiftright({high} + 1, 2 * ({level})) - 1"

    (first, last), (above, above_last) = whole("l"), whole("l + 1")
    # one test for both ends: without a whole cell above, all cells of the level are its own
    cells = f"""CASE WHEN {first} > {last} THEN array()
      WHEN {above} > {above_last} THEN sequence({first}, {last})
      ELSE concat(CASE WHEN {first} < 4 * ({above}) THEN sequence({first}, 4 * ({above}) - 1) ELSE array() END,
                  CASE WHEN 4 * ({above_last}) + 4 <= {last} THEN sequence(4 * ({above_last}) + 4, {last}) ELSE array() END) END"""
    levels = f"sequence(0, cast(log2({high} - {low} + 1) / 2 AS int))"
    return F.expr(f"""CASE WHEN {low} <= {high}
      THEN flatten(transform({levels}, l -> transform({cells}, c -> struct(l AS level, cast(c AS bigint) AS cell)))) END""")


#: Up to so many node runs, their cells (a year has less than 70) go to every task.
FEW_RUNS = 1_000


def length_level(low: str, high: str) -> Column:
    """The level of an interval by its length: of cells of 16^l numbers, those whose length is
    between a quarter and four times that of the interval, so it touches at most six."""
    return F.expr(f"CAST(floor(log2({high} - {low} + 1) / 4 + 0.5) AS int)")


def interval_join_stats(nr: DataFrame, stats: DataFrame, bucket_seconds: int = 4, min_samples: int = 0) -> DataFrame:
    """Interval join of node runs with statistics samples (J03); see ``system_stats``.

    Time is cut into cells of ``bucket_seconds`` and of multiples of that. Samples of the same
    run join on (run_id, level, cell), sentinel samples (run -1) on (level, cell); a sample
    has one cell for each level that any run has, and a pair meets in one cell.

    Many node runs are shuffled, each as the few cells that it touches on the level of its
    length (``length_level``); the samples in these lie in it or, at either end, at most its
    own length times four away, and the BETWEEN drops those. Few node runs are broadcast, as the
    fewest cells that cover each one (``interval_cells``), and the samples stay where they are.
    So neither long runs nor many sentinel samples make pairs out of proportion."""
    from spark_elt.functions.durations import wall_micros
    from spark_elt.session import checkpoint_root

    # wall-clock micros since 1970 (no session time zone involved)
    finest = lambda c: F.floor(wall_micros(c) / (bucket_seconds * 1_000_000))
    nr = nr.where("end_time IS NOT NULL AND start_time <= end_time").select(
        "node_run_id", F.col("run_id").alias("nr_run_id"), "start_time", "end_time"
    )
    # stored: its levels are asked for first, and both kinds of samples meet it
    checkpoint_root(nr.sparkSession)
    nr = nr.checkpoint(eager=True)
    nr = nr.withColumns({"_lo": finest(F.col("start_time")), "_hi": finest(F.col("end_time"))})
    by_length = nr.groupBy(length_level("_lo", "_hi").alias("level")).count().collect()  # a row for each level
    few = sum(r["count"] for r in by_length) <= FEW_RUNS
    if few:
        bits, touched = 2, nr.withColumn("_c", F.explode(interval_cells("_lo", "_hi")))
        levels = sorted(r["level"] for r in touched.select("_c.level").distinct().collect())  # at most 32
    else:
        bits, levels = 4, sorted(r["level"] for r in by_length)
        touched = nr.withColumn("_l", length_level("_lo", "_hi")).withColumn(
            "_c", F.explode(F.expr("transform(sequence(shiftright(_lo, 4 * _l), shiftright(_hi, 4 * _l)), c -> struct(_l AS level, c AS cell))"))
        )
    nr_b = touched.select(
        "node_run_id", "nr_run_id", "start_time", "end_time", F.col("_c.level").alias("nr_level"), F.col("_c.cell").alias("nr_cell")
    )
    nr_b = F.broadcast(nr_b) if few else nr_b
    between = (F.col("timestamp") >= F.col("start_time")) & (F.col("timestamp") <= F.col("end_time"))
    cell = finest(F.col("timestamp"))
    cells = [F.struct(F.lit(n).alias("level"), F.shiftright(cell, bits * n).alias("cell")) for n in levels]
    s_b = stats.withColumn("_c", F.explode(F.array(*cells))) if cells else stats.limit(0).withColumn(
        "_c", F.struct(F.lit(0).alias("level"), F.lit(0).cast("long").alias("cell")))
    meet = (F.col("_c.level") == F.col("nr_level")) & (F.col("_c.cell") == F.col("nr_cell"))
    own = s_b.where(F.col("run_id") != -1).join(nr_b, (F.col("run_id") == F.col("nr_run_id")) & meet).where(between)
    sentinel = s_b.where(F.col("run_id") == -1).join(nr_b, meet).where(between)
    cols = ["node_run_id", "timestamp", "run_id"] + STAT_COLS
    joined = own.select(cols).unionByName(sentinel.select(cols))
    if min_samples:
        joined = min_rows(joined, ["node_run_id"], min_samples, few)
    return joined


def min_rows(df: DataFrame, keys: Sequence[str], n: int, few: bool = False) -> DataFrame:
    """Keep the rows of groups with at least ``n`` rows (P07). The group size is a
    partial-aggregated count joined back on the keys, so no group is buffered. Of ``few``
    groups the counts are broadcast, so that large ones stay in their parts."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= n).drop("_n")
    return df.join(F.broadcast(counts) if few else counts, list(keys), "left_semi")
