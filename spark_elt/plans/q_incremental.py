"""Registered incremental-processing queries.

State tables are derived from the driver tables (one processed-file / dependency /
copy-status row per event-type node) and written into scratch directories; the
copy and upsert queries use two snapshots of ``orders``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_elt.functions.durations import wall_micros
from spark_elt.operators import incremental as inc
from spark_elt.operators.state_log import StateLog
from spark_elt.plans import fixtures as fx
from spark_elt.plans.oracle_views import with_views
from spark_elt.plans.registry import register
from spark_elt.session import scratch_dir, table

T0 = dt.datetime(2024, 2, 1)
NODES_D = "SELECT DISTINCT event_type FROM events"


def _dep_state(spark, sf_dir) -> inc.StateTable:
    """Dependency hashes per node ['load', type]; the 'error' node has a stale hash."""
    st = inc.StateTable(spark, scratch_dir(spark, "file_dependency"), inc.FILE_DEPENDENCY, ["node_path", "dependency_type"])
    types = table(spark, sf_dir, "events").select("event_type").distinct()
    rows = types.select(
        F.array(F.lit("load"), F.col("event_type")).alias("node_path"),
        F.lit("ParallelReadFile").alias("dependency_type"),
        F.when(F.col("event_type") == "error", F.lit("stale")).otherwise(F.md5("event_type")).alias("hash"),
        F.lit(T0.isoformat(sep=" ")).cast("timestamp_ntz").alias("timestamp"),
    )
    st.replace(rows)
    return st


def _current_hashes(spark, sf_dir) -> DataFrame:
    types = table(spark, sf_dir, "events").select("event_type").distinct()
    return types.select(F.array(F.lit("load"), F.col("event_type")).alias("node_path"),
                        F.lit("ParallelReadFile").alias("dependency_type"), F.md5("event_type").alias("hash"))


def _dep_out(df: DataFrame) -> DataFrame:
    return df.select(F.array_join("node_path", "/").alias("node_path"), "dependency_type", "hash")


@register(
    "dependency_hash",
    """SELECT '2000-01-01 None ' || string_agg(md5(event_type || chr(10)), ' ' ORDER BY event_type) AS hash
FROM (SELECT DISTINCT event_type FROM events) t""",
)
def dependency_hash(spark, sf_dir):
    """I01 over one file per event type that holds the type's name as its line, in the order
    of the names."""
    root = scratch_dir(spark, "dependency_files")
    types = table(spark, sf_dir, "events").select("event_type").distinct()
    types.repartition(4, "event_type").select(F.col("event_type").alias("value"), "event_type").write.partitionBy("event_type").text(root)
    files = spark.read.format("binaryFile").load(root).select("path", "event_type").distinct()
    paths = [r["path"] for r in files.orderBy("event_type").collect()]
    return inc.dependency_hash_frame(spark, paths, dt.date(2000, 1, 1))


@register(
    "dependency_is_modified",
    f"SELECT 'load/' || event_type AS node_path, 'ParallelReadFile' AS dependency_type, event_type = 'error' AS is_modified FROM ({NODES_D}) t",
)
def dependency_is_modified(spark, sf_dir):
    st = _dep_state(spark, sf_dir)
    out = inc.modified_dependencies(st.read(), _current_hashes(spark, sf_dir))
    return out.withColumn("node_path", F.array_join("node_path", "/"))


@register(
    "dependency_update",
    f"SELECT 'load/' || event_type AS node_path, 'ParallelReadFile' AS dependency_type, md5(event_type) AS hash FROM ({NODES_D}) t",
)
def dependency_update(spark, sf_dir):
    st = _dep_state(spark, sf_dir)
    h = _current_hashes(spark, sf_dir).where(F.element_at("node_path", 2) == "error").first()["hash"]
    inc.update_dependency(st, ["load", "error"], "ParallelReadFile", h, T0)
    return _dep_out(st.read())


@register(
    "dependency_delete",
    f"""SELECT 'load/' || event_type AS node_path, 'ParallelReadFile' AS dependency_type,
       CASE WHEN event_type = 'error' THEN 'stale' ELSE md5(event_type) END AS hash FROM ({NODES_D}) t
WHERE event_type <> 'click'""",
)
def dependency_delete(spark, sf_dir):
    st = _dep_state(spark, sf_dir)
    inc.delete_dependency(st, ["load", "click"], "ParallelReadFile")
    return _dep_out(st.read())


@register(
    "track_processed_files",
    """SELECT DISTINCT 'load_events' AS node_path, strftime(ts, '%d') AS day FROM events""",
)
def track_processed_files(spark, sf_dir):
    """The whole selection is recorded with one upsert after the load; a
    second tracking of the same files does not add rows."""
    from spark_elt.plans.q_files import DATE_REGEX, write_daily_csv
    from spark_elt.sources.files import list_files
    from spark_elt.sources.selection import ReadMode, select_files

    root = write_daily_csv(spark, sf_dir, "track_processed")
    st = inc.StateTable(spark, scratch_dir(spark, "processed_file"), inc.PROCESSED_FILE, ["node_path", "file_name"])
    sel = select_files(list_files(spark, root, "*.csv"), ReadMode.ALL, date_regex=DATE_REGEX)
    inc.track_processed(st, ["load_events"], sel)
    inc.track_processed(st, ["load_events"], sel)
    s = st.read()
    n_files = sel.count()
    if s.count() != n_files:
        raise AssertionError("tracking the same files twice must not add rows")
    return s.select(
        F.array_join("node_path", "/").alias("node_path"), F.regexp_extract("file_name", r"d=(\d{2})", 1).alias("day")
    ).distinct()


@register(
    "processed_files_log",
    """SELECT 'load/' || event_type AS node_path, strftime(ts, '%Y-%m-%d') AS file_name, epoch_us(max(ts)) AS modified_us
FROM events WHERE event_type <> 'click' GROUP BY 1, 2""",
)
def processed_files_log(spark, sf_dir):
    """I05, I07 in a log of changes: each event type is a node whose files are its days, with
    the time of the first event at first and of the last one later; one node is reset."""
    st = StateLog(spark, scratch_dir(spark, "processed_log"), inc.PROCESSED_FILE, ["node_path", "file_name"])
    micros = wall_micros(F.col("ts"))
    days = table(spark, sf_dir, "events").groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("file_name")).agg(
        F.min(micros).alias("first"), F.max(micros).alias("last")
    )
    days = days.withColumn("node_path", F.array(F.lit("load"), F.col("event_type")))
    st.upsert(days.select("node_path", "file_name", F.timestamp_micros("first").alias("last_modified_timestamp")))
    for (node,) in days.select("node_path").distinct().collect():  # a node for each event type
        st.compact(node)
    st.upsert(days.select("node_path", "file_name", F.timestamp_micros("last").alias("last_modified_timestamp")))
    inc.reset({"processed_file": st}, ["load", "click"])
    return st.read().select(F.array_join("node_path", "/").alias("node_path"), "file_name", F.unix_micros("last_modified_timestamp").alias("modified_us"))


def _copy_state(spark, sf_dir) -> inc.StateTable:
    st = inc.StateTable(spark, scratch_dir(spark, "copy_status"), inc.COPY_STATUS, ["node_path", "source_table"])
    e = table(spark, sf_dir, "events")
    rows = e.groupBy("event_type").agg(F.max("ts").alias("m")).select(
        F.array(F.lit("copy"), F.col("event_type")).alias("node_path"),
        F.concat(F.lit("db.events_"), F.col("event_type")).alias("source_table"),
        F.date_format("m", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_comparison_value"),
    )
    st.replace(rows)
    return st


@register(
    "copy_status_roundtrip",
    """SELECT 'copy/' || event_type AS node_path, 'db.events_' || event_type AS source_table,
       CASE WHEN event_type = 'view' THEN '2024-02-01 00:00:00' ELSE strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') END AS last_comparison_value
FROM events WHERE event_type <> 'signup' GROUP BY event_type""",
)
def copy_status_roundtrip(spark, sf_dir):
    """Values stored per node, one updated, one deleted, then read back."""
    st = _copy_state(spark, sf_dir)
    inc.set_last_value(st, ["copy", "view"], "db.events_view", "2024-02-01 00:00:00")
    inc.delete_last_value(st, ["copy", "signup"], "db.events_signup")
    assert inc.get_last_value(st, ["copy", "view"], "db.events_view") == "2024-02-01 00:00:00"
    return st.read().select(F.array_join("node_path", "/").alias("node_path"), "source_table", "last_comparison_value")


def _all_states(spark, sf_dir) -> dict[str, inc.StateTable]:
    from spark_elt.plans.q_files import DATE_REGEX, write_daily_csv  # noqa: F401

    pf = inc.StateTable(spark, scratch_dir(spark, "processed_file"), inc.PROCESSED_FILE, ["node_path", "file_name"])
    e = table(spark, sf_dir, "events")
    pf.replace(
        e.groupBy("event_type", F.date_format("ts", "yyyy/MM/dd").alias("d")).agg(F.max("ts").alias("m")).select(
            F.array(F.lit("load"), F.col("event_type")).alias("node_path"),
            F.concat(F.lit("events/"), F.col("d"), F.lit(".csv")).alias("file_name"),
            F.col("m").alias("last_modified_timestamp"),
        )
    )
    return {"processed files": pf, "file dependencies": _dep_state(spark, sf_dir), "incremental copy statuses": _copy_state(spark, sf_dir)}


_SUMMARY_D = """SELECT 'load/' || event_type AS node_path, 'processed files' AS kind,
       CAST(count(DISTINCT strftime(ts, '%Y/%m/%d')) AS BIGINT) AS n FROM events GROUP BY event_type
UNION SELECT 'load/' || event_type, 'file dependencies', CAST(1 AS BIGINT) FROM events GROUP BY event_type"""


@register("reset_summary", _SUMMARY_D)
def reset_summary(spark, sf_dir):
    """What a reset of ``['load']`` would delete, per node and kind."""
    s = inc.reset_summary(_all_states(spark, sf_dir), ["load"])
    return s.select(F.array_join("node_path", "/").alias("node_path"), "kind", F.col("n").cast("bigint").alias("n"))


@register(
    "reset_incremental",
    """SELECT 'copy/' || event_type AS node_path, 'incremental copy statuses' AS kind, CAST(1 AS BIGINT) AS n
FROM events GROUP BY event_type""",
)
def reset_incremental(spark, sf_dir):
    """After resetting ``['load']`` only the copy statuses remain."""
    states = _all_states(spark, sf_dir)
    inc.reset(states, ["load"])
    s = inc.reset_summary(states, [])
    return s.select(F.array_join("node_path", "/").alias("node_path"), "kind", F.col("n").cast("bigint").alias("n"))


# ---------------------------------------------------------------- copy / upsert

def _copy(spark, sf_dir, label, runs):
    target = scratch_dir(spark, f"{label}_target")
    st = inc.StateTable(spark, scratch_dir(spark, f"{label}_status"), inc.COPY_STATUS, ["node_path", "source_table"])
    staging = scratch_dir(spark, f"{label}_staging")  # one folder per node, the same in every run
    modes = [
        inc.copy_incrementally(spark, src, target, "o_orderdate", ["o_orderkey"], st, ["copy_orders"], "db.orders", staging,
                               partition_by=["o_orderstatus"])
        for src in runs
    ]
    return spark.read.schema(fx.orders_v1(spark, sf_dir).schema).parquet(target), modes


_ORD = _ORD_COLS = "o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice, o_orderdate, o_orderpriority"


def _ord(df):
    return df.select("o_orderkey", "o_custkey", "o_orderstatus", F.round("o_totalprice", 6).alias("o_totalprice"),
                     "o_orderdate", "o_orderpriority")


@register("copy_incrementally_full", with_views(["orders_v1"], f"SELECT {_ORD_COLS} FROM orders_v1"))
def copy_incrementally_full(spark, sf_dir):
    out, modes = _copy(spark, sf_dir, "copy_full", [fx.orders_v1(spark, sf_dir)])
    assert modes == ["full"], modes
    return _ord(out)


_DELTA_D = with_views(
    ["orders_v1", "orders_v2"],
    f"""SELECT {_ORD_COLS} FROM orders_v2 WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders_v1)
UNION ALL SELECT {_ORD_COLS} FROM orders_v1 WHERE o_orderdate < (SELECT max(o_orderdate) FROM orders_v1)""",
)


@register("copy_incrementally_delta", _DELTA_D)
def copy_incrementally_delta(spark, sf_dir):
    """Full load of the first snapshot, then the delta of the second one
    (rows with o_orderdate >= stored max) upserted by o_orderkey; older changes of
    the second snapshot do not arrive."""
    out, modes = _copy(spark, sf_dir, "copy_delta", [fx.orders_v1(spark, sf_dir), fx.orders_v2(spark, sf_dir)])
    assert modes == ["full", "delta"], modes
    return _ord(out)


@register("copy_incrementally_sql", _DELTA_D)
def copy_incrementally_sql(spark, sf_dir):
    """I08 from a SQL text with a placeholder for the comparison with the last value."""
    fx.orders_v1(spark, sf_dir).createOrReplaceTempView("copy_sql_orders")
    sql = inc.sql_source(spark, "SELECT * FROM copy_sql_orders WHERE @@comparison@@")
    target, staging = scratch_dir(spark, "copy_sql_target"), scratch_dir(spark, "copy_sql_staging")
    st = inc.StateTable(spark, scratch_dir(spark, "copy_sql_status"), inc.COPY_STATUS, ["node_path", "source_table"])
    modes = []
    for version in (fx.orders_v1, fx.orders_v2):
        version(spark, sf_dir).createOrReplaceTempView("copy_sql_orders")
        modes.append(inc.copy_incrementally(spark, sql, target, "o_orderdate", ["o_orderkey"], st, ["copy_orders"], "db.orders", staging))
    assert modes == ["full", "delta"], modes
    return _ord(spark.read.parquet(target))


@register(
    "copy_incrementally_dedup",
    with_views(["orders_v2"], f"SELECT {_ORD_COLS} FROM orders_v2"),
)
def copy_incrementally_dedup(spark, sf_dir):
    """I08 over a source that has both snapshots of the orders, two rows for most keys: the
    first (full) load keeps the newest per key."""
    both = fx.orders_v1(spark, sf_dir).withColumn("snapshot", F.lit(1)).unionByName(fx.orders_v2(spark, sf_dir).withColumn("snapshot", F.lit(2)))
    target, staging = scratch_dir(spark, "dedup_target"), scratch_dir(spark, "dedup_staging")
    st = inc.StateTable(spark, scratch_dir(spark, "dedup_status"), inc.COPY_STATUS, ["node_path", "source_table"])
    inc.copy_incrementally(spark, both, target, "o_orderdate", ["o_orderkey"], st, ["copy_orders"], "db.orders", staging, dedup_by="snapshot")
    return _ord(spark.read.parquet(target))


@register("copy_incrementally_empty", with_views(["orders_v1"], f"SELECT {_ORD_COLS} FROM orders_v1"))
def copy_incrementally_empty(spark, sf_dir):
    """A source without rows (max is NULL) changes nothing and succeeds."""
    empty_src = table(spark, sf_dir, "orders").where(F.col("o_orderkey") < 0)
    out, modes = _copy(spark, sf_dir, "copy_empty", [fx.orders_v1(spark, sf_dir), empty_src])
    assert modes == ["full", "empty"], modes
    return _ord(out)


_UPSERT_D = with_views(
    ["orders_v1", "orders_v2"],
    f"""SELECT {_ORD_COLS} FROM orders_v1 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_v2 WHERE o_orderkey % 7 = 0)
UNION ALL SELECT {_ORD_COLS} FROM orders_v2 WHERE o_orderkey % 7 = 0""",
)


@register("upsert_on_conflict", _UPSERT_D)
def upsert_on_conflict(spark, sf_dir):
    """The repriced orders (every seventh key) are upserted into the first snapshot."""
    target = scratch_dir(spark, "upsert_target")
    fx.orders_v1(spark, sf_dir).write.parquet(target)
    delta = fx.orders_v2(spark, sf_dir).where(F.col("o_orderkey") % 7 == 0)
    inc.upsert(spark, target, delta, ["o_orderkey"], scratch_dir(spark, "upsert_staging"))
    return _ord(spark.read.parquet(target))


@register(
    "explicit_upsert",
    with_views(
        ["orders_v1", "orders_v2"],
        f"""SELECT {_ORD_COLS} FROM orders_v1 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_v2 WHERE o_orderkey % 7 = 0)
UNION ALL SELECT {_ORD_COLS} FROM orders_v2 WHERE o_orderkey % 7 = 0
UNION ALL SELECT NULL AS o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6), o_orderdate, o_orderpriority
          FROM orders WHERE o_orderstatus = 'P'""",
    ),
)
def explicit_upsert(spark, sf_dir):
    """UPDATE matched keys then INSERT the rest; rows with a NULL key (here the
    pending orders, sent without key) never match and are inserted."""
    target = scratch_dir(spark, "explicit_target")
    fx.orders_v1(spark, sf_dir).write.parquet(target)
    delta = fx.orders_v2(spark, sf_dir).where(F.col("o_orderkey") % 7 == 0).unionByName(
        table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P").withColumn("o_orderkey", F.lit(None).cast("bigint"))
    )
    inc.upsert(spark, target, delta, ["o_orderkey"], scratch_dir(spark, "explicit_staging"), explicit=True)
    return _ord(spark.read.parquet(target))


@register(
    "delta_latest_per_key",
    with_views(
        ["orders_v1", "orders_v2"],
        f"""SELECT {_ORD_COLS}, version FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) AS rn FROM (
    SELECT *, 1 AS version FROM orders_v1 UNION ALL SELECT *, 2 AS version FROM orders_v2 WHERE o_orderkey % 7 = 0) u) t
WHERE rn = 1""",
    ),
)
def delta_latest_per_key(spark, sf_dir):
    both = fx.orders_v1(spark, sf_dir).withColumn("version", F.lit(1)).unionByName(
        fx.orders_v2(spark, sf_dir).where(F.col("o_orderkey") % 7 == 0).withColumn("version", F.lit(2))
    )
    newest = inc.latest_per_key(both, ["o_orderkey"], "version")
    return newest.select(*_ord(newest).columns, "version").withColumn("o_totalprice", F.round("o_totalprice", 6))


@register("max_modification_value", "SELECT max(o_orderdate) AS maxval FROM orders")
def max_modification_value(spark, sf_dir):
    return inc.max_value(table(spark, sf_dir, "orders"), "o_orderdate")


@register(
    "is_target_empty",
    "SELECT 'orders' AS tbl, count(*) = 0 AS is_empty FROM (SELECT 1 FROM orders LIMIT 1) a "
    "UNION ALL SELECT 'orders_future', count(*) = 0 FROM (SELECT 1 FROM orders WHERE o_orderdate > TIMESTAMP '2100-01-01' LIMIT 1) b",
)
def is_target_empty(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return inc.is_empty_frame(o).select(F.lit("orders").alias("tbl"), "is_empty").unionByName(
        inc.is_empty_frame(o.where(F.col("o_orderdate") > F.lit("2100-01-01").cast("timestamp_ntz"))).select(
            F.lit("orders_future").alias("tbl"), "is_empty")
    )


@register("run_if_changed", f"SELECT {_ORD_COLS} FROM orders")
def run_if_changed(spark, sf_dir):
    """Q04: the load runs once; the second call sees the same dependency hash and
    skips, so the appended target holds the orders once."""
    target = scratch_dir(spark, "run_if_changed")
    deps = inc.StateTable(spark, scratch_dir(spark, "deps"), inc.FILE_DEPENDENCY, ["node_path", "dependency_type"])
    h = "2000-01-01 None " + "1" * 32
    load = lambda: table(spark, sf_dir, "orders").write.mode("append").parquet(target)
    ran1, _ = inc.run_if_changed(deps, ["load_orders"], "ExecuteSQL", h, load, T0)
    ran2, _ = inc.run_if_changed(deps, ["load_orders"], "ExecuteSQL", h, load, T0)
    assert (ran1, ran2) == (True, False)
    return _ord(spark.read.parquet(target))
