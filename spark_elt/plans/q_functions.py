"""Registered scalar-function queries (F01–F19) and run-log folds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from spark_elt import functions as sf
from spark_elt.operators import runlog as rl
from spark_elt.operators.run_tables import RunTables
from spark_elt.plans import fixtures as fx
from spark_elt.plans.oracle_views import with_views
from spark_elt.plans.q_runlog import _format_duration_d
from spark_elt.plans.registry import register
from spark_elt.session import scratch_dir, table


@register(
    "format_duration",
    f"""SELECT event_id, value, {_format_duration_d('value')} AS short, {_format_duration_d('value * 60')} AS medium,
       {_format_duration_d('value * 3600')} AS long FROM events""",
)
def format_duration(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", "value",
        sf.format_duration(F.col("value")).alias("short"),
        sf.format_duration(F.col("value") * 60).alias("medium"),
        sf.format_duration(F.col("value") * 3600).alias("long"),
    )


def _fmt_ms_d(x: str) -> str:
    h = f"({x}) // 3600000"
    r1 = f"(({x}) - 3600000 * ({h}))"
    m = f"({r1} // 60000)"
    r2 = f"({r1} - 60000 * {m})"
    s = f"({r2} // 1000)"
    ms = f"({r2} - 1000 * {s})"
    t = f"({s} * 10 + CAST(floor({ms} / 100 + 0.5) AS BIGINT))"
    return (
        f"CASE WHEN ({x}) IS NULL THEN NULL "
        f"WHEN {h} <> 0 THEN CAST({h} AS VARCHAR) || ':' || lpad(CAST({m} AS VARCHAR), 2, '0') || 'h' "
        f"WHEN {m} <> 0 THEN CAST({m} AS VARCHAR) || ':' || lpad(CAST({s} AS VARCHAR), 2, '0') || 'm' "
        f"WHEN {s} <> 0 THEN CAST({t} // 10 AS VARCHAR) || '.' || CAST({t} % 10 AS VARCHAR) || 's' "
        f"ELSE CAST({ms} AS VARCHAR) || 'ms' END"
    )


@register(
    "format_duration_ms",
    f"""SELECT event_id, {_fmt_ms_d('CAST(round(value * 1000) AS BIGINT)')} AS a,
       {_fmt_ms_d('CAST(round(value * 100000) AS BIGINT)')} AS b,
       {_fmt_ms_d('CAST(round(value * 10) AS BIGINT)')} AS c FROM events""",
)
def format_duration_ms(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    ms = lambda f: F.round(F.col("value") * f).cast("bigint")
    return e.select(
        "event_id",
        sf.format_duration_ms(ms(1000)).alias("a"),
        sf.format_duration_ms(ms(100000)).alias("b"),
        sf.format_duration_ms(ms(10)).alias("c"),
    )


def _time_diff_d(a: str, b: str) -> str:
    m0 = f"((year({b}) - year({a})) * 12 + (month({b}) - month({a})))"
    mo = f"(CASE WHEN {a} + to_months({m0}) > {b} THEN {m0} - 1 ELSE {m0} END)"
    secs = f"(date_diff('microsecond', {a} + to_months({mo}), {b}) // 1000000)"
    parts = [
        (f"{mo} // 12", "years"), (f"{mo} % 12", "months"), (f"{secs} // 86400", "days"),
        (f"({secs} % 86400) // 3600", "hours"), (f"({secs} % 3600) // 60", "minutes"),
    ]
    items = [f"CASE WHEN ({v}) <> 0 THEN CAST({v} AS VARCHAR) || ' {u}' END" for v, u in parts]
    items.append(f"CAST({secs} % 60 AS VARCHAR) || ' seconds'")
    return f"concat_ws(', ', {', '.join(items)})"


@register(
    "format_time_difference",
    f"""SELECT o_orderkey, {_time_diff_d('o_orderdate', "TIMESTAMP '2001-09-30 12:34:56.5'")} AS since_order,
       {_time_diff_d('o_orderdate', "o_orderdate + INTERVAL (o_orderkey % 1000) HOUR + INTERVAL (o_orderkey % 61) SECOND")} AS short_gap
FROM orders""",
)
def format_time_difference(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    later = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 1000).cast("int"), F.lit(0),
                                                       (F.col("o_orderkey") % 61).cast("decimal(18,6)"))
    return o.select(
        "o_orderkey",
        sf.format_time_difference("o_orderdate", F.lit("2001-09-30 12:34:56.5").cast("timestamp_ntz")).alias("since_order"),
        sf.format_time_difference(F.col("o_orderdate"), later).alias("short_gap"),
    )


MASKS = ["purchase", '"k": 1', "9}"]


@register(
    "mask_secrets",
    with_views(["node_output"], """SELECT node_output_id,
  replace(replace(replace(message, 'purchase', '***'), '"k": 1', '***'), '9}', '***') AS message FROM node_output"""),
)
def mask_secrets(spark, sf_dir):
    o = fx.node_output(spark, sf_dir)
    return o.select("node_output_id", sf.mask_secrets("message", MASKS).alias("message"))


@register(
    "clean_log_lines",
    """SELECT event_id, message FROM (
  SELECT event_id, regexp_replace(CASE WHEN event_id % 4 = 0 THEN '   ' || chr(9) ELSE event_type || ' ' || props || '  ' || chr(10) END,
                                  '\\s+$', '') AS message FROM events) t
WHERE length(message) > 0""",
)
def clean_log_lines(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    raw = F.when(F.col("event_id") % 4 == 0, F.lit("   \t")).otherwise(
        F.concat(F.col("event_type"), F.lit(" "), F.col("props"), F.lit("  \n"))
    )
    return e.select("event_id", sf.clean_message(raw).alias("message")).where(F.length("message") > 0)


@register(
    "sanitize_ids",
    """SELECT c_custkey, regexp_replace(replace(lower(c_name), '-', '_'), '[^0-9a-z\\-_]+', '', 'g') || '_' ||
       regexp_replace(replace(lower(c_mktsegment), '-', '_'), '[^0-9a-z\\-_]+', '', 'g') AS task_id FROM customer""",
)
def sanitize_ids(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", F.concat_ws("_", sf.sanitize_id("c_name"), sf.sanitize_id("c_mktsegment")).alias("task_id"))


@register(
    "validate_ids",
    """SELECT p_partkey, lower(p_type) AS node_id, regexp_full_match(lower(p_type), '[a-z0-9_]+') AS is_valid,
       regexp_full_match(replace(lower(p_type), ' ', '_'), '[a-z0-9_]+') AS is_valid_fixed FROM part""",
)
def validate_ids(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    node_id = F.lower("p_type")
    return p.select(
        "p_partkey",
        node_id.alias("node_id"),
        node_id.rlike("^[a-z0-9_]+$").alias("is_valid"),
        F.replace(node_id, F.lit(" "), F.lit("_")).rlike("^[a-z0-9_]+$").alias("is_valid_fixed"),
    )


@register(
    "node_names",
    with_views(["node_run"], """SELECT node_run_id, coalesce(node_path[-1], 'root') AS node_name,
       CAST(len(node_path) AS BIGINT) AS depth, array_to_string(node_path[1:1], '/') AS top FROM node_run"""),
)
def node_names(spark, sf_dir):
    nr = fx.node_run(spark, sf_dir)
    return nr.select(
        "node_run_id", sf.last_name("node_path").alias("node_name"), F.size("node_path").cast("bigint").alias("depth"),
        F.array_join(F.slice("node_path", 1, 1), "/").alias("top"),
    )


@register(
    "events_to_json",
    """SELECT event_id, '{"event_id":' || event_id || ',"ts":"' ||
       CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END
       || '","event_type":"' || event_type || '","value":' || CAST(value AS VARCHAR) || '}' AS json FROM events""",
)
def events_to_json(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        F.to_json(F.struct("event_id", sf.iso_timestamp("ts").alias("ts"), "event_type", "value")).alias("json"),
    )


_TS_JSON_D = "coalesce('\"' || strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') || '\"', 'null')"


@register(
    "run_data_json",
    with_views(["node_run"], """SELECT node_run_id, '{"node_run_id":' || node_run_id || ',"run_id":' || run_id
       || ',"node_path":' || CAST(to_json(node_path) AS VARCHAR)
       || ',"start_time":' || """ + _TS_JSON_D.format(c="start_time") + """
       || ',"end_time":' || """ + _TS_JSON_D.format(c="end_time") + """
       || ',"succeeded":' || coalesce(CAST(succeeded AS VARCHAR), 'null')
       || ',"is_pipeline":' || CAST(is_pipeline AS VARCHAR) || '}' AS json
FROM node_run"""),
)
def run_data_json(spark, sf_dir):
    """whole node-run rows as JSON text (``row_to_json``), NULL fields kept."""
    nr = fx.node_run(spark, sf_dir)
    opts = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}
    return nr.select("node_run_id", F.to_json(F.struct(*nr.columns), opts).alias("json"))


# ---------------------------------------------------------------- folds I14–I19

@register("fold_runs", with_views(["run"], "SELECT run_id, start_time, end_time, succeeded FROM run"))
def fold_runs(spark, sf_dir):
    return rl.fold_runs(fx.run_events(spark, sf_dir))


@register(
    "fold_node_runs",
    with_views(["node_run"], """SELECT node_run_id, run_id, array_to_string(node_path, '/') AS node_path, start_time,
       end_time, succeeded, is_pipeline FROM node_run"""),
)
def fold_node_runs(spark, sf_dir):
    return rl.fold_node_runs(fx.run_events(spark, sf_dir)).withColumn("node_path", F.array_join("node_path", "/"))


@register(
    "fold_node_output",
    with_views(["node_run", "node_output"], """SELECT o.* FROM node_output o JOIN node_run n USING (node_run_id)
WHERE n.end_time IS NOT NULL"""),
)
def fold_node_output(spark, sf_dir):
    ev = fx.run_events(spark, sf_dir)
    return rl.fold_node_output(ev, rl.fold_node_runs(ev))


NOW = dt.datetime(2024, 1, 31, 0, 0, 0)


@register(
    "close_open_runs",
    with_views(["node_run"], """SELECT node_run_id, run_id,
       CASE WHEN run_id = 7001 AND end_time IS NULL THEN TIMESTAMP '2024-01-31 00:00:00' ELSE end_time END AS end_time,
       CASE WHEN run_id = 7001 AND end_time IS NULL THEN FALSE ELSE succeeded END AS succeeded FROM node_run"""),
)
def close_open_runs(spark, sf_dir):
    nr = fx.node_run(spark, sf_dir)
    return rl.close_open_runs(nr, 7001, NOW).select("node_run_id", "run_id", "end_time", "succeeded")


_OLD_D = "coalesce({t} + INTERVAL 20 DAY < TIMESTAMP '2024-01-31 00:00:00', FALSE)"


_RETENTION_D = with_views(["node_run", "node_output", "run", "system_statistics"], f"""SELECT 'run' AS tbl, run_id AS id, start_time AS t FROM kept
UNION ALL SELECT 'node_run', node_run_id, start_time FROM node_run WHERE run_id IN (SELECT run_id FROM kept)
UNION ALL SELECT 'node_output', node_output_id, "timestamp" FROM node_output
  WHERE node_run_id IN (SELECT node_run_id FROM node_run JOIN kept USING (run_id))
UNION ALL SELECT 'system_statistics', run_id, seen FROM (
  SELECT run_id, CASE WHEN disc_read <> 7 THEN "timestamp" END AS seen FROM system_statistics) s WHERE NOT {_OLD_D.format(t="seen")}""",
               extra=[("kept", f"""SELECT * FROM (SELECT run_id, CASE WHEN run_id % 11 <> 5 THEN start_time END AS start_time FROM run) r
WHERE NOT {_OLD_D.format(t="start_time")}""")])


@register("retention_prune", _RETENTION_D)
def retention_prune(spark, sf_dir):
    """I19 with a 20-day retention at 2024-01-31: the rows kept in the four tables. Some
    runs and samples have no time and stay."""
    return _kept_rows(*rl.retention_prune(*_run_log(spark, sf_dir), 20, NOW))


@register("retention_stored", _RETENTION_D)
def retention_stored(spark, sf_dir):
    """I19 on stored tables: old days leave the manifest of the four tables, the day of the
    limit is rewritten; the rows come in two parts, by run."""
    tables = RunTables(spark, scratch_dir(spark, "run_tables"))
    run, nr, out, stats = _run_log(spark, sf_dir)
    of = nr.select("node_run_id", (F.col("run_id") % 2).alias("part"))
    for part in (0, 1):
        tables.append(
            run.where(F.col("run_id") % 2 == part), nr.where(F.col("run_id") % 2 == part),
            out.join(of, "node_run_id").where(F.col("part") == part).drop("part"), stats.where(F.pmod("run_id", F.lit(2)) == part),
        )
    tables.prune(20, NOW)
    return _kept_rows(*tables.read())


def _run_log(spark, sf_dir):
    nr = fx.node_run(spark, sf_dir)
    run = fx.run(spark, sf_dir).withColumn("start_time", F.when(F.col("run_id") % 11 != 5, F.col("start_time")))
    stats = fx.system_statistics(spark, sf_dir).withColumn("timestamp", F.when(F.col("disc_read") != 7, F.col("timestamp")))
    return run, nr, fx.node_output(spark, sf_dir), stats


def _kept_rows(r, n, o, s):
    rows = lambda df, name, key, t: df.select(F.lit(name).alias("tbl"), F.col(key).alias("id"), F.col(t).alias("t"))
    return (
        rows(r, "run", "run_id", "start_time").union(rows(n, "node_run", "node_run_id", "start_time"))
        .union(rows(o, "node_output", "node_output_id", "timestamp")).union(rows(s, "system_statistics", "run_id", "timestamp"))
    )


_DIGEST_D = with_views(["node_run", "node_output"], r""", failed AS (
  SELECT node_run_id, array_to_string(node_path, '/') AS path FROM node_run WHERE succeeded = FALSE AND NOT is_pipeline),
ev AS (
  SELECT o.node_run_id, o.is_error, o.message, o.format,
         row_number() OVER w AS i, lag(o.format) OVER w AS prev_f, lead(o.format) OVER w AS next_f
  FROM node_output o WHERE o.node_run_id IN (SELECT node_run_id FROM failed)
  WINDOW w AS (PARTITION BY o.node_run_id, o.is_error ORDER BY o."timestamp", o.node_output_id)),
ev2 AS (SELECT *, max(CASE WHEN format = 'standard' THEN i END) OVER (PARTITION BY node_run_id, is_error) AS last_std FROM ev),
pieces AS (
  SELECT node_run_id, is_error, i,
         CASE format
           WHEN 'verbatim' THEN (CASE WHEN prev_f = 'verbatim' THEN chr(10) ELSE chr(10) || '<pre>' END) || message
                                || (CASE WHEN next_f = 'verbatim' THEN '' ELSE '</pre>' END)
           WHEN 'italics' THEN CASE WHEN message = '' THEN '' ELSE array_to_string(list_transform(
                 string_split_regex(regexp_replace(message, '(\r\n|[\n\r\x0B\f\x1C\x1D\x1E\x{85}\x{2028}\x{2029}])$', ''),
                                    '\r\n|[\n\r\x0B\f\x1C\x1D\x1E\x{85}\x{2028}\x{2029}]'),
                 lambda l: chr(10) || chr(10) || replace(l, '_', '\_')), '') END
           ELSE chr(10) || message END AS piece
  FROM ev2 WHERE last_std IS NULL OR i >= last_std),
body AS (SELECT node_run_id, string_agg(piece, '' ORDER BY is_error, i) AS txt FROM pieces GROUP BY node_run_id),
msg AS (
  SELECT f.node_run_id, '<font size="4">&#x1F424;</font> Ooops, a hiccup in [_' || replace(f.path, '_', '\_') || '_](/'
         || f.path || ')' || coalesce(b.txt, '') AS t
  FROM failed f LEFT JOIN body b USING (node_run_id))
SELECT node_run_id, CASE WHEN length(t) > 2000 THEN substr(t, 1, 2000) || '</pre>' ELSE t END AS message FROM msg""").replace(
    "\n, failed AS", ",\nfailed AS")


@register("failure_digest", _DIGEST_D)
def failure_digest(spark, sf_dir):
    """One chat message per failed task: the sequential message fold expressed
    with lag/lead and the position of the last standard line."""
    nr = fx.node_run(spark, sf_dir)
    return rl.failure_digest(nr, fx.node_output(spark, sf_dir))
