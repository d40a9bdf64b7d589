"""Run-log maintenance: folding event streams into run tables (I14–I16), closing
open runs (I18), retention (I19), counter rates (W04), output grouping (A12) and the
failure digest (G08)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spark_elt.functions.durations import epoch_seconds
from spark_elt.operators.ordered import ordered_scan

MIB = 1024 * 1024


def _ntz(t: dt.datetime) -> Column:
    """A wall-clock literal (from text, so no time zone is applied)."""
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def counter_rates(df: DataFrame, partition: Sequence[str], ts: str, cols: Sequence[str], tie: str | None = None) -> DataFrame:
    """Turn cumulative byte counters into MiB per second since the previous sample
    of the same partition (W04). The first sample of a partition has NULL rates.

    The previous sample comes from one ordered scan (range partitioning, see
    ``ordered``), so a run with a very large number of samples is not one task."""
    out = ordered_scan(df, partition, [ts, *([tie] if tie else [])], lag=[ts, *cols])
    elapsed = epoch_seconds(F.col(f"lag_{ts}"), F.col(ts))
    for c in cols:
        out = out.withColumn(f"{c}_rate", (F.col(c) - F.col(f"lag_{c}")) / F.lit(float(MIB)) / elapsed)
    return out.drop("_idx", *[f"lag_{c}" for c in [ts, *cols]])


def output_by_error(node_output: DataFrame) -> DataFrame:
    """Output lines per node run and error flag (A12): count, first and last message
    by time. All three are partial aggregates (map-side combine), so a node with a
    very large output is never gathered in one place."""
    key = F.struct("timestamp", "node_output_id", "message")
    return node_output.groupBy("node_run_id", "is_error").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.min(key)["message"].alias("first_message"),
        F.max(key)["message"].alias("last_message"),
    )


# ------------------------------------------------------------------ folds

def fold_runs(run_events: DataFrame) -> DataFrame:
    """``run`` rows from RunStarted and RunFinished events (I14); a run that has not
    finished keeps a NULL end and status, whatever its nodes did."""
    ev = F.col("event")
    fin = F.struct("ts", "succeeded")
    return (
        run_events.where(ev.isin("RunStarted", "RunFinished"))
        .groupBy("run_id")
        .agg(F.min(F.when(ev == "RunStarted", F.col("ts"))).alias("start_time"), F.max(F.when(ev == "RunFinished", fin)).alias("fin"))
        .select("run_id", "start_time", F.col("fin.ts").alias("end_time"), F.col("fin.succeeded").alias("succeeded"))
    )


def fold_node_runs(run_events: DataFrame) -> DataFrame:
    """``node_run`` rows from NodeStarted / NodeFinished events keyed by
    (run_id, node_path) (I15); unfinished nodes keep NULL end and status."""
    ev = F.col("event")
    fin = F.struct(F.col("ts"), F.col("succeeded"))
    return (
        run_events.where(ev.isin("NodeStarted", "NodeFinished"))
        .groupBy("run_id", "node_path")
        .agg(
            F.min(F.when(ev == "NodeStarted", F.col("seq"))).alias("node_run_id"),
            F.min(F.when(ev == "NodeStarted", F.col("ts"))).alias("start_time"),
            F.max(F.when(ev == "NodeFinished", fin)).alias("fin"),
            F.max(F.when(ev == "NodeStarted", F.col("is_pipeline"))).alias("is_pipeline"),
        )
        .select("node_run_id", "run_id", "node_path", "start_time", F.col("fin.ts").alias("end_time"),
                F.col("fin.succeeded").alias("succeeded"), "is_pipeline")
    )


def fold_node_output(run_events: DataFrame, node_runs: DataFrame) -> DataFrame:
    """Output events stored against the node run when it finishes (I16): output of a
    node that never finished is not stored; a finish with no output adds nothing."""
    out = run_events.where(F.col("event") == "Output").select(
        "run_id", "node_path", F.col("seq").alias("node_output_id"), F.col("ts").alias("timestamp"), "message",
        "format", "is_error",
    )
    finished = node_runs.where(F.col("end_time").isNotNull()).select("run_id", "node_path", "node_run_id")
    return out.join(finished, ["run_id", "node_path"]).select(
        "node_output_id", "node_run_id", "timestamp", "message", "format", "is_error"
    )


def close_open_runs(df: DataFrame, run_id: int, now: dt.datetime) -> DataFrame:
    """Rows of ``run_id`` that have no end are closed as failed at ``now``."""
    hit = (F.col("run_id") == run_id) & F.col("end_time").isNull()
    now_c = _ntz(now)
    return df.withColumn("succeeded", F.when(hit, F.lit(False)).otherwise(F.col("succeeded"))).withColumn(
        "end_time", F.when(hit, now_c).otherwise(F.col("end_time"))
    )


def retention_prune(run: DataFrame, node_run: DataFrame, node_output: DataFrame, stats: DataFrame,
                    days: int, now: dt.datetime) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Drop runs that started more than ``days`` days before ``now`` (strict), with
    their node runs and output; statistics by their own timestamp (I19). Rows without a time
    are never too old. Returns the four kept tables; the cascade is a chain of anti/semi
    joins."""
    now_c = _ntz(now)
    too_old = lambda c: F.coalesce(F.col(c) + F.make_dt_interval(F.lit(days)) < now_c, F.lit(False))
    old = too_old("start_time")
    old_runs = run.where(old).select("run_id")
    kept_run = run.where(~old)
    kept_nr = node_run.join(old_runs, "run_id", "left_anti")
    old_nr = node_run.join(old_runs, "run_id", "left_semi").select("node_run_id")
    kept_out = node_output.join(old_nr, "node_run_id", "left_anti")
    kept_stats = stats.where(~too_old("timestamp"))
    return kept_run, kept_nr, kept_out, kept_stats


# ------------------------------------------------------------------ failure digest

# Message markup of the chat digest (Teams form).
PRE_OPEN = "<pre>"
PRE_CLOSE = "</pre>"
DIGEST_LIMIT = 2000
HEADER = '<font size="4">&#x1F424;</font> Ooops, a hiccup in [_'
LINE_BREAKS = r"\r\n|[\n\r\x0B\f\x1C\x1D\x1E\x85\u2028\u2029]"  # Python str.splitlines()


def _digest_part(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Digest text of one (node, is_error) output list, re-expressed set-wise.

    The sequential rules are: a verbatim line after a verbatim line joins the same
    ``<pre>`` block; italics lines are added one by one; a standard line replaces
    everything written so far. So only events from the last standard line on count,
    and each event's piece depends on its neighbours' formats (lag/lead)."""
    ev = ordered_scan(events, keys, ["timestamp", "node_output_id"], index_col="_i", lag=["format"], lead=["format"])
    ev = ev.withColumnsRenamed({"lag_format": "_prev", "lead_format": "_next"})
    last_std = ev.where(F.col("format") == "standard").groupBy(*keys).agg(F.max("_i").alias("_last_std"))
    ev = ev.join(last_std, list(keys), "left")
    ev = ev.where(F.col("_last_std").isNull() | (F.col("_i") >= F.col("_last_std")))
    msg = F.col("message")
    # a break at the end ends the last line and starts no other
    split = F.split(msg, LINE_BREAKS, -1)
    lines = F.when(F.element_at(split, -1) == "", F.slice(split, 1, F.size(split) - 1)).otherwise(split)
    italics = F.when(msg == "", F.lit("")).otherwise(
        F.array_join(
            F.transform(lines, lambda ln: F.concat(F.lit("\n\n"), F.replace(ln, F.lit("_"), F.lit("\\_")))),
            "",
        )
    )
    verbatim = F.concat(
        F.when(F.col("_prev") == "verbatim", F.lit("\n")).otherwise(F.lit("\n" + PRE_OPEN)),
        msg,
        F.when(F.col("_next") == "verbatim", F.lit("")).otherwise(F.lit(PRE_CLOSE)),
    )
    piece = (
        F.when(F.col("format") == "verbatim", verbatim)
        .when(F.col("format") == "italics", italics)
        .otherwise(F.concat(F.lit("\n"), msg))
    )
    return ev.select(*keys, "_i", piece.alias("piece"))


def failure_digest(node_run: DataFrame, node_output: DataFrame, limit: int = DIGEST_LIMIT, base_url: str = "") -> DataFrame:
    """Message per failed task (not pipeline): header, normal output, error output,
    cut to ``limit`` characters plus ``</pre>`` (G08, F19).

    Only pieces that start inside the first ``limit`` characters are gathered, so
    the per-node collect is bounded by ``limit`` whatever the output size."""
    failed = node_run.where((F.col("succeeded") == F.lit(False)) & ~F.col("is_pipeline")).select(
        "node_run_id", "node_path"
    )
    out = node_output.join(failed.select("node_run_id"), "node_run_id", "left_semi")
    parts = _digest_part(out, ["node_run_id", "is_error"])
    path_txt = F.array_join("node_path", "/")
    header = failed.select(
        "node_run_id",
        F.lit(-1).alias("grp"),
        F.lit(0).alias("_i"),
        F.concat(F.lit(HEADER), F.replace(path_txt, F.lit("_"), F.lit("\\_")), F.lit("_]("), F.lit(base_url), F.lit("/"),
                 path_txt, F.lit(")")).alias("piece"),
    )
    body = parts.select(
        "node_run_id", F.when(F.col("is_error"), F.lit(1)).otherwise(F.lit(0)).alias("grp"), "_i", "piece"
    )
    allp = header.unionByName(body).where(F.length("piece") > 0).withColumn("_len", F.length("piece"))
    # start offset of each piece = running length before it
    allp = ordered_scan(allp, ["node_run_id"], ["grp", "_i"], sums=["_len"], index_col="_k")
    allp = allp.withColumn("_start", F.col("_len_cum") - F.col("_len"))
    kept = allp.where(F.col("_start") < limit)
    text = kept.groupBy("node_run_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("grp", "_i", "piece"))), lambda x: x["piece"]), "")
        .alias("text")
    )
    cut = F.when(F.length("text") > limit, F.concat(F.substring("text", 1, limit), F.lit(PRE_CLOSE))).otherwise(F.col("text"))
    return text.select("node_run_id", cut.alias("message"))
