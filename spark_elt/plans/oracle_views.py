"""DuckDB text of the derived views (FIXTURES.md §3), used to write the oracle SQL of
each registered query. ``with_views(["node_run"], body)`` prefixes ``body`` with the
CTEs it needs (dependencies are added automatically)."""

from __future__ import annotations

VIEWS: dict[str, tuple[list[str], str]] = {
    "base": ([], "SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"),
    "nr0": (
        ["base"],
        """SELECT event_id AS node_run_id, user_id * 1000 + row_number() OVER (PARTITION BY user_id, path ORDER BY event_id) AS run_id,
       ts AS start_time, path AS node_path,
       CASE WHEN event_id % 97 <> 0 THEN ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) END AS end_time,
       CASE WHEN event_id % 97 <> 0 THEN k % 10 <> 0 END AS succeeded,
       (event_id % 50 = 0 OR event_id % 5 = 1) AS is_pipeline,
       k, event_type, props
FROM (SELECT *, CASE WHEN event_id % 50 = 0 THEN CAST([] AS VARCHAR[])
                     WHEN event_id % 5 = 1 THEN [event_type]
                     ELSE [event_type, 'task_' || CAST(k % 12 AS VARCHAR)] END AS path FROM base) p""",
    ),
    "node_run": (
        ["nr0"],
        "SELECT node_run_id, run_id, node_path, start_time, end_time, succeeded, is_pipeline FROM nr0",
    ),
    "run": (
        ["node_run"],
        """SELECT run_id, CAST([] AS VARCHAR[]) AS node_path, min(start_time) AS start_time,
       CASE WHEN run_id % 10 <> 3 THEN max(coalesce(end_time, start_time)) END AS end_time,
       CASE WHEN run_id % 10 <> 3 THEN count(*) FILTER (succeeded = FALSE) = 0 END AS succeeded
FROM node_run GROUP BY run_id""",
    ),
    "node_output": (
        ["nr0"],
        """SELECT node_run_id * 10 + j AS node_output_id, node_run_id, start_time + to_seconds(j) AS "timestamp",
       event_type || ' ' || props || '  ' || CASE WHEN j = 2 THEN chr(10) ELSE '' END AS message,
       CASE (node_run_id + j // 2) % 3 WHEN 0 THEN 'standard' WHEN 1 THEN 'verbatim' ELSE 'italics' END AS format,
       (k + j) % 4 = 0 AS is_error
FROM (SELECT *, unnest(generate_series(0, k % 5)) AS j FROM nr0) l""",
    ),
    "system_statistics": (
        ["base"],
        """SELECT ts AS "timestamp", CASE WHEN event_id % 10 = 0 THEN -1 ELSE user_id * 1000 + 1 END AS run_id,
       CAST(k AS DOUBLE) AS disc_read, CAST(k AS DOUBLE) * 2 AS disc_write, CAST(k % 10 AS DOUBLE) AS net_recv,
       CAST(NULL AS DOUBLE) AS net_sent, value AS cpu_usage, CAST(k AS DOUBLE) AS mem_usage,
       CAST(NULL AS DOUBLE) AS swap_usage, CAST(NULL AS DOUBLE) AS iowait
FROM base""",
    ),
    "counter_samples": (
        [],
        """SELECT user_id AS run_id, ts, event_id,
       sum(CAST(round(value * 1000) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS read_bytes
FROM events""",
    ),
    "dag_node": ([], "SELECT p_partkey AS node, CAST(p_size AS DOUBLE) AS cost FROM part WHERE p_partkey > 0"),
    "edge": (
        [],
        """SELECT a.p_partkey AS u, b.p_partkey AS v FROM part a JOIN part b
  ON b.p_partkey IN (2 * a.p_partkey, 3 * a.p_partkey, 6 * a.p_partkey) WHERE a.p_partkey > 0""",
    ),
    "orders_v1": ([], "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'"),
    "orders_v2": (
        [],
        """SELECT * REPLACE (CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice * 1.1 ELSE o_totalprice END AS o_totalprice)
FROM orders""",
    ),
}


def _order(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in VIEWS[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(names: list[str], body: str, extra: list[tuple[str, str]] = ()) -> str:
    """``WITH <views…>, <extra…> <body>``."""
    parts = [f"{n} AS (\n{VIEWS[n][1]}\n)" for n in _order(names)] + [f"{n} AS (\n{sql}\n)" for n, sql in extra]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body
