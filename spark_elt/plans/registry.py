"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame`` and,
where the semantics are plain SQL, the DuckDB text that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"query {key!r} registered twice")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return deco


def load_all() -> None:
    """Import every query module so that its ``register`` calls run."""
    from spark_elt.plans import (  # noqa: F401
        q_dag,
        q_files,
        q_functions,
        q_incremental,
        q_runlog,
        q_sql,
        q_streaming,
        q_udf,
    )
