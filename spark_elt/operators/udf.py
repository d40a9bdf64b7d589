"""Python function steps.

* ``apply_function``: a ``DataFrame -> DataFrame`` step (``df.transform``); a falsy
  result is a failure, as a Python task returning False fails.
* ``parallel_run_function``: one call of a Python function per parameter row,
  distributed with ``mapInPandas`` (each task handles a batch of parameters).
* ``parallel_execute_python``: the same for parameter tuples passed as positional
  arguments; the function may return several rows per call.

The parameter lists are rows of a DataFrame, so they are split over tasks; a single
call never sees more than its own parameters."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame

from spark_elt.session import ship_code


def apply_function(df: DataFrame, fn: Callable[..., DataFrame | None], *args, **kwargs) -> DataFrame:
    out = df.transform(fn, *args, **kwargs)
    if out is None or out is False:
        raise RuntimeError(f"function {getattr(fn, '__name__', fn)!r} failed")
    return out


def task_name(parameter) -> str:
    """Task id of a single parameter: lower case, blanks and ``-`` to ``_``."""
    return str(parameter).lower().replace(" ", "_").replace("-", "_")


def parallel_run_function(params: DataFrame, fn: Callable[[object], Iterable[tuple] | object], param_col: str,
                          schema: str) -> DataFrame:
    """Call ``fn(parameter)`` for every row of ``params``; ``fn`` returns a tuple or a
    list of tuples matching ``schema`` (its first field receives the parameter)."""
    ship_code(params.sparkSession)
    names = [f.strip().split(" ")[0] for f in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for p in pdf[param_col]:
                r = fn(p)
                if r is None or r is False:
                    raise RuntimeError(f"function failed for parameter {p!r}")
                rows.extend(r if isinstance(r, list) else [r])
            yield pd.DataFrame(rows, columns=names)

    return params.select(param_col).mapInPandas(run, schema)


def parallel_execute_python(params: DataFrame, fn: Callable[..., Iterable[tuple]], arg_cols: Sequence[str],
                            schema: str) -> DataFrame:
    """Call ``fn(*tuple)`` for each parameter tuple (columns ``arg_cols``); the rows it
    yields form the result, tagged with the task id of the tuple."""
    ship_code(params.sparkSession)
    names = [f.strip().split(" ")[0] for f in schema.split(",")]
    from spark_elt.operators.sql import task_id

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for tup in pdf[list(arg_cols)].itertuples(index=False, name=None):
                for r in fn(*tup):
                    rows.append((task_id(tup),) + tuple(r))
            yield pd.DataFrame(rows, columns=["task_id"] + names)

    return params.select(*arg_cols).mapInPandas(run, "task_id string, " + schema)

