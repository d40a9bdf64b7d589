"""Rows printed by a generator function (S09, re-aimed script output).

The reference loads whatever lines a script prints. Here the "script" is a Python
function called once per input row (``mapInPandas``, vectorised over batches); the
lines it yields are parsed with ``from_csv`` like a file load: a malformed line
fails, blank lines are skipped, and duplicate lines are dropped with ``make_unique``."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_elt.session import ship_code


def read_generator(inputs: DataFrame, fn: Callable[[dict], Iterable[str]], schema: str, *, sep: str = ",",
                   make_unique: bool = False, null_value: str | None = None) -> DataFrame:
    ship_code(inputs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            lines: list[str] = []
            for rec in pdf.to_dict("records"):
                lines.extend(fn(rec))
            yield pd.DataFrame({"value": lines})

    lines = inputs.mapInPandas(run, "value string")
    if make_unique:
        lines = lines.dropDuplicates(["value"])
    opts = {"sep": sep, "mode": "FAILFAST"}
    if null_value is not None:
        opts["nullValue"] = null_value
    return lines.where("value <> ''").select(F.from_csv("value", schema, opts).alias("r")).select("r.*")
