"""Ordered per-group values (row index, running sum, running maximum, lag, lead) without
putting a group into one task.

A window ``PARTITION BY g ORDER BY o`` sends every row of a group to one task. Here the
rows are range-partitioned on ``(g, o)`` instead: Spark samples the keys, so a hot group
is spread over many balanced partitions. One vectorised pass over each sorted partition
gives the values as far as the partition knows; only the group that a partition starts
with, and the first and last row of a partition, lack what lies in other partitions. The
first and last rows of all partitions (at most two per partition) hold what is missing,
and are the only thing broadcast. The plan is the same for all sizes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, IntegralType, LongType, StructField, StructType

from spark_elt.session import checkpoint_root, ship_code


def _differs(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Where two arrays differ; nulls equal each other."""
    other = pc.fill_null(pc.not_equal(a, b), False)
    return pc.or_(other, pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)


def _shifted(first: pa.Array, rest: pa.Array) -> pa.Array:
    return pa.concat_arrays([first, rest])


class _Pass:
    """The values of one partition, batch by batch; a batch waits for the next one, whose
    first row its last row's leads need."""

    def __init__(self, group: list[str], sums: list[str], maxima: list[str], lags: list[str], leads: list[str]):
        self.group, self.sums, self.maxima, self.lags, self.leads = group, sums, maxima, lags, leads
        self.last: pa.RecordBatch | None = None  # the last row so far
        self.count, self.in_first = 0, True
        self.total: dict[str, float] = {}
        self.most: dict[str, int | float | None] = {}

    def read(self, batch: pa.RecordBatch) -> dict[str, pa.Array]:
        n = batch.num_rows
        new = np.zeros(n, bool)
        for g in self.group:
            column = batch.column(g)
            new[1:] |= _differs(column[1:], column[:-1])
            if self.last is not None:
                new[0] |= _differs(column[:1], self.last.column(g))[0]
        first = self.last is None
        new[0] |= first
        begins = np.flatnonzero(new)
        run = np.cumsum(new)  # 0: the group of the row before this batch
        at = np.concatenate([[0], begins])[run]
        own = np.arange(n) - at + 1
        own[run == 0] += self.count
        out: dict[str, pa.Array] = {"_index": pa.array(own)}
        head = (run == 0) if not first else (run == 1)
        out["_head"] = pa.array(head & self.in_first)
        out["_first"] = pa.array((np.arange(n) == 0) & first)
        for c in self.sums:
            x = batch.column(c).fill_null(0).to_numpy(zero_copy_only=False)
            cum = np.cumsum(x, dtype=np.int64 if x.dtype.kind in "iu" else np.float64)
            before = np.concatenate([[0], cum[begins - 1] * (begins > 0)])[run]
            value = cum - before
            value[run == 0] += self.total.get(c, 0)
            self.total[c] = value[-1]
            out[f"{c}_cum"] = pa.array(value.astype(np.int64 if x.dtype.kind in "iu" else np.float64))
        for c in self.maxima:
            out[f"{c}_prev_max"], out[f"{c}_max"] = self._maxima(c, batch.column(c), begins)
        for c in self.lags:
            column = batch.column(c)
            before = self.last.column(c) if self.last is not None else pa.nulls(1, column.type)
            out[f"lag_{c}"] = pc.if_else(pa.array(new), pa.nulls(n, column.type), _shifted(before, column[:-1]))
        for c in self.leads:
            column = batch.column(c)
            ends = np.append(new[1:], True)
            out[f"lead_{c}"] = pc.if_else(pa.array(ends), pa.nulls(n, column.type), _shifted(column[1:], pa.nulls(1, column.type)))
        self.in_first = bool(self.in_first and head[-1])
        self.count, self.last = int(own[-1]), batch.slice(n - 1)
        self.next_continues = not new[0]
        return out

    def _maxima(self, c: str, column: pa.Array, begins: np.ndarray) -> tuple[pa.Array, pa.Array]:
        plain = column.cast(pa.int64()) if pa.types.is_temporal(column.type) else column
        floating = pa.types.is_floating(plain.type)
        low = -np.inf if floating else np.iinfo(np.int64).min
        x = plain.fill_null(low).to_numpy(zero_copy_only=False)
        top = np.empty_like(x)
        for s, e in zip([0, *begins], [*begins, len(x)], strict=True):
            if e > s:
                top[s:e] = np.maximum.accumulate(x[s:e])
        if (begin := begins[0] if len(begins) else len(x)) and c in self.most:
            top[:begin] = np.maximum(top[:begin], self.most[c])
        before = np.concatenate([[self.most.get(c, low)], top[:-1]]).astype(x.dtype)
        before[begins] = low
        self.most[c] = top[-1]
        return tuple(pa.array(v, mask=v == low).cast(column.type) for v in (before, top))


def _scan(batches: Iterator[pa.RecordBatch], names: list[str], added: list[str], **columns: list[str]) -> Iterator[pa.RecordBatch]:
    state = _Pass(**columns)
    waiting: tuple[pa.RecordBatch, dict[str, pa.Array]] | None = None
    pid = TaskContext.get().partitionId()

    def finished(batch: pa.RecordBatch, values: dict[str, pa.Array], follows: pa.RecordBatch | None) -> pa.RecordBatch:
        n = batch.num_rows
        if follows is not None and state.next_continues:
            for c in state.leads:
                values[f"lead_{c}"] = _shifted(values[f"lead_{c}"][: n - 1], follows.column(c)[:1])
        values["_pid"] = pa.array(np.full(n, pid, np.int32))
        values["_last"] = pa.array((np.arange(n) == n - 1) & (follows is None))
        return pa.RecordBatch.from_arrays([*batch.columns, *(values[a] for a in added)], [*names, *added])

    for batch in batches:
        if not batch.num_rows:
            continue
        values = state.read(batch)
        if waiting:
            yield finished(*waiting, batch)
        waiting = batch, values
    if waiting:
        yield finished(*waiting, None)


def ordered_scan(df: DataFrame, group: Sequence[str], order: Sequence[str], index_col: str = "_idx", sums: Sequence[str] = (),
                 prev_max: Sequence[str] = (), lag: Sequence[str] = (), lead: Sequence[str] = (),
                 partitions: int | None = None) -> DataFrame:
    """``df`` with, per row and within its group in ``order``: ``index_col`` (from 1),
    ``<c>_cum`` running sums of ``sums`` (nulls count as 0), ``<c>_prev_max`` the maximum
    over the earlier rows, ``lag_<c>`` and ``lead_<c>`` the neighbours' values.

    ``order`` should have no ties within a group. Null group values form a group. The
    scanned rows are stored in the checkpoint folder, so their partitions are fixed."""
    ship_code(df.sparkSession)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group, order, sums, prev_max, lag, lead = (list(x) for x in (group, order, sums, prev_max, lag, lead))
    of = {f.name: f for f in df.schema.fields}
    kinds = {"_pid": IntegerType(), "_index": LongType(), "_head": BooleanType(), "_first": BooleanType(), "_last": BooleanType()}
    for c in sums:
        kinds[f"{c}_cum"] = LongType() if isinstance(of[c].dataType, IntegralType) else DoubleType()
    for c in prev_max:
        kinds[f"{c}_prev_max"] = kinds[f"{c}_max"] = of[c].dataType
    kinds |= {f"lag_{c}": of[c].dataType for c in lag} | {f"lead_{c}": of[c].dataType for c in lead}
    schema = StructType([*df.schema.fields, *(StructField(k, t) for k, t in kinds.items())])
    keys = [F.col(c) for c in (*group, *order)]
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    columns = {"group": group, "sums": sums, "maxima": prev_max, "lags": lag, "leads": lead}
    checkpoint_root(df.sparkSession)
    rows = ranged.mapInArrow(partial(_scan, names=df.columns, added=list(kinds), **columns), schema).checkpoint(eager=True)

    # first and last rows of the partitions: at most two per partition
    edges = rows.where("_first or _last").select(
        "_pid", F.struct(*group).alias("_g"),
        F.explode(F.filter(F.array(F.when(F.col("_first"), 0), F.when(F.col("_last"), 1)), lambda x: x.isNotNull())).alias("_end"),
        "_index", *[f"{c}_cum" for c in sums], *[f"{c}_max" for c in prev_max], *dict.fromkeys([*lag, *lead]),
    )
    last = F.col("_end") == 1
    before = Window.partitionBy("_g").orderBy("_pid", "_end").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("_g").orderBy("_pid", "_end").rowsBetween(1, Window.unboundedFollowing)
    missing = edges.select(
        F.col("_pid"), "_end",
        F.sum(F.when(last, F.col("_index"))).over(before).alias("_add"),
        *[F.sum(F.when(last, F.col(f"{c}_cum"))).over(before).alias(f"_add_{c}") for c in sums],
        *[F.max(F.when(last, F.col(f"{c}_max"))).over(before).alias(f"_most_{c}") for c in prev_max],
        *[F.last(F.when(last, F.struct(c)), ignorenulls=True).over(before)[c].alias(f"_lag_{c}") for c in lag],
        *[F.first(F.when(~last, F.struct(c)), ignorenulls=True).over(after)[c].alias(f"_lead_{c}") for c in lead],
    )
    starts = missing.where("_end = 0").select("_pid", "_add", *[f"_add_{c}" for c in sums], *[f"_most_{c}" for c in prev_max], *[f"_lag_{c}" for c in lag])
    out = rows.join(F.broadcast(starts), "_pid", "left")
    if lead:
        ends = missing.where("_end = 1").select("_pid", *[f"_lead_{c}" for c in lead])
        out = out.join(F.broadcast(ends), "_pid", "left")

    def plus(value: str, extra: str) -> Column:
        return F.when(F.col("_head"), F.col(value) + F.coalesce(F.col(extra), F.lit(0))).otherwise(F.col(value))

    return out.select(
        *df.columns,
        plus("_index", "_add").cast("bigint").alias(index_col),
        *[plus(f"{c}_cum", f"_add_{c}").alias(f"{c}_cum") for c in sums],
        *[F.when(F.col("_head"), F.greatest(f"{c}_prev_max", f"_most_{c}")).otherwise(F.col(f"{c}_prev_max")).alias(f"{c}_prev_max") for c in prev_max],
        *[F.when(F.col("_first"), F.col(f"_lag_{c}")).otherwise(F.col(f"lag_{c}")).alias(f"lag_{c}") for c in lag],
        *[F.when(F.col("_last"), F.col(f"_lead_{c}")).otherwise(F.col(f"lead_{c}")).alias(f"lead_{c}") for c in lead],
    )
