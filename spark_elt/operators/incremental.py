"""Incremental processing (I01–I11, S20, Q04): state tables, keyed upsert and the
incremental table copy.

State tables (file dependency hashes, processed files, copy status) are small
parquet tables keyed by node path. Each change writes a new version ``v=N`` next to the
old ones, so a job never overwrites what it reads and a failed write leaves the previous
version in force; readers take the newest committed version. A writer claims its version
number first, so of two writers that started from the same version one fails instead of
losing the other's change. The last two versions are kept. For many nodes, or nodes of
many files, ``state_log.StateLog`` keeps the same state as changes by node.

Whether a table is there is asked of the file system. Every other error, of a storage
service or of rights, rises and leaves targets as they are.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Sequence
from functools import partial, reduce
from operator import and_
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from spark_elt.functions.paths import path_has_prefix, path_literal
from spark_elt.sources import file_system

_PATH = ArrayType(StringType())
FILE_DEPENDENCY = StructType([
    StructField("node_path", _PATH), StructField("dependency_type", StringType()), StructField("hash", StringType()),
    StructField("timestamp", TimestampNTZType()),
])
PROCESSED_FILE = StructType([
    StructField("node_path", _PATH), StructField("file_name", StringType()),
    StructField("last_modified_timestamp", TimestampType()),  # an instant, as file times are
])
COPY_STATUS = StructType([
    StructField("node_path", _PATH), StructField("source_table", StringType()),
    StructField("last_comparison_value", StringType()),
])
_LIVE = StructField("_live", BooleanType())
#: A claimed but uncommitted version younger than this belongs to a running writer.
CLAIM_SECONDS = 3600


class StateChanged(RuntimeError):
    """Another writer has changed the state table since it was read."""


class StateTable:
    """A keyed state table with versioned storage."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]):
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, list(keys)

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        found = (n for n in file_system.children(self.spark, self.path) if n.startswith("v="))
        return sorted(int(n[2:]) for n in found if file_system.committed(self.spark, f"{self.path}/{n}"))

    def version(self) -> int | None:
        """Newest committed version."""
        return max(self.versions(), default=None)

    def read(self, node_path: Sequence[str] | None = None) -> DataFrame:
        """The state, or the rows of one node."""
        rows = self._read(self.version())
        return rows if node_path is None else rows.where(_node_key(node_path))

    def _read(self, v: int | None) -> DataFrame:
        if v is None:
            return self.spark.createDataFrame([], self.schema)
        df = self.spark.read.schema(
            StructType(self.schema.fields + [_LIVE])
        ).parquet(f"{self.path}/v={v}")
        return df.where(F.col("_live")).drop("_live")

    def replace(self, rows: DataFrame) -> None:
        self._write(rows, self.version())

    def _write(self, rows: DataFrame, base: int | None) -> None:
        """Write ``rows`` as the version after ``base``, if no one else has claimed it."""
        taken = [int(n[len("_claim-"):]) for n in file_system.children(self.spark, self.path) if n.startswith("_claim-")]
        v = max([base or 0, *(t for t in taken if not self._pending(t, base))]) + 1
        if not file_system.create_new(self.spark, f"{self.path}/_claim-{v}"):
            raise StateChanged(f"version {v} of {self.path} is being written by another job")
        if (self.version() or 0) != (base or 0):
            raise StateChanged(f"{self.path} has changed since version {base}")
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        marker = self.spark.createDataFrame([tuple([None] * len(self.schema.fields))], self.schema)
        out = rows.withColumn("_live", F.lit(True)).unionByName(marker.withColumn("_live", F.lit(False)))
        out.write.mode("errorifexists").parquet(f"{self.path}/v={v}")
        for old in self.versions()[:-2]:
            file_system.delete(self.spark, f"{self.path}/v={old}")
            file_system.delete(self.spark, f"{self.path}/_claim-{old}")

    def _pending(self, claim: int, base: int | None) -> bool:
        """Whether a claim after ``base`` is young enough to belong to a running writer."""
        return claim > (base or 0) and file_system.age(self.spark, f"{self.path}/_claim-{claim}") < CLAIM_SECONDS

    def upsert(self, rows: DataFrame) -> None:
        base = self.version()
        current = self._read(base)
        kept = current.join(rows.select(*self.keys), self.keys, "left_anti")
        self._write(kept.unionByName(rows.select(current.columns)), base)

    def delete_where(self, cond: Column) -> None:
        """Delete the rows where ``cond`` is true (not those where it is NULL)."""
        base = self.version()
        self._write(self._read(base).where(~F.coalesce(cond, F.lit(False))), base)


def _node_key(node_path: Sequence[str]) -> Column:
    return F.col("node_path") == path_literal(node_path)


# ------------------------------------------------------------ file dependencies

def dependency_hash(files: Sequence[str | Path], first_date: dt.date, last_date: dt.date | None = None) -> str:
    """Combined hash of code files: ``first_date last_date md5 md5 …`` (I01). The
    files are the node's own SQL/Python sources (a handful of small files)."""
    h = f"{first_date} {last_date}"
    for f in files:
        h += " " + hashlib.md5(Path(f).read_text().encode()).hexdigest()
    return h


def dependency_hash_frame(spark: SparkSession, paths: Sequence[str], first_date: dt.date,
                          last_date: dt.date | None = None) -> DataFrame:
    """The same hash computed by Spark over ``binaryFile`` contents, in list order."""
    contents = spark.read.format("binaryFile").load(list(paths)).select("path", F.md5("content").alias("md5"))
    order = spark.createDataFrame([(file_system.qualified(spark, p), i) for i, p in enumerate(paths)], "path string, i int")
    joined = contents.join(order, "path")
    return joined.agg(
        F.concat_ws(" ", F.lit(f"{first_date} {last_date}"),
                    F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "md5"))), lambda x: x["md5"]), " "))
        .alias("hash")
    )


def is_modified(state: StateTable, node_path: Sequence[str], dependency_type: str, hash_value: str) -> bool:
    """True unless the stored hash of (node, type) equals ``hash_value``."""
    if state.version() is None:
        return True
    hit = state.read(node_path).where((F.col("dependency_type") == dependency_type) & (F.col("hash") == hash_value))
    return hit.isEmpty()


def update_dependency(state: StateTable, node_path: Sequence[str], dependency_type: str, hash_value: str,
                      now: dt.datetime) -> None:
    row = state.spark.createDataFrame([(list(node_path), dependency_type, hash_value, now)], FILE_DEPENDENCY)
    state.upsert(row)


def delete_dependency(state: StateTable, node_path: Sequence[str], dependency_type: str) -> None:
    state.delete_where(_node_key(node_path) & (F.col("dependency_type") == dependency_type))


def run_if_changed(state: StateTable, node_path: Sequence[str], dependency_type: str, hash_value: str,
                   fn: Callable[[], object], now: dt.datetime) -> tuple[bool, object]:
    """Q04: skip ``fn`` when the dependency hash is unchanged. Otherwise delete the
    old hash first (a crash then forces a rerun), run, and store the new hash only
    after success. Returns (ran, result)."""
    if not is_modified(state, node_path, dependency_type, hash_value):
        return False, None
    delete_dependency(state, node_path, dependency_type)
    result = fn()
    if result is False:
        raise RuntimeError("step failed; dependency hash not stored")
    update_dependency(state, node_path, dependency_type, hash_value, now)
    return True, result


def run_if_files_changed(state: StateTable, node_path: Sequence[str], dependency_type: str, files: Sequence[str | Path],
                         fn: Callable[[], object], now: dt.datetime, first_date: dt.date = dt.date(2000, 1, 1),
                         last_date: dt.date | None = None) -> tuple[bool, object]:
    """``run_if_changed`` on the content of the step's own files (its SQL or Python): for a
    load, a copy or a function step alike."""
    return run_if_changed(state, node_path, dependency_type, dependency_hash(files, first_date, last_date), fn, now)


# ------------------------------------------------------------ processed files

def track_processed(state: StateTable, node_path: Sequence[str], selected: DataFrame) -> None:
    """Record the loaded files with their modification time, one upsert for the
    whole selection (after the load succeeded)."""
    rows = selected.select(
        path_literal(node_path).alias("node_path"), "file_name",
        F.col("modification_time").alias("last_modified_timestamp"),
    )
    state.upsert(rows)


def processed_files(state: StateTable, node_path: Sequence[str]) -> DataFrame:
    return state.read(node_path).select("file_name", "last_modified_timestamp")


# ------------------------------------------------------------ copy status

def get_last_value(state: StateTable, node_path: Sequence[str], source_table: str) -> str | None:
    if state.version() is None:  # no state written yet: nothing to read
        return None
    r = state.read(node_path).where(F.col("source_table") == source_table).select("last_comparison_value").first()
    return None if r is None else r[0]


def set_last_value(state: StateTable, node_path: Sequence[str], source_table: str, value: str) -> None:
    row = state.spark.createDataFrame([(list(node_path), source_table, value)], COPY_STATUS)
    state.upsert(row)


def delete_last_value(state: StateTable, node_path: Sequence[str], source_table: str) -> None:
    state.delete_where(_node_key(node_path) & (F.col("source_table") == source_table))


# ------------------------------------------------------------ reset

def reset_summary(states: dict[str, StateTable], prefix: Sequence[str]) -> DataFrame:
    """Rows per node path and kind that a reset of ``prefix`` would delete."""
    frames = []
    for kind, st in states.items():
        frames.append(
            st.read().where(path_has_prefix("node_path", prefix)).groupBy("node_path").agg(
                F.count(F.lit(1)).alias("n")
            ).withColumn("kind", F.lit(kind))
        )
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out.distinct()


def reset(states: dict[str, StateTable], prefix: Sequence[str]) -> None:
    for st in states.values():
        st.delete_where(path_has_prefix("node_path", prefix))


# ------------------------------------------------------------ upsert

def _all_keys(keys: Sequence[str]) -> Column:
    return reduce(and_, (F.col(k).isNotNull() for k in keys))


def latest_per_key(delta: DataFrame, keys: Sequence[str], order_by: str | Column) -> DataFrame:
    """Newest row per key (I11) as an aggregate of ``max(struct(order, row))``: it
    combines map-side, so a hot key never gathers in one task. Rows with a NULL in a key
    equal no other row and all stay."""
    o = F.col(order_by) if isinstance(order_by, str) else order_by
    rest = [c for c in delta.columns if c not in keys]
    keyed = delta.where(_all_keys(keys))
    packed = keyed.groupBy(*keys).agg(F.max(F.struct(o.alias("_o"), *[F.col(c) for c in rest])).alias("_r"))
    newest = packed.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(delta.columns)
    return newest.unionByName(delta.where(~_all_keys(keys)))


def check_unique(delta: DataFrame, keys: Sequence[str]) -> None:
    """Fail when the delta has two rows with one key (the database refuses them). As in a
    unique index, a key with a NULL in it equals no other."""
    dup = delta.where(_all_keys(keys)).groupBy(*keys).count().where(F.col("count") > 1)
    if not dup.isEmpty():
        raise ValueError(f"delta has duplicate keys {keys}; pass dedup_by= to keep the newest row per key")


def merge_upsert(target: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows without a matching delta key, plus all delta rows (I09). NULL
    keys never match, so such delta rows are added (as a unique index allows)."""
    return target.join(delta.select(*keys), list(keys), "left_anti").unionByName(delta.select(target.columns))


def merge_newer(target: DataFrame, delta: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Per key the row of the highest ``version``, the delta's among equals: a delta that
    arrives late does not replace a newer row."""
    both = target.withColumn("_new", F.lit(0)).unionByName(delta.select(target.columns).withColumn("_new", F.lit(1)))
    return latest_per_key(both, keys, F.struct(version, "_new")).drop("_new")


def merge_explicit(target: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """UPDATE … FROM then INSERT … WHERE NOT EXISTS (I10). Every target column takes
    the source value when matched (also NULLs); unmatched source rows are inserted."""
    src = delta.select(*[F.col(c).alias(f"_s_{c}") for c in target.columns]).withColumn("_m", F.lit(True))
    # one source row per key for the update (the database takes an arbitrary one)
    one = latest_per_key(src, [f"_s_{k}" for k in keys], F.lit(0))
    cond = [F.col(k) == F.col(f"_s_{k}") for k in keys]
    joined = target.join(one, cond, "left")
    updated = joined.select(
        *[F.when(F.col("_m"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) for c in target.columns]
    )
    inserted = delta.join(target.select(*keys), list(keys), "left_anti").select(target.columns)
    return updated.unionByName(inserted)


def upsert(spark: SparkSession, target_path: str, delta: DataFrame, keys: Sequence[str], staging: str,
           partition_by: Sequence[str] | None = None, dedup_by: str | None = None, explicit: bool = False,
           fmt: str = "parquet", resume: bool = False, version: str | None = None, discard: bool = False) -> None:
    """Keyed upsert into a parquet target (I09/I10) without MERGE.

    The delta is written to ``staging`` once and read from there, so a changing source
    gives every step the same rows. The merged rows are staged too (Spark cannot
    overwrite the path it reads), then copied over the target. With ``partition_by`` only
    the partitions that the delta touches, or that hold older rows of its keys, are read
    and rewritten (dynamic overwrite); a partition left without rows is removed. With
    ``version`` a stored row of a higher version stays.

    Crash safety: retry a failed upsert with the same ``staging``. A merge that is
    complete there may be the only whole copy of a target that the failed copy left
    incomplete, so it is finished first, whatever the call; ``discard`` throws it away
    instead. With ``resume`` the delta is known to be the one of that merge, which then is
    all that is done. A finished upsert removes its staging."""
    staging = staging.rstrip("/")
    if staged(spark, staging) and not discard:
        finish_staged(spark, target_path, staging, partition_by, fmt)
        if resume:
            return
    file_system.delete(spark, staging)
    if dedup_by:
        delta = latest_per_key(delta, keys, dedup_by)
    delta.write.format("parquet").save(f"{staging}/delta")
    delta = spark.read.schema(delta.schema).parquet(f"{staging}/delta")
    if not dedup_by and not explicit:
        check_unique(delta, keys)
    _stage(spark, target_path, delta, keys, staging, list(partition_by or []), explicit, fmt, version)
    finish_staged(spark, target_path, staging, partition_by, fmt)


def by_partition(rows: DataFrame, parts: Sequence[str]) -> DataFrame:
    """``rows`` gathered for a write partitioned by ``parts``: a task then has whole partitions
    (a large one is split), where else each task would write a file into every partition."""
    return rows.hint("rebalance", *parts) if parts else rows


def staged(spark: SparkSession, staging: str) -> bool:
    """Whether ``staging`` holds a merge, or a checked full load, that is complete but
    perhaps not yet copied."""
    staging = staging.rstrip("/")
    return file_system.committed(spark, f"{staging}/merged") or file_system.exists(spark, f"{staging}/_checked")


def _stage(spark: SparkSession, target_path: str, delta: DataFrame, keys: Sequence[str], staging: str,
           parts: list[str], explicit: bool, fmt: str, version: str | None) -> None:
    if file_system.has_data(spark, target_path):
        target = spark.read.format(fmt).load(target_path)
    else:
        target = spark.createDataFrame([], delta.schema)
    emptied = spark.createDataFrame([], "path string")
    merge = merge_explicit if explicit else partial(merge_newer, version=version) if version else merge_upsert
    if parts and file_system.has_data(spark, target_path):
        files = target.select("*", F.col("_metadata.file_path").alias("_path"))
        moved = target.select(*keys, *parts).join(delta.select(*keys), list(keys), "left_semi").select(*parts)
        touched = delta.select(*parts).union(moved).distinct().select(*[F.col(p).alias(f"_t_{p}") for p in parts])
        same = [F.col(p).eqNullSafe(F.col(f"_t_{p}")) for p in parts]
        merged = merge(target.join(touched, same, "left_semi"), delta, keys)
        # files of touched partitions that get no row: the dynamic overwrite leaves them
        after = merged.select(*[F.col(p).alias(f"_t_{p}") for p in parts]).distinct()
        gone = files.select(*parts, "_path").distinct().join(touched, same, "left_semi").join(after, same, "left_anti")
        emptied = gone.select(F.col("_path").alias("path")).distinct()
    else:
        merged = merge(target, delta, keys)
    emptied.write.parquet(f"{staging}/emptied")
    w = by_partition(merged, parts).write.format(fmt)
    (w.partitionBy(*parts) if parts else w).save(f"{staging}/merged")


def finish_staged(spark: SparkSession, target_path: str, staging: str, partition_by: Sequence[str] | None = None,
                  fmt: str = "parquet") -> None:
    """Copy a complete staged merge, or a full load, over the target and remove the
    staging. Doing so twice gives the same target."""
    staging = staging.rstrip("/")
    parts = list(partition_by or [])
    whole = file_system.exists(spark, f"{staging}/_checked")
    merged = spark.read.format(fmt).load(f"{staging}/full" if whole else f"{staging}/merged")
    w = merged.select([c for c in merged.columns if c not in parts] + parts).write.format(fmt).mode("overwrite")
    if parts:
        w = w.partitionBy(*parts).option("partitionOverwriteMode", "static" if whole else "dynamic")
    w.save(target_path)
    if whole:
        file_system.delete(spark, staging)
        return
    for row in spark.read.schema("path string").parquet(f"{staging}/emptied").toLocalIterator():
        file_system.delete_file(spark, row.path)
    file_system.delete(spark, staging)


# ------------------------------------------------------------ CopyIncrementally

def full_load(spark: SparkSession, rows: DataFrame, target_path: str, keys: Sequence[str], staging: str,
              partition_by: Sequence[str] | None = None, dedup_by: str | None = None, unique: bool = True,
              fmt: str = "parquet") -> None:
    """Replace the target by ``rows`` (I08b): the newest row per key with ``dedup_by``, else
    with ``unique`` a key that two rows have fails, as a primary key would.

    A target without data is written at once and emptied again on such a failure. One that
    has data stays as it is until the new rows are written to ``staging`` and checked."""
    staging = staging.rstrip("/")
    file_system.delete(spark, staging)
    fresh = not file_system.has_data(spark, target_path)
    place = target_path if fresh else f"{staging}/full"
    out = latest_per_key(rows, keys, dedup_by) if dedup_by else rows
    w = by_partition(out, partition_by or []).write.mode("overwrite").format(fmt)
    (w.partitionBy(*partition_by) if partition_by else w).save(place)
    if unique and not dedup_by:
        try:
            check_unique(spark.read.format(fmt).load(place).select(*keys), keys)
        except ValueError:
            file_system.delete(spark, place)
            raise
    if not fresh:
        file_system.create_new(spark, f"{staging}/_checked")
        finish_staged(spark, target_path, staging, partition_by, fmt)


def comparison_value(rows: DataFrame, expr: str) -> str | None:
    """``max(expr)`` as text that reads as the same value in every session: an instant
    (TIMESTAMP) with the offset of UTC, other types as Spark writes them."""
    greatest = rows.select(F.max(F.expr(expr)).alias("m"))
    if isinstance(greatest.schema["m"].dataType, TimestampType):
        micros = greatest.select(F.unix_micros("m").alias("m")).first()["m"]
        if micros is None:
            return None
        return f"{dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=micros)}+00:00"
    return greatest.select(F.col("m").cast("string").alias("m")).first()["m"]


def copy_incrementally(
    spark: SparkSession,
    source: DataFrame | Callable[[str], DataFrame],
    target_path: str,
    modification_expr: str,
    keys: Sequence[str],
    status: StateTable,
    node_path: Sequence[str],
    source_name: str,
    staging: str,
    comparison_type: str | None = None,
    explicit: bool = False,
    dedup_by: str | None = None,
    fmt: str = "parquet",
    lookback: str | None = None,
    partition_by: Sequence[str] | None = None,
) -> str:
    """Incremental copy of ``source`` into ``target_path``.

    ``source`` is a frame, or a function that makes one from a predicate: it gets
    ``(1=1)`` for all rows and ``(expr >= CAST('last' AS type))`` for a delta
    (``sql_source`` puts the predicate into a SQL text).

    0. A merge that an earlier, broken run left complete in ``staging`` (a folder of this
       node, the same in every run) is finished first.
    1. ``max(modification_expr)`` of the source, read before the load (a NULL max:
       nothing to copy, succeed). 2. target empty? 3. stored last value.
    4. Empty target or no/'' stored value: full load (stale value deleted first).
       Otherwise: delta = rows with ``expr >= last`` (inclusive; pushed into the
       source scan), upserted by ``keys``. Both refuse two rows with one key, or keep the
       newest by ``dedup_by``. 5. The max from step 1 is stored last (instants with their
       offset), so a crash before it repeats the load. Returns 'empty', 'full' or 'delta'.
    ``lookback`` (e.g. ``"INTERVAL 2 DAYS"``) widens the delta window so that late
    changes below the stored value are read again (off by default: such rows are then
    never re-read). With ``partition_by`` the target is partitioned and a delta rewrites
    only the partitions it touches."""
    read = source if callable(source) else lambda predicate: source.where(F.expr(predicate))
    if staged(spark, staging):
        finish_staged(spark, target_path, staging, partition_by, fmt)
    everything = read("(1=1)")
    greatest = comparison_value(everything, modification_expr)
    if greatest is None:
        return "empty"
    target_empty = not file_system.has_data(spark, target_path) or spark.read.format(fmt).load(target_path).isEmpty()
    last = get_last_value(status, node_path, source_name)
    if target_empty or not last:
        if target_empty and last:
            delete_last_value(status, node_path, source_name)
        full_load(spark, everything, target_path, keys, staging, partition_by, dedup_by, unique=not explicit, fmt=fmt)
        mode = "full"
    else:
        typ = comparison_type or everything.select(F.expr(modification_expr).alias("e")).schema["e"].dataType.simpleString()
        quoted = last.replace("\\", "\\\\").replace("'", "\\'")
        bound = f"CAST('{quoted}' AS {typ})" + (f" - {lookback}" if lookback else "")
        upsert(spark, target_path, read(f"({modification_expr} >= {bound})"), keys, staging, partition_by=partition_by,
               dedup_by=dedup_by, explicit=explicit, fmt=fmt)
        mode = "delta"
    set_last_value(status, node_path, source_name, greatest)
    return mode


def sql_source(spark: SparkSession, sql: str, placeholder: str = "@@comparison@@") -> Callable[[str], DataFrame]:
    """A source for ``copy_incrementally`` from a SQL text that has ``placeholder`` where
    the comparison with the last value belongs (in a WHERE clause)."""
    if placeholder not in sql:
        raise ValueError(f"the source SQL has no {placeholder}")
    return lambda predicate: spark.sql(sql.replace(placeholder, predicate))


def modified_dependencies(state: DataFrame, current: DataFrame) -> DataFrame:
    """Set-wise ``is_modified`` (I02) for many nodes at once: ``current`` has
    (node_path, dependency_type, hash); a node is modified unless the state holds
    the same hash for it."""
    same = current.join(state.select("node_path", "dependency_type", "hash"), ["node_path", "dependency_type", "hash"],
                        "left_semi").withColumn("_same", F.lit(True))
    return current.join(same.select("node_path", "dependency_type", "_same"), ["node_path", "dependency_type"], "left") \
        .select("node_path", "dependency_type", F.col("_same").isNull().alias("is_modified"))


def is_empty_frame(df: DataFrame) -> DataFrame:
    """One row ``is_empty`` computed by the cluster (A04): reads at most one row."""
    return df.limit(1).agg((F.count(F.lit(1)) == 0).alias("is_empty"))


def max_value(df: DataFrame, expr: str) -> DataFrame:
    """``SELECT max(expr) AS maxval`` (A02), one row."""
    return df.agg(F.max(F.expr(expr)).alias("maxval"))
