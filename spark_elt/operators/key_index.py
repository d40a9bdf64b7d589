"""Upserts that read and rewrite only files which may hold the keys of a delta.

Beside a Parquet target, in its hidden folder ``_keys``, lies an index with a row for each data
file: the least and greatest value of the first key column (where it is a whole number, a date
or a time) and a Bloom filter over all key columns. The delta's keys meet first the ranges,
then the filters of the files left; only files that pass are read, merged with the delta and
replaced. The work of an upsert so follows its delta and the files that it touches.

An index row speaks of one file and files are never changed in place, so rows of files that are
gone are ignored and a file without a row counts as one that may hold any key, and gets its row
with the next upsert. A write that breaks anywhere leaves the index right.

The merged files are staged with the list of those that they replace, moved into the target by
name, and the old ones deleted; a retry with the same staging goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DateType, IntegerType, LongType, ShortType, TimestampNTZType, TimestampType

from spark_elt.functions.durations import wall_micros
from spark_elt.operators.incremental import by_partition, check_unique, latest_per_key, merge_newer, merge_upsert, staged
from spark_elt.session import ship_code
from spark_elt.sources import file_system

FOLDER = "_keys"
INDEX = "file string, n long, low long, high long, bits binary"
#: Bits a key and hash functions of the filters: about 1 % of other keys pass.
BITS, HASHES = 10, 7
#: Meetings of delta keys with file ranges beyond which the filters are not asked: so many
#: keys, each in the ranges of so many files, touch nearly all of these anyway.
MOST_MEETINGS = 1 << 32


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def _place(column: str, kind: DataType) -> Column:
    """The first key column as a whole number in its order, null where it has none."""
    if isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        return F.col(column).cast("long")
    if isinstance(kind, DateType):
        return F.unix_date(F.col(column)).cast("long")
    if isinstance(kind, TimestampNTZType):
        return wall_micros(F.col(column))
    if isinstance(kind, TimestampType):
        return F.unix_micros(F.col(column))
    return F.lit(None).cast("long")


def _probes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The bits of each hash in a filter of ``size`` bits."""
    h = hashes.astype(np.int64).view(np.uint64)
    step = ((h >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return (h[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) % np.uint64(size)


def bloom(hashes: np.ndarray) -> bytes:
    """A Bloom filter of the hashes."""
    size = max(64, -(-len(hashes) * BITS // 8) * 8)
    bits = np.zeros(size, bool)
    bits[_probes(hashes, size).ravel()] = True
    return np.packbits(bits).tobytes()


def may_hold(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be among those of a filter."""
    packed = np.frombuffer(bits, np.uint8)
    at = _probes(hashes, len(packed) * 8)
    return ((packed[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1).astype(bool).all(axis=1)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index rows of files whose (file, place, hash) rows pass by together."""
    file, places, hashes = None, [], []
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def done() -> pa.RecordBatch:
        place, hashed = pa.chunked_array(places), np.concatenate(hashes)
        ends = pc.min_max(place).as_py()  # of those that are not null
        row = (file, len(hashed), ends["min"], ends["max"], bloom(hashed))
        return pa.record_batch([pa.array([v], k) for v, k in zip(row, kinds)], [f.split()[0] for f in INDEX.split(", ")])

    for batch in batches:
        if not batch.num_rows:
            continue
        names = np.array(batch.column(0).to_pylist(), object)
        cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
        for a, b in zip(cuts, cuts[1:]):
            if names[a] != file:
                if file is not None:
                    yield done()
                file, places, hashes = names[a], [], []
            places.append(batch.column(1).slice(a, b - a))
            hashes.append(batch.column(2).slice(a, b - a).to_numpy(zero_copy_only=False))
    if file is not None:
        yield done()


def data_files(spark: SparkSession, target: str) -> list[str]:
    """The data files of a target, below its folder. A scan's files are known to the driver."""
    return [f for f in file_system.files_below(spark, target) if not any(p.startswith(("_", ".")) for p in f.split("/"))]


def _relative(root: str) -> Column:
    """The path of a row's file below ``root`` (a path without scheme and authority)."""
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.substring(F.regexp_replace(decoded, r"^[^/:]+:(//[^/]*)?", ""), len(root) + 2, 1 << 20)


def _read(spark: SparkSession, target: str, files: Sequence[str], schema) -> DataFrame:
    reader = spark.read.schema(schema).option("basePath", target)
    return reader.parquet(*[file_system.escaped(f"{target}/{f}") for f in files])


def index(spark: SparkSession, target: str, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The index rows of the target's files, after the files without one have got theirs, and
    the names of the files. Only the key columns of such files are read."""
    ship_code(spark)
    target = target.rstrip("/")
    files, folder = data_files(spark, target), f"{target}/{FOLDER}"
    known = _index(spark, folder)
    listed = spark.createDataFrame([(f,) for f in files], "file string")
    new = [r.file for r in listed.join(known.select("file"), "file", "left_anti").collect()]
    if new:
        schema = spark.read.parquet(target).schema
        rows = _read(spark, target, new, schema).select(
            _relative(file_system.plain_path(spark, target)).alias("file"), _place(keys[0], schema[keys[0]].dataType).alias("place"), _hash(keys).alias("hash")
        )
        made = rows.repartition("file").sortWithinPartitions("file").mapInArrow(_rows, INDEX)
        made.write.mode("append").parquet(folder)
        known = _index(spark, folder)
    return known.join(listed, "file", "left_semi").dropDuplicates(["file"]), files


def _index(spark: SparkSession, folder: str) -> DataFrame:
    if not file_system.has_data(spark, folder):
        return spark.createDataFrame([], INDEX)
    return spark.read.schema(INDEX).parquet(folder)


def _meet(batches: Iterator[pa.RecordBatch], names: list[str], low: np.ndarray, high: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(file, hash) of every (place, hash) and file whose range has the place. The ranges are
    in order of ``low``; those that end before a place begin with the greatest end so far."""
    ceiling = np.maximum.accumulate(high) if len(high) else high
    for batch in batches:
        place = batch.column(0)
        free = np.asarray(place.is_null())
        at = place.fill_null(0).to_numpy(zero_copy_only=False)
        hashes = batch.column(1).to_numpy(zero_copy_only=False)
        begin = np.where(free, 0, np.searchsorted(ceiling, at, "left"))
        end = np.where(free, len(low), np.searchsorted(low, at, "right"))
        for lo in range(0, len(at), 1024):
            size = np.maximum(end[lo : lo + 1024] - begin[lo : lo + 1024], 0)
            row = np.repeat(np.arange(lo, lo + len(size)), size)
            file = begin[row] + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            keep = free[row] | (high[file] >= at[row])
            yield pa.record_batch([pa.array([names[i] for i in file[keep].tolist()], pa.string()), pa.array(hashes[row[keep]])], ["file", "hash"])


def _passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files of which a hash passes the filter: each file's filter comes first, hashes follow."""
    file, bits, found = None, None, False
    for batch in batches:
        names, filters = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        hashes = batch.column(2).fill_null(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1] or filters[i - 1] is not None), len(names)]
        out = []
        for a, b in zip(cuts, cuts[1:]):
            if filters[a] is not None:
                file, bits, found = names[a], filters[a], False
            elif not found and names[a] == file and may_hold(bits, hashes[a:b]).any():
                found = True
                out.append(file)
        if out:
            yield pa.record_batch([pa.array(out, pa.string())], ["file"])


def touched_files(spark: SparkSession, target: str, delta: DataFrame, keys: Sequence[str]) -> list[str]:
    """The files of the target that may hold a key of ``delta``, by the index. Keys with a NULL
    equal no other. The ranges of all files (names and two numbers each, as many as the driver
    lists for any scan) go with the tasks; filters stay where they are."""
    rows, _ = index(spark, target, keys)
    ranges = sorted(
        ((r.file, -(2**63) if r.low is None else r.low, 2**63 - 1 if r.high is None else r.high) for r in rows.select("file", "low", "high").toLocalIterator()),
        key=lambda r: r[1],
    )
    names = [r[0] for r in ranges]
    low, high = (np.array([r[i] for r in ranges], np.int64) for i in (1, 2))
    whole = delta.dropna(subset=list(keys))
    wanted = whole.select(_place(keys[0], delta.schema[keys[0]].dataType).alias("place"), _hash(keys).alias("hash")).distinct()
    meetings = wanted.mapInArrow(partial(_meet, names=names, low=low, high=high), "file string, hash long")
    if wanted.count() * len(names) > MOST_MEETINGS:
        return sorted(r.file for r in meetings.select("file").distinct().toLocalIterator())
    none = F.lit(None)
    stream = rows.select("file", "bits", none.cast("long").alias("hash")).unionByName(meetings.select("file", none.cast("binary").alias("bits"), "hash"))
    stream = stream.repartition("file").sortWithinPartitions("file", F.col("bits").isNull())
    return sorted(r.file for r in stream.mapInArrow(_passed, "file string").distinct().toLocalIterator())


def upsert_indexed(spark: SparkSession, target: str, delta: DataFrame, keys: Sequence[str], staging: str,
                   partition_by: Sequence[str] | None = None, dedup_by: str | None = None, version: str | None = None,
                   resume: bool = False) -> None:
    """``incremental.upsert`` into a Parquet target by its key index: the same rows come out,
    but only files that may hold the delta's keys are read and replaced. With ``partition_by``
    the new files go to their partitions; a key may move between them.

    A retry with the same ``staging`` first finishes what is complete there; with ``resume``
    that is all it does."""
    target, staging, parts = target.rstrip("/"), staging.rstrip("/"), list(partition_by or [])
    if staged(spark, staging):
        _replace(spark, target, keys, staging)
        if resume:
            return
    file_system.delete(spark, staging)
    if dedup_by:
        delta = latest_per_key(delta, keys, dedup_by)
    delta.write.parquet(f"{staging}/delta")
    delta = spark.read.schema(delta.schema).parquet(f"{staging}/delta")
    if not dedup_by:
        check_unique(delta, keys)
    exists = file_system.has_data(spark, target)
    touched = touched_files(spark, target, delta, keys) if exists else []
    merged = delta
    if touched:
        old = _read(spark, target, touched, spark.read.parquet(target).schema)
        merged = merge_newer(old, delta, keys, version) if version else merge_upsert(old, delta, keys)
    spark.createDataFrame([(f,) for f in touched], "file string").coalesce(1).write.parquet(f"{staging}/replaced")
    w = by_partition(merged, parts).write
    (w.partitionBy(*parts) if parts else w).parquet(f"{staging}/merged")
    _replace(spark, target, keys, staging)


def _replace(spark: SparkSession, target: str, keys: Sequence[str], staging: str) -> None:
    """Move the staged files into the target, delete those that they replace, and index them.
    Each step may be done again."""
    for name in data_files(spark, f"{staging}/merged"):
        file_system.move(spark, f"{staging}/merged/{name}", f"{target}/{name}")
    for row in spark.read.schema("file string").parquet(f"{staging}/replaced").toLocalIterator():
        file_system.delete(spark, f"{target}/{row.file}")
    file_system.delete(spark, staging)
    index(spark, target, keys)
