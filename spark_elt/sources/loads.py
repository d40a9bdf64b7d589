"""The file load as one step (S11, S17–S20, K03–K05, I05): list, select, read, write, keep
the statistics and the state.

The order makes a broken load harmless: the stored hash of the code goes first (its
absence makes the next run load everything), the rows are written, and only then the
files are recorded and the hash is stored."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spark_elt.functions import day_id
from spark_elt.operators import incremental as inc
from spark_elt.operators import sinks
from spark_elt.session import checkpoint_root
from spark_elt.sources.files import Compression, list_files, read_delimited
from spark_elt.sources.selection import DEFAULT_FIRST_DATE, ReadMode, file_date_of_path, select_files

DEPENDENCY_TYPE = "ParallelReadFile"


@dataclass
class FileLoad:
    """What a load needs to know about its node.

    ``state`` and ``dependencies`` are state tables (``PROCESSED_FILE``,
    ``FILE_DEPENDENCY``); ``file_dependencies`` the code files that a change of makes
    the load read everything again. ``fmt`` other than ``csv`` is any Spark file format,
    read with ``options``. ``by_day`` partitions the target by the day of the file's date
    (``truncate``: the days of the new files are replaced). ``table_name``: catalog table
    over the target, whose loaded partitions get statistics."""

    root: str
    pattern: str
    schema: StructType | str
    target: str
    node_path: Sequence[str]
    state: inc.StateTable | None = None
    dependencies: inc.StateTable | None = None
    file_dependencies: Sequence[str | Path] = ()
    mode: ReadMode = ReadMode.ALL
    date_regex: str | None = None
    first_date: dt.date | None = DEFAULT_FIRST_DATE
    last_date: dt.date | None = None
    fmt: str = "csv"
    options: dict | None = None
    by_day: bool = False
    truncate: bool = False
    table_name: str | None = None


def code_hash(load: FileLoad) -> str:
    return inc.dependency_hash(load.file_dependencies, load.first_date or DEFAULT_FIRST_DATE, load.last_date)


def read_selected(spark: SparkSession, load: FileLoad, selected: DataFrame) -> DataFrame:
    """Rows of the selected files with ``file``, the path each came from. The paths go to
    the reader, which keeps every file's status on the driver anyway."""
    paths = [r["path"] for r in selected.select("path").toLocalIterator()]
    options = dict(load.options or {})
    if load.fmt == "csv":
        return read_delimited(spark, paths, load.schema, with_file=True, **options)
    st = load.schema if isinstance(load.schema, StructType) else StructType.fromDDL(load.schema)
    if not paths:
        return spark.createDataFrame([], st).withColumn("file", F.lit(None).cast("string"))
    rows = spark.read.format(load.fmt).schema(st).options(**options).load(paths)
    return rows.withColumn("file", F.col("_metadata.file_path"))


def select(spark: SparkSession, load: FileLoad, reload_all: bool = False) -> DataFrame:
    """The listing of the files that the load is to read."""
    listing = list_files(spark, load.root, load.pattern)
    processed = inc.processed_files(load.state, load.node_path) if load.state else None
    return select_files(listing, load.mode, processed, date_regex=load.date_regex, first_date=load.first_date,
                        last_date=load.last_date, reload_all=reload_all)


def parallel_read_file(spark: SparkSession, load: FileLoad, now: dt.datetime | None = None) -> int:
    """Load the files of ``load`` into its target; returns how many files were read."""
    digest = code_hash(load) if load.dependencies else None
    changed = bool(digest) and inc.is_modified(load.dependencies, load.node_path, DEPENDENCY_TYPE, digest)
    if changed:
        inc.delete_dependency(load.dependencies, load.node_path, DEPENDENCY_TYPE)
    # stored, not cached: a selection made again after a loss would list other file times
    checkpoint_root(spark)
    selected = select(spark, load, changed).checkpoint(eager=True)
    n = selected.count()
    if n:
        rows = read_selected(spark, load, selected)
        if load.by_day:
            _load_days(spark, load, rows, selected)
        else:
            rows.drop("file").write.mode("append").parquet(load.target)
        if load.state:
            inc.track_processed(load.state, load.node_path, selected)
    if changed:
        inc.update_dependency(load.dependencies, load.node_path, DEPENDENCY_TYPE, digest, now or dt.datetime.now())
    return n


def _load_days(spark: SparkSession, load: FileLoad, rows: DataFrame, selected: DataFrame) -> None:
    if load.date_regex is None:
        raise ValueError("a load by day needs date_regex")
    day = day_id(file_date_of_path(F.col("file"), load.root, load.date_regex))
    out = rows.withColumn("day_id", day).drop("file").write.partitionBy("day_id")
    if load.truncate:
        out = out.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        out = out.mode("append")
    out.parquet(load.target)
    if load.table_name:
        spark.sql(f"ALTER TABLE {load.table_name} RECOVER PARTITIONS")
        # one per loaded day, as the listing has them: the files are not read again
        for r in selected.select(day_id(F.col("file_date")).alias("d")).distinct().collect():
            sinks.analyze(spark, load.table_name, {"day_id": r["d"]})
