"""SQLite files as a Spark source (S08, S12) and a SQLite writer for test inputs.

``read_sqlite`` is a Python Data Source with one input partition per SQLite file:
each task opens its file with ``sqlite3`` and streams the rows of the query. Files
on shared storage are copied to the task's local scratch first (SQLite needs a
local file). The file list comes from a listing DataFrame (S13–S19 selection)."""

from __future__ import annotations

import json
import os
import sqlite3
import tempfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from spark_elt.session import ship_code


def _local_copy(path: str) -> tuple[str, bool]:
    if path.startswith("file:") or "://" not in path:
        p = path.removeprefix("file://").removeprefix("file:")
        return p, False
    from pyarrow import fs

    filesystem, p = fs.FileSystem.from_uri(path)
    fd, local = tempfile.mkstemp(suffix=".sqlite", dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None)
    os.close(fd)
    with filesystem.open_input_stream(p) as src, open(local, "wb") as dst:
        dst.write(src.read())
    return local, True


class SQLiteReader(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.paths = json.loads(options["paths"])
        self.query = options["query"]
        self.with_file = options.get("with_file", "false") == "true"

    def partitions(self) -> Sequence[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition) -> Iterator[tuple]:
        path = partition.value
        local, tmp = _local_copy(path)
        try:
            con = sqlite3.connect(f"file:{local}?mode=ro", uri=True)
            try:
                cur = con.execute(self.query)
                while True:
                    rows = cur.fetchmany(10_000)
                    if not rows:
                        break
                    for r in rows:
                        yield (tuple(r) + (path,)) if self.with_file else tuple(r)
            finally:
                con.close()
        finally:
            if tmp:
                os.remove(local)


class SQLiteFiles(DataSource):
    """``spark.read.format("sqlite_files").option("paths", json).option("query", sql)``"""

    @classmethod
    def name(cls) -> str:
        return "sqlite_files"

    def schema(self) -> str:
        return self.options["schema"]

    def reader(self, schema) -> DataSourceReader:
        return SQLiteReader(self.options, schema)


_REGISTERED: set[int] = set()


def register(spark: SparkSession) -> None:
    ship_code(spark)
    key = id(spark)
    if key not in _REGISTERED:
        spark.dataSource.register(SQLiteFiles)
        _REGISTERED.add(key)


def read_sqlite(spark: SparkSession, paths: Sequence[str], query: str, schema: str, with_file: bool = False) -> DataFrame:
    """Rows of ``query`` run in every SQLite file (one task per file)."""
    register(spark)
    full_schema = schema + (", file string" if with_file else "")
    if not paths:
        return spark.createDataFrame([], full_schema)
    return (
        spark.read.format("sqlite_files").option("paths", json.dumps(list(paths))).option("query", query)
        .option("schema", full_schema).option("with_file", str(with_file).lower()).schema(full_schema).load()
    )


def write_sqlite_per_group(spark: SparkSession, df: DataFrame, key: str, table_name: str, target_dir: str,
                           ddl: str, rows_per_file: int = 200_000) -> DataFrame:
    """Write each ``key`` group of ``df`` into SQLite files ``<target_dir>/<key>_<n>.sqlite``.

    A group is split into ``ceil(rows / rows_per_file)`` files by a hash of the row
    (the group sizes come from a partial-aggregated count), so no task ever builds a
    file from more than about ``rows_per_file`` rows, however large one group is."""
    from pyspark.sql import functions as F

    ship_code(spark)
    cols = [c for c in df.columns if c != key]
    sizes = df.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_file)).alias("_nb"))
    split = df.join(sizes, key).withColumn("_b", F.pmod(F.xxhash64(*cols), F.col("_nb"))).drop("_nb")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        from spark_elt.sources.archives import write_bytes

        k, b = str(pdf[key].iloc[0]), int(pdf["_b"].iloc[0])
        fd, local = tempfile.mkstemp(suffix=".sqlite")
        os.close(fd)
        try:
            con = sqlite3.connect(local)
            con.execute(f"CREATE TABLE {table_name} ({ddl})")
            data = pdf[cols].astype(object).where(pdf[cols].notna(), None)
            rows = [tuple(x.isoformat(sep=" ") if hasattr(x, "isoformat") else x for x in r)
                    for r in data.itertuples(index=False, name=None)]
            con.executemany(f"INSERT INTO {table_name} VALUES ({', '.join('?' * len(cols))})", rows)
            con.commit()
            con.close()
            out = f"{target_dir.rstrip('/')}/{k}_{b}.sqlite"
            with open(local, "rb") as f:
                write_bytes(out, f.read())
        finally:
            os.remove(local)
        return pd.DataFrame({key: [k], "file": [out]})

    return split.groupBy(key, "_b").applyInPandas(build, f"{key} string, file string")
