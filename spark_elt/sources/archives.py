"""Writing archives (zip, tar.gz) of existing files with a Spark job.

Used to produce archive inputs for the archive readers: files are grouped by a key
(for instance the day), each group is packed by one task, and the archive bytes are
written through ``pyarrow.fs`` so the same code writes to local disks, HDFS or
object stores. Groups are bounded by the grouping the caller chooses (one day's
files), never the whole input."""

from __future__ import annotations

import io
import tarfile
import time
import zipfile
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_elt.session import ship_code


def file_system(path: str):
    """The file system of a path as Spark names it, and the path in it."""
    from pyarrow import fs

    scheme, _, rest = path.rpartition("://") if "://" in path else ("file", "", path.removeprefix("file:"))
    if scheme == "file":
        return fs.LocalFileSystem(), rest
    return fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{quote(rest, safe='/:@')}")


def write_bytes(path: str, data: bytes) -> None:
    """Write a whole file from a task: to a unique temporary name first, then renamed,
    so a retried or speculative task attempt never leaves a half-written file."""
    import uuid

    filesystem, p = file_system(path)
    parent = p.rsplit("/", 1)[0]
    filesystem.create_dir(parent, recursive=True)
    tmp = f"{p}.tmp-{uuid.uuid4().hex}"
    with filesystem.open_output_stream(tmp, compression=None) as f:
        f.write(data)
    filesystem.move(tmp, p)


def pack(spark: SparkSession, files: DataFrame, key: str, target_dir: str, kind: str) -> DataFrame:
    """Pack the files of each ``key`` group into ``<target_dir>/<key>.<zip|tar.gz>``.

    ``files`` needs ``path`` and ``key`` columns. Returns (key, archive path)."""
    ship_code(spark)
    contents = spark.read.format("binaryFile").load(
        [r["path"] for r in files.select("path").collect()]
    ).select("path", "content")
    grouped = files.select("path", F.col(key).cast("string").alias("k")).join(contents, "path")
    ext = "zip" if kind == "zip" else "tar.gz"

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("path")
        k = pdf["k"].iloc[0]
        buf = io.BytesIO()
        if kind == "zip":
            with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
                for i, (p, c) in enumerate(zip(pdf["path"], pdf["content"])):
                    z.writestr(f"part-{i:05d}.csv", bytes(c))
        else:
            with tarfile.open(fileobj=buf, mode="w:gz") as t:
                for i, (p, c) in enumerate(zip(pdf["path"], pdf["content"])):
                    info = tarfile.TarInfo(f"part-{i:05d}.csv")
                    info.size = len(c)
                    info.mtime = int(time.time())
                    t.addfile(info, io.BytesIO(bytes(c)))
        out = f"{target_dir.rstrip('/')}/{k}.{ext}"
        write_bytes(out, buf.getvalue())
        return pd.DataFrame({"k": [k], "archive": [out]})

    return grouped.groupBy("k").applyInPandas(build, "k string, archive string").withColumnRenamed("k", key)

