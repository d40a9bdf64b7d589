"""Delimited-file loads.

One call reads any number of files in one Spark scan: Spark splits the files into
tasks (``spark.sql.files.maxPartitionBytes``), so there is no per-file job. The
schema is always given (the reference loads into a table whose DDL exists first);
nothing is inferred.

Compression: none and gzip are read natively (by extension). Of a zip only the directory
at its end is read first; then each member is a task of its own, which reads its part of
the archive. A tar.gz can only be read from its start: it is one task, streamed from its
store. Lines come in batches, and no archive or member is held in memory, so their sizes
do not matter.
"""

from __future__ import annotations

import io
import itertools
import tarfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from enum import Enum
from functools import partial
from typing import IO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from spark_elt.session import checkpoint_root, ship_code
from spark_elt.sources import archives, file_system


class Compression(Enum):
    NONE = "none"
    GZIP = "gzip"
    TAR_GZIP = "tar.gz"
    ZIP = "zip"


def csv_options(sep: str = ",", quote: str | None = '"', null_value: str | None = None, escape: str | None = None) -> dict:
    opts = {"sep": sep, "mode": "FAILFAST", "multiLine": "false"}
    if quote is not None:
        opts["quote"] = quote
    if null_value is not None:
        opts["nullValue"] = null_value
    if escape is not None:
        opts["escape"] = escape
    return opts


def _ddl(schema: StructType | str) -> str:
    return schema if isinstance(schema, str) else schema.simpleString()[len("struct<"):-1].replace(":", " ")


def _schema(spark: SparkSession, schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


#: Lines that an archive reader holds at a time.
ARCHIVE_LINES = 50_000


#: Tasks that the members of zip archives are spread over at most.
MEMBER_TASKS = 100_000


class _Ranged(io.RawIOBase):
    """A stored file; a place before its start is an OSError, as for files on disk."""

    def __init__(self, stored):
        self.stored = stored

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        return self.stored.readinto(into)

    def tell(self) -> int:
        return self.stored.tell()

    def seek(self, offset: int, whence: int = 0) -> int:
        try:
            return self.stored.seek(offset, whence)
        except ValueError as e:
            raise OSError(str(e)) from e

    def close(self) -> None:
        self.stored.close()
        super().close()


def _open(path: str) -> IO[bytes]:
    """A file of any store, for reading by range."""
    filesystem, p = archives.file_system(path)
    return io.BufferedReader(_Ranged(filesystem.open_input_file(p)), 1 << 20)


def _infos(z: zipfile.ZipFile) -> list[zipfile.ZipInfo]:
    """The files in a zip archive that are not empty."""
    return [i for i in z.infolist() if not i.is_dir() and i.file_size]


def _zip_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(path, place) of the files in zip archives, from their directories; ``place`` counts
    those of an archive from 0."""
    for pdf in batches:
        for path in pdf["path"]:
            with _open(path) as f, zipfile.ZipFile(f) as z:
                n = len(_infos(z))
            yield pd.DataFrame({"path": [path] * n, "place": range(n)}).astype({"path": "str", "place": "int64"})


def _batched(path: str, files: Iterator[IO[bytes]], begin: bool) -> Iterator[pd.DataFrame]:
    """The text lines of ``files``, one after the other, decompressed as they are read.
    ``first`` marks the first one, if they ``begin`` an archive."""
    lines = (ln.decode() for f in files for ln in f)
    while part := [ln.rstrip("\n").removesuffix("\r") for ln in itertools.islice(lines, ARCHIVE_LINES)]:
        yield pd.DataFrame({"file": path, "first": [begin] + [False] * (len(part) - 1), "value": part})
        begin = False


def _member_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path, place in zip(pdf["path"], pdf["place"], strict=True):
            with _open(path) as f, zipfile.ZipFile(f) as z, z.open(_infos(z)[place]) as m:
                yield from _batched(path, iter([m]), place == 0)


def _tar_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path in pdf["path"]:
            with _open(path) as f, tarfile.open(fileobj=f, mode="r|gz") as t:
                yield from _batched(path, (t.extractfile(m) for m in t if m.isfile()), True)


def _archive_lines(spark: SparkSession, paths: Sequence[str], compression: Compression) -> DataFrame:
    """Lines of archives: ``file`` (the archive), ``first`` (first line of it), ``value``."""
    schema = "file string, first boolean, value string"
    listing = spark.read.format("binaryFile").load(list(paths)).select("path")  # contents are not read
    if compression == Compression.TAR_GZIP:
        return listing.mapInPandas(_tar_lines, schema)
    checkpoint_root(spark)  # names the folder of stored frames
    members = listing.mapInPandas(_zip_members, "path string, place long").checkpoint()
    # a row for each archive; the driver holds the paths of a scan anyway
    counts = members.groupBy("path").count().orderBy("path").collect()
    before = list(itertools.accumulate((r["count"] for r in counts), initial=0))
    total = before.pop()
    if not total:
        return spark.createDataFrame([], schema)
    starts = spark.createDataFrame([(r["path"], n) for r, n in zip(counts, before)], "path string, before long")
    tasks = min(total, MEMBER_TASKS)
    numbered = members.join(starts, "path").withColumn("task", ((F.col("before") + F.col("place")) % tasks).cast("int"))
    return numbered.repartitionById(tasks, "task").select("path", "place").mapInPandas(_member_lines, schema)


def _mark_first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines of one split arrive in file order; the first line of the split that starts
    at byte 0 is the first line of its file."""
    seen: set[str] = set()
    for pdf in batches:
        begins = (pdf["block_start"] == 0) & ~pdf["file"].duplicated() & ~pdf["file"].isin(seen)
        seen.update(pdf["file"][begins])
        yield pd.DataFrame({"file": pdf["file"], "first": begins, "value": pdf["value"]})


def read_lines(spark: SparkSession, paths: Sequence[str], compression: Compression = Compression.NONE,
               header: bool = False) -> DataFrame:
    """Text lines of the files as ``file`` (path) and ``value``; with ``header`` without
    the first line of each file (exactly, also when files are split). A member of a zip
    archive is a task, a tar.gz archive is one."""
    ship_code(spark)
    if compression in (Compression.ZIP, Compression.TAR_GZIP):
        lines = _archive_lines(spark, paths, compression)
        return (lines.where(~F.col("first")) if header else lines).select("file", "value")
    txt = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block_start"), "value"
    )
    if not header:
        return txt.select("file", "value")
    marked = txt.mapInPandas(_mark_first, "file string, first boolean, value string")
    return marked.where(~F.col("first")).select("file", "value")


def parse_lines(lines: DataFrame, schema: StructType | str, options: dict, *keep: str) -> DataFrame:
    """Parse text lines with ``from_csv`` (same options as the CSV reader; a malformed
    line fails, blank lines are skipped), with the columns ``keep`` beside them."""
    opts = {k: v for k, v in options.items() if k != "multiLine"}
    parsed = lines.where("value <> ''").select(*keep, F.from_csv(F.col("value"), _ddl(schema), opts).alias("r"))
    return parsed.select(*keep, "r.*")


def read_delimited(
    spark: SparkSession,
    paths: Sequence[str] | str,
    schema: StructType | str,
    *,
    sep: str = ",",
    quote: str | None = '"',
    header: bool = False,
    null_value: str | None = None,
    escape: str | None = None,
    timezone: str | None = None,
    compression: Compression = Compression.NONE,
    mapper: Callable[[pd.Series], pd.Series] | None = None,
    make_unique: bool = False,
    with_file: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Rows of delimited files.

    ``mapper`` is applied to every line (vectorised over pandas batches) before
    parsing; ``make_unique`` drops duplicate raw lines of a file (the header is
    removed first). ``timezone``: times in the files are wall-clock times of that zone;
    TIMESTAMP columns hold the instants, whatever the session's zone, and TIMESTAMP_NTZ
    columns the wall-clock times of UTC. ``multi_line``: quoted values may contain line
    breaks (a file is then one task). A malformed line fails the load."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    st = _schema(spark, schema)
    opts = csv_options(sep, quote, null_value, escape)
    if timezone:
        opts["timeZone"] = timezone
    if not paths:
        return spark.createDataFrame([], StructType([*st.fields, StructField("file", StringType())]) if with_file else st)
    plain = compression in (Compression.NONE, Compression.GZIP) and mapper is None and not make_unique
    if plain:
        opts["multiLine"] = str(multi_line).lower()
        df = spark.read.schema(st).options(**opts).option("header", str(header).lower()).csv(paths)
        if with_file:
            df = df.withColumn("file", F.col("_metadata.file_path"))
    elif multi_line:
        raise ValueError("line breaks in values cannot be read by line (archives, mapper, make_unique)")
    else:
        lines = read_lines(spark, paths, compression, header)
        if mapper is not None:
            fn = mapper

            def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for pdf in batches:
                    yield pd.DataFrame({"file": pdf["file"], "value": fn(pdf["value"])})

            lines = lines.mapInPandas(apply, "file string, value string")
        if make_unique:
            lines = lines.dropDuplicates(["file", "value"])
        df = parse_lines(lines, st, opts, "file").select(*st.names, *(["file"] if with_file else []))
    if timezone:
        for f in st.fields:
            if f.dataType.typeName() == "timestamp_ntz":
                df = df.withColumn(f.name, F.convert_timezone(F.lit(timezone), F.lit("UTC"), F.col(f.name)))
    return df


def list_files(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """File listing (S21): ``path``, ``file_name`` (relative to ``root``),
    ``modification_time`` and ``length``. Content is not read (the binary-file
    source prunes the content column).

    ``glob`` without a folder matches file names in ``root`` and, with ``recursive``,
    below it. With folders (``2024/*/part-*.csv``) it matches the path below ``root``;
    ``**/`` at its start stands for any folders. Nothing found is an empty listing."""
    root_uri = root.rstrip("/")
    folders, _, name = glob.removeprefix("**/").rpartition("/")
    deep = glob.startswith("**/") or (recursive and not folders)
    at = f"{root_uri}/{folders}" if folders else root_uri
    names = "path string, file_name string, modification_time timestamp, length bigint"
    if not file_system.matches(spark, at):
        return spark.createDataFrame([], names)
    df = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", name)
        .option("recursiveFileLookup", str(deep).lower())
        .load(at if deep else f"{at}/{name}" if file_system.matches(spark, f"{at}/{name}") else at)
        .select("path", "modificationTime", "length")
    )
    # relative name: everything after the root directory
    rel = F.regexp_replace(F.col("path"), r"^.*?" + _root_marker(root_uri) + "/", "")
    return df.select(
        "path",
        rel.alias("file_name"),
        F.col("modificationTime").alias("modification_time"),  # an instant (TIMESTAMP), zone-free
        "length",
    )


def _root_marker(root: str) -> str:
    import re

    tail = root.split(":", 1)[-1].lstrip("/")
    return re.escape(tail)

