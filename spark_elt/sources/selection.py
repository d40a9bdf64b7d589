"""File selection on a listing DataFrame (S13–S20): date from the file name, lower
date bound, and the five read modes. Everything here is a relational operation on
the listing (one row per file), so it is cheap and distributed; only the final list
of selected paths goes to the reader, which needs it on the driver anyway."""

from __future__ import annotations

import datetime as dt
from enum import Enum

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ReadMode(Enum):
    ALL = "all"
    ONLY_LATEST = "only_latest"
    ONLY_NEW = "only_new"
    ONLY_CHANGED = "only_changed"
    ONLY_NEW_EXCEPT_LATEST = "only_new_except_latest"


# Fixed value: default lower date bound of file loads.
DEFAULT_FIRST_DATE = dt.date(2000, 1, 1)


def with_file_date(listing: DataFrame, date_regex: str, name_col: str = "file_name") -> DataFrame:
    """Add ``file_date`` from the first three groups (year, month, day) of
    ``date_regex`` matched at the start of the relative file name. A file that
    does not match fails the job (as the reference raises)."""
    anchored = "^(?:" + date_regex + ")"
    name = F.col(name_col)
    y, m, d = (F.regexp_extract(name, anchored, i).cast("int") for i in (1, 2, 3))
    fails = F.raise_error(F.concat(F.lit('file name "'), name, F.lit(f'" does not match date regex "{date_regex}"')))
    # as a filter: a column that no one reads would be pruned, and the failure with it
    matching = listing.where(F.when(name.rlike(anchored), F.lit(True)).otherwise(fails.cast("boolean")))
    return matching.withColumn("file_date", F.make_date(y, m, d))


def file_date_of_path(path_col, root: str, date_regex: str):
    """The same file date as ``with_file_date``, computed from each row's own file
    path (``_metadata.file_path``): a narrow projection, so loaded rows never have to
    be joined with the listing to learn their date."""
    import re

    tail = re.escape(root.rstrip("/").split(":", 1)[-1].lstrip("/"))
    # metadata columns have encoded paths, the root is as the user wrote it; the paths of
    # archives are not encoded
    decoded = F.coalesce(F.try_url_decode(F.replace(path_col, F.lit("+"), F.lit("%2B"))), path_col)
    rel = F.regexp_replace(decoded, r"^.*?" + tail + "/", "")
    anchored = "^(?:" + date_regex + ")"
    y, m, d = (F.regexp_extract(rel, anchored, i).cast("int") for i in (1, 2, 3))
    fails = F.raise_error(F.concat(F.lit('file "'), decoded, F.lit(f'" does not match date regex "{date_regex}"')))
    return F.when(rel.rlike(anchored), F.make_date(y, m, d)).otherwise(fails.cast("date"))


def _order_cols(dated: bool) -> list:
    return ([F.col("file_date").desc()] if dated else []) + [F.col("file_name").desc()]


def select_files(
    listing: DataFrame,
    mode: ReadMode = ReadMode.ALL,
    processed: DataFrame | None = None,
    *,
    date_regex: str | None = None,
    first_date: dt.date | None = DEFAULT_FIRST_DATE,
    last_date: dt.date | None = None,
    reload_all: bool = False,
) -> DataFrame:
    """Files to read for one load.

    ``processed``: the processed-file state of this node (``file_name``,
    ``last_modified_timestamp``). ``reload_all``: the node's code dependencies
    changed, so the state is ignored (S20). ``last_date`` (off by default, as in
    the reference, where it only enters the dependency hash) adds an upper bound.
    Order: newest date first, then file name descending."""
    files = listing
    dated = date_regex is not None
    if dated:
        files = with_file_date(files, date_regex)
        if first_date is not None:
            files = files.where(F.col("file_date") >= F.lit(first_date))
        if last_date is not None:
            files = files.where(F.col("file_date") <= F.lit(last_date))
    order = _order_cols(dated)
    if mode in (ReadMode.ONLY_LATEST, ReadMode.ONLY_NEW_EXCEPT_LATEST):
        # top-1 by the file order: a distributed TakeOrderedAndProject, one row out
        latest = files.orderBy(*order).limit(1)
        if mode == ReadMode.ONLY_LATEST:
            return latest
        files = files.join(F.broadcast(latest.select("file_name")), "file_name", "left_anti")
    if mode in (ReadMode.ALL, ReadMode.ONLY_LATEST) or reload_all or processed is None:
        return files
    state = processed.select("file_name", F.col("last_modified_timestamp").alias("_seen"))
    joined = files.join(state, "file_name", "left")
    keep = F.col("_seen").isNull()
    if mode == ReadMode.ONLY_CHANGED:
        keep = keep | (F.col("modification_time") > F.col("_seen"))
    return joined.where(keep).drop("_seen")


def files_per_day(selected: DataFrame) -> DataFrame:
    """Selected files grouped by date (A11): count and first/last file name. The file
    list itself stays in the listing frame (join on ``file_date``), so a day with very
    many files is never gathered into one row."""
    return selected.groupBy("file_date").agg(
        F.count(F.lit(1)).alias("n_files"), F.min("file_name").alias("first_file"), F.max("file_name").alias("last_file")
    )
