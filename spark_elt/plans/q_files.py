"""Registered file-load queries.

Each query first writes its own input files from ``events`` into a fresh scratch
directory under the session's checkpoint folder (daily CSV files, compressed
variants, archives), then loads them with the library and returns what was loaded.
The oracle is plain SQL on ``events``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_elt.operators import incremental as inc
from spark_elt.operators import sinks
from spark_elt.plans.registry import register
from spark_elt.session import scratch_dir, table
from spark_elt.sources import archives
from spark_elt.sources.files import Compression, list_files, read_delimited
from spark_elt.sources.loads import FileLoad, parallel_read_file, read_selected, select
from spark_elt.sources.selection import ReadMode, file_date_of_path, files_per_day, select_files

SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DATE_REGEX = r"y=(\d{4})/m=(\d{2})/d=(\d{2})/"
EV_D = "SELECT event_id, ts, user_id, event_type, value FROM events"


def _events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")


def write_daily_csv(spark: SparkSession, sf_dir: str, label: str, df: DataFrame | None = None, **options) -> str:
    """Events as CSV, one directory per day ``y=YYYY/m=MM/d=DD``. Rows are range
    partitioned by time first, so a day with very many rows is written by several
    tasks (several files in its directory) instead of one."""
    root = scratch_dir(spark, label)
    df = df if df is not None else _events(spark, sf_dir)
    opts = {"timestampNTZFormat": TS_FMT, "header": "false"}
    opts.update(options)
    (
        df.withColumn("y", F.date_format("ts", "yyyy")).withColumn("m", F.date_format("ts", "MM"))
        .withColumn("d", F.date_format("ts", "dd"))
        .repartitionByRange("ts")
        .write.partitionBy("y", "m", "d").options(**opts).csv(root)
    )
    return root


def _load(spark, root, mode=ReadMode.ALL, state=None, first_date=dt.date(2000, 1, 1), dependencies=None, files=(),
          by_day=False, **options) -> DataFrame:
    """Load the daily files of ``root`` with the library's file load and read the target."""
    load = FileLoad(
        root, "*.csv*", SCHEMA, scratch_dir(spark, "loaded"), ["load_events"], state=state, dependencies=dependencies,
        file_dependencies=files, mode=mode, date_regex=DATE_REGEX, first_date=first_date, options=options, by_day=by_day,
    )
    parallel_read_file(spark, load, dt.datetime(2024, 1, 2))
    schema = SCHEMA + (", day_id int" if by_day else "")
    return spark.read.schema(schema).parquet(load.target)


_TS_OPTS = {"timestampNTZFormat": TS_FMT}


@register("read_file_csv", EV_D)
def read_file_csv(spark, sf_dir):
    root = write_daily_csv(spark, sf_dir, "read_file_csv")
    return _load(spark, root)


@register(
    "read_file_options",
    "SELECT event_id, ts, user_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS event_type, value FROM events",
)
def read_file_options(spark, sf_dir):
    e = _events(spark, sf_dir).withColumn(
        "event_type", F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("event_type"))
    )
    root = write_daily_csv(spark, sf_dir, "read_file_options", e, sep="|", quote="'", nullValue="\\N", header="true")
    return _load(spark, root, sep="|", quote="'", null_value="\\N", header=True)


@register("read_file_timezone", "SELECT event_id, ts - INTERVAL 1 HOUR AS ts, user_id, event_type, value FROM events")
def read_file_timezone(spark, sf_dir):
    """Timestamps written as Berlin wall-clock time (UTC+1 in January) load as UTC."""
    root = write_daily_csv(spark, sf_dir, "read_file_timezone")
    return _load(spark, root, timezone="Europe/Berlin")


@register("read_file_gzip", EV_D)
def read_file_gzip(spark, sf_dir):
    root = write_daily_csv(spark, sf_dir, "read_file_gzip", compression="gzip")
    return _load(spark, root, compression=Compression.GZIP)


def _archive_query(spark, sf_dir, kind: str) -> DataFrame:
    src = write_daily_csv(spark, sf_dir, f"src_{kind}")
    listing = list_files(spark, src, "*.csv")
    # one archive per written file (each file came from one bounded task), named by day and part
    days = listing.withColumn(
        "day", F.concat_ws("_", F.regexp_extract("file_name", r"d=(\d{2})", 1),
                           F.regexp_extract("file_name", r"part-(\d+)", 1))
    )
    target = scratch_dir(spark, f"archives_{kind}")
    done = archives.pack(spark, days, "day", target, kind).collect()  # one row per archive (a file list)
    paths = sorted(r["archive"] for r in done)
    comp = Compression.ZIP if kind == "zip" else Compression.TAR_GZIP
    return read_delimited(spark, paths, SCHEMA, compression=comp)


@register("read_file_zip", EV_D)
def read_file_zip(spark, sf_dir):
    return _archive_query(spark, sf_dir, "zip")


@register("read_file_tar_gzip", EV_D)
def read_file_tar_gzip(spark, sf_dir):
    return _archive_query(spark, sf_dir, "tar")


@register("read_file_mapper", "SELECT event_id, ts, user_id, upper(event_type) AS event_type, value FROM events")
def read_file_mapper(spark, sf_dir):
    root = write_daily_csv(spark, sf_dir, "read_file_mapper")
    return _load(spark, root, mapper=lambda s: s.str.upper())


@register("read_file_make_unique", "SELECT DISTINCT event_id, ts, user_id, event_type, value FROM events")
def read_file_make_unique(spark, sf_dir):
    """Every line written twice, with a header line; make_unique drops the copies."""
    e = _events(spark, sf_dir)
    root = write_daily_csv(spark, sf_dir, "read_file_make_unique", e.unionAll(e), header="true")
    return _load(spark, root, header=True, make_unique=True)


@register(
    "parallel_read_files_all",
    "SELECT event_id, ts, user_id, event_type, value, strftime(ts, '%Y-%m-%d') AS file_date FROM events",
)
def parallel_read_files_all(spark, sf_dir):
    """All daily files in one scan; each row's file date comes from its own
    file path (no join of the rows with the listing)."""
    load = FileLoad(write_daily_csv(spark, sf_dir, "parallel_read_all"), "*.csv", SCHEMA, "", ["load_events"], date_regex=DATE_REGEX)
    df = read_selected(spark, load, select(spark, load))
    day = file_date_of_path(F.col("file"), load.root, DATE_REGEX)
    return df.withColumn("file_date", F.date_format(day, "yyyy-MM-dd")).drop("file")


@register(
    "file_dates",
    "SELECT strftime(ts, '%Y-%m-%d') AS file_date, CAST(count(*) AS BIGINT) AS n_rows FROM events GROUP BY 1",
)
def file_dates(spark, sf_dir):
    load = FileLoad(write_daily_csv(spark, sf_dir, "file_dates"), "*.csv", SCHEMA, "", ["load_events"], date_regex=DATE_REGEX)
    df = read_selected(spark, load, select(spark, load))
    day = F.date_format(file_date_of_path(F.col("file"), load.root, DATE_REGEX), "yyyy-MM-dd")
    return df.groupBy(day.alias("file_date")).agg(F.count(F.lit(1)).alias("n_rows"))


@register("file_first_date", EV_D + " WHERE ts >= TIMESTAMP '2024-01-15'")
def file_first_date(spark, sf_dir):
    root = write_daily_csv(spark, sf_dir, "file_first_date")
    return _load(spark, root, first_date=dt.date(2024, 1, 15))


@register("read_only_latest", EV_D + " WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)")
def read_only_latest(spark, sf_dir):
    root = write_daily_csv(spark, sf_dir, "read_only_latest")
    return _load(spark, root, ReadMode.ONLY_LATEST)


def _state_until(spark, root: str, last_day: int, node=("load_events",)) -> inc.StateTable:
    """Processed-file state in which the files up to ``last_day`` were loaded before."""
    st = inc.StateTable(spark, scratch_dir(spark, "processed_file"), inc.PROCESSED_FILE, ["node_path", "file_name"])
    listing = select_files(list_files(spark, root, "*.csv"), ReadMode.ALL, date_regex=DATE_REGEX)
    inc.track_processed(st, list(node), listing.where(F.dayofmonth("file_date") <= last_day))
    return st


@register("read_only_new", EV_D + " WHERE ts >= TIMESTAMP '2024-01-11'")
def read_only_new(spark, sf_dir):
    root = write_daily_csv(spark, sf_dir, "read_only_new")
    st = _state_until(spark, root, 10)
    return _load(spark, root, ReadMode.ONLY_NEW, st)


@register("read_only_changed", EV_D + " WHERE ts >= TIMESTAMP '2024-01-21' OR day(ts) IN (3, 4)")
def read_only_changed(spark, sf_dir):
    """Files of days 3 and 4 were modified after they were recorded (their recorded
    time is older than the file's); days 21+ were never loaded."""
    root = write_daily_csv(spark, sf_dir, "read_only_changed")
    st = _state_until(spark, root, 20)
    older = F.when(F.col("file_name").rlike(r"d=0[34]/"), F.expr("INTERVAL 1 HOUR")).otherwise(F.expr("INTERVAL 0 HOUR"))
    st.replace(st.read().withColumn("last_modified_timestamp", F.col("last_modified_timestamp") - older))
    return _load(spark, root, ReadMode.ONLY_CHANGED, st)


@register(
    "read_only_new_except_latest",
    EV_D + " WHERE ts >= TIMESTAMP '2024-01-11' AND CAST(ts AS DATE) < (SELECT max(CAST(ts AS DATE)) FROM events)",
)
def read_only_new_except_latest(spark, sf_dir):
    root = write_daily_csv(spark, sf_dir, "read_only_new_except_latest")
    st = _state_until(spark, root, 10)
    return _load(spark, root, ReadMode.ONLY_NEW_EXCEPT_LATEST, st)


@register("read_dependency_reload", EV_D)
def read_dependency_reload(spark, sf_dir):
    """The loader's code dependency changed, so the processed-file state is
    ignored and all files are read; the new hash is stored after the load."""
    root = write_daily_csv(spark, sf_dir, "read_dependency_reload")
    st = _state_until(spark, root, 10)
    deps = inc.StateTable(spark, scratch_dir(spark, "file_dependency"), inc.FILE_DEPENDENCY, ["node_path", "dependency_type"])
    inc.update_dependency(deps, ["load_events"], "ParallelReadFile", "2000-01-01 None old-hash", dt.datetime(2024, 1, 1))
    out = _load(spark, root, ReadMode.ONLY_NEW, st, dependencies=deps, files=[__file__])
    assert not inc.is_modified(deps, ["load_events"], "ParallelReadFile", inc.dependency_hash([__file__], dt.date(2000, 1, 1)))
    return out


def _one_file_a_day(spark, sf_dir, label) -> str:
    """The event ids of each day as the lines of one text file."""
    root = scratch_dir(spark, label)
    lines = _events(spark, sf_dir).select(F.col("event_id").cast("string").alias("value"), "event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    lines.repartition(8, "day").sortWithinPartitions("day", "event_id").select("value", "day").write.partitionBy("day").text(root)
    return root


@register(
    "files_per_day",
    """SELECT strftime(ts, '%Y-%m-%d') AS file_date, CAST(1 AS BIGINT) AS n_files,
       'day=' || strftime(ts, '%Y-%m-%d') AS first_folder, 'day=' || strftime(ts, '%Y-%m-%d') AS last_folder
FROM events GROUP BY ts::DATE, 1, 3, 4""".replace("GROUP BY ts::DATE, 1, 3, 4", "GROUP BY ALL"),
)
def files_per_day_q(spark, sf_dir):
    """The selected files grouped by their date."""
    root = _one_file_a_day(spark, sf_dir, "files_per_day")
    sel = select_files(list_files(spark, root, "day=*/*.txt"), ReadMode.ALL, date_regex=r"day=(\d{4})-(\d{2})-(\d{2})/")
    return files_per_day(sel).select(
        F.date_format("file_date", "yyyy-MM-dd").alias("file_date"),
        F.col("n_files").cast("bigint").alias("n_files"),
        F.split("first_file", "/")[0].alias("first_folder"),
        F.split("last_file", "/")[0].alias("last_folder"),
    )


@register(
    "file_listing",
    """SELECT 'day=' || strftime(ts, '%Y-%m-%d') AS folder, CAST(sum(length(CAST(event_id AS VARCHAR)) + 1) AS BIGINT) AS length,
       md5(string_agg(event_id || chr(10), '' ORDER BY event_id)) AS md5
FROM events GROUP BY 1""",
)
def file_listing(spark, sf_dir):
    """Listing with relative name, size and md5 of the content."""
    root = _one_file_a_day(spark, sf_dir, "file_listing")
    listing = list_files(spark, root, "*.txt")
    hashes = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(
        "path", F.md5("content").alias("md5")
    )
    return listing.join(hashes, "path").select(F.split("file_name", "/")[0].alias("folder"), "length", "md5")


# ---------------------------------------------------------------- sinks

@register(
    "load_by_day_id",
    """SELECT CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS day_id, CAST(count(*) AS BIGINT) AS n,
       round(sum(value), 2) AS total FROM events GROUP BY 1""",
)
def load_by_day_id(spark, sf_dir):
    """Partitions by the date of the file that a row came from."""
    back = _load(spark, write_daily_csv(spark, sf_dir, "load_by_day"), by_day=True)
    return back.groupBy("day_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@register(
    "load_by_day_id_truncate",
    """SELECT CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS day_id, CAST(count(*) AS BIGINT) AS n,
       round(sum(CASE WHEN day(ts) IN (5, 6) THEN value * 2 ELSE value END), 2) AS total FROM events GROUP BY 1""",
)
def load_by_day_id_truncate(spark, sf_dir):
    """Days 5 and 6 are reloaded with changed values; the other days stay as loaded."""
    target = scratch_dir(spark, "load_by_day_truncate")
    e = _events(spark, sf_dir)
    sinks.load_by_day(e, "ts", target)
    again = e.where(F.dayofmonth("ts").isin(5, 6)).withColumn("value", F.col("value") * 2)
    sinks.load_by_day(again, "ts", target, truncate=True)
    back = spark.read.parquet(target)
    return back.groupBy("day_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@register("append_load", EV_D + " UNION ALL " + EV_D + " WHERE event_type = 'view'")
def append_load(spark, sf_dir):
    """Positional appends: the second load has other column names, same order."""
    target = scratch_dir(spark, "append_load")
    e = _events(spark, sf_dir)
    e.write.parquet(target)
    renamed = e.where(F.col("event_type") == "view").toDF("a", "b", "c", "d", "e")
    sinks.append_load(renamed, target, schema_of=spark.read.parquet(target))
    return spark.read.parquet(target)


def _write_read_back(spark, sf_dir, label, sep):
    path = scratch_dir(spark, label)
    q = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit(" "), F.col("c_name"), F.lit("\t,")).alias("c_name"), "c_acctbal"
    )
    sinks.write_file(q, path, "csv", single_file=False, sep=sep, header="false", ignoreLeadingWhiteSpace="false",
                     ignoreTrailingWhiteSpace="false", quoteAll="false")
    return spark.read.schema("c_custkey bigint, c_name string, c_acctbal double").options(
        sep=sep, header="false", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path)


_WF_D = "SELECT c_custkey, ' ' || c_name || chr(9) || ',' AS c_name, c_acctbal FROM customer"


@register("write_file_csv", _WF_D)
def write_file_csv(spark, sf_dir):
    return _write_read_back(spark, sf_dir, "write_file_csv", ",")


@register("write_file_tsv", _WF_D)
def write_file_tsv(spark, sf_dir):
    return _write_read_back(spark, sf_dir, "write_file_tsv", "\t")


@register("truncate_reload", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def truncate_reload(spark, sf_dir):
    target = scratch_dir(spark, "truncate_reload")
    o = table(spark, sf_dir, "orders")
    sinks.truncate_reload(o, target)
    sinks.truncate_reload(o.where(F.col("o_orderstatus") == "F"), target)
    return spark.read.parquet(target)


@register("empty_clone", "SELECT * FROM orders WHERE FALSE")
def empty_clone(spark, sf_dir):
    target = scratch_dir(spark, "empty_clone")
    sinks.empty_clone(table(spark, sf_dir, "orders")).write.parquet(target)
    return spark.read.parquet(target)


@register(
    "load_with_hooks",
    "SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY o_orderstatus",
)
def load_with_hooks(spark, sf_dir):
    """A statement before the load creates the summary view the load reads;
    the statement after it drops the view again."""
    import uuid

    view = f"orders_{uuid.uuid4().hex[:8]}"
    target = scratch_dir(spark, "load_with_hooks")
    before = [f"CREATE TEMPORARY VIEW {view} AS SELECT * FROM parquet.`{sf_dir}/orders.parquet`"]
    after = [f"DROP VIEW {view}"]
    sinks.load_with_hooks(
        spark,
        lambda: spark.sql(f"SELECT o_orderstatus, count(*) AS n FROM {view} GROUP BY o_orderstatus").write.parquet(target),
        before,
        after,
    )
    return spark.read.parquet(target)
