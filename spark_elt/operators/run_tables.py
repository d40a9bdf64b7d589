"""The four run-log tables as one stored set (I18, I19): one commit changes all of them.

Rows lie in Parquet folders by the day on which their run started (statistics: the day of the
sample). A manifest names the folders of all four tables; a change writes new folders first and
then the next manifest, whose number is claimed. A crash at any step leaves the last manifest in
force, so readers see all four tables before the change or all four after it.

Retention drops the folders of days that are old as a whole by leaving them out of the manifest,
and rewrites only those of the day that the limit falls into. ``clean`` deletes folders that the
last two manifests do not name.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spark_elt.operators.incremental import CLAIM_SECONDS, StateChanged
from spark_elt.operators.runlog import close_open_runs, retention_prune
from spark_elt.sources import file_system

TABLES = ("run", "node_run", "node_output", "system_statistics")
#: Folder of rows without a day: their run is unknown or has no start. They are never old.
NO_DAY = "none"


class RunTables:
    """Stored run, node_run, node_output and system_statistics under one manifest."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ------------------------------------------------------------ reading

    def version(self) -> int:
        """Number of the manifest in force, 0 before the first."""
        names = file_system.children(self.spark, f"{self.path}/manifests")
        return max((int(n[:-5]) for n in names if n.endswith(".json")), default=0)

    def _manifest(self, version: int) -> dict:
        if not version:
            return {"schemas": {}, "folders": {t: [] for t in TABLES}}
        return json.loads(file_system.read_text(self.spark, f"{self.path}/manifests/{version}.json"))

    def read(self, *tables: str) -> tuple[DataFrame, ...]:
        """The named tables (all four without names) as one manifest has them."""
        manifest = self._manifest(self.version())
        return tuple(self._rows(manifest, t) for t in tables or TABLES)

    def _rows(self, manifest: dict, table: str, days: set[str] | None = None) -> DataFrame:
        if table not in manifest["schemas"]:
            raise ValueError(f"{table} has no rows yet")
        schema = StructType.fromJson(manifest["schemas"][table])
        paths = [f"{self.path}/{f}" for f, day in manifest["folders"][table] if days is None or day in days]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    # ------------------------------------------------------------ changes

    def append(self, run: DataFrame, node_run: DataFrame, node_output: DataFrame, stats: DataFrame) -> None:
        """Add rows to the four tables. Node runs and output go to the day of their run, which
        may be stored already; the days of stored runs are read by their keys only. A row that
        comes before the run or node run it belongs to counts as one without a run."""
        base = self.version()
        old = self._manifest(base)
        runs = run.select("run_id", _day("start_time"))
        nodes = node_run.select("node_run_id", "run_id")
        if base:
            runs = runs.unionByName(self._rows(old, "run").select("run_id", _day("start_time")))
            nodes = nodes.unionByName(self._rows(old, "node_run").select("node_run_id", "run_id"))
        # a run's one day: pre-aggregated, so rows that come twice add none
        run_days = runs.groupBy("run_id").agg(F.min("day_of_run").alias("day_of_run"))
        node_days = nodes.join(run_days, "run_id").groupBy("node_run_id").agg(F.min("day_of_run").alias("day_of_run"))
        known = F.coalesce("day_of_run", F.lit(NO_DAY)).alias("day_of_run")
        frames = {
            "run": run.withColumn("day_of_run", _day("start_time")),
            "node_run": node_run.join(run_days, "run_id", "left").select(*node_run.columns, known),
            "node_output": node_output.join(node_days, "node_run_id", "left").select(*node_output.columns, known),
            "system_statistics": stats.withColumn("day_of_run", _day("timestamp")),
        }
        folders = {t: old["folders"][t] + self._write(t, frames[t]) for t in TABLES}
        plain = {t: frames[t].drop("day_of_run").schema.jsonValue() for t in TABLES}
        self._commit(base, {"schemas": {**plain, **old["schemas"]}, "folders": folders})

    def close_open_runs(self, run_id: int, now: dt.datetime) -> None:
        """Close the run and its open node runs as failed at ``now`` (I18). Only the folders of
        the run's day are rewritten."""
        base = self.version()
        old = self._manifest(base)
        found = self._rows(old, "run").where(F.col("run_id") == run_id).select(_day("start_time")).distinct()
        days = {r[0] for r in found.collect()}  # a run starts once
        new = {t: close_open_runs(self._rows(old, t, days), run_id, now) for t in ("run", "node_run")}
        self._rewrite(base, old, days, new)

    def prune(self, days: int, now: dt.datetime) -> None:
        """Retention (I19): runs that started more than ``days`` days before ``now``, with their
        node runs and output, and as old statistics, leave the tables."""
        base = self.version()
        old = self._manifest(base)
        limit = (now - dt.timedelta(days=days)).date().isoformat()
        kept = {**old, "folders": {t: [f for f in old["folders"][t] if f[1] == NO_DAY or f[1] >= limit] for t in TABLES}}
        whole = [self._rows(kept, t, {limit}) for t in TABLES]
        self._rewrite(base, kept, {limit}, dict(zip(TABLES, retention_prune(*whole, days, now))))

    def clean(self) -> None:
        """Delete data that neither the manifest in force nor the one before it names."""
        version = self.version()
        named = {f for v in (version, version - 1) if v > 0 for t in TABLES for f, _ in self._manifest(v)["folders"][t]}
        for table in TABLES:
            for load in file_system.children(self.spark, f"{self.path}/{table}"):
                for part in file_system.children(self.spark, f"{self.path}/{table}/{load}"):
                    if "=" in part and f"{table}/{load}/{part}" not in named:
                        file_system.delete(self.spark, f"{self.path}/{table}/{load}/{part}")

    # ------------------------------------------------------------ storage

    def _rewrite(self, base: int, manifest: dict, days: set[str], frames: dict[str, DataFrame]) -> None:
        """Commit ``manifest`` with ``frames`` in place of the folders of ``days``; each such
        day's rows stay in it, so a frame of several days keeps them apart by their folders."""
        folders = dict(manifest["folders"])
        for table, rows in frames.items():
            rest = [f for f in folders[table] if f[1] not in days]
            if len(rest) < len(folders[table]):
                day = next(iter(days)) if len(days) == 1 else None
                placed = rows.withColumn("day_of_run", F.lit(day) if day else _day("start_time"))
                folders[table] = rest + self._write(table, placed)
        self._commit(base, {**manifest, "folders": folders})

    def _write(self, table: str, rows: DataFrame) -> list[list[str]]:
        """Write rows to new folders by day; their names and days."""
        load = f"{table}/{uuid.uuid4().hex}"
        rows.write.partitionBy("day_of_run").parquet(f"{self.path}/{load}")
        parts = [n for n in file_system.children(self.spark, f"{self.path}/{load}") if n.startswith("day_of_run=")]
        return [[f"{load}/{n}", n.partition("=")[2]] for n in sorted(parts)]

    def _commit(self, base: int, manifest: dict) -> None:
        """Put ``manifest`` in force as the one after ``base``, if no one else has. The claim of a
        writer that is gone is taken over after a while."""
        claim = f"{self.path}/manifests/_claim-{base + 1}"
        if not file_system.create_new(self.spark, claim) and file_system.age(self.spark, claim) < CLAIM_SECONDS:
            raise StateChanged(f"manifest {base + 1} of {self.path} is being written by another job")
        if self.version() != base:
            raise StateChanged(f"{self.path} has changed since manifest {base}")
        try:
            file_system.write_text(self.spark, f"{self.path}/manifests/{base + 1}.json", json.dumps(manifest))
        finally:
            file_system.delete(self.spark, claim)


def _day(time: str) -> Column:
    return F.coalesce(F.date_format(time, "yyyy-MM-dd"), F.lit(NO_DAY)).alias("day_of_run")
