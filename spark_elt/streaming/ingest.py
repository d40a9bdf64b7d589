"""Structured Streaming forms of file tracking, incremental copy and the run-log fold.

* I12 ``ingest_new_files``: the file stream source keeps the set of files it has
  read in its checkpoint, which is exactly the processed-file state of ONLY_NEW.
  ``Trigger.AvailableNow`` reads what is new and stops, like one scheduled load.
  (Rewritten files are not re-read by the file source; ONLY_CHANGED stays batch.)
* I13 ``stream_upsert``: every micro-batch is deduplicated (newest per key) and
  upserted into the target with the staged upsert, which rewrites only the target
  partitions the batch touches and keeps a stored row that is newer. The staging of a
  batch is named by its batch id; an upsert is idempotent, so a replayed batch changes
  nothing.
* I17 ``stream_fold_node_runs``: node events folded per (run, path) in each batch and
  merged with the stored rows of the touched keys (an idempotent min/last fold), then
  upserted the same way; no state store, so state does not grow with the number of
  runs. Unfinished nodes keep NULL end and status until their finish arrives.

The checkpoint folder of every query lives under the session's checkpoint root.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spark_elt.operators.incremental import latest_per_key, upsert
from spark_elt.operators.key_index import upsert_indexed
from spark_elt.session import ship_code
from spark_elt.sources import file_system


def ingest_new_files(spark: SparkSession, source_dir: str, schema: StructType | str, sink_dir: str,
                     checkpoint: str, fmt: str = "csv", glob: str = "*.csv", max_files_per_trigger: int | None = None,
                     **options) -> None:
    """Load the files of ``source_dir`` that this query has not loaded before.

    ``max_files_per_trigger`` splits a large backlog into several micro-batches
    (``availableNow`` still processes all of it, batch by batch)."""
    ship_code(spark)
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(source_dir)
    q = (
        stream.writeStream.format("parquet").option("path", sink_dir).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()


def _upsert_batch(spark: SparkSession, delta: DataFrame, target_path: str, keys: Sequence[str], staging_root: str,
                  batch_id: int, partition_by: Sequence[str] | None, version: str | None = None) -> None:
    """Apply one micro-batch by the staged upsert (only partitions the batch touches are
    rewritten; the first batch creates the target). Upserting the same delta twice gives
    the same table, and a staging that a failed batch left complete is finished when the
    batch is replayed, so a replay is harmless. A finished batch leaves no staging."""
    upsert(spark, target_path, delta, keys, f"{staging_root.rstrip('/')}/batch={batch_id}",
           partition_by=partition_by, resume=True, version=version)


def stream_upsert(spark: SparkSession, source: DataFrame, target_path: str, keys: Sequence[str], order_by: str,
                  checkpoint: str, staging_root: str, partition_by: Sequence[str] | None = None, indexed: bool = False) -> None:
    """Upsert every micro-batch of ``source`` into ``target_path`` by ``keys`` (I13). The
    newest row per key (``order_by``) wins, within a batch and against the stored row,
    so the target keeps ``order_by``. With ``indexed`` a batch reads and replaces only files
    that may hold its keys, by the target's key index (``operators.key_index``)."""
    ship_code(spark)

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        delta = latest_per_key(batch, keys, order_by)
        if indexed:
            upsert_indexed(spark, target_path, delta, keys, f"{staging_root.rstrip('/')}/batch={batch_id}", partition_by,
                           version=order_by, resume=True)
            return
        _upsert_batch(spark, delta, target_path, keys, staging_root, batch_id, partition_by, version=order_by)

    q = (
        source.writeStream.foreachBatch(upsert_batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()


def _fold_rows(rows: DataFrame) -> DataFrame:
    """Node runs from partial node runs of the same key (min start, last finish)."""
    fin = F.when(F.col("end_time").isNotNull(), F.struct("end_time", "succeeded"))
    return rows.groupBy("run_id", "path_key").agg(
        F.min("node_run_id").alias("node_run_id"),
        F.min("start_time").alias("start_time"),
        F.max(fin).alias("fin"),
        F.max("is_pipeline").alias("is_pipeline"),
    ).select("node_run_id", "run_id", "path_key", "start_time", F.col("fin.end_time").alias("end_time"),
             F.col("fin.succeeded").alias("succeeded"), "is_pipeline")


def stream_fold_node_runs(spark: SparkSession, events: DataFrame, target_path: str, checkpoint: str,
                          staging_root: str, runs_per_partition: int = 1000) -> None:
    """Fold a stream of NodeStarted / NodeFinished events into node runs.

    No streaming state is kept: each micro-batch is folded per (run, path), the
    stored rows of the keys it touches are folded in again (min start, last finish;
    both are idempotent, so a replayed batch or events arriving out of order give
    the same row), and the result is upserted. The node-run table is the state, so
    nothing grows in executor memory with the number of runs.

    The table is partitioned by ``run_block = run_id // runs_per_partition``. Run ids
    are serial, so a batch (recent runs) touches few blocks: only those are read
    (static partition pruning on the touched block list) and rewritten."""
    ship_code(spark)
    keys = ["run_id", "path_key"]
    ev = F.col("event")

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        part = (
            batch.where(ev.isin("NodeStarted", "NodeFinished"))
            .select(
                F.when(ev == "NodeStarted", F.col("seq")).alias("node_run_id"),
                "run_id", "path_key",
                F.when(ev == "NodeStarted", F.col("ts")).alias("start_time"),
                F.when(ev == "NodeFinished", F.col("ts")).alias("end_time"),
                F.when(ev == "NodeFinished", F.col("succeeded")).alias("succeeded"),
                F.when(ev == "NodeStarted", F.col("is_pipeline")).alias("is_pipeline"),
            )
        )
        block = F.floor(F.col("run_id") / runs_per_partition).cast("long")
        part = _fold_rows(part).withColumn("run_block", block)
        if file_system.has_data(spark, target_path):
            # touched blocks: at most one value per partition of the table
            blocks = [r[0] for r in part.select("run_block").distinct().collect()]
            stored = (
                spark.read.parquet(target_path).where(F.col("run_block").isin(blocks))
                .join(part.select(*keys), keys, "left_semi")
            )
            part = _fold_rows(stored.drop("run_block").unionByName(part.drop("run_block"))).withColumn("run_block", block)
        _upsert_batch(spark, part, target_path, keys, staging_root, batch_id, ["run_block"])

    q = (
        events.writeStream.foreachBatch(upsert_batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
