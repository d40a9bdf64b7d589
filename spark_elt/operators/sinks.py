"""Sinks and table maintenance.

Targets are parquet directories (optionally registered as catalog tables). Writes
use Spark's commit protocol, so a failed or retried job never leaves partial files;
overwrites only ever replace what they name (dynamic partition overwrite on
partitioned targets)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_elt.functions import day_id


def append_load(df: DataFrame, target: str, schema_of: DataFrame | None = None, fmt: str = "parquet") -> None:
    """Append rows positionally to an existing table (K01), as COPY FROM does: the
    i-th column goes to the i-th target column. The column count must match."""
    if schema_of is not None:
        tcols = schema_of.columns
        if len(tcols) != len(df.columns):
            raise ValueError(f"column count {len(df.columns)} does not match target ({len(tcols)})")
        df = df.select(*[F.col(c).cast(schema_of.schema[t].dataType).alias(t) for c, t in zip(df.columns, tcols)])
    df.write.mode("append").format(fmt).save(target)


def insert_into(spark: SparkSession, df: DataFrame, table_name: str) -> None:
    """Positional append into a catalog table."""
    df.write.insertInto(table_name)


def load_by_day(df: DataFrame, date_col: str, target: str, truncate: bool = False, fmt: str = "parquet") -> DataFrame:
    """Load into daily partitions ``day_id=yyyymmdd`` (K03). With ``truncate`` the
    days present in ``df`` are replaced and every other day is left as it is (K04,
    dynamic partition overwrite on the path write)."""
    out = df.withColumn("day_id", day_id(F.col(date_col)))
    w = out.write.format(fmt).partitionBy("day_id")
    if truncate:
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode("append")
    w.save(target)
    return out


def write_file(df: DataFrame, path: str, fmt: str = "csv", single_file: bool = False, mode: str = "overwrite",
               **options) -> None:
    """Write a query result to files (K02). ``single_file`` gives one part file
    (coalesce(1): only for results known to be small)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).format(fmt).options(**options).save(path)


def analyze(spark: SparkSession, table_name: str, partition: dict | None = None) -> None:
    """Compute table statistics for the optimizer."""
    spec = ""
    if partition:
        spec = " PARTITION(" + ", ".join(f"{k}={v!r}" if isinstance(v, str) else f"{k}={v}" for k, v in partition.items()) + ")"
    spark.sql(f"ANALYZE TABLE {table_name}{spec} COMPUTE STATISTICS")


def empty_clone(df: DataFrame) -> DataFrame:
    """An empty frame with the schema of ``df``."""
    return df.where(F.lit(False))


def truncate_reload(df: DataFrame, target: str, fmt: str = "parquet") -> None:
    """Full reload: replace the whole target."""
    df.write.mode("overwrite").format(fmt).save(target)


def run_statements(spark: SparkSession, statements: Sequence[str]) -> None:
    for s in statements:
        spark.sql(s)


def load_with_hooks(spark: SparkSession, load, before: Sequence[str] = (), after: Sequence[str] = ()):
    """Run SQL statements around a load (K09): ``before`` first, then the load, then
    ``after`` (only when the load succeeded)."""
    run_statements(spark, before)
    result = load()
    run_statements(spark, after)
    return result


def write_jdbc(df: DataFrame, url: str, table_name: str, mode: str = "append", num_partitions: int | None = None,
               **options) -> None:
    """Copy to another database (K08): one connection per write partition."""
    out = df.repartition(num_partitions) if num_partitions else df
    out.write.format("jdbc").option("url", url).option("dbtable", table_name).options(**options).mode(mode).save()
