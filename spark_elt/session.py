"""Session helpers: building a session, reading the driver tables, scratch space.

Scratch space always lives under the checkpoint directory the cluster names in
``spark.checkpoint.dir`` (a shared folder). Only when no such folder is set, as in
local tests, a private one is created.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def scale_conf(target_partition_mb: int = 256, initial_partitions: int = 8192) -> dict[str, str]:
    """Settings meant for large clusters (set them when the session is created):
    AQE starts from many shuffle partitions and coalesces them to ~256 MB, splits
    skewed join partitions, reads files in 256 MB splits, and keeps streaming state
    in RocksDB (off-heap, spills to local disk) instead of the JVM heap."""
    mb = f"{target_partition_mb}m"
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial_partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": mb,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": mb,
        "spark.sql.files.maxPartitionBytes": mb,
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def default_driver_memory(cap_gb: int = 16) -> str:
    """Local-mode heap: 60 % of the machine's memory, at most ``cap_gb``."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
        return f"{max(1, min(cap_gb, int(total * 0.6 / 2**30)))}g"
    except (ValueError, OSError, AttributeError):
        return "4g"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "spark_elt") -> SparkSession:
    """Session for tests and the bench (UI off, AQE on, UTC); with the settings of
    ``scale_conf`` where the master is a cluster."""
    builder = SparkSession.builder.master(master)
    if not master.startswith("local"):
        builder = builder.config(map=scale_conf())
    return (
        builder
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", default_driver_memory()))
        .getOrCreate()
    )


_SHIPPED: set[int] = set()


def ship_code(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (once per context).

    Functions handed to ``mapInPandas`` / ``applyInPandas`` / UDFs refer to this
    package; the package is zipped and added with ``addPyFile``, the usual way to
    ship code to executors."""
    sc = spark.sparkContext
    key = id(sc._jsc) if getattr(sc, "_jsc", None) is not None else id(sc)
    if key in _SHIPPED:
        return
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    fd, zpath = tempfile.mkstemp(prefix="spark_elt-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(zpath, "w") as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Catalyst prunes columns and pushes filters into this scan."""
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session. Only a local session without one, as in
    tests, gets a private folder; on a cluster a missing one is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-elt-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unique directory under the shared checkpoint folder (never reused)."""
    return f"{checkpoint_root(spark).rstrip('/')}/scratch/{label}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so that Python's own file functions accept the path."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path
