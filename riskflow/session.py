"""Session set-up and shared-folder helpers.

``configure`` pins the settings the library relies on (UTC session time zone,
AQE with skew-join splitting) on any session it is handed, so the same code
behaves alike under a test session and a cluster session.

Scratch output (materialised feature tables, stream checkpoints, write-then-read
round trips) always goes below the folder the cluster names in
``spark.checkpoint.dir``; a private temporary folder is only created when that
setting is absent, as in local tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_scratch: dict[str, list[str]] = {}  # application id -> scratch paths

# Settings applied to every session handed to the library.
_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def cluster_settings(total_cores: int, shuffle_partitions_per_core: int = 3) -> dict:
    """Settings for a large cluster run (pass to ``get_session(extra=...)`` or spark-submit).

    * shuffle partitions start at a few per core; AQE coalesces small ones to the
      advisory size and splits skewed ones (a partition 5x the median and over
      256 MB) in joins;
    * scans split files into 256 MB partitions;
    * the window operator spills its per-key buffer early (a hot key's history is
      at most one row per second, but its rows are wide).
    """
    return {
        "spark.sql.shuffle.partitions": str(max(200, total_cores * shuffle_partitions_per_core)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 * 1024),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.windowExec.buffer.spill.threshold": str(1 << 20),
        "spark.sql.parquet.filterPushdown": "true",
    }


def get_session(master: str | None = None, app: str = "riskflow", shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session; ``master`` is left to spark-submit when None."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false")
    for k, v in _RUNTIME_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library depends on to ``spark``."""
    for k, v in _RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session, set to a private temp dir only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (e.g. on HDFS/S3)")
        configured = tempfile.mkdtemp(prefix="riskflow-ckpt-")  # local runs and tests only
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def unique_name(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder; ``release_scratch`` removes it."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/riskflow/{name}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Remove what ``scratch_path`` and ``materialize`` have handed out in this application (tables that were built
    on it can then no longer be read); returns how many folders were there."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    removed = 0
    for path in _scratch.pop(spark.sparkContext.applicationId, []):
        p = jvm.org.apache.hadoop.fs.Path(path)
        removed += bool(p.getFileSystem(conf).delete(p, True))
    return removed


def materialize(df, name: str, partition_by: list[str] | None = None):
    """Write ``df`` as a parquet table below the shared checkpoint folder and return it read back.

    Used where one intermediate feeds several consumers whose column sets differ
    (so Spark cannot reuse one exchange for all): computed once, columnar on
    disk, and the lineage of later jobs starts at the table, so a lost executor
    costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.parquet(path)
