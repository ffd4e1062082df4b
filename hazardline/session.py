"""Spark session helpers.

Every result depends on the session time zone being UTC (the reference forces
its warehouse session to UTC), so jobs call :func:`ensure_utc` before building
plans.  Nothing here keeps global state.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "hazardline") -> SparkSession:
    """Session used by tests and the benchmark (a cluster supplies its own)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def scale_settings(scoped_input_bytes: int, total_cores: int,
                   partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Runtime SQL settings sized for a cluster run.

    ``scoped_input_bytes`` is the size of what the request reads after its
    knowledge-time and date filters (deliveries + status rows of the windows),
    not the whole lake.  Initial shuffle partitions aim at ~256 MB each (at
    least 2 per core); AQE then coalesces small ones and splits skewed ones.
    """
    parts = max(2 * total_cores, -(-scoped_input_bytes // partition_bytes))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(2 * partition_bytes),
        # AQE broadcasts a join side only after measuring it below this size
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def ensure_utc(spark: SparkSession) -> None:
    """Force the settings every operator relies on (idempotent)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by the cluster for written intermediate tables.

    Read from ``spark.checkpoint.dir`` (session conf, then the context); only
    when neither is set (local tests) is a scratch folder created and
    registered as the checkpoint dir.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
        if d:
            # the context appends its own uuid folder; use its parent
            d = d.rsplit("/", 1)[0]
    if not d and not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="hazardline-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/hazardline/{name}-{uuid.uuid4().hex}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for local file checks."""
    return path[5:] if path.startswith("file:") else path


__all__ = ["build_session", "ensure_utc", "shared_dir", "scratch_path", "local_path", "scale_settings"]
