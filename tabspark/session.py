"""Session helpers.

Cluster settings (shuffle partitions, executor memory, checkpoint folder) come
from the cluster's own configuration. ``get_session`` only fills gaps, so a
job submitted to a real cluster keeps whatever the operator configured.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession

# Settings every job relies on; applied only when the session lacks them.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app_name: str = "tabspark",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, creating a local one for tests and benches."""
    active = SparkSession.getActiveSession()
    if active is not None:
        _apply_defaults(active)
        return active
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    _apply_defaults(spark)
    return spark


def _apply_defaults(spark: SparkSession) -> None:
    for key, value in _DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the setting is absent and the master is local a scratch folder is
    created and registered; a cluster without the setting raises.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="tabspark-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), name)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts lineage (a lost executor recomputes from the written files, not from
    the raw input) and lets several consumers share one computation. Each call
    writes a fresh directory; nothing is deleted.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)


def cluster_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings to pass at submit time for a given input size and cluster.

    Shuffle partitions start at the larger of 3 x cores and input/256 MB, so
    no shuffle partition has to hold more than ~256 MB before AQE coalesces
    small ones back; file splits stay at 256 MB; AQE splits skewed join
    partitions. The session never overrides values the cluster already set.
    """
    parts = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def materialize_observed(df: DataFrame, name: str, *exprs) -> tuple[DataFrame, dict]:
    """``materialize`` plus aggregates observed on the same write (no extra job)."""
    obs = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    out = materialize(df.observe(obs, *exprs), name)
    return out, obs.get
