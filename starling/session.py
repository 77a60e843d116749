"""Spark session defaults for the engine.

Settings that matter at scale:
* UTC session time zone and ANSI mode (exact decimals, no silent overflow).
* AQE on, with partition coalescing and skew-join splitting: a hot key (one
  customer / one date holding a third of the rows) is split into several
  tasks at runtime instead of landing in one.
* ``spark.checkpoint.dir`` is read from the session; a scratch directory is
  only set when the cluster has not named one (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # reliable checkpoints (dense numbering) are removed once their frames are gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "starling",
                  shuffle_partitions: int | None = None,
                  conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the engine's SQL settings to an existing session (e.g. the driver's)."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql.") and not k.startswith("spark.sql.execution.arrow"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on a running session
                pass
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint directory, setting a scratch one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: the server owns the checkpoint dir
        return None
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # a machine-local folder is not visible to other executors
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on this cluster")
        # local runs / tests only: the cluster names a shared folder itself
        configured = tempfile.mkdtemp(prefix="starling-ckpt-", dir=os.environ.get("STARLING_SCRATCH", "/tmp"))
    sc.setCheckpointDir(configured)
    return configured


def checkpoint_dir(spark: SparkSession) -> str | None:
    return ensure_checkpoint_dir(spark)


def cluster_conf(input_bytes: int, total_cores: int, target_shuffle_partition_bytes: int = 256 << 20,
                 max_shuffle_partitions: int = 200_000) -> dict:
    """Sizing for a job reading ``input_bytes`` on ``total_cores`` task slots.

    Initial shuffle partitions ~ input / 256 MB (at least 2 x cores, capped):
    every reduce task then holds a few hundred MB at most and AQE coalesces
    small partitions and splits skewed ones at runtime; scan splits stay at
    128 MB; size-based (not parallelism-first) coalescing on a busy cluster.
    E.g. 100 TB on 1000 executors x 8 cores -> ~200k shuffle partitions.
    """
    parts = max(2 * total_cores, min(max_shuffle_partitions, -(-input_bytes // target_shuffle_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
