"""Writers: append, partitioned append, timestamped snapshot, create-if-absent,
schema-checked mirror append, views.

Partitioned writes use the REBALANCE hint on the partition column before
``partitionBy``: each task writes one partition directory (small partitions
are coalesced, so no explosion of tiny files), and AQE splits an oversized
partition -- a hot date holding a third of the rows -- over several tasks.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.schemas import assert_schema
from starling.sources.files import path_exists, read_parquet


def snapshot_path(lake_root: str, prefix: str, ts: _dt.datetime) -> str:
    return f"{lake_root.rstrip('/')}/{prefix}_{ts.strftime('%Y%m%d_%H%M%S')}"


def write_snapshot(df: DataFrame, lake_root: str, prefix: str, ts: _dt.datetime) -> str:
    """One timestamped Parquet snapshot per load (also written when empty); never overwrites."""
    path = snapshot_path(lake_root, prefix, ts)
    df.write.mode("errorifexists").parquet(path)
    return path


def append(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    if partition_by:
        df.hint("rebalance", partition_by).write.mode("append").partitionBy(partition_by).parquet(path)
    else:
        df.write.mode("append").parquet(path)


def append_if_any(df: DataFrame, path: str, **kw) -> bool:
    """Skip the write when there is nothing new (one-row probe)."""
    if df.isEmpty():
        return False
    append(df, path, **kw)
    return True


def append_checked(df: DataFrame, path: str, schema: T.StructType, **kw) -> bool:
    """Fixed-schema mirror append: the frame must match the declared schema exactly."""
    assert_schema(df, schema)
    return append_if_any(df, path, **kw)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Read an append-only table whose later loads may have added columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def create_if_absent(spark: SparkSession, path: str, schema: T.StructType,
                     partition_by: str | None = None) -> bool:
    """CREATE TABLE IF NOT EXISTS: an empty table with the declared schema."""
    if path_exists(spark, path):
        return False
    w = spark.createDataFrame([], schema).write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return True


def materialize(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Write once, read back: later sinks and queries see one fixed batch (cuts lineage)."""
    spark = df.sparkSession
    if partition_by:
        append(df, path, partition_by=partition_by)
    else:
        df.write.mode("overwrite").parquet(path)
    return read_parquet(spark, path)


def replace_view(df: DataFrame, name: str) -> str:
    df.createOrReplaceTempView(name)
    return name


def drop_view(spark: SparkSession, name: str) -> None:
    spark.catalog.dropTempView(name)
