"""Scans: Parquet tables with explicit schemas, tolerant reads, empty-input guards."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan; an explicit schema skips footer inference on huge directories."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def table_path(root: str, name: str) -> str:
    p = os.path.join(root, f"{name}.parquet")
    return p if os.path.exists(p) or "://" in root else os.path.join(root, name)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through Hadoop FileSystem (works for any cluster file system)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right under a folder, in order; none where it is missing."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory()) if fs.exists(hpath) else []


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of one's own making, on any cluster file system; a missing one is no error."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Missing target table = empty frame with the declared schema; other errors propagate."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return read_parquet(spark, path, schema)


def table_or_none(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    return read_parquet(spark, path, schema) if path_exists(spark, path) else None


class EmptyInputError(RuntimeError):
    pass


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail fast when an input that must not be empty is empty (one-row probe, not a count)."""
    if df.isEmpty():
        raise EmptyInputError(f"No {what} found. Load {what} first.")
    return df
