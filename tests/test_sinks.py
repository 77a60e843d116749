"""Writers, tolerant reads, views and incremental dimension keys."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from starling.plans import dims
from starling.schemas import DIM_POLICY_TYPE
from starling.sinks import writers as W
from starling.sources.files import EmptyInputError, read_or_empty, require_rows


def _tmp():
    return tempfile.mkdtemp(prefix="sinks-test-")


def test_snapshot_is_timestamped_and_never_overwritten(spark):
    root = _tmp()
    ts = dt.datetime(2024, 5, 6, 7, 8, 9)
    df = spark.createDataFrame([(1,)], "a int")
    path = W.write_snapshot(df, root, "fact_sales", ts)
    assert path.endswith("fact_sales_20240506_070809")
    empty = W.write_snapshot(df.where("false"), root, "empty", ts)  # written even when empty
    assert spark.read.parquet(empty).count() == 0
    with pytest.raises(Exception):
        W.write_snapshot(df, root, "fact_sales", ts)


def test_append_with_added_column_reads_back_merged(spark):
    path = os.path.join(_tmp(), "t")
    W.append(spark.createDataFrame([(1, "a")], "id int, s string"), path)
    W.append(spark.createDataFrame([(2, "b", 3.5)], "id int, s string, extra double"), path)
    got = sorted((r["id"], r["extra"]) for r in W.read_evolving(spark, path).collect())
    assert got == [(1, None), (2, 3.5)]


def test_fixed_schema_append_checks_and_skips_empty(spark):
    path = os.path.join(_tmp(), "t")
    good = spark.createDataFrame([(1, "Life")], DIM_POLICY_TYPE)
    assert W.append_checked(good, path, DIM_POLICY_TYPE)
    assert not W.append_checked(good.where("false"), path, DIM_POLICY_TYPE)
    with pytest.raises(ValueError):
        W.append_checked(good.withColumn("x", F.lit(1)), path, DIM_POLICY_TYPE)
    assert spark.read.parquet(path).count() == 1


def test_partitioned_append_and_create_if_absent(spark):
    root = _tmp()
    path = os.path.join(root, "p")
    assert W.create_if_absent(spark, path, DIM_POLICY_TYPE)
    assert not W.create_if_absent(spark, path, DIM_POLICY_TYPE)
    df = spark.range(0, 100).select((F.col("id") % 3).cast("int").alias("k"), F.col("id"))
    out = os.path.join(root, "parts")
    W.append(df, out, partition_by="k")
    assert sorted(d for d in os.listdir(out) if d.startswith("k=")) == ["k=0", "k=1", "k=2"]
    assert spark.read.parquet(out).count() == 100


def test_tolerant_read_and_fail_fast(spark):
    missing = os.path.join(_tmp(), "nope")
    assert read_or_empty(spark, missing, DIM_POLICY_TYPE).count() == 0
    with pytest.raises(EmptyInputError):
        require_rows(spark.createDataFrame([], DIM_POLICY_TYPE), "policies")


def test_views_register_and_query(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    W.replace_view(df, "tmp_view_x")
    assert spark.sql("SELECT SUM(v) AS s FROM tmp_view_x").first()["s"] == 1
    W.drop_view(spark, "tmp_view_x")
    assert not spark.catalog.tableExists("tmp_view_x")


def test_claim_status_incremental_serial_keys(spark):
    existing = spark.createDataFrame([(1, "Pending"), (2, "Approved"), (9, "Legacy")], "status_id int, status_name string")
    new = dims.dim_claim_status(spark, existing).orderBy("status_id").collect()
    assert [(r["status_id"], r["status_name"]) for r in new] == [(10, "Rejected"), (11, "Paid"), (12, "Escalated")]
    fresh = dims.dim_claim_status(spark).orderBy("status_id").collect()
    assert [r["status_name"] for r in fresh] == ["Pending", "Approved", "Rejected", "Paid", "Escalated"]
