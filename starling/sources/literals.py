"""Small literal relations and generated relations (bounded by construction)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.functions.columns import CLAIM_STATUSES, REGION_BY_COUNTY
from starling.schemas import REGION_MAP


def claim_status_names(spark: SparkSession) -> DataFrame:
    """The 5 default claim statuses, with their load order (1..5)."""
    rows = [(i + 1, s) for i, s in enumerate(CLAIM_STATUSES)]
    return spark.createDataFrame(rows, "load_order int, status_name string")


def region_map_literal(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(REGION_BY_COUNTY.items()), REGION_MAP)


def calendar(spark: SparkSession, start: _dt.date, end: _dt.date) -> DataFrame:
    """Every date from start to end inclusive (one row per day, a few thousand rows)."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date_key"))


def calendar_from(bounds: DataFrame) -> DataFrame:
    """Calendar over a one-row frame with columns ``lo``/``hi`` (dates)."""
    return bounds.select(F.explode(F.sequence(F.col("lo"), F.col("hi"))).alias("date_key"))
