"""Dimension builds (insert-only, re-runnable: existing members are never updated).

Each builder takes the source frames and the current dimension (``None`` when
the target does not exist yet) and returns only the rows to append.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starling.functions import columns as C
from starling.functions.hashing import hash32, pick
from starling.operators.expand import PAYMENT_DELAY_DAYS
from starling.operators.keys import assign_serial_keys, only_new_rows
from starling.params import RunParams
from starling.schemas import DIM_AGENT, DIM_CUSTOMER, conform
from starling.sources import literals



def dim_date(spark: SparkSession, policies: DataFrame | None, params: RunParams,
             existing: DataFrame | None = None) -> DataFrame:
    """Calendar with 13 attributes.

    Bounds: ``params.calendar_start/end`` when given (the reference uses
    2019-01-01..2030-12-31), otherwise whole years from that of the first payment possible, derived
    from the data (one made early, on the first policy), through that of the last one possible
    (due on ``as_of``, with the longest delay).
    """
    last = params.as_of + _dt.timedelta(days=PAYMENT_DELAY_DAYS[1])
    end = params.calendar_end or _dt.date(last.year, 12, 31)
    if params.calendar_start is not None or policies is None:
        days = literals.calendar(spark, params.calendar_start or _dt.date(params.as_of.year, 1, 1), end)
    else:
        bounds = policies.agg(F.trunc(F.date_add(F.min("start_date"), PAYMENT_DELAY_DAYS[0]), "year").alias("lo")).select(
            "lo", F.lit(end).alias("hi"))
        days = literals.calendar_from(bounds)
    out = days.select(*C.calendar_attributes("date_key"))
    return only_new_rows(out, existing, "date_key")


def dim_policy_type(policies: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return assign_serial_keys(policies, "policy_type", "policy_type_id", existing)


def dim_county(customers: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    new = assign_serial_keys(customers.select(F.col("county").alias("county_name")),
                             "county_name", "county_id", existing)
    return new


def dim_claim_status(spark: SparkSession, existing: DataFrame | None = None) -> DataFrame:
    """The 5 default statuses; SERIAL ids follow load order, new members continue after max(id)."""
    names = literals.claim_status_names(spark)
    if existing is None:
        return names.select(F.col("load_order").alias("status_id"), "status_name")
    new = names.join(existing.select("status_name"), "status_name", "left_anti")
    base = existing.select(F.coalesce(F.max("status_id"), F.lit(0))).scalar()
    # rank among the (at most 5) new literal members by load order: a literal, bounded relation
    rank = F.row_number().over(Window.orderBy("load_order"))
    return new.select((base + rank).cast("int").alias("status_id"), "status_name")


def region_of(df: DataFrame, county_col: str, region_map: DataFrame | None) -> DataFrame:
    """Add ``region`` from a (county, region) lookup, default 'Other'.

    ``region_map=None`` uses the fixed 5-county literal map.  A lookup table is
    one row per county; its size statistics decide whether it is broadcast.
    """
    if region_map is None:
        return df.withColumn("region", C.region_literal(F.col(county_col)))
    rm = region_map.select(F.col("county").alias("_rc"), F.col("region").alias("_rr"))
    out = df.join(rm, df[county_col] == rm["_rc"], "left")
    return out.withColumn("region", F.coalesce(F.col("_rr"), F.lit(C.REGION_DEFAULT))).drop("_rc", "_rr")


def dim_customer(customers: DataFrame, params: RunParams, region_map: DataFrame | None = None,
                 existing: DataFrame | None = None) -> DataFrame:
    src = only_new_rows(customers, existing, "customer_id")
    df = (region_of(src, "county", region_map)
          .withColumn("age_band", C.age_band("age"))
          .withColumn("customer_tenure", C.customer_tenure("signup_date", params.as_of)))
    return conform(df, DIM_CUSTOMER)


def dim_agent(agents: DataFrame, region_map: DataFrame | None = None,
              existing: DataFrame | None = None) -> DataFrame:
    src = only_new_rows(agents, existing, "agent_id")
    df = region_of(src, "county", region_map)
    df = df.select(
        "agent_id", F.col("full_name").alias("agent_name"), C.agent_code("agent_id").alias("agent_code"),
        "region", pick(C.CHANNELS, hash32("channel", "agent_id")).alias("channel"),
        F.to_date("hire_date").alias("hire_date"), C.is_active("status").alias("is_active"))
    return conform(df, DIM_AGENT)
