"""Fact builds: sales, claims, payments.

Joins: the customer lookup (grows with the data) is a shuffle join on
customer_id, AQE splits a hot customer; the small dimensions are broadcast
behind a checked row count (policy type, county, agent) or a bound by
construction (calendar, the 5 claim statuses).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from starling.functions.hashing import hash32, stable_id
from starling.functions.money import lenient_money
from starling.operators.expand import installment_schedule, payment_attributes
from starling.operators.keys import assign_partner, keep_observed, split_by_reference
from starling.operators.lookup import bounded_broadcast, checked_broadcast
from starling.params import RunParams
from starling.schemas import FACT_CLAIMS, FACT_PAYMENTS, FACT_SALES, MONEY, RATE, conform

COMMISSION_BP = (500, 1500)  # commission rate 0.0500 .. 0.1500 in basis points of 1/10000


def with_county_id(df: DataFrame, dim_customer: DataFrame, dim_county: DataFrame, params: RunParams) -> DataFrame:
    """Add county_id: row -> customer (county name) -> county id, two left lookups.

    The customer lookup is joined on its own (a plain scan of the stored
    dimension carries its true size, so Spark's size check can broadcast it or
    fall back to a shuffle join); the county list is a checked broadcast.
    """
    counties = checked_broadcast(dim_county.select(F.col("county_name").alias("_county"), "county_id"),
                                 params.broadcast_max_rows)
    cust = dim_customer.select("customer_id", F.col("county").alias("_county"))
    return df.join(cust, "customer_id", "left").join(counties, "_county", "left").drop("_county")


def commission_rate(key: str) -> F.Column:
    lo, hi = COMMISSION_BP
    bp = F.lit(lo) + F.pmod(hash32("commission", key), F.lit(hi - lo + 1))
    return (bp.cast("decimal(9,0)") / F.lit(10000).cast("decimal(5,0)")).cast(RATE)


def fact_sales(policies: DataFrame, dim_customer: DataFrame, dim_policy_type: DataFrame,
               dim_county: DataFrame, dim_agent: DataFrame, params: RunParams) -> DataFrame:
    df = with_county_id(policies, dim_customer, dim_county, params)
    types = checked_broadcast(dim_policy_type.select("policy_type", "policy_type_id"), params.broadcast_max_rows)
    df = df.join(types, "policy_type", "left")
    active = dim_agent.where(F.col("is_active"))
    df = assign_partner(df, active, "agent_id", "policy_id", "agent", "agent_id", params.broadcast_max_rows)
    out = df.select(
        stable_id("sale", "policy_id").alias("sale_id"), "policy_id", "customer_id", "agent_id",
        F.col("start_date").alias("date_key"), "policy_type_id", "county_id",
        lenient_money("premium").alias("premium_amount"), commission_rate("policy_id").alias("commission_rate"),
        "policy_type", "start_date", "end_date", F.col("status").alias("policy_status"))
    return conform(out, FACT_SALES)


def fact_claims_joined(claims: DataFrame, dim_customer: DataFrame, dim_county: DataFrame,
                       policies: DataFrame, dim_policy_type: DataFrame, dim_claim_status: DataFrame,
                       params: RunParams) -> DataFrame:
    """Claims with every lookup attached (before projection); misses are null ids.

    Policies come first: claims and policies that are stored bucketed by ``policy_id``
    (``sources.bucketed``) are joined as they lie, without an exchange.
    """
    df = claims.join(policies.select("policy_id", "policy_type"), "policy_id", "left")
    df = with_county_id(df, dim_customer, dim_county, params)
    types = checked_broadcast(dim_policy_type.select("policy_type", "policy_type_id"), params.broadcast_max_rows)
    df = df.join(types, "policy_type", "left")
    # the status dimension is a short literal list (bounded by construction)
    status = bounded_broadcast(dim_claim_status.select(F.col("status_name").alias("claim_status"), "status_id"))
    return df.join(status, "claim_status", "left")


def fact_claims(claims: DataFrame, dim_customer: DataFrame, dim_county: DataFrame, policies: DataFrame,
                dim_policy_type: DataFrame, dim_claim_status: DataFrame, params: RunParams) -> DataFrame:
    df = fact_claims_joined(claims, dim_customer, dim_county, policies, dim_policy_type, dim_claim_status, params)
    out = df.select(
        "claim_id", "policy_id", "customer_id", F.col("claim_date").alias("date_key"),
        F.col("incident_date").alias("incident_date_key"), "status_id", "county_id", "policy_type_id",
        "claim_type", lenient_money("claim_amount").alias("claim_amount"),
        F.coalesce(lenient_money("approved_amount"), F.lit(0).cast(MONEY)).alias("approved_amount"),
        "claim_status", "incident_date", "claim_date",
        F.coalesce(F.col("created_at"), F.lit(params.load_ts)).alias("created_at"))
    return conform(out, FACT_CLAIMS)


def payment_rows(policies: DataFrame, dim_customer: DataFrame, dim_county: DataFrame,
                 dim_policy_type: DataFrame, params: RunParams) -> DataFrame:
    """All generated installments (before the calendar check)."""
    types = checked_broadcast(dim_policy_type.select("policy_type", "policy_type_id"), params.broadcast_max_rows)
    base = with_county_id(policies, dim_customer, dim_county, params).join(types, "policy_type", "left")
    # The schedule multiplies rows ~20x.  AQE sizes the join output by its
    # pre-expansion bytes, which would leave the expansion to a few tasks;
    # a fixed-count repartition of the (small) policy side spreads it.
    n = int(policies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = base.repartition(n, "policy_id")
    sched = installment_schedule(base, params.as_of, carry=["county_id", "policy_type_id"])
    df = payment_attributes(sched).withColumn("date_key", F.col("payment_date"))
    return df.withColumn("created_at", F.lit(params.load_ts).cast("timestamp"))


def split_payments(rows: DataFrame, dim_date: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped): installments whose payment date is / is not in the calendar.

    The calendar is bounded (years x 366 rows), so the semi/anti joins broadcast it.
    """
    kept, dropped = split_by_reference(rows, bounded_broadcast(dim_date.select("date_key")), "date_key")
    return conform(kept, FACT_PAYMENTS), dropped


def fact_payments(policies, dim_customer, dim_county, dim_policy_type, dim_date, params: RunParams,
                  observation: Observation | None = None) -> DataFrame:
    """Installments whose payment date is in the calendar; ``observation`` counts read and dropped rows."""
    rows = payment_rows(policies, dim_customer, dim_county, dim_policy_type, params)
    calendar = bounded_broadcast(dim_date.select("date_key"))
    return conform(keep_observed(rows, calendar, "date_key", observation), FACT_PAYMENTS)
