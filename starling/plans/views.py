"""Reporting views (Q-16 .. Q-21) and the view registration helper."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.functions.money import as_double, round_sum
from starling.operators.lookup import bounded_broadcast, checked_broadcast
from starling.operators.metrics import Metric, metric_set
from starling.plans import analytics
from starling.plans.star import Star


def v_premium_by_policy_type(star: Star) -> DataFrame:
    """Q-16: policies, average and total premium per type (JOIN ... USING policy_type_id)."""
    per_id = star.fact_sales.groupBy("policy_type_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("premium_amount").alias("_p"), F.count("premium_amount").alias("_np"))
    types = checked_broadcast(star.dim_policy_type, star.params.broadcast_max_rows)
    j = per_id.join(types, "policy_type_id").groupBy("policy_type").agg(
        F.sum("_n").cast("long").alias("policies"), F.sum("_p").alias("_p"), F.sum("_np").alias("_np"))
    return j.select("policy_type", "policies",
                    as_double(F.round(F.col("_p") / F.nullif(F.col("_np"), F.lit(0)).cast("decimal(20,0)"), 2))
                    .alias("avg_premium"),
                    as_double(F.round("_p", 2)).alias("total_premium"))


def v_claims_summary(star: Star) -> DataFrame:
    """Q-17: per status; approval_pct is the MEAN OF PER-CLAIM RATIOS (zero claims skipped)."""
    fc = star.fact_claims
    ratio = F.col("approved_amount") / F.nullif(F.col("claim_amount"), F.lit(0).cast("decimal(12,2)"))
    per_id = fc.groupBy("status_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("claim_amount").alias("_c"), F.sum("approved_amount").alias("_a"),
        F.sum(ratio).alias("_rs"), F.count(ratio).alias("_rn"))
    st = bounded_broadcast(star.dim_claim_status)
    j = per_id.join(st, "status_id").groupBy("status_name").agg(
        F.sum("_n").cast("long").alias("claims"), F.sum("_c").alias("_c"), F.sum("_a").alias("_a"),
        F.sum("_rs").alias("_rs"), F.sum("_rn").alias("_rn"))
    mean_ratio = F.col("_rs") / F.nullif(F.col("_rn"), F.lit(0)).cast("decimal(20,0)")
    return j.select("status_name", "claims", as_double(F.round("_c", 2)).alias("total_claimed"),
                    as_double(F.round("_a", 2)).alias("total_approved"),
                    as_double(F.round(mean_ratio * F.lit(100).cast("decimal(3,0)"), 1)).alias("approval_pct"))


def v_payment_methods(star: Star) -> DataFrame:
    """Q-18: every status (unlike Q-7), transactions / total / average per method."""
    g = star.fact_payments.groupBy("payment_method").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("payment_amount").alias("_t"),
        F.count("payment_amount").alias("_n"))
    return g.select("payment_method", "transactions", as_double(F.round("_t", 2)).alias("total_collected"),
                    as_double(F.round(F.col("_t") / F.nullif(F.col("_n"), F.lit(0)).cast("decimal(20,0)"), 2))
                    .alias("avg_payment"))


def v_monthly_trends(star: Star) -> DataFrame:
    """Q-19: per month (truncated date): distinct sales and premium volume."""
    fs = star.fact_sales.withColumn("month", F.trunc("date_key", "MM"))
    return fs.groupBy("month").agg(F.count_distinct("sale_id").alias("policies_sold"),
                                   as_double(round_sum("premium_amount")).alias("premium_volume"))


VIEW_SUMMARY = [
    Metric("Total Customers", "dim_customer"),
    Metric("Total Policies", "fact_sales"),
    Metric("Total Claims", "fact_claims"),
    Metric("Total Payments", "fact_payments"),
    Metric("Total Premium", "fact_sales", "premium_amount", 0),
    Metric("Total Claimed", "fact_claims", "claim_amount", 0),
    Metric("Total Collected", "fact_payments", "payment_amount", 0),
]


def v_summary_stats(star: Star) -> DataFrame:
    """Q-20: 7 metrics over 4 tables as text; money rounded to whole units; collected has no status filter."""
    return metric_set(star.table, VIEW_SUMMARY)


DIMENSIONS = ["dim_date", "dim_customer", "dim_policy_type", "dim_county", "dim_agent", "dim_claim_status"]


def dim_row_counts(star: Star) -> DataFrame:
    """Q-21: row count per dimension table."""
    return metric_set(star.table, [Metric(n, n) for n in DIMENSIONS], "table_name", "row_count", "long")


VIEWS = {
    "v_premium_by_policy_type": v_premium_by_policy_type,
    "v_claims_summary": v_claims_summary,
    "v_payment_methods": v_payment_methods,
    "v_late_payments": analytics.late_by_policy_type,
    "v_monthly_trends": v_monthly_trends,
    "v_summary_stats": v_summary_stats,
    "summary_stats": analytics.summary_stats,
}


def register_views(star: Star, names: list[str] | None = None) -> list[str]:
    """CREATE OR REPLACE (temp) VIEW for each reporting view; returns the names."""
    done = []
    for name in names or list(VIEWS):
        VIEWS[name](star).createOrReplaceTempView(name)
        done.append(name)
    return done
