"""Business queries over the star schema (Q-1 .. Q-15).

Each query is ``q(star) -> DataFrame``; ``star.params.as_of`` replaces
CURRENT_DATE.  Money is summed and rounded in DECIMAL, then presented as
DOUBLE; counts are BIGINT.  ORDER BY is applied only where a LIMIT makes it
part of the result (top-k) -- other orderings are presentation and are left
to the caller (``ordered(...)``) so no needless global sort is planned.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.functions.money import as_double, pct_of_counts, ratio_pct, round_sum
from starling.operators.fanout import fanout_join, per_key
from starling.operators.metrics import Metric, metric_set
from starling.operators.lookup import bounded_broadcast, checked_broadcast
from starling.plans.star import Star


def _year_window(star: Star):
    """Years [year(as_of - N years), year(as_of)] (EXTRACT(YEAR FROM CURRENT_DATE - INTERVAL 'N years'))."""
    a = star.params.as_of
    try:
        lo = a.replace(year=a.year - star.params.trend_years)
    except ValueError:  # Feb 29
        lo = a.replace(year=a.year - star.params.trend_years, day=28)
    return lo.year, a.year


def _window_bounds(star: Star):
    lo, hi = _year_window(star)
    return _dt.date(lo, 1, 1), _dt.date(hi, 12, 31)


def _in_window(df: DataFrame, star: Star) -> DataFrame:
    """Static date-range filter implied by the year window: pushed into the Parquet scan
    (row groups of date-clustered facts are skipped); the calendar join still decides."""
    lo, hi = _window_bounds(star)
    out = df.where(F.col("date_key").between(F.lit(lo), F.lit(hi)))
    if "date_month" in df.columns:  # stored facts: prune month partitions too
        out = out.where(F.col("date_month").between(F.lit(lo.replace(day=1)), F.lit(hi.replace(day=1))))
    return out


def _dates_in_window(star: Star) -> DataFrame:
    lo, hi = _year_window(star)
    # calendar rows: bounded by years x 366
    return bounded_broadcast(star.dim_date.where(F.col("year").between(lo, hi))
                             .select("date_key", "year", "month", "month_name"))


def monthly_premium(star: Star) -> DataFrame:
    """Q-1: premium, commission and policies per month of the last 4 calendar years."""
    fs = _in_window(star.fact_sales, star)
    j = fs.join(_dates_in_window(star), "date_key")
    return j.groupBy("year", "month", "month_name").agg(
        as_double(round_sum("premium_amount")).alias("premium"),
        as_double(round_sum(F.col("commission_rate") * F.col("premium_amount"))).alias("commission"),
        F.count("sale_id").alias("policies"))


def county_premium(star: Star) -> DataFrame:
    """Q-2: premium and policies by county (rows without a county id drop out)."""
    counties = checked_broadcast(star.dim_county, star.params.broadcast_max_rows)
    agg = star.fact_sales.groupBy("county_id").agg(
        F.sum("premium_amount").alias("_p"), F.count("sale_id").alias("policies"))
    # aggregate first (one row per county id), then attach the name
    j = agg.join(counties, "county_id")
    return j.groupBy("county_name").agg(
        as_double(F.round(F.sum("_p"), 2)).alias("total_premium"),
        F.sum("policies").cast("long").alias("policies"))


def policy_type_dist(star: Star) -> DataFrame:
    """Q-3: policy count and premium per policy type."""
    return star.fact_sales.groupBy("policy_type").agg(
        F.count(F.lit(1)).alias("count"), as_double(round_sum("premium_amount")).alias("total_premium"))


def _claims_by_status_id(star: Star) -> DataFrame:
    return star.fact_claims.groupBy("status_id").agg(
        F.count("claim_id").alias("claims"), F.count(F.lit(1)).alias("_rows"),
        F.sum("claim_amount").alias("_claimed"), F.sum("approved_amount").alias("_approved"))


def claims_status(star: Star) -> DataFrame:
    """Q-4: claims, claimed and approved per claim status."""
    st = bounded_broadcast(star.dim_claim_status)  # literal status list
    j = _claims_by_status_id(star).join(st, "status_id")
    return j.groupBy("status_name").agg(
        F.sum("claims").cast("long").alias("claims"),
        as_double(F.round(F.sum("_claimed"), 2)).alias("total_claimed"),
        as_double(F.round(F.sum("_approved"), 2)).alias("total_approved"))


def _risk_level(star: Star):
    """Optional pass-through: the dimension's ``risk_level`` if a deployment has one, else null."""
    cols = star.dim_policy_type.columns
    return F.col("risk_level") if "risk_level" in cols else F.lit(None).cast("string").alias("risk_level")


def _loss_inputs(star: Star) -> DataFrame:
    sales = per_key(star.fact_sales, "policy_type_id", "premium_amount", "p")
    claims = per_key(star.fact_claims, "policy_type_id", "approved_amount", "a")
    base = star.dim_policy_type.select("policy_type_id", "policy_type", _risk_level(star))
    return fanout_join(base, "policy_type_id", sales, claims, "p", "a")


def loss_ratio_as_written(star: Star) -> DataFrame:
    """Q-5 literal: dim LEFT JOIN sales LEFT JOIN claims multiplies rows per type.

    Computed from per-type aggregates (never materialising the product).
    ``risk_level`` is selected by the reference but no load creates it: passed
    through from the dimension when present, else null.
    """
    j = _loss_inputs(star).groupBy("policy_type", "risk_level").agg(
        F.sum("p_fanout").alias("_p"), F.sum("a_fanout").alias("_a"))
    return j.select(
        "policy_type", "risk_level",
        as_double(F.round("_p", 2)).alias("total_premium"), as_double(F.round("_a", 2)).alias("total_approved"),
        as_double(ratio_pct(F.col("_a"), F.col("_p"), 2)).alias("loss_ratio_pct"))


def loss_ratio_corrected(star: Star) -> DataFrame:
    """Q-5 corrected: approved / premium per type without the fan-out."""
    j = _loss_inputs(star).groupBy("policy_type", "risk_level").agg(
        F.sum("p_sum").alias("_p"), F.sum("a_sum").alias("_a"))
    return j.select(
        "policy_type", "risk_level",
        as_double(F.round("_p", 2)).alias("total_premium"), as_double(F.round("_a", 2)).alias("total_approved"),
        as_double(ratio_pct(F.col("_a"), F.col("_p"), 2)).alias("loss_ratio_pct"))


def agent_top10(star: Star, k: int = 10) -> DataFrame:
    """Q-6: top-k agents by premium (grouped by id, so same-named agents stay apart).

    Aggregates per agent_id first (shuffle of one partial row per agent per
    task), then a bounded top-k (TakeOrderedAndProject) with agent_id as the
    tie-breaker.
    """
    per_agent = star.fact_sales.groupBy("agent_id").agg(
        F.count("sale_id").alias("policies"), F.sum("premium_amount").alias("_p"),
        F.sum(F.col("commission_rate") * F.col("premium_amount")).alias("_c"))
    agents = star.dim_agent.select("agent_id", "agent_name", "channel")
    j = per_agent.join(agents, "agent_id")
    ranked = j.select("agent_id", "agent_name", "channel", "policies",
                      F.round("_p", 2).alias("_tp"), F.round("_c", 2).alias("_tc"))
    top = ranked.orderBy(F.col("_tp").desc_nulls_first(), F.col("agent_id").asc()).limit(k)
    return top.select("agent_name", "channel", "policies", as_double("_tp").alias("total_premium"),
                      as_double("_tc").alias("commission"))


def payment_method(star: Star) -> DataFrame:
    """Q-7: completed payments and amount collected per method."""
    fp = star.fact_payments.where(F.col("payment_status") == "Completed")
    return fp.groupBy("payment_method").agg(
        F.count(F.lit(1)).alias("payments"), as_double(round_sum("payment_amount")).alias("total_collected"))


def late_by_frequency(star: Star) -> DataFrame:
    """Q-8: total, late and late % per payment frequency."""
    late = F.count_if(F.col("is_late"))
    total = F.count(F.lit(1))
    return star.fact_payments.groupBy("payment_frequency").agg(
        total.alias("total"), late.alias("late"), as_double(pct_of_counts(late, total, 1)).alias("late_pct"))


def _sales_per_customer(star: Star) -> DataFrame:
    return star.fact_sales.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("premium_amount").alias("_p"),
        F.count("premium_amount").alias("_np"))


def _age_band_join(star: Star) -> DataFrame:
    """dim_customer LEFT JOIN (sales aggregated per customer): 1:1, no row fan-out."""
    return star.dim_customer.select("customer_id", "age_band").join(_sales_per_customer(star), "customer_id", "left")


def _avg_from_parts(total, n, digits):
    return F.round(total / F.nullif(n, F.lit(0)).cast("decimal(20,0)"), digits)


def age_band(star: Star) -> DataFrame:
    """Q-9 as written: COUNT(*) counts joined rows (a customer with 3 policies counts 3, with none 1)."""
    j = _age_band_join(star)
    return j.groupBy("age_band").agg(
        F.sum(F.greatest(F.coalesce("_rows", F.lit(0)), F.lit(1))).cast("long").alias("customers"),
        as_double(_avg_from_parts(F.sum("_p"), F.sum("_np"), 2)).alias("avg_premium"))


def age_band_corrected(star: Star) -> DataFrame:
    """Q-9 corrected: distinct customers per band; average premium over their policies."""
    j = _age_band_join(star)
    return j.groupBy("age_band").agg(
        F.count(F.lit(1)).alias("customers"),
        as_double(_avg_from_parts(F.sum("_p"), F.sum("_np"), 2)).alias("avg_premium"))


def _collections_inputs(star: Star) -> DataFrame:
    dates = _dates_in_window(star)
    sales = per_key(_in_window(star.fact_sales, star), "date_key", "premium_amount", "p")
    pays = per_key(_in_window(star.fact_payments, star), "date_key", "payment_amount", "c",
                   where=F.col("payment_status") == "Completed")
    return fanout_join(dates, "date_key", sales, pays, "p", "c")


def collections_as_written(star: Star) -> DataFrame:
    """Q-10 literal: dim_date LEFT JOIN sales LEFT JOIN payments on the date (fan-out per day)."""
    j = _collections_inputs(star)
    return j.groupBy("year", "month", "month_name").agg(
        as_double(F.round(F.sum("p_fanout"), 2)).alias("gross_premium"),
        as_double(F.round(F.sum("c_fanout"), 2)).alias("collected"))


def collections_corrected(star: Star) -> DataFrame:
    """Q-10 corrected: monthly premium sold and amount collected, each summed once."""
    j = _collections_inputs(star)
    return j.groupBy("year", "month", "month_name").agg(
        as_double(F.round(F.sum("p_sum"), 2)).alias("gross_premium"),
        as_double(F.round(F.sum("c_sum"), 2)).alias("collected"))


SUMMARY = [
    Metric("Total Customers", "customers"),
    Metric("Total Policies", "policies"),
    Metric("Total Claims", "claims"),
    Metric("Gross Premium (KES)", "fact_sales", "premium_amount"),
    Metric("Total Collected (KES)", "fact_payments", "payment_amount", where="payment_status = 'Completed'"),
]


def summary_stats(star: Star) -> DataFrame:
    """Q-11: 5 platform metrics as (metric, text)."""
    return metric_set(star.table, SUMMARY)


def late_by_policy_type(star: Star) -> DataFrame:
    """Q-12 (view v_late_payments): late / on-time counts and average days late per type."""
    per_type = star.fact_payments.groupBy("policy_type_id").agg(
        F.count_if(F.col("is_late") == True).alias("_late"),  # noqa: E712  (FILTER WHERE is_late = TRUE)
        F.count_if(F.col("is_late") == False).alias("_ontime"),  # noqa: E712
        F.sum("days_late").alias("_d"), F.count("days_late").alias("_nd"))
    types = checked_broadcast(star.dim_policy_type, star.params.broadcast_max_rows)
    j = per_type.join(types, "policy_type_id").groupBy("policy_type").agg(
        F.sum("_late").cast("long").alias("late_payments"), F.sum("_ontime").cast("long").alias("on_time_payments"),
        F.sum("_d").alias("_d"), F.sum("_nd").alias("_nd"))
    return j.select("policy_type", "late_payments", "on_time_payments",
                    as_double(F.round(F.col("_d").cast("decimal(20,0)")
                                      / F.nullif(F.col("_nd"), F.lit(0)).cast("decimal(20,0)"), 1))
                    .alias("avg_days_late"))


def sales_by_type(star: Star) -> DataFrame:
    """Q-13: fact_sales rows and premium per policy type (post-load verification)."""
    return star.fact_sales.groupBy("policy_type").agg(
        F.count(F.lit(1)).alias("cnt"), as_double(round_sum("premium_amount")).alias("total_premium"))


def claims_totals_by_status(star: Star) -> DataFrame:
    """Q-14: claim totals per status name, unrounded sums."""
    st = bounded_broadcast(star.dim_claim_status)
    j = _claims_by_status_id(star).join(st, "status_id")
    return j.groupBy("status_name").agg(
        F.sum("_rows").cast("long").alias("claims"),
        as_double(F.sum("_claimed")).alias("total_claimed"),
        as_double(F.sum("_approved")).alias("total_approved"))


def payments_by_method_status_top10(star: Star, k: int = 10) -> DataFrame:
    """Q-15: payments per (method, status), top-k by count, ties broken by the names."""
    g = star.fact_payments.groupBy("payment_method", "payment_status").agg(
        F.count(F.lit(1)).alias("payments"), F.round(F.sum("payment_amount"), 2).alias("_t"))
    top = g.orderBy(F.col("payments").desc(), "payment_method", "payment_status").limit(k)
    return top.select("payment_method", "payment_status", "payments", as_double("_t").alias("total_amount"))


def ordered(df: DataFrame, *cols) -> DataFrame:
    """Presentation ordering (the reference's ORDER BY) for display/export."""
    return df.orderBy(*cols)
