"""The warehouse's data-quality rules and post-load verifications (DQ-1 .. DQ-7).

Every table's rules are one aggregation pass; referential rules ride on a
left join with the distinct reference keys inside the same pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.functions.money import as_double
from starling.operators.quality import count_checks, null_profile, value_counts, with_membership
from starling.operators.reconcile import reconcile
from starling.plans import facts
from starling.plans.star import Star
from starling.schemas import STAR

PREMIUM_MAX = 1_000_000


def dq_sales(star: Star) -> DataFrame:
    """DQ-1: source policies before the fact_sales load."""
    p = with_membership(star.policies, "customer_id", star.dim_customer, "customer_id", "_known")
    c = F.col
    return count_checks(p, [
        ("null policy_id", c("policy_id").isNull()),
        ("null customer_id", c("customer_id").isNull()),
        ("null premium", c("premium").isNull()),
        ("null start_date", c("start_date").isNull()),
        ("premium out of range", (c("premium") < 0) | (c("premium") > PREMIUM_MAX)),
        ("end_date before start_date", c("end_date") < c("start_date")),
        ("unmatched customer_id", ~c("_known")),
    ])


def dq_claims(star: Star) -> DataFrame:
    """DQ-2: source claims before the fact_claims load."""
    c = F.col
    return count_checks(star.claims, [
        ("null claim_id", c("claim_id").isNull()),
        ("null customer_id", c("customer_id").isNull()),
        ("null policy_id", c("policy_id").isNull()),
        ("negative claim_amount", c("claim_amount") < 0),
        ("null claim_amount", c("claim_amount").isNull()),
        ("claim_date before incident_date", c("claim_date") < c("incident_date")),
    ])


def dq_payments(star: Star) -> DataFrame:
    """DQ-3: source policies before the fact_payments load."""
    c = F.col
    return count_checks(star.policies, [
        ("null policy_id", c("policy_id").isNull()),
        ("null customer_id", c("customer_id").isNull()),
        ("null premium", c("premium").isNull()),
        ("negative premium", c("premium") < 0),
        ("null start_date", c("start_date").isNull()),
    ])


def lookup_misses(star: Star) -> DataFrame:
    """DQ-4: lookups that found nothing while building fact_claims."""
    j = facts.fact_claims_joined(star.claims, star.dim_customer, star.dim_county, star.policies,
                                 star.dim_policy_type, star.dim_claim_status, star.params)
    c = F.col
    return count_checks(j, [
        ("unmatched status", c("status_id").isNull()),
        ("unmatched policy type", c("policy_type_id").isNull()),
        ("unmatched county", c("county_id").isNull()),
    ])


def null_profile_facts(star: Star) -> DataFrame:
    """AGG-18: null count of every column of the three facts, one pass each."""
    out = None
    for name in ("fact_sales", "fact_claims", "fact_payments"):
        one = null_profile(star.table(name), STAR[name].fieldNames()).select(F.lit(name).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def value_counts_payments(star: Star) -> DataFrame:
    """AGG-17: frequency tables of payment method, status and frequency."""
    return value_counts(star.fact_payments, ["payment_method", "payment_status", "payment_frequency"])


def verify_sales(star: Star) -> DataFrame:
    """DQ-5: rows, null premiums and orphaned customer ids of fact_sales, one pass."""
    fs = with_membership(star.fact_sales, "customer_id", star.dim_customer, "customer_id", "_known")
    return fs.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.count_if(F.col("premium_amount").isNull()).alias("null_premiums"),
                  F.count_if(~F.col("_known")).alias("orphaned_rows"))


def reconcile_claims(star: Star) -> DataFrame:
    """DQ-6: source vs fact counts, source claims missing from the fact, null amounts.

    The digests count nulls of all columns that the fact's lookups need, so that claims are read
    alike on both sides and exchanged once for both.
    """
    found = reconcile(star.claims, star.fact_claims, "claim_id", {"null_amounts": F.col("claim_amount").isNull(), **{
        f"null_{c}": F.col(c).isNull() for c in ("policy_id", "customer_id", "claim_status")}})
    return found.select("source_rows", "target_rows", "missing_rows", "null_amounts").toDF(
        "source_claims", "fact_claims", "missing_rows", "null_amounts")


def verify_payments(star: Star) -> DataFrame:
    """DQ-7: post-load checks of fact_payments in one aggregation."""
    fp = star.fact_payments
    return fp.agg(
        F.count(F.lit(1)).alias("total_payments"),
        F.count_if(F.col("payment_amount").isNull()).alias("null_amounts"),
        F.count_if(F.col("is_late") == True).alias("late_payments"),  # noqa: E712
        F.count_if(F.col("payment_status").isin("Failed", "Reversed")).alias("failed_or_reversed"),
        as_double(F.round(F.sum(F.when(F.col("payment_status") == "Completed", F.col("payment_amount"))), 2))
        .alias("total_collected"))
