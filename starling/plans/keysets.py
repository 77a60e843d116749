"""Key-level queries: incremental loads, calendar split, orphans, partner
assignment, sampling and child expansion (JN-10 .. JN-14, FLT-8, ARR-2)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.functions.hashing import below, hash32, stable_id
from starling.operators.expand import child_rows
from starling.operators.keys import assign_partner, only_new_rows
from starling.plans import facts
from starling.plans.star import Star

CLAIM_PROBABILITY = 0.4  # share of policies that file a claim (re-aimed generator)


def new_rows_only(star: Star) -> DataFrame:
    """JN-10: incremental fact_sales load -- rows not yet in the target.

    The target is what a previous run (``params.prev_as_of``) loaded: sales
    of policies that had started by then.  Today's rows minus the target's
    keys (null-safe left anti join) are the rows to append.
    """
    target = star.fact_sales.where(F.col("start_date") <= F.lit(star.params.prev_as_of)).select("policy_id")
    new = only_new_rows(star.fact_sales, target, "policy_id")
    return new.select("sale_id", "policy_id", "customer_id", "date_key",
                      F.col("premium_amount").cast("double").alias("premium_amount"))


def _up_to_as_of(star: Star) -> DataFrame:
    """The calendar through the ``as_of`` year, in which late payments of its last days have no date."""
    return star.dim_date.where(F.col("date_key") <= F.lit(dt.date(star.params.as_of.year, 12, 31)))


def rows_with_valid_date(star: Star) -> DataFrame:
    """JN-12 kept side: installments whose payment date is in the calendar through the ``as_of`` year."""
    kept, _ = facts.split_payments(star.payment_rows, _up_to_as_of(star))
    return kept.select("payment_id", "policy_id", "date_key",
                       F.col("payment_amount").cast("double").alias("payment_amount"))


def dropped_dates(star: Star) -> DataFrame:
    """JN-12 dropped side: installments outside of that calendar (reported, not loaded)."""
    _, dropped = facts.split_payments(star.payment_rows, _up_to_as_of(star))
    return dropped.select("payment_id", "policy_id", "date_key",
                          F.col("payment_amount").cast("double").alias("payment_amount"))


def orphan_customers(star: Star) -> DataFrame:
    """JN-13: policies whose customer is missing from dim_customer, counted."""
    orphans = star.policies.join(star.dim_customer.select("customer_id"), "customer_id", "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("orphan_policies"),
                       F.count_distinct("customer_id").alias("orphan_customer_ids"))


def hash_assigned_agent(star: Star) -> DataFrame:
    """JN-14: the agent each policy's sale was assigned to."""
    return star.fact_sales.select("policy_id", "agent_id")


def sampled_rows(star: Star) -> DataFrame:
    """FLT-8: the policies that file a claim, a reproducible Bernoulli(0.4) sample by key hash."""
    p = star.policies
    return p.where(below(hash32("claim", "policy_id"), CLAIM_PROBABILITY)).select(
        "policy_id", "customer_id", "start_date", F.col("premium").cast("double").alias("premium"))


def child_expansion(star: Star) -> DataFrame:
    """ARR-2: 1..6 OLTP payment rows per policy."""
    df = child_rows(star.policies, star.params.as_of)
    return df.select("payment_id", "policy_id", "customer_id", "payment_date",
                     F.col("amount").cast("double").alias("amount"), "payment_method", "status")


SALE_RATE_PCT = (5, 15)  # OLTP sales: commission rate 0.05 .. 0.15 on a 0.01 grid


def sales_records(star: Star) -> DataFrame:
    """OLTP sales rows: one sale per policy, an agent drawn from all agents by
    key hash, a 2-decimal commission rate and commission = round(premium * rate, 2)."""
    lo, hi = SALE_RATE_PCT
    rate = ((F.lit(lo) + F.pmod(hash32("sale_rate", "policy_id"), F.lit(hi - lo + 1))).cast("decimal(5,0)")
            / F.lit(100).cast("decimal(3,0)")).cast("decimal(5,4)")
    p = assign_partner(star.policies, star.agents, "agent_id", "policy_id", "sale_agent", "agent_id",
                       star.params.broadcast_max_rows)
    return p.select(
        stable_id("oltp_sale", "policy_id").alias("sale_id"), "policy_id", "customer_id", "agent_id",
        F.lit(star.params.as_of).alias("sale_date"), rate.cast("double").alias("commission_rate"),
        F.round(F.col("premium") * rate, 2).cast("decimal(12,2)").cast("double").alias("commission_amount"),
        F.col("premium").cast("double").alias("premium_amount"))


def installment_schedule(star: Star) -> DataFrame:
    """ARR-1: the due-date series of every policy (before payment attributes)."""
    from starling.operators.expand import installment_schedule as sched
    s = sched(star.policies, star.params.as_of)
    return s.select("policy_id", "payment_frequency", "installment_no", "due_date",
                    F.col("expected_amount").cast("double").alias("expected_amount"))
