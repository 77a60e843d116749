"""Row-to-many expansion (the reference's only UDTF-like logic).

* ``installment_schedule``: every policy becomes its dated installment series
  at 30 / 90 / 365-day steps up to ``least(end_date, as_of)``.  Expressed as
  ``explode(sequence(0, n))`` inside the scan's stage: no shuffle, no Python.
  Policies starting after the cut-off are filtered *before* the sequence
  (reversed bounds would throw).
* ``child_rows``: 1..6 children per parent (re-aimed payment generation).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.functions.hashing import below, hash32, int_between, md5_hex, pick, slice32
from starling.schemas import MONEY

# ---- fixed values (must equal the reference's for identical results) -------
FREQUENCIES = ["Monthly", "Quarterly", "Annual"]
FREQUENCY_STEP_DAYS = {"Monthly": 30, "Quarterly": 90, "Annual": 365}
FREQUENCY_INSTALLMENTS = {"Monthly": 12, "Quarterly": 4, "Annual": 1}
PAYMENT_METHODS = ["Mpesa", "Bank Transfer", "Cash", "Card"]
PAYMENT_STATUSES = ["Completed", "Completed", "Completed", "Pending", "Failed", "Reversed"]
PAYMENT_DELAY_DAYS = (-3, 15)
PARTIAL_PAYMENT_P = 0.05
PARTIAL_FACTOR_PCT = (70, 99)
OLTP_PAYMENT_METHODS = ["M-Pesa", "Bank", "Card"]
OLTP_PAYMENTS_PER_POLICY = (1, 6)
# ---------------------------------------------------------------------------


def _by_frequency(freq, table: dict) -> F.Column:
    expr = None
    for name, value in table.items():
        expr = F.when(freq == name, F.lit(value)) if expr is None else expr.when(freq == name, F.lit(value))
    return expr


def installment_schedule(policies: DataFrame, as_of: _dt.date, carry: list[str] | None = None) -> DataFrame:
    """One row per due installment: policy columns + frequency, installment_no, due_date, expected_amount."""
    carry = carry or []
    # a policy's frequency is drawn from its key unless the input already carries one
    freq = (F.col("payment_frequency") if "payment_frequency" in policies.columns
            else pick(FREQUENCIES, hash32("frequency", "policy_id")))
    df = policies.select("policy_id", "customer_id", "premium", "start_date", "end_date", *carry,
                         freq.alias("payment_frequency"))
    step = _by_frequency(F.col("payment_frequency"), FREQUENCY_STEP_DAYS)
    parts = _by_frequency(F.col("payment_frequency"), FREQUENCY_INSTALLMENTS)
    cutoff = F.least(F.col("end_date"), F.lit(as_of))
    df = (df.withColumn("_step", step)
            .withColumn("expected_amount", F.round(F.col("premium") / parts, 2).cast(MONEY))
            .where(F.col("start_date") <= cutoff))
    n_last = F.floor(F.datediff(cutoff, F.col("start_date")) / F.col("_step")).cast("int")
    df = df.withColumn("installment_no", F.explode(F.sequence(F.lit(0), n_last)))
    return (df.withColumn("due_date", F.date_add(F.col("start_date"), F.col("installment_no") * F.col("_step")))
              .drop("_step"))


def payment_attributes(schedule: DataFrame) -> DataFrame:
    """Payment date, status, amount, method, late flags for each installment.

    One md5 per installment feeds four independent 32-bit draws (its four
    8-hex slices); a fifth draw (partial-payment factor) is only evaluated for
    the rows that need it.  The md5 itself is the payment_id, so re-runs are
    idempotent (the reference used a fresh uuid4 and re-appended everything).
    """
    hx = md5_hex("payment", "policy_id", "installment_no")
    df = schedule.withColumn("payment_id", hx)
    delay = int_between(slice32(F.col("payment_id"), 0), *PAYMENT_DELAY_DAYS)
    status = pick(PAYMENT_STATUSES, slice32(F.col("payment_id"), 1))
    partial = below(slice32(F.col("payment_id"), 2), PARTIAL_PAYMENT_P)
    method = pick(PAYMENT_METHODS, slice32(F.col("payment_id"), 3))
    lo, hi = PARTIAL_FACTOR_PCT
    factor = (int_between(hash32("factor", "payment_id"), lo, hi).cast("decimal(5,0)")
              / F.lit(100).cast("decimal(3,0)")).cast("decimal(3,2)")
    df = (df.withColumn("payment_date", F.date_add(F.col("due_date"), delay))
            .withColumn("payment_status", status)
            .withColumn("payment_method", method))
    amount = (F.when((F.col("payment_status") == "Completed") & partial,
                     F.round(F.col("expected_amount") * factor, 2))
              .when(F.col("payment_status").isin("Failed", "Reversed"), F.lit(0))
              .otherwise(F.col("expected_amount")))
    return (df.withColumn("payment_amount", amount.cast(MONEY))
              .withColumn("is_late", F.col("payment_date") > F.col("due_date"))
              .withColumn("days_late", F.greatest(F.lit(0), F.datediff("payment_date", "due_date")).cast("int"))
              .withColumn("variance", (F.col("payment_amount") - F.col("expected_amount")).cast(MONEY))
              .withColumn("is_full_payment", F.col("payment_amount") >= F.col("expected_amount")))


def child_rows(policies: DataFrame, as_of: _dt.date) -> DataFrame:
    """1..6 payment rows per policy (OLTP payments generator, re-aimed and reproducible)."""
    lo, hi = OLTP_PAYMENTS_PER_POLICY
    n = int_between(hash32("children", "policy_id"), lo, hi)
    df = policies.select("policy_id", "customer_id", "premium",
                         F.explode(F.sequence(F.lit(1), n)).alias("payment_no"))
    hx = md5_hex("oltp_payment", "policy_id", "payment_no")
    df = df.withColumn("payment_id", hx)
    return df.select(
        "payment_id", "policy_id", "customer_id",
        F.date_sub(F.lit(as_of), int_between(slice32(F.col("payment_id"), 0), 0, 180)).alias("payment_date"),
        F.round(F.col("premium") / 6, 2).cast(MONEY).alias("amount"),
        pick(OLTP_PAYMENT_METHODS, slice32(F.col("payment_id"), 1)).alias("payment_method"),
        F.lit("Completed").alias("status"),
        "payment_no")
