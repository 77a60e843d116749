"""Named queries over the test tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each call maps the driver tables onto the domain lazily, builds the star
schema lazily, and returns the query's DataFrame; nothing runs until an action.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.params import RunParams
from starling.plans import analytics as A
from starling.plans import charts as CH
from starling.plans import checks as Q
from starling.plans import keysets as K
from starling.plans import views as V
from starling.plans.star import Star
from starling.sources import testbed
from starling.streaming import consumer as C
from starling.streaming import decode as D


def _present(df: DataFrame) -> DataFrame:
    """Decimal money -> double, timestamps kept; for result comparison/export."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "decimal":
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _dim(name):
    return lambda s: _present(s.table(name))


STAR_QUERIES: dict[str, Callable[[Star], DataFrame]] = {
    # dimensions / facts (PIP-1..9)
    "dim_date": _dim("dim_date"),
    "dim_policy_type": _dim("dim_policy_type"),
    "dim_county": _dim("dim_county"),
    "dim_customer": _dim("dim_customer"),
    "dim_agent": _dim("dim_agent"),
    "fact_sales": _dim("fact_sales"),
    "fact_claims": _dim("fact_claims"),
    "fact_payments": _dim("fact_payments"),
    "installment_schedule": K.installment_schedule,
    # analytics (Q-1..Q-15)
    "monthly_premium": A.monthly_premium,
    "county_premium": A.county_premium,
    "policy_type_dist": A.policy_type_dist,
    "claims_status": A.claims_status,
    "loss_ratio_as_written": A.loss_ratio_as_written,
    "loss_ratio_corrected": A.loss_ratio_corrected,
    "agent_top10": A.agent_top10,
    "payment_method": A.payment_method,
    "late_by_frequency": A.late_by_frequency,
    "age_band": A.age_band,
    "age_band_corrected": A.age_band_corrected,
    "collections_as_written": A.collections_as_written,
    "collections_corrected": A.collections_corrected,
    "summary_stats": A.summary_stats,
    "late_by_policy_type": A.late_by_policy_type,
    "sales_by_type": A.sales_by_type,
    "claims_totals_by_status": A.claims_totals_by_status,
    "payments_by_method_status_top10": A.payments_by_method_status_top10,
    # views (Q-16..Q-21)
    "v_premium_by_policy_type": V.v_premium_by_policy_type,
    "v_claims_summary": V.v_claims_summary,
    "v_payment_methods": V.v_payment_methods,
    "v_monthly_trends": V.v_monthly_trends,
    "v_summary_stats": V.v_summary_stats,
    "dim_row_counts": V.dim_row_counts,
    # data quality (DQ-1..7, AGG-17/18)
    "dq_sales": Q.dq_sales,
    "dq_claims": Q.dq_claims,
    "dq_payments": Q.dq_payments,
    "lookup_misses": Q.lookup_misses,
    "null_profile": Q.null_profile_facts,
    "value_counts": Q.value_counts_payments,
    "verify_sales": Q.verify_sales,
    "reconcile_claims": Q.reconcile_claims,
    "verify_payments": Q.verify_payments,
    # key operators (JN-10..14, FLT-8, ARR-2)
    "new_rows_only": K.new_rows_only,
    "rows_with_valid_date": K.rows_with_valid_date,
    "dropped_dates": K.dropped_dates,
    "orphan_customers": K.orphan_customers,
    "hash_assigned_agent": K.hash_assigned_agent,
    "sampled_rows": K.sampled_rows,
    "child_expansion": K.child_expansion,
    "sales_records": K.sales_records,
    # chart frames (Q-23)
    "period_labels": CH.period_labels,
    "collections_chart": CH.collections_chart,
    "premium_share": CH.premium_share,
    "payment_share": CH.payment_share,
    "loss_ratio_tier": CH.loss_ratio_tier,
    "money_labels": CH.money_labels,
    "label_positions": CH.label_positions,
}


def _events(policy: str):
    def q(spark: SparkSession, sf_dir: str, params: RunParams) -> DataFrame:
        log = D.decode(testbed.event_feed(spark, sf_dir), policy, ingest_ts=F.lit(params.load_ts).cast("timestamp"))
        return log.withColumn("amount", F.col("amount").cast("double"))
    return q


def _event_totals(spark: SparkSession, sf_dir: str, params: RunParams) -> DataFrame:
    feed = testbed.event_feed(spark, sf_dir)
    return D.event_totals(D.decode(feed, "strict", ingest_ts=F.lit(params.load_ts).cast("timestamp")))


def _event_quarantine(spark: SparkSession, sf_dir: str, params: RunParams) -> DataFrame:
    return D.quarantine(testbed.broken_feed(spark, sf_dir), keep=["key", "seq"])


def _event_lines(spark: SparkSession, sf_dir: str, params: RunParams) -> DataFrame:
    return C.event_lines(D.parse(testbed.broken_feed(spark, sf_dir)), F.col("seq"))


FEED_QUERIES = {
    "events_strict": _events("strict"),
    "events_lenient": _events("lenient"),
    "event_totals": _event_totals,
    "event_quarantine": _event_quarantine,
    "event_lines": _event_lines,
}

ALL = list(STAR_QUERIES) + list(FEED_QUERIES)

# The reference's presentation order per query (ORDER BY ... ; DESC puts nulls first as in
# PostgreSQL).  Results are sets; order is applied only on request (``run(..., ordered=True)``).
# "-col" = descending with nulls first
ORDER_BY = {
    "monthly_premium": ["year", "month"], "period_labels": ["year", "month"],
    "collections_as_written": ["year", "month"], "collections_corrected": ["year", "month"],
    "collections_chart": ["year", "month"],
    "county_premium": ["-total_premium"], "money_labels": ["-total_premium"],
    "policy_type_dist": ["-count"], "premium_share": ["-count"],
    "payment_share": ["-total_collected"],
    "claims_status": ["-claims"], "claims_totals_by_status": ["-claims"], "v_claims_summary": ["-claims"],
    "loss_ratio_as_written": ["-loss_ratio_pct"], "loss_ratio_corrected": ["-loss_ratio_pct"],
    "loss_ratio_tier": ["-loss_ratio_pct"],
    "agent_top10": ["-total_premium"], "payments_by_method_status_top10": ["-payments"],
    "payment_method": ["-total_collected"], "v_payment_methods": ["-total_collected"],
    "late_by_frequency": ["-late_pct"], "late_by_policy_type": ["-late_payments"],
    "age_band": ["age_band"], "age_band_corrected": ["age_band"],
    "sales_by_type": ["-total_premium"], "v_premium_by_policy_type": ["-total_premium"],
    "v_monthly_trends": ["month"], "value_counts": ["column_name", "-n"],
}


def run(spark: SparkSession, sf_dir: str, name: str, params: RunParams | None = None,
        ordered: bool = False) -> DataFrame:
    params = params or RunParams()
    if name in FEED_QUERIES:
        df = FEED_QUERIES[name](spark, sf_dir, params)
    else:
        df = STAR_QUERIES[name](Star.from_sf_dir(spark, sf_dir, params))
    if not ordered or name not in ORDER_BY:
        return df
    return df.orderBy(*order_columns(name))


def order_columns(name: str) -> list:
    """The reference's presentation ORDER BY of a query as Columns (empty if none)."""
    return [F.col(c[1:]).desc_nulls_first() if c.startswith("-") else F.col(c).asc()
            for c in ORDER_BY.get(name, [])]


def callables(params: RunParams | None = None) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: (lambda spark, sf_dir, _n=n: run(spark, sf_dir, _n, params)) for n in ALL}
