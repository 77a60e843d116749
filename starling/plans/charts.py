"""Chart-ready frames (Q-23): labels, shares and tiers as columns.

Drawing is not built; these are the data the charts are drawn from.  Shares and
maxima are windows over the few rows of an aggregated frame, so that the fact is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starling.functions import columns as C
from starling.functions.money import as_double, pct_of_counts, ratio_pct
from starling.plans import analytics
from starling.plans.star import Star


def period_labels(star: Star) -> DataFrame:
    """Monthly premium trend with its 'Mon YYYY' period label."""
    m = analytics.monthly_premium(star)
    return m.withColumn("period", C.period_label("month_name", "year"))


def collections_chart(star: Star) -> DataFrame:
    """Collections vs premium as charted: rows with any null dropped, then labelled."""
    c = analytics.collections_as_written(star).dropna(how="any")
    return c.withColumn("period", C.period_label("month_name", "year"))


def over_all(aggregate: Column) -> Column:
    """An aggregate over a whole frame of few rows: one per policy type, payment method or county."""
    return aggregate.over(Window.partitionBy())


def premium_share(star: Star) -> DataFrame:
    """Policy-type donut: share of policies and of premium, one decimal."""
    g = star.fact_sales.groupBy("policy_type").agg(
        F.count(F.lit(1)).alias("count"), F.sum("premium_amount").alias("_p"))
    g = g.withColumns({"_n_all": over_all(F.sum("count")), "_p_all": over_all(F.sum("_p"))})
    return g.select("policy_type", "count", as_double(F.round("_p", 2)).alias("total_premium"),
                    as_double(pct_of_counts(F.col("count"), F.col("_n_all"), 1)).alias("count_share_pct"),
                    as_double(ratio_pct(F.col("_p"), F.col("_p_all"), 1)).alias("premium_share_pct"))


def payment_share(star: Star) -> DataFrame:
    """Payment-method donut: completed amount per method, its share and the centre total."""
    g = star.fact_payments.where(F.col("payment_status") == "Completed").groupBy("payment_method").agg(
        F.count(F.lit(1)).alias("payments"), F.sum("payment_amount").alias("_t"))
    g = g.withColumn("_all", over_all(F.sum("_t")))
    return g.select("payment_method", "payments", as_double(F.round("_t", 2)).alias("total_collected"),
                    as_double(ratio_pct(F.col("_t"), F.col("_all"), 1)).alias("share_pct"),
                    as_double(F.round("_all", 2)).alias("grand_total"))


def label_positions(star: Star) -> DataFrame:
    """County bars: where each label goes, a hundredth of the greatest bar beyond its own."""
    cp = analytics.county_premium(star)
    return cp.select("county_name", "total_premium", over_all(F.max("total_premium")).alias("max_premium")).withColumn(
        "label_at", F.round(F.col("total_premium") + F.col("max_premium") * 0.01, 2))


def loss_ratio_tier(star: Star) -> DataFrame:
    """Loss ratio bars coloured by tier (>100 danger, >70 warning, else success)."""
    lr = analytics.loss_ratio_as_written(star)
    return lr.select("policy_type", "loss_ratio_pct", C.loss_ratio_tier("loss_ratio_pct").alias("tier"),
                     F.concat(F.col("loss_ratio_pct").cast("string"), F.lit("%")).alias("label"))


def money_labels(star: Star) -> DataFrame:
    """County bars: fixed-unit label 'KES 1.23M' and the tiered axis label."""
    cp = analytics.county_premium(star)
    return cp.select("county_name", "total_premium",
                     C.kes_millions("total_premium", 2).alias("label_millions"),
                     C.kes_label("total_premium").alias("axis_label"))
