"""A hot key holding a third of the rows: results stay whole and exact when
AQE splits the skewed join partitions (thresholds lowered so the split runs)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from starling.params import RunParams
from starling.plans import analytics as A
from starling.plans import facts
from starling.plans.star import Star

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",  # force shuffle joins
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


def _domain(spark, n=6000):
    hot = F.col("id") % 3 == 0  # a third of all policies belong to customer c0
    pol = spark.range(0, n, numPartitions=6).select(
        F.col("id").cast("string").alias("policy_id"),
        F.when(hot, F.lit("c0")).otherwise(F.concat(F.lit("c"), (1 + F.col("id") % 199).cast("string"))).alias("customer_id"),
        F.concat(F.lit("T"), (F.col("id") % 4).cast("string")).alias("policy_type"),
        (F.lit(100) + F.col("id") % 50).cast("decimal(12,2)").alias("premium"),
        F.lit(dt.date(2000, 1, 1)).alias("start_date"), F.lit(dt.date(2005, 1, 1)).alias("end_date"),
        F.lit("Active").alias("status"))
    cust = spark.range(0, 200).select(
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("customer_id"), F.lit("x").alias("full_name"),
        F.lit(40).alias("age"), F.lit("Male").alias("gender"),
        F.concat(F.lit("K"), (F.col("id") % 7).cast("string")).alias("county"),
        F.lit(dt.date(1999, 1, 1)).alias("signup_date"), F.lit(None).cast("timestamp").alias("ingested_at"))
    agents = spark.range(0, 20).select(
        F.concat(F.lit("a"), F.col("id").cast("string")).alias("agent_id"), F.lit("n").alias("full_name"),
        F.lit(None).cast("string").alias("phone"), F.lit(None).cast("string").alias("email"),
        F.lit("K1").alias("county"), F.lit(dt.date(1990, 1, 1)).alias("hire_date"), F.lit("Active").alias("status"))
    return {"customers": cust, "policies": pol, "agents": agents, "claims": None}


def test_hot_customer_fact_sales_whole_and_exact(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        s = Star(spark, _domain(spark), RunParams(broadcast_max_rows=None))
        fs = s.fact_sales
        got = fs.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"), F.count("county_id").alias("with_county"))
        hot = got.where("customer_id = 'c0'").first()
        assert hot["n"] == 2000 and hot["with_county"] == 2000
        assert fs.count() == 6000 and fs.select("policy_id").distinct().count() == 6000
        assert fs.where(F.col("agent_id").isNull()).count() == 0
        per_type = {r["policy_type"]: r["total_premium"] for r in A.policy_type_dist(s).collect()}
        expected = {f"T{t}": float(sum(Decimal(100 + i % 50) for i in range(6000) if i % 4 == t)) for t in range(4)}
        assert per_type == expected
        age = A.age_band(s).first()
        assert age["customers"] == 6000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_key_payment_schedule_is_complete(spark):
    d = _domain(spark, 900)
    s = Star(spark, d, RunParams(broadcast_max_rows=None, as_of=dt.date(2001, 12, 31)))
    rows = facts.payment_rows(d["policies"], s.dim_customer, s.dim_county, s.dim_policy_type, s.params)
    per_policy = rows.groupBy("policy_id").count()
    assert per_policy.count() == 900
    # 730 days: monthly 25, quarterly 9 or annual 3 installments (day 0 included)
    assert {r["count"] for r in per_policy.collect()} <= {25, 9, 3}
