import datetime as dt
from decimal import Decimal

import pytest

from starling.operators.quality import DataQualityError, null_profile, raise_if_failed, value_counts
from starling.params import RunParams
from starling.plans import checks
from starling.plans.star import Star

D = dt.date(2024, 1, 1)


def _star(spark, policies=None, claims=None, customers=None):
    cust = customers or spark.createDataFrame(
        [("c1", "A", 30, "Male", "Nairobi", D, None)],
        "customer_id string, full_name string, age int, gender string, county string, signup_date date, ingested_at timestamp")
    pol = policies or spark.createDataFrame([], "policy_id string, customer_id string, policy_type string, "
                                                "premium decimal(12,2), start_date date, end_date date, status string")
    clm = claims or spark.createDataFrame([], "claim_id string, policy_id string, customer_id string, claim_type string, "
                                              "claim_amount decimal(12,2), claim_status string, incident_date date, "
                                              "claim_date date, approved_amount decimal(12,2), created_at timestamp")
    return Star(spark, {"customers": cust, "policies": pol, "claims": clm, "agents": None}, RunParams())


def _as_dict(df):
    return {r["check"]: r["failures"] for r in df.collect()}


def test_dq_sales_rules(spark):
    pol = spark.createDataFrame([
        ("p1", "c1", "Life", Decimal("-1.00"), D, D, "Active"),
        ("p2", "c1", "Life", Decimal("1000001.00"), D, D, "Active"),
        ("p3", "c1", "Life", None, D, D, "Active"),
        ("p4", "c1", "Life", Decimal("10.00"), D, D - dt.timedelta(days=1), "Active"),
        ("p5", "zz", "Life", Decimal("10.00"), D, D, "Active"),
    ], "policy_id string, customer_id string, policy_type string, premium decimal(12,2), start_date date, end_date date, status string")
    got = _as_dict(checks.dq_sales(_star(spark, policies=pol)))
    assert got["premium out of range"] == 2 and got["null premium"] == 1
    assert got["end_date before start_date"] == 1 and got["unmatched customer_id"] == 1
    assert got["null policy_id"] == 0


def test_dq_claims_null_dates_not_counted(spark):
    clm = spark.createDataFrame([
        ("k1", "p1", "c1", "Fire", Decimal("5.00"), "Paid", D, D - dt.timedelta(days=2), Decimal("1.00"), None),
        ("k2", "p1", "c1", "Fire", Decimal("-5.00"), "Paid", D, None, Decimal("1.00"), None),
    ], "claim_id string, policy_id string, customer_id string, claim_type string, claim_amount decimal(12,2), "
       "claim_status string, incident_date date, claim_date date, approved_amount decimal(12,2), created_at timestamp")
    got = _as_dict(checks.dq_claims(_star(spark, claims=clm)))
    assert got["claim_date before incident_date"] == 1 and got["negative claim_amount"] == 1


def test_strict_mode_raises(spark):
    df = spark.createDataFrame([("bad", 2), ("ok", 0)], "check string, failures long")
    with pytest.raises(DataQualityError):
        raise_if_failed(df, strict=True)
    assert raise_if_failed(df, strict=False).count() == 2


def test_null_profile_and_value_counts(spark):
    df = spark.createDataFrame([("a", None), ("a", 1), (None, 2)], "s string, n int")
    assert {r["column_name"]: r["null_count"] for r in null_profile(df).collect()} == {"s": 1, "n": 1}
    vc = {(r["column_name"], r["value"]): r["n"] for r in value_counts(df, ["s", "n"]).collect()}
    assert vc[("s", "a")] == 2 and vc[("s", None)] == 1 and vc[("n", "2")] == 1
