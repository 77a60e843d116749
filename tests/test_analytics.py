"""Query semantics on hand-made star tables (FIXTURES §4)."""

import datetime as dt
from decimal import Decimal

from starling.params import RunParams
from starling.plans import analytics as A
from starling.plans import charts as CH
from starling.plans import views as V
from starling.plans.star import Star
from starling.schemas import STAR

D = dt.date(2001, 3, 1)


def _empty(spark, name):
    return spark.createDataFrame([], STAR[name])


def _star(spark, **tables):
    base = {n: _empty(spark, n) for n in STAR}
    base.update({k: spark.createDataFrame(v, STAR[k]) for k, v in tables.items()})
    return Star.from_tables(spark, base, RunParams())


def _sale(sid, cust, type_id, premium, date=D, agent="a1"):
    return (sid, sid, cust, agent, date, type_id, 1, Decimal(premium), Decimal("0.1000"), "T", date, date, "Active")


def _claim(cid, type_id, approved, status_id=1, amount="100.00"):
    return (cid, "p", "c", D, D, status_id, 1, type_id, "Fire", Decimal(amount), Decimal(approved), "Pending", D, D, None)


def test_loss_ratio_fanout_and_null_type(spark):
    s = _star(spark, dim_policy_type=[(1, "X"), (2, "Y")],
              fact_sales=[_sale("s1", "c1", 1, "10"), _sale("s2", "c1", 1, "20")],
              fact_claims=[_claim("k1", 1, "5"), _claim("k2", 1, "5"), _claim("k3", 1, "5"), _claim("k4", 2, "7")])
    written = {r["policy_type"]: r for r in A.loss_ratio_as_written(s).collect()}
    assert written["X"]["total_premium"] == 90.0 and written["X"]["total_approved"] == 30.0
    assert written["X"]["loss_ratio_pct"] == 33.33
    assert written["Y"]["total_premium"] is None and written["Y"]["loss_ratio_pct"] is None
    corrected = {r["policy_type"]: r for r in A.loss_ratio_corrected(s).collect()}
    assert corrected["X"]["loss_ratio_pct"] == 50.0
    tiers = {r["policy_type"]: r["tier"] for r in CH.loss_ratio_tier(s).collect()}
    assert tiers["Y"] == "success"


def test_risk_level_passes_through_when_present(spark):
    s = _star(spark, dim_policy_type=[(1, "X")], fact_sales=[_sale("s1", "c1", 1, "10")],
              fact_claims=[_claim("k1", 1, "5")])
    dims = dict(s._given)
    dims["dim_policy_type"] = spark.createDataFrame([(1, "X", "high")], "policy_type_id int, policy_type string, risk_level string")
    s2 = Star.from_tables(spark, dims, RunParams())
    r = A.loss_ratio_as_written(s2).first()
    assert (r["policy_type"], r["risk_level"], r["loss_ratio_pct"]) == ("X", "high", 50.0)
    assert A.loss_ratio_corrected(s).first()["risk_level"] is None


def test_age_band_counts_joined_rows(spark):
    cust = [("c1", "A", 30, "26-35", "M", "X", "Other", D, "Loyal", None),
            ("c2", "B", 31, "26-35", "F", "X", "Other", D, "Loyal", None)]
    s = _star(spark, dim_customer=cust, fact_sales=[_sale("s1", "c1", 1, "10"), _sale("s2", "c1", 1, "21")])
    as_written = A.age_band(s).first()
    assert as_written["customers"] == 3 and as_written["avg_premium"] == 15.5
    corrected = A.age_band_corrected(s).first()
    assert corrected["customers"] == 2 and corrected["avg_premium"] == 15.5


def test_approval_pct_is_mean_of_ratios_skipping_zero_claims(spark):
    s = _star(spark, dim_claim_status=[(1, "Paid")],
              fact_claims=[_claim("k1", 1, "50.00", amount="100.00"), _claim("k2", 1, "0.00", amount="0.00")])
    r = V.v_claims_summary(s).first()
    assert r["approval_pct"] == 50.0 and r["claims"] == 2


def test_top10_tie_break_and_limit(spark):
    sales = [_sale(f"s{i}", "c", 1, "100", agent=f"a{i:02d}") for i in range(15)]
    agents = [(f"a{i:02d}", f"Agent {i}", "X", "Other", "Direct", D, True) for i in range(15)]
    s = _star(spark, fact_sales=sales, dim_agent=agents)
    top = A.agent_top10(s).collect()
    assert [r["agent_name"] for r in top] == [f"Agent {i}" for i in range(10)]


def test_share_columns_sum_to_100(spark):
    sales = [_sale(f"s{i}", "c", 1, str(10 + i)) for i in range(7)]
    s = _star(spark, fact_sales=sales)
    rows = CH.premium_share(s).collect()
    assert abs(sum(r["premium_share_pct"] for r in rows) - 100) < 0.5


def test_late_pct_rounds_half_up(spark):
    # 1 late of 8 = 12.5 % exactly
    s = _star(spark)
    fp = [(f"x{i}", "p", "c", D, 1, 1, Decimal("1.00"), Decimal("1.00"), Decimal("0"), True, "Cash", "Completed",
           "Monthly", i == 0, 1 if i == 0 else 0, D, D, None) for i in range(8)]
    s = _star(spark, fact_payments=fp)
    r = A.late_by_frequency(s).first()
    assert (r["total"], r["late"], r["late_pct"]) == (8, 1, 12.5)
