"""Faults planted in the source tables: every quality rule and key check finds its own, and only those."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starling.params import RunParams
from starling.plans import checks, keysets, registry
from starling.plans.star import Star
from starling.schemas import CLAIMS, CUSTOMERS, POLICIES, REGION_MAP
from starling.schemas import AGENTS
from tests.conftest import SF_SMALL

D1, D2 = dt.date(2000, 1, 10), dt.date(2000, 12, 31)
TS = dt.datetime(2000, 1, 1)


def policy(i, **changes):
    row = {"policy_id": f"P{i}", "customer_id": f"C{i % 3}", "policy_type": "Auto", "premium": Decimal("100.00"),
           "start_date": D1, "end_date": D2, "status": "Active", **changes}
    return tuple(row[f] for f in POLICIES.names)


def claim(i, **changes):
    row = {"claim_id": f"CL{i}", "policy_id": f"P{i}", "customer_id": f"C{i % 3}", "claim_type": "Accident",
           "claim_amount": Decimal("50.00"), "claim_status": "Pending", "incident_date": D1, "claim_date": D2,
           "approved_amount": Decimal("0.00"), "created_at": TS, **changes}
    return tuple(row[f] for f in CLAIMS.names)


POLICY_FAULTS = [policy(10, policy_id=None), policy(11, customer_id=None), policy(12, premium=None), policy(13, start_date=None),
                 policy(14, premium=Decimal("-1.00")), policy(15, premium=Decimal("1000001.00")),
                 policy(16, end_date=dt.date(1999, 1, 1)), policy(17, customer_id="nobody"), policy(18, customer_id="nobody")]
CLAIM_FAULTS = [claim(20, claim_id=None), claim(21, customer_id=None), claim(22, policy_id=None), claim(23, claim_amount=Decimal("-5.00")),
                claim(24, claim_amount=None), claim(25, incident_date=D2, claim_date=D1), claim(1, claim_id="CL26", claim_status="Lost"),
                claim(27, policy_id="none"), claim(2, claim_id="CL28", customer_id="nobody")]


@pytest.fixture(scope="module")
def star(spark):
    customers = [(f"C{i}", f"Name {i}", 30 + i, "F", "Nairobi", D1, TS) for i in range(3)]
    agents = [("A1", "Agent One", "1", "a@x", "Nairobi", D1, "Active")]
    domain = {"customers": spark.createDataFrame(customers, CUSTOMERS), "agents": spark.createDataFrame(agents, AGENTS),
              "policies": spark.createDataFrame([policy(i) for i in range(10)] + POLICY_FAULTS, POLICIES),
              "claims": spark.createDataFrame([claim(i) for i in range(10)] + CLAIM_FAULTS, CLAIMS),
              "region_map": spark.createDataFrame([("Nairobi", "Central")], REGION_MAP)}
    return Star(spark, domain, RunParams())


def failures(df):
    return {r["check"]: r["failures"] for r in df.collect()}


def test_policy_rules_find_planted_faults(star):
    assert failures(checks.dq_sales(star)) == {
        "null policy_id": 1, "null customer_id": 1, "null premium": 1, "null start_date": 1, "premium out of range": 2,
        "end_date before start_date": 1, "unmatched customer_id": 3}       # null and two of nobody's
    assert failures(checks.dq_payments(star)) == {"null policy_id": 1, "null customer_id": 1, "null premium": 1,
                                                  "negative premium": 1, "null start_date": 1}


def test_claim_rules_find_planted_faults(star):
    assert failures(checks.dq_claims(star)) == {
        "null claim_id": 1, "null customer_id": 1, "null policy_id": 1, "negative claim_amount": 1, "null claim_amount": 1,
        "claim_date before incident_date": 1}


def test_lookup_misses_find_planted_faults(star):
    found = failures(checks.lookup_misses(star))
    assert found["unmatched status"] == 1                                  # Lost
    assert found["unmatched county"] == 2                                  # a null customer and nobody
    # claims 20 to 27 name policies that are not there, and one none at all
    assert found["unmatched policy type"] == 7


def test_orphans_and_post_load_checks(star):
    assert tuple(keysets.orphan_customers(star).first()) == (3, 1)
    assert checks.verify_sales(star).first().asDict() == {"total_rows": 19, "null_premiums": 1, "orphaned_rows": 3}
    assert checks.reconcile_claims(star).first().asDict() == {
        "source_claims": 19, "fact_claims": 19, "missing_rows": 1, "null_amounts": 1}      # the claim without an id
    gone = Star(star.spark, star.domain, star.params, {"fact_claims": star.fact_claims.where("claim_id <> 'CL3'")})
    assert checks.reconcile_claims(gone).first()["missing_rows"] == 2


def test_unreadable_money_is_null(spark):
    from starling.functions.money import lenient_money
    got = spark.createDataFrame([("12.345",), ("abc",), (None,), ("",)], "m string").select(lenient_money("m").alias("m")).collect()
    assert [r["m"] for r in got] == [Decimal("12.35"), None, None, None]


@pytest.mark.parametrize("name", ["monthly_premium", "county_premium", "loss_ratio_as_written", "claims_status", "age_band"])
def test_results_come_in_the_order_asked_for(spark, name):
    got = [tuple(r) for r in registry.run(spark, SF_SMALL, name, ordered=True).collect()]
    cols = registry.run(spark, SF_SMALL, name).columns
    keys = registry.ORDER_BY[name]

    def key(row):
        # descending columns: nulls first, as the greatest values
        return [(-float("inf") if row[cols.index(k[1:])] is None else -row[cols.index(k[1:])]) if k.startswith("-")
                else row[cols.index(k)] for k in keys]

    assert len(got) > 1 and [key(r) for r in got] == sorted(key(r) for r in got)


def test_descending_order_puts_nulls_first(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 3.0)], "policy_type string, loss_ratio_pct double")
    assert [r[0] for r in df.orderBy(*registry.order_columns("loss_ratio_as_written")).collect()] == ["b", "c", "a"]
