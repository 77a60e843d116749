"""Every registered star query completes (ANSI mode on) over a domain seeded with nulls."""

import datetime as dt
from decimal import Decimal

import pytest

from starling.params import RunParams
from starling.plans import registry
from starling.plans.star import Star
from starling.schemas import AGENTS, CLAIMS, CUSTOMERS, POLICIES, REGION_MAP

D = dt.date(2000, 3, 1)


@pytest.fixture(scope="module")
def null_star(spark):
    customers = spark.createDataFrame([
        ("c1", "Ann", 30, "F", "Nairobi", D, None),
        ("c2", "Bob", None, None, None, None, None),        # null age, county, signup
        (None, "Nobody", 40, "M", "Kisumu", D, None),        # null key
    ], CUSTOMERS)
    policies = spark.createDataFrame([
        ("p1", "c1", "Life", Decimal("1200.00"), D, D + dt.timedelta(days=1825), "Active"),
        ("p2", "c2", None, None, D, None, None),             # null type, premium, end, status
        ("p3", None, "Auto", Decimal("-5.00"), None, None, "Pending"),   # null customer and dates
        ("p4", "zz", "Auto", Decimal("50.00"), dt.date(2003, 1, 1), dt.date(2002, 1, 1), "Active"),
        (None, "c1", "Life", Decimal("10.00"), D, D, "Active"),         # null key
    ], POLICIES)
    claims = spark.createDataFrame([
        ("k1", "p1", "c1", "Fire", Decimal("100.00"), "Approved", D, D, Decimal("80.00"), None),
        ("k2", "p2", "c2", None, None, None, None, None, None, None),
        ("k3", None, None, "Theft", Decimal("0.00"), "Paid", D, D - dt.timedelta(days=3), Decimal("0.00"), None),
    ], CLAIMS)
    agents = spark.createDataFrame([
        ("a1", "Agent One", None, None, "Nairobi", D, "Active"),
        ("a2", None, None, None, None, None, None),
    ], AGENTS)
    region_map = spark.createDataFrame([("Nairobi", "Nairobi Metro")], REGION_MAP)
    domain = {"customers": customers, "policies": policies, "claims": claims, "agents": agents,
              "region_map": region_map}
    return Star(spark, domain, RunParams(as_of=dt.date(2001, 12, 31)))


@pytest.mark.parametrize("name", sorted(registry.STAR_QUERIES))
def test_query_runs_with_nulls(null_star, name):
    registry.STAR_QUERIES[name](null_star).collect()


def test_null_rows_are_kept_or_reported(null_star):
    from starling.plans import checks
    dq = {r["check"]: r["failures"] for r in checks.dq_sales(null_star).collect()}
    assert dq["null policy_id"] == 1 and dq["null customer_id"] == 1 and dq["null premium"] == 1
    assert dq["premium out of range"] == 1 and dq["end_date before start_date"] == 1
    assert dq["unmatched customer_id"] == 2  # 'zz' and the null customer id
    assert null_star.fact_sales.count() == 5  # lookups never drop rows
    misses = {r["check"]: r["failures"] for r in checks.lookup_misses(null_star).collect()}
    assert misses["unmatched status"] == 1
