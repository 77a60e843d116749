"""Bucketed domain tables: the claims-to-policies join has no exchange and the same result."""

import tempfile

import pytest

from starling.params import RunParams
from starling.plans.star import Star
from starling.sources import bucketed, testbed
from tests.conftest import SF_SMALL, rows

DB = "starling_buckets"


@pytest.fixture(scope="module")
def domains(spark):
    params = RunParams()
    plain = testbed.domain(spark, SF_SMALL, params)
    root = tempfile.mkdtemp(prefix="buckets-")
    assert bucketed.store(spark, DB, root, plain, 4) == ["policies", "claims"]
    assert bucketed.store(spark, DB, root, plain, 4) == []
    yield plain, bucketed.stored(spark, DB, plain)
    spark.sql(f"DROP DATABASE {DB} CASCADE")


def test_stored_join_has_no_exchange(spark, domains):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain, stored = domains

        def exchanges(d):
            joined = d["claims"].select("policy_id", "claim_id").join(d["policies"].select("policy_id", "policy_type"), "policy_id", "left")
            return joined._jdf.queryExecution().executedPlan().toString().count("Exchange")

        assert exchanges(plain) > 0 and exchanges(stored) == 0
        star = Star(spark, stored, RunParams())
        plan = star.fact_claims._jdf.queryExecution().executedPlan().toString()
        tail = plan[:plan.index("Bucketed: true")]
        assert "SortMergeJoin [policy_id" in plan and "hashpartitioning(policy_id" not in tail
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_facts_are_the_same(spark, domains):
    plain, stored = (Star(spark, d, RunParams()) for d in domains)
    assert rows(plain.fact_claims) == rows(stored.fact_claims)
    assert rows(plain.fact_sales, "policy_id", "policy_type_id", "agent_id") == \
        rows(stored.fact_sales, "policy_id", "policy_type_id", "agent_id")
