"""The full run: loads every table, and a second run appends nothing."""

import tempfile

from starling.params import RunParams
from starling.plans import analytics as A
from starling.plans import load
from starling.plans.star import Star
from starling.sources import testbed
from tests.conftest import SF_SMALL, rows


def test_full_load_is_idempotent_and_matches_lazy_star(spark):
    params = RunParams()
    root = tempfile.mkdtemp(prefix="wh-test-")
    lake = tempfile.mkdtemp(prefix="lake-test-")
    domain = testbed.domain(spark, SF_SMALL, params)
    first = load.run(spark, domain, root, params, lake_root=lake + "/snap1")
    assert first["appended"]["fact_sales"] == domain["policies"].count()
    assert first["appended"]["dim_claim_status"] == 5
    assert first["verify"]["reconcile_claims"]["missing_rows"] == 0
    assert first["verify"]["verify_sales"]["orphaned_rows"] == 0
    second = load.run(spark, domain, root, params, lake_root=lake + "/snap2", with_checks=False)
    assert all(v == 0 for v in second["appended"].values()), second["appended"]

    stored = load.stored_star(spark, root, params, domain)
    lazy = Star(spark, domain, params)
    for name in ["fact_sales", "fact_claims", "fact_payments", "dim_customer", "dim_agent", "dim_date"]:
        assert stored.table(name).count() == lazy.table(name).count(), name
    assert rows(A.county_premium(stored)) == rows(A.county_premium(lazy))
    assert rows(A.collections_as_written(stored)) == rows(A.collections_as_written(lazy))
    # the view set (PIP-12/13) is queryable with SQL over the stored tables
    from starling.plans import views
    names = views.register_views(stored)
    assert spark.sql("SELECT COUNT(*) AS n FROM v_summary_stats").first()["n"] == 7
    assert spark.sql("SELECT COUNT(*) AS n FROM summary_stats").first()["n"] == 5
    late = spark.sql("SELECT SUM(late_payments + on_time_payments) AS n FROM v_late_payments").first()["n"]
    assert late == stored.fact_payments.where("policy_type_id IS NOT NULL AND is_late IS NOT NULL").count()
    assert set(names) >= {"v_premium_by_policy_type", "v_claims_summary", "v_payment_methods", "v_monthly_trends"}


def test_incremental_load_appends_only_new_rows(spark):
    import datetime as dt

    from pyspark.sql import functions as F
    params = RunParams()
    root = tempfile.mkdtemp(prefix="wh-incr-")
    domain = testbed.domain(spark, SF_SMALL, params)
    cut = dt.date(2000, 12, 31)
    earlier = dict(domain)
    earlier["policies"] = domain["policies"].where(F.col("start_date") <= cut)
    earlier["claims"] = domain["claims"].join(earlier["policies"].select("policy_id"), "policy_id", "left_semi")
    first = load.run(spark, earlier, root, params, with_checks=False)
    second = load.run(spark, domain, root, params, with_checks=False)
    newer = domain["policies"].where(F.col("start_date") > cut).count()
    assert first["appended"]["fact_sales"] + second["appended"]["fact_sales"] == domain["policies"].count()
    assert second["appended"]["fact_sales"] == newer
    stored = load.stored_star(spark, root, params, domain)
    lazy = Star(spark, domain, params)
    for name in ["fact_sales", "fact_claims", "fact_payments"]:
        cols = [c for c in lazy.table(name).columns if c != "created_at"]
        assert stored.table(name).select(cols).exceptAll(lazy.table(name).select(cols)).count() == 0, name
        assert stored.table(name).count() == lazy.table(name).count(), name


def test_rerun_with_null_and_corrected_dates_appends_nothing(spark):
    import datetime as dt

    from pyspark.sql import functions as F
    params = RunParams()
    root = tempfile.mkdtemp(prefix="wh-rerun-")
    domain = testbed.domain(spark, SF_SMALL, params)
    some = [r[0] for r in domain["policies"].orderBy("policy_id").limit(2).select("policy_id").collect()]

    def dated(day):
        p = domain["policies"]
        moved = F.when(F.col("policy_id") == some[0], F.lit(None).cast("date")).when(
            F.col("policy_id") == some[1], F.lit(day)).otherwise(F.col("start_date"))
        return {**domain, "policies": p.withColumn("start_date", moved)}

    first = load.run(spark, dated(dt.date(1999, 3, 4)), root, params, with_checks=False)
    assert first["appended"]["fact_sales"] == domain["policies"].count()
    for day in (dt.date(1999, 3, 4), dt.date(2000, 9, 9)):
        again = load.run(spark, dated(day), root, params, with_checks=False)
        assert again["appended"]["fact_sales"] == 0 and again["appended"]["fact_claims"] == 0
