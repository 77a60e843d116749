"""Catalog tables and stored views over a loaded warehouse."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from starling.params import RunParams
from starling.plans import catalog, load, views
from starling.sources import testbed
from tests.conftest import SF_SMALL, rows

DB = "starling_test"


@pytest.fixture(scope="module")
def published(spark):
    root, params = tempfile.mkdtemp(prefix="wh-catalog-"), RunParams()
    domain = testbed.domain(spark, SF_SMALL, params)
    load.run(spark, domain, root, params, with_checks=False)
    catalog.publish(spark, DB, root)
    yield load.stored_star(spark, root, params, domain)
    spark.sql(f"DROP DATABASE {DB} CASCADE")


@pytest.mark.parametrize("name", sorted(catalog.VIEWS))
def test_stored_views_equal_the_queries(spark, published, name):
    query = views.VIEWS[name](published)
    got = spark.sql(f"SELECT * FROM {DB}.{name}")
    assert sorted(got.columns) == sorted(query.columns)
    assert rows(got, *sorted(got.columns)) == rows(query, *sorted(query.columns))


def test_tables_are_created_once_and_read_what_the_load_wrote(spark, published):
    for name in catalog.REQUIRED:
        assert spark.table(f"{DB}.{name}").count() == published.table(name).count() > 0
    root = published.fact_sales.inputFiles()[0].split("/fact_sales/")[0].removeprefix("file://")
    assert catalog.create_tables(spark, DB, root) == list(catalog.REQUIRED)
    assert spark.table(f"{DB}.fact_sales").count() == published.fact_sales.count()
    plan = spark.table(f"{DB}.fact_sales").where("date_month = DATE '2000-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_month" in plan


def test_inserts_fill_in_defaults(spark, published):
    before = spark.table(f"{DB}.fact_payments").count()
    one = spark.createDataFrame([("new-1", "P5", dt.date(2000, 5, 6))], "payment_id string, policy_id string, date_key date")
    catalog.insert(spark, DB, "fact_payments", one)
    row = spark.table(f"{DB}.fact_payments").where("payment_id = 'new-1'").first()
    assert (row["is_late"], row["days_late"], row["payment_amount"]) == (False, 0, None) and row["created_at"] is not None
    assert row["date_month"] == dt.date(2000, 5, 1) and spark.table(f"{DB}.fact_payments").count() == before + 1
    catalog.insert(spark, DB, "dim_agent", published.dim_agent.limit(1).select(F.lit("A-new").alias("agent_id")))
    assert spark.table(f"{DB}.dim_agent").where("agent_name IS NULL").select("is_active").first()[0] is True


def test_required_columns_and_unknown_ones_are_refused(spark, published):
    none = published.fact_payments.limit(1).select(F.lit(None).cast("string").alias("payment_id"), "policy_id")
    with pytest.raises(Exception, match="payment_id is null"):
        catalog.insert(spark, DB, "fact_payments", none)
    with pytest.raises(ValueError, match="required columns"):
        catalog.insert(spark, DB, "fact_payments", published.fact_payments.limit(1).select("policy_id"))
    with pytest.raises(ValueError, match="unknown columns"):
        catalog.insert(spark, DB, "dim_county", published.dim_county.withColumn("other", F.lit(1)))


def test_views_can_be_replaced_and_dropped(spark, published):
    assert catalog.create_views(spark, DB, ["v_monthly_trends"]) == ["v_monthly_trends"]
    catalog.drop_view(spark, DB, "v_monthly_trends")
    catalog.drop_view(spark, DB, "v_monthly_trends")
    assert not spark.catalog.tableExists(f"{DB}.v_monthly_trends")
    catalog.create_views(spark, DB)
    assert spark.catalog.tableExists(f"{DB}.v_monthly_trends")
