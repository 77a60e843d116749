import datetime as dt

from pyspark.sql import functions as F

from starling.functions import columns as C
from starling.params import RunParams
from starling.plans import dims


def test_age_band_edges(spark):
    ages = [18, 25, 26, 35, 36, 45, 46, 55, 56, 65, 66, None]
    df = spark.createDataFrame([(a,) for a in ages], "age int").select("age", C.age_band("age").alias("b"))
    got = {r["age"]: r["b"] for r in df.collect()}
    assert got == {18: "18-25", 25: "18-25", 26: "26-35", 35: "26-35", 36: "36-45", 45: "36-45",
                   46: "46-55", 55: "46-55", 56: "56-65", 65: "56-65", 66: "66+", None: "66+"}


def test_region_literal_default(spark):
    df = spark.createDataFrame([("Nairobi",), ("Eldoret",), (None,)], "county string")
    got = [r[0] for r in df.select(C.region_literal("county")).collect()]
    assert got == ["Nairobi Metro", "Other", "Other"]


def test_region_lookup_table_default(spark):
    cust = spark.createDataFrame([("Kisumu",), ("Garissa",), (None,)], "county string")
    rm = spark.createDataFrame([("Kisumu", "Nyanza")], "county string, region string")
    got = sorted((r["county"] or "", r["region"]) for r in dims.region_of(cust, "county", rm).collect())
    assert got == [("", "Other"), ("Garissa", "Other"), ("Kisumu", "Nyanza")]


def test_tenure_edges(spark):
    as_of = dt.date(2024, 6, 30)
    days = [364, 365, 729, 730, -10, None]
    data = [(None if d is None else as_of - dt.timedelta(days=d),) for d in days]
    df = spark.createDataFrame(data, "signup_date date")
    got = [r[0] for r in df.select(C.customer_tenure("signup_date", as_of)).collect()]
    assert got == ["New", "Established", "Established", "Loyal", "New", "Unknown"]


def test_agent_active_and_code(spark):
    df = spark.createDataFrame([("ab12cd34-9999", "Active"), ("x", "Inactive"), ("y", None)],
                               "agent_id string, status string")
    got = df.select(C.agent_code("agent_id").alias("c"), C.is_active("status").alias("a")).collect()
    assert [(r["c"], r["a"]) for r in got] == [("AB12CD34", True), ("X", False), ("Y", False)]


def test_calendar_attributes_2021_01_03(spark):
    p = RunParams(calendar_start=dt.date(2021, 1, 1), calendar_end=dt.date(2021, 1, 31))
    d = dims.dim_date(spark, None, p).where(F.col("date_key") == dt.date(2021, 1, 3)).first()
    assert d["day_name"] == "Sunday" and d["day_of_week"] == 7 and d["is_weekend"]
    assert d["week_of_year"] == 53 and d["quarter"] == 1 and d["quarter_name"] == "Q1 2021"
    assert d["month_name"] == "January" and not d["is_month_end"] and not d["is_month_start"]


def test_reference_calendar_size(spark):
    cal = dims.dim_date(spark, None, RunParams.reference_calendar())
    assert cal.count() == 4383
    ends = cal.where("is_month_end").count()
    assert ends == 12 * 12


def test_labels(spark):
    df = spark.createDataFrame([(1234567.0,), (45678.0,), (999.0,), (150.0,)], "v double")
    got = [r[0] for r in df.select(C.kes_label("v")).collect()]
    assert got == ["KES 1.2M", "KES 46K", "KES 999", "KES 150"]
    p = spark.createDataFrame([("January", 2024)], "m string, y int").select(C.period_label("m", "y")).first()[0]
    assert p == "Jan 2024"
    t = spark.createDataFrame([(120.0,), (80.0,), (10.0,), (None,)], "p double")
    assert [r[0] for r in t.select(C.loss_ratio_tier("p")).collect()] == ["danger", "warning", "success", "success"]
    assert spark.range(1).select(C.thousands(F.lit(1234567.891), 2)).first()[0] == "1,234,567.89"
