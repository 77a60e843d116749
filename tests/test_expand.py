import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from starling.operators.expand import child_rows, installment_schedule, payment_attributes

POL = "policy_id string, customer_id string, premium decimal(12,2), start_date date, end_date date, payment_frequency string"


def _pol(spark, rows):
    return spark.createDataFrame(rows, POL)


def test_monthly_schedule_to_cutoff(spark):
    p = _pol(spark, [("p1", "c1", Decimal("1200.00"), dt.date(2024, 1, 1), dt.date(2029, 1, 1), "Monthly")])
    s = installment_schedule(p, dt.date(2024, 3, 15)).orderBy("installment_no").collect()
    assert [r["due_date"] for r in s] == [dt.date(2024, 1, 1), dt.date(2024, 1, 31), dt.date(2024, 3, 1)]
    assert {r["expected_amount"] for r in s} == {Decimal("100.00")}


def test_schedule_start_after_cutoff_gives_no_rows(spark):
    p = _pol(spark, [("p1", "c1", Decimal("1200.00"), dt.date(2024, 5, 1), dt.date(2029, 5, 1), "Monthly")])
    assert installment_schedule(p, dt.date(2024, 3, 15)).count() == 0


def test_schedule_ends_at_end_date_and_rounds_half_up(spark):
    p = _pol(spark, [("q", "c", Decimal("100.02"), dt.date(2020, 1, 1), dt.date(2020, 12, 31), "Quarterly"),
                     ("a", "c", Decimal("99.99"), dt.date(2020, 1, 1), dt.date(2022, 6, 1), "Annual"),
                     ("n", "c", Decimal("50.00"), dt.date(2020, 1, 1), None, "Annual")])
    s = installment_schedule(p, dt.date(2030, 1, 1))
    q = s.where("policy_id = 'q'").orderBy("installment_no").collect()
    assert [r["due_date"] for r in q] == [dt.date(2020, 1, 1), dt.date(2020, 3, 31), dt.date(2020, 6, 29),
                                          dt.date(2020, 9, 27), dt.date(2020, 12, 26)]
    assert q[0]["expected_amount"] == Decimal("25.01")  # 25.005 -> 25.01
    assert s.where("policy_id = 'a'").count() == 3
    # a null end date is ignored by least(): the run's as_of is the cutoff (the original would raise)
    assert s.where("policy_id = 'n'").count() == 11


def test_payment_attributes_rules(spark):
    p = _pol(spark, [(f"p{i}", "c", Decimal("1200.00"), dt.date(2020, 1, 1), dt.date(2025, 1, 1), "Monthly")
                     for i in range(200)])
    pay = payment_attributes(installment_schedule(p, dt.date(2024, 12, 31))).collect()
    assert len(pay) == 200 * 61  # 1826 days // 30 + 1
    for r in pay:
        delay = (r["payment_date"] - r["due_date"]).days
        assert -3 <= delay <= 15
        assert r["is_late"] == (delay > 0) and r["days_late"] == max(0, delay)
        assert r["variance"] == r["payment_amount"] - r["expected_amount"]
        assert r["is_full_payment"] == (r["payment_amount"] >= r["expected_amount"])
        if r["payment_status"] in ("Failed", "Reversed"):
            assert r["payment_amount"] == 0
        elif r["payment_status"] == "Pending":
            assert r["payment_amount"] == r["expected_amount"]
        else:
            assert Decimal("0.70") * r["expected_amount"] - Decimal("0.01") <= r["payment_amount"] <= r["expected_amount"]
    partial = sum(1 for r in pay if r["payment_status"] == "Completed" and r["payment_amount"] < r["expected_amount"])
    completed = sum(1 for r in pay if r["payment_status"] == "Completed")
    assert 0.02 < partial / completed < 0.08
    assert len({r["payment_id"] for r in pay}) == len(pay)
    methods = {r["payment_method"] for r in pay}
    assert methods == {"Mpesa", "Bank Transfer", "Cash", "Card"}


def test_payment_ids_are_reproducible(spark):
    p = _pol(spark, [("p1", "c1", Decimal("10.00"), dt.date(2020, 1, 1), dt.date(2021, 1, 1), "Monthly")])
    a = [r["payment_id"] for r in payment_attributes(installment_schedule(p, dt.date(2030, 1, 1))).collect()]
    b = [r["payment_id"] for r in payment_attributes(installment_schedule(p.repartition(2), dt.date(2030, 1, 1))).collect()]
    assert sorted(a) == sorted(b)


def test_child_rows_between_one_and_six(spark):
    p = spark.range(0, 500).select(F.col("id").cast("string").alias("policy_id"), F.lit("c").alias("customer_id"),
                                   F.lit(Decimal("600.00")).cast("decimal(12,2)").alias("premium"))
    out = child_rows(p, dt.date(2024, 1, 1))
    per = [r["count"] for r in out.groupBy("policy_id").count().collect()]
    assert len(per) == 500 and min(per) == 1 and max(per) == 6
    assert {r["amount"] for r in out.select("amount").distinct().collect()} == {Decimal("100.00")}
