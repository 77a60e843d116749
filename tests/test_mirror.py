"""Mirror tables: contract, visibility by manifest, and the load's mirror step and row counts."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.params import RunParams
from starling.plans import load
from starling.plans.facts import split_payments
from starling.plans.star import Star
from starling.sinks.mirror import Contract, Mirror, SchemaRefused
from starling.sources import testbed
from tests.conftest import SF_SMALL, rows

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def mirror(spark, additive):
    return Mirror(spark, tempfile.mkdtemp(prefix="mirror-test-"), {"t": Contract(SCHEMA, additive)})


def frame(spark, ids, extra=""):
    return spark.createDataFrame([(i, f"n{i}") for i in ids], SCHEMA).selectExpr("id", "name", *([extra] if extra else []))


def test_added_column_is_taken_by_an_additive_contract(spark):
    m = mirror(spark, True)
    m.append("t", frame(spark, [1, 2]), "a")
    m.append("t", frame(spark, [3], "id * 2 as twice"), "b")
    m.append("t", frame(spark, [4]), "c")
    assert rows(m.read("t")) == [(1, "n1", None), (2, "n2", None), (3, "n3", 6), (4, "n4", None)]
    with pytest.raises(SchemaRefused, match="twice"):           # its type is fixed from then on
        m.append("t", frame(spark, [5], "'x' as twice"), "d")
    assert m.read("t").count() == 4


def test_refused_columns_write_nothing(spark):
    m = mirror(spark, False)
    m.append("t", frame(spark, [1]), "a")
    for bad in (frame(spark, [2], "1 as more"), frame(spark, [2]).drop("name"), frame(spark, [2]).withColumn("name", F.lit(5))):
        with pytest.raises(SchemaRefused):
            m.append("t", bad, "b")
    assert not os.path.exists(f"{m.root}/t/rows/load=b")
    assert rows(m.read("t")) == [(1, "n1")]
    m.append("t", frame(spark, [3]).select("name", "id"), "c")  # order does not matter
    assert rows(m.read("t")) == [(1, "n1"), (3, "n3")]


def test_a_broken_load_is_not_seen_and_can_be_repeated(spark):
    m = mirror(spark, False)
    assert m.read("t").count() == 0
    m.append("t", frame(spark, [1]), "a")
    frame(spark, [2, 3]).write.parquet(f"{m.root}/t/rows/load=b")      # broke off before its manifest
    assert rows(m.read("t")) == [(1, "n1")]
    fails = frame(spark, [4]).withColumn("name", F.raise_error(F.lit("sink is down")).cast("string"))
    with pytest.raises(Exception, match="sink is down"):
        m.append("t", fails, "c")
    assert rows(m.read("t")) == [(1, "n1")]
    for _ in range(2):
        m.append("t", frame(spark, [2, 3]), "b")
    assert rows(m.read("t")) == [(1, "n1"), (2, "n2"), (3, "n3")] and m.state("t")[1] == 3


def test_load_mirrors_facts_and_reports_dropped_rows(spark):
    root, mirrored = tempfile.mkdtemp(prefix="wh-mirror-"), tempfile.mkdtemp(prefix="mirror-")
    params = RunParams(calendar_end=dt.date(2001, 12, 31))       # late payments of December have no date
    domain = testbed.domain(spark, SF_SMALL, params)
    half = {**domain, "policies": domain["policies"].where("policy_id % 2 = 0")}
    first = load.run(spark, half, root, params, with_checks=False, mirror_root=mirrored)
    star = Star(spark, half, params)
    dropped = split_payments(star.payment_rows, star.dim_date)[1].count()
    assert first["dropped"]["fact_payments"] == dropped > 0
    assert first["kept"]["fact_payments"] + dropped == star.payment_rows.count()
    facts = {name: first["appended"][name] for name in load.FACT_KEYS}
    assert first["mirrored"] == facts
    m = Mirror(spark, mirrored, load.CONTRACTS)
    # the second load's mirror step breaks off: the third one catches up
    broken = load.run(spark, domain, root, params, with_checks=False)
    assert broken["already_stored"]["fact_sales"] == first["appended"]["fact_sales"] and broken["appended"]["fact_sales"]
    third = load.run(spark, domain, root, params, with_checks=False, mirror_root=mirrored)
    assert all(v == 0 for v in third["appended"].values())
    assert third["mirrored"] == {name: broken["appended"][name] for name in load.FACT_KEYS}
    stored = load.stored_star(spark, root, params, domain)
    for name, key in load.FACT_KEYS.items():
        assert rows(m.read(name), key) == rows(stored.table(name), key)
    assert third["dropped"]["fact_payments"] >= dropped


def test_default_calendar_reaches_past_the_longest_delay(spark):
    params = RunParams()
    domain = testbed.domain(spark, SF_SMALL, params)
    report = load.run(spark, domain, tempfile.mkdtemp(prefix="wh-cal-"), params, with_checks=False)
    assert report["dropped"]["fact_payments"] == 0
    assert report["kept"]["fact_payments"] == Star(spark, domain, params).payment_rows.count()
