"""Reconciliation by digests, and metric sets: results and scans."""

import re
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starling.operators.metrics import Metric, metric_set
from starling.operators.reconcile import compared, digests, missing_keys, reconcile


def brute(source, target):
    keys = {k for k, _ in target}
    return (len(source), len(target), sum(k is None or k not in keys for k, _ in source), sum(v is None for _, v in target))


def frames(spark, source, target):
    return [spark.createDataFrame(rows, "k string, v int").repartition(3) for rows in (source, target)]


BASE = [(f"C{i}", i) for i in range(500)]
CASES = {
    "equal": (BASE, BASE), "gaps": (BASE, BASE[:100] + BASE[137:]), "more in the target": (BASE[:10], BASE),
    "copies in the source": (BASE + BASE[:7], BASE), "copies in both": (BASE + BASE[:2], BASE + BASE[1:3]),
    "null keys": ([*BASE, (None, 1), (None, 2)], [*BASE, (None, 1), (None, 2)]), "null values": (BASE, [(k, None) for k, _ in BASE]),
    "empty target": (BASE, []), "empty source": ([], BASE), "both empty": ([], []),
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_reconcile_equals_brute_force(spark, case):
    source, target = CASES[case]
    a, b = frames(spark, source, target)
    assert tuple(reconcile(a, b, "k", {"nulls": F.col("v").isNull()}, buckets=64).first()) == brute(source, target)


def test_only_buckets_that_differ_are_compared(spark):
    a, b = frames(spark, BASE, BASE[:100] + BASE[103:])
    assert 1 <= compared(digests(a, "k"), digests(b, "k")).where("not equal").count() <= 3
    a, b = frames(spark, BASE, BASE)
    assert compared(digests(a, "k"), digests(b, "k")).where("not equal").count() == 0


def scans(df):
    """Scans in the plans that ran: the final ones, of the query and its subqueries."""
    df.collect()
    lines, depth, found = df._jdf.queryExecution().executedPlan().toString().split("\n"), None, 0
    for line in lines:
        at = len(line) - len(line.lstrip(" :+-"))
        if depth is not None and at <= depth:
            depth = None
        if "== Initial Plan ==" in line and depth is None:
            depth = at - 1
        found += depth is None and "FileScan parquet" in line
    return found


def test_equal_tables_are_read_once_each(spark):
    paths = [tempfile.mkdtemp(prefix="recon-") + "/t" for _ in range(2)]
    for df, path in zip(frames(spark, BASE, BASE), paths):
        df.write.parquet(path)
    a, b = (spark.read.parquet(p) for p in paths)
    df = reconcile(a, b, "k", {"nulls": F.col("v").isNull()})
    assert tuple(df.first()) == (500, 500, 0, 0)
    assert scans(df) == 2


def test_equal_joins_are_not_exchanged_again(spark):
    a, b = frames(spark, BASE, BASE)
    a, b = (d.join(spark.range(500).selectExpr("id", "'x' || id AS note").hint("merge"), F.col("v") == F.col("id")) for d in (a, b))
    unequal = compared(digests(a, "k"), digests(b, "k")).where("not equal").select(F.col("a_bucket").alias("bucket"))
    found = missing_keys(a.select("k"), b, "k", unequal)
    lines = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    gates = [i for i, line in enumerate(lines) if "Filter" in line and "scalar-subquery" in line]
    joins = [i for i, line in enumerate(lines) if "Join Inner" in line]
    # the rows' filter lies below each join of the inputs, so that nothing reaches its exchange
    assert len(gates) == 2 and all(any(j < g < j + 4 for g in gates) for j in joins[:1]) and found.count() == 0


def test_claims_are_exchanged_once_for_both_sides(spark):
    from starling.plans.checks import reconcile_claims
    from starling.plans.star import Star
    from tests.conftest import SF_SMALL
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = reconcile_claims(Star.from_sf_dir(spark, SF_SMALL))
        lines = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
        reads = [sorted(set(re.findall(r"[lo]_[a-z]+", line))) for line in lines if "Project [l_orderkey" in line]
        # the digests' reads; the comparison of rows behind the filter needs fewer columns
        digested = [r for r in reads if "l_extendedprice" in r]
        assert df.first()["missing_rows"] == 0 and len(digested) >= 2 and all(r == digested[0] for r in digested)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_metric_set_reads_every_table_once(spark):
    paths = [tempfile.mkdtemp(prefix="metric-") + "/t" for _ in range(2)]
    for path in paths:
        spark.createDataFrame([(i, None if i % 7 == 0 else Decimal(i) / 4) for i in range(50)], "i int, d decimal(12,2)") \
            .write.parquet(path)
    tables = {n: spark.read.parquet(p) for n, p in zip(("a", "b"), paths)}
    metrics = [Metric("rows", "a"), Metric("sum", "a", "d", 1), Metric("some", "b", "d", where="i > 10"),
               Metric("odd", "a", where="i % 2 = 1"), Metric("few", "b", where="i > 10"), Metric("none", "a", "d", where="i < 0")]
    df = metric_set(tables.__getitem__, metrics)
    got = {r["metric"]: r["value"] for r in df.collect()}
    want = [i / 4 for i in range(50) if i % 7]
    assert got == {"rows": "50", "sum": "257.3", "odd": "25", "few": "39", "none": None,
                   "some": f"{sum(i / 4 for i in range(11, 50) if i % 7):.2f}"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert scans(df) == 2 and "PushedFilters: [IsNotNull(i), GreaterThan(i,10)]" in plan
