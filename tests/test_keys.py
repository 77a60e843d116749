from pyspark.sql import functions as F

from starling.functions.hashing import below, hash32, pick
from starling.operators.keys import (assign_partner, assign_serial_keys, dense_index, only_new_rows,
                                     split_by_reference)
from tests.conftest import rows


def test_new_row_filter_keeps_batch_duplicates(spark):
    incoming = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "k string, v int")
    target = spark.createDataFrame([("a",), (None,)], "k string")
    assert rows(only_new_rows(incoming, target, "k"), "k", "v") == [("b", 2), ("b", 3)]


def test_new_row_filter_without_target_keeps_all(spark):
    incoming = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    assert only_new_rows(incoming, None, "k").count() == 2


def test_semi_plus_anti_is_total(spark):
    df = spark.range(0, 1000).withColumn("k", F.col("id") % 37)
    ref = spark.range(0, 20).withColumnRenamed("id", "k")
    kept, dropped = split_by_reference(df, ref, "k")
    assert kept.count() + dropped.count() == 1000
    assert dropped.where("k < 20").count() == 0


def test_dense_index_is_global_order_across_partitions(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("v")).repartition(5)
    out = dense_index(df, ["v"], "i").collect()
    assert sorted((r["v"], r["i"]) for r in out) == [(v, v) for v in range(5000)]


def test_dense_index_of_shared_prefixes_nulls_ties_and_few_rows(spark):
    from starling.operators.keys import SPLITS
    words = spark.range(3000).select(F.concat(F.lit("AGENT-0000-"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("k"),
                                     F.lit(9).alias("bucket"))      # a name that the operator uses itself
    out = dense_index(words.repartition(6), ["k"], "i")
    assert out.columns == ["k", "bucket", "i"]
    assert [r["i"] for r in sorted(out.collect())] == list(range(3000))
    # no bucket holds a large share of the rows
    ks = words.groupBy(F.pmod(F.xxhash64(F.lit("splitter"), "k"), F.lit(SPLITS)).alias("s")).agg(
        F.min_by("k", F.xxhash64(F.lit("splitter"), "k")).alias("k")).collect()
    bounds = sorted(r["k"] for r in ks)
    sizes = [0] * (len(bounds) + 1)
    for r in words.collect():
        sizes[sum(b <= r["k"] for b in bounds)] += 1
    assert max(sizes) < 150
    odd = spark.createDataFrame([("b", 1), (None, 2), ("a", 3), ("b", 4), (None, 5)], "k string, n int")
    got = sorted((r["i"], r["k"]) for r in dense_index(odd, ["k"], "i").collect())
    assert got == [(0, None), (1, None), (2, "a"), (3, "b"), (4, "b")]
    assert sorted((r["i"], r["n"]) for r in dense_index(odd, ["k", "n"], "i").collect()) == [(0, 2), (1, 5), (2, 3), (3, 1), (4, 4)]
    assert dense_index(odd.where("false"), ["k"], "i").collect() == []


def test_no_query_runs_a_job_while_it_is_built(spark):
    from starling.params import RunParams
    from starling.plans import registry
    from starling.plans.star import Star
    from starling.sources import testbed
    from tests.conftest import SF_SMALL
    domain = testbed.domain(spark, SF_SMALL, RunParams())     # schemas of the files are read here
    sc = spark.sparkContext
    for name in ("dim_policy_type", "dim_agent", "fact_sales", "fact_payments", "sales_records", "hash_assigned_agent"):
        sc.setJobGroup(f"build {name}", "")
        registry.STAR_QUERIES[name](Star(spark, domain, RunParams()))
        assert not sc.statusTracker().getJobIdsForGroup(f"build {name}"), name
    sc._jsc.clearJobGroup()


def test_serial_keys_continue_after_existing(spark):
    src = spark.createDataFrame([("Life",), ("Auto",), ("Life",), (None,), ("Home",)], "policy_type string")
    existing = spark.createDataFrame([(1, "Auto"), (7, "Health")], "policy_type_id int, policy_type string")
    new = assign_serial_keys(src, "policy_type", "policy_type_id", existing)
    assert rows(new, "policy_type_id", "policy_type") == [(8, "Home"), (9, "Life")]
    fresh = assign_serial_keys(src, "policy_type", "policy_type_id")
    assert rows(fresh, "policy_type_id", "policy_type") == [(1, "Auto"), (2, "Home"), (3, "Life")]


def test_partner_assignment_is_stable_and_uniform(spark):
    policies = spark.range(0, 20000).select(F.col("id").cast("string").alias("policy_id"))
    agents = spark.range(0, 10).select(F.concat(F.lit("A"), F.col("id").cast("string")).alias("agent_id"))
    a1 = assign_partner(policies, agents, "agent_id", "policy_id", "agent", "agent_id", 1000)
    a2 = assign_partner(policies.repartition(3), agents, "agent_id", "policy_id", "agent", "agent_id", 1000)
    assert rows(a1) == rows(a2)
    counts = [r["count"] for r in a1.groupBy("agent_id").count().collect()]
    assert len(counts) == 10 and min(counts) > 1700 and max(counts) < 2300
    # no partners -> null, no error
    none = assign_partner(policies.limit(5), agents.where("false"), "agent_id", "policy_id", "agent", "agent_id", 10)
    assert [r["agent_id"] for r in none.collect()] == [None] * 5


def test_hash_helpers_match_sql_twin(spark):
    import duckdb

    from starling.oracle.sql import h32
    df = spark.createDataFrame([("p1",), ("p2",), ("zz-9",)], "k string")
    spark_vals = [r[0] for r in df.select(hash32("salt", "k")).orderBy("k").collect()]
    duck_vals = [duckdb.connect().execute(f"SELECT {h32('salt', repr(k))}").fetchall()[0][0] for k in ["p1", "p2", "zz-9"]]
    assert spark_vals == duck_vals
    share = spark.range(0, 100000).select(below(hash32("s", F.col("id")), 0.4).alias("b")).where("b").count()
    assert 39000 < share < 41000
    picks = spark.range(0, 3000).select(pick(["x", "y", "z"], hash32("p", F.col("id"))).alias("c"))
    assert {r["c"] for r in picks.collect()} == {"x", "y", "z"}
