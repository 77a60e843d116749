"""Fan-out queries: the eager-aggregation rewrite equals the literal SQL product."""

import random
from decimal import Decimal

from pyspark.sql import functions as F

from starling.operators.fanout import fanout_join, per_key


def _frames(spark, dim_keys, sales, claims):
    base = spark.createDataFrame([(k,) for k in dim_keys], "k int")
    s = spark.createDataFrame(sales, "k int, premium decimal(12,2)")
    c = spark.createDataFrame(claims, "k int, approved decimal(12,2), ok boolean")
    return base, s, c


def _rewrite(base, s, c):
    j = fanout_join(base, "k", per_key(s, "k", "premium", "p"),
                    per_key(c, "k", "approved", "a", where=F.col("ok")), "p", "a")
    return {r["k"]: (r["p_fanout"], r["a_fanout"], r["p_sum"], r["a_sum"]) for r in j.collect()}


def _literal(spark, base, s, c):
    base.createOrReplaceTempView("b")
    s.createOrReplaceTempView("s")
    c.createOrReplaceTempView("c")
    out = spark.sql("""SELECT b.k, SUM(s.premium) AS p, SUM(c.approved) FILTER (WHERE c.ok) AS a
                       FROM b LEFT JOIN s ON s.k = b.k LEFT JOIN c ON c.k = b.k GROUP BY b.k""")
    return {r["k"]: (r["p"], r["a"]) for r in out.collect()}


def test_fixture_type_x(spark):
    base, s, c = _frames(spark, [1], [(1, Decimal("10")), (1, Decimal("20"))],
                         [(1, Decimal("5"), True)] * 3)
    p_fan, a_fan, p, a = _rewrite(base, s, c)[1]
    assert (p_fan, a_fan) == (Decimal("90.00"), Decimal("30.00"))
    assert (p, a) == (Decimal("30.00"), Decimal("15.00"))
    assert round(a_fan / p_fan * 100, 2) == Decimal("33.33") and a / p * 100 == 50


def test_rewrite_equals_literal_product_random(spark):
    rnd = random.Random(7)
    keys = list(range(12))
    sales = [(rnd.choice(keys[:9]), Decimal(rnd.randint(0, 99999)) / 100) for _ in range(60)]
    sales += [(10, None)]  # a key whose only sale has a null premium
    claims = [(rnd.choice(keys[3:]), Decimal(rnd.randint(0, 9999)) / 100, rnd.random() < 0.7) for _ in range(50)]
    base, s, c = _frames(spark, keys, sales, claims)
    rw = _rewrite(base, s, c)
    lit = _literal(spark, base, s, c)
    assert {k: v[:2] for k, v in rw.items()} == lit
