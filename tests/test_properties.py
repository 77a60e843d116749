"""Property tests: exact rounding and the schedule expansion against brute force."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starling.functions.money import exact_avg, pct_of_counts, ratio_pct
from starling.operators.expand import FREQUENCY_INSTALLMENTS, FREQUENCY_STEP_DAYS, installment_schedule

SETTINGS = dict(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _half_up(x: Decimal, digits: int) -> Decimal:
    return x.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP)


cents = st.integers(min_value=0, max_value=10**9)


@settings(**SETTINGS)
@given(values=st.lists(cents, min_size=1, max_size=40))
def test_exact_avg_is_half_up_of_true_mean(spark, values):
    df = spark.createDataFrame([(Decimal(v) / 100,) for v in values], "x decimal(12,2)")
    got = df.agg(exact_avg("x", 2).alias("a")).first()["a"]
    true_mean = Decimal(sum(values)) / 100 / len(values)
    assert got == _half_up(true_mean, 2)


@settings(**SETTINGS)
@given(total=st.integers(min_value=1, max_value=10**7), frac=st.floats(min_value=0, max_value=1))
def test_pct_of_counts_half_up(spark, total, frac):
    late = int(total * frac)
    got = spark.range(1).select(pct_of_counts(F.lit(late).cast("long"), F.lit(total).cast("long"), 1)).first()[0]
    assert got == _half_up(Decimal(late) * 100 / Decimal(total), 1)


@settings(**SETTINGS)
@given(a=cents, p=st.integers(min_value=1, max_value=10**11))
def test_ratio_pct_half_up(spark, a, p):
    da, dp = Decimal(a) / 100, Decimal(p) / 100
    got = spark.range(1).select(ratio_pct(F.lit(da).cast("decimal(22,2)"), F.lit(dp).cast("decimal(22,2)"), 2)).first()[0]
    assert got == _half_up(da * 100 / dp, 2)


def _brute_schedule(start, end, as_of, freq, premium):
    """The original loop: step from start while due <= min(end, as_of)."""
    cutoff = min(end, as_of)
    step = FREQUENCY_STEP_DAYS[freq]
    inst = _half_up(premium / FREQUENCY_INSTALLMENTS[freq], 2)
    out, due = [], start
    while due <= cutoff:
        out.append((due, inst))
        due += dt.timedelta(days=step)
    return out


policy = st.tuples(st.dates(min_value=dt.date(1995, 1, 1), max_value=dt.date(2005, 12, 31)),
                   st.integers(min_value=0, max_value=2500),
                   st.sampled_from(sorted(FREQUENCY_STEP_DAYS)),
                   st.integers(min_value=0, max_value=10**8))


@settings(**SETTINGS)
@given(rows=st.lists(policy, min_size=1, max_size=12), as_of=st.dates(min_value=dt.date(1996, 1, 1),
                                                                       max_value=dt.date(2006, 1, 1)))
def test_schedule_matches_brute_force(spark, rows, as_of):
    data = [(f"p{i}", "c", Decimal(pr) / 100, s, s + dt.timedelta(days=d), f) for i, (s, d, f, pr) in enumerate(rows)]
    df = spark.createDataFrame(data, "policy_id string, customer_id string, premium decimal(12,2), "
                                     "start_date date, end_date date, payment_frequency string")
    got = sorted((r["policy_id"], r["due_date"], r["expected_amount"])
                 for r in installment_schedule(df, as_of).collect())
    want = sorted((pid, due, inst) for pid, _, prem, s, e, f in data
                  for due, inst in _brute_schedule(s, e, as_of, f, prem))
    assert got == want
