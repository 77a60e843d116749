"""Fan-out (many-to-many) joins answered by eager aggregation.

``base LEFT JOIN a ON k LEFT JOIN b ON k`` followed by ``SUM(a.x), SUM(b.y)``
multiplies every a-row by the number of b-rows of its key (and vice versa).
Materialising that product is quadratic per key -- one hot key with a third of
the rows would make it explode.  Per key let P, n be the sum and row count of
``a`` and A, m those of ``b``; the literal SQL returns ``P * max(m, 1)`` and
``A * max(n, 1)`` (null sums stay null).  So both facts are aggregated per
key first (map-side partial aggregation, one small row per key) and only the
aggregates are joined.  The corrected totals are plain ``P`` and ``A``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def per_key(df: DataFrame, key: str, value: str, name: str, where: Column | None = None) -> DataFrame:
    """Per key: sum of ``value`` (optionally filtered) and the row count (all rows)."""
    v = F.col(value) if where is None else F.when(where, F.col(value))
    return df.groupBy(key).agg(F.sum(v).alias(f"{name}_sum"), F.count(F.lit(1)).alias(f"{name}_rows"))


def fanout_join(base: DataFrame, key: str, left: DataFrame, right: DataFrame,
                left_name: str = "l", right_name: str = "r") -> DataFrame:
    """base + per-key aggregates of both facts + the as-written (fan-out) sums.

    Output adds ``{l}_sum, {l}_rows, {r}_sum, {r}_rows`` (corrected inputs) and
    ``{l}_fanout, {r}_fanout`` (what the literal SQL sums to).
    """
    j = base.join(left, key, "left").join(right, key, "left")
    lr, rr = F.coalesce(F.col(f"{left_name}_rows"), F.lit(0)), F.coalesce(F.col(f"{right_name}_rows"), F.lit(0))
    return (j.withColumn(f"{left_name}_fanout", F.col(f"{left_name}_sum") * F.greatest(rr, F.lit(1)))
             .withColumn(f"{right_name}_fanout", F.col(f"{right_name}_sum") * F.greatest(lr, F.lit(1))))
