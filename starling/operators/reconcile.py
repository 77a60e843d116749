"""Reconciliation of two tables by key: digests per key bucket first, rows only where these differ.

A bucket's digest does not depend on the order of its rows (count, sum and exclusive or of
64-bit key hashes).  If no bucket differs, the rows to compare are filtered out by a scalar subquery
before they are exchanged: adaptive execution starts all exchanges of a plan at once, also those
whose result is never read, so an empty list of buckets alone comes too late for tables that are joins.
Equal plain tables cost one scan each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(F.lit("bucket"), F.col(key)), F.lit(buckets)).cast("int")


def digests(df: DataFrame, key: str, conditions: dict[str, Column] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n, s, x, ...): one row per bucket of non-null keys; null keys have their own bucket, -1.

    ``conditions`` add counts of rows that meet them.
    """
    h = F.xxhash64(F.col(key))
    bucket = F.when(F.col(key).isNull(), F.lit(-1)).otherwise(bucket_of(key, buckets))
    return df.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(20,0)")).alias("s"), F.bit_xor(h).alias("x"),
        *[F.count_if(c).alias(name) for name, c in (conditions or {}).items()])


def compared(source: DataFrame, target: DataFrame) -> DataFrame:
    """Two digest tables side by side (a_*, b_*), with ``equal`` per bucket."""
    names = source.columns
    a, b = (d.select(*[F.col(c).alias(f"{side}_{c}") for c in names]) for d, side in ((source, "a"), (target, "b")))
    same = F.lit(True)
    for c in names:
        same = same & F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
    return a.join(b, F.col("a_bucket") == F.col("b_bucket"), "full").withColumn("equal", same)


def missing_keys(source: DataFrame, target: DataFrame, key: str, unequal: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Source rows with a key that the target lacks, looked for in the given buckets only."""
    few = F.broadcast(unequal.select("bucket"))     # at most one row per bucket
    some = unequal.agg(F.count(F.lit(1))).scalar() > 0      # known before a task of the rows' plan starts

    def within(df):
        near = df.where(some).select("*", bucket_of(key, buckets).alias("bucket"))
        return near.join(few, "bucket", "left_semi").drop("bucket")

    keys = within(target.select(key)).select(F.col(key).alias("_target_key"))
    rows = within(source.where(F.col(key).isNotNull()))
    return rows.join(keys, F.col(key) == F.col("_target_key"), "left_anti")


def reconcile(source: DataFrame, target: DataFrame, key: str, conditions: dict[str, Column] | None = None,
              buckets: int = BUCKETS) -> DataFrame:
    """One row: source_rows, target_rows, missing_rows, and counts of target rows per condition.

    A source row is missing if its key is null or in no target row.  Conditions read columns of both
    tables; their counts are part of the digests.
    """
    both = compared(digests(source, key, conditions, buckets), digests(target, key, conditions, buckets))
    unequal = both.where(~F.col("equal")).select(F.coalesce("a_bucket", "b_bucket").alias("bucket"))
    gaps = missing_keys(source.select(key), target, key, unequal, buckets).agg(F.count(F.lit(1)).alias("n")).scalar()

    def total(value):
        return F.coalesce(F.sum(value), F.lit(0).cast("long"))

    found = both.agg(total("a_n").alias("source_rows"), total("b_n").alias("target_rows"),
                     total(F.when(F.col("a_bucket") == -1, F.col("a_n"))).alias("null_keys"),
                     *[total(f"b_{c}").alias(c) for c in (conditions or {})],
                     F.count_if(~F.col("equal")).alias("unequal"))
    # reading ``unequal`` keeps all of the digests here, so that both uses share their exchanges
    return found.where("unequal >= 0").select("source_rows", "target_rows", (F.col("null_keys") + gaps).alias("missing_rows"),
                                              *(conditions or {}))
