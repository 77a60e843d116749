"""Data-quality passes: every rule of one table is evaluated in ONE aggregation.

Checks warn, never stop the load (``strict=True`` raises instead).  A result is
a small frame ``(check, failures)``; pass when failures = 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DataQualityError(RuntimeError):
    pass


def count_checks(df: DataFrame, checks: Sequence[tuple[str, Column]]) -> DataFrame:
    """One pass: ``count_if(rule)`` per rule, returned long as (check, failures)."""
    agg = df.agg(*[F.count_if(rule).alias(f"_c{i}") for i, (_, rule) in enumerate(checks)])
    args = []
    for i, (name, _) in enumerate(checks):
        args += [F.lit(name), F.col(f"_c{i}")]
    return agg.select(F.stack(F.lit(len(checks)), *args).alias("check", "failures"))


def with_membership(df: DataFrame, key: str, ref: DataFrame, ref_key: str, flag: str) -> DataFrame:
    """Add boolean ``flag`` = key found in ``ref`` (left join on distinct keys; no row fan-out)."""
    r = ref.select(F.col(ref_key).alias("_mk")).distinct().withColumn(flag, F.lit(True))
    out = df.join(r, df[key] == r["_mk"], "left").drop("_mk")
    return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def raise_if_failed(result: DataFrame, strict: bool) -> DataFrame:
    if strict:
        bad = result.where(F.col("failures") > 0).collect()  # at most one row per rule
        if bad:
            raise DataQualityError("; ".join(f"{r['check']}: {r['failures']}" for r in bad))
    return result


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, null_count) for every column, one aggregation."""
    columns = list(columns or df.columns)
    return count_checks(df, [(c, F.col(c).isNull()) for c in columns]).select(
        F.col("check").alias("column_name"), F.col("failures").alias("null_count"))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, n) frequency tables of several columns in one shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    return (df.select(F.explode(pairs).alias("p"))
              .groupBy(F.col("p.column_name").alias("column_name"), F.col("p.value").alias("value"))
              .agg(F.count(F.lit(1)).alias("n")))
