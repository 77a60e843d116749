"""Dimension lookups with a checked broadcast.

A dimension is broadcast only when its row count is known to be small:
either bounded by construction (a calendar, a literal status list) or checked
with a bounded ``limit(n+1).count()``.  Above the bound the join is left to the
planner (sort-merge with AQE skew splitting).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def checked_broadcast(df: DataFrame, max_rows: int | None) -> DataFrame:
    """``broadcast(df)`` if it has at most ``max_rows`` rows, else ``df`` unchanged.

    ``max_rows=None``: the side is a stored table whose file statistics are
    exact, so Spark's own size check (``autoBroadcastJoinThreshold``, then
    AQE at runtime) decides, with a sort-merge join beyond it.
    """
    if max_rows is None:
        return df
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a side whose size is bounded by construction (document the bound at the call)."""
    return F.broadcast(df)
