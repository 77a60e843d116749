"""Metric sets: named numbers over several tables, one aggregate and one scan per table.

A metric is declared by table, measure and condition.  ``metric_set`` groups metrics by table,
computes each table's in one aggregate and turns its columns into rows.  A condition that
all metrics of a table share becomes a filter, which reaches the scan; others stay inside
their aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Metric:
    """``column=None`` counts rows; else the column's sum, rounded to ``digits``.  ``where`` is SQL."""
    name: str
    table: str
    column: str | None = None
    digits: int = 2
    where: str | None = None

    def aggregate(self, filtered: bool) -> Column:
        given = None if filtered or self.where is None else F.expr(self.where)
        if self.column is None:
            return F.count(F.lit(1)) if given is None else F.count_if(given)
        value = F.col(self.column) if given is None else F.when(given, F.col(self.column))
        return F.round(F.sum(value), self.digits)


def metric_set(tables: Callable[[str], DataFrame], metrics: Sequence[Metric], name: str = "metric",
               value: str = "value", value_type: str = "string") -> DataFrame:
    """(name, value) rows of all metrics."""
    by_table: dict[str, list[Metric]] = {}
    for m in metrics:
        by_table.setdefault(m.table, []).append(m)
    parts = [_rows(tables(table), own, name, value, value_type) for table, own in by_table.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _rows(df: DataFrame, metrics: list[Metric], name: str, value: str, value_type: str) -> DataFrame:
    conditions = {m.where for m in metrics}
    shared = len(conditions) == 1 and None not in conditions
    if shared:
        df = df.where(metrics[0].where)
    one = df.agg(*[m.aggregate(shared).cast(value_type).alias(f"m{i}") for i, m in enumerate(metrics)])
    args = [x for i, m in enumerate(metrics) for x in (F.lit(m.name), F.col(f"m{i}"))]
    return one.select(F.stack(F.lit(len(metrics)), *args).alias(name, value))
