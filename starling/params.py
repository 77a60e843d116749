"""Run parameters.

The reference reads the wall clock (``now()``, ``CURRENT_DATE``) in many
places.  A lazy Spark plan may be evaluated more than once (one evaluation per
sink), so "today" is a run parameter passed as a literal instead; this also
lets Catalyst fold it and lets dynamic partition pruning use it.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class RunParams:
    # the run's "today": cut-off for schedules, tenure, year windows
    as_of: _dt.date = _dt.date(2001, 12, 31)
    # the run's load timestamp (ingested_at / created_at defaults)
    load_ts: _dt.datetime = _dt.datetime(2001, 12, 31, 0, 0, 0)
    # calendar bounds; None = derive from the data (first policy year .. as_of year)
    calendar_start: _dt.date | None = None
    calendar_end: _dt.date | None = None
    # "previous run" date used by the incremental (new rows only) queries
    prev_as_of: _dt.date = _dt.date(2000, 12, 31)
    # None: Spark's size statistics decide on broadcasts; a number: lookup sides of at most so many
    # rows are broadcast, which costs a probe job per lookup when a query is built (operators.lookup)
    broadcast_max_rows: int | None = None
    # years of history shown by the monthly queries (reference: CURRENT_DATE - 3 years .. now)
    trend_years: int = 3
    # concurrent independent steps in the full run (dimensions; then the three facts)
    parallel_steps: int = 3
    extra: dict = field(default_factory=dict)

    @staticmethod
    def reference_calendar() -> "RunParams":
        """The reference's fixed calendar, 2019-01-01 .. 2030-12-31."""
        return RunParams(calendar_start=_dt.date(2019, 1, 1), calendar_end=_dt.date(2030, 12, 31))


DEFAULT = RunParams()
