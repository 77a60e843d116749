"""Column rules of the warehouse, all native expressions (no Python UDF).

Bands, tenure, region lookup, calendar attributes, agent code, labels.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's for identical results) -------
# age bands: upper bounds 25, 35, 45, 55, 65 and the open band
AGE_BANDS = [(25, "18-25"), (35, "26-35"), (45, "36-45"), (55, "46-55"), (65, "56-65")]
AGE_BAND_TOP = "66+"
# county -> region, default "Other"
REGION_BY_COUNTY = {
    "Nairobi": "Nairobi Metro",
    "Kiambu": "Central",
    "Mombasa": "Coast",
    "Nakuru": "Rift Valley",
    "Kisumu": "Nyanza",
}
REGION_DEFAULT = "Other"
# sales channels for agents
CHANNELS = ["Direct", "Broker", "Online", "Bancassurance"]
# claim statuses of the status dimension, in load order
CLAIM_STATUSES = ["Pending", "Approved", "Rejected", "Paid", "Escalated"]
# tenure thresholds in days
TENURE_NEW_DAYS = 365
TENURE_ESTABLISHED_DAYS = 730
# loss-ratio tiers (percent)
LOSS_DANGER_PCT = 100
LOSS_WARNING_PCT = 70
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def age_band(age) -> Column:
    """<=25 18-25, <=35 26-35, ... else 66+; a null age falls through to 66+."""
    age = _c(age)
    expr = None
    for upper, label in AGE_BANDS:
        expr = F.when(age <= upper, label) if expr is None else expr.when(age <= upper, label)
    return expr.otherwise(AGE_BAND_TOP)


def customer_tenure(signup_date, as_of: _dt.date) -> Column:
    """Unknown when null; <365 days New; <730 Established; else Loyal (future dates are New)."""
    d = _c(signup_date)
    days = F.datediff(F.lit(as_of), d)
    return (F.when(d.isNull(), "Unknown")
            .when(days < TENURE_NEW_DAYS, "New")
            .when(days < TENURE_ESTABLISHED_DAYS, "Established")
            .otherwise("Loyal"))


def region_literal(county) -> Column:
    """The fixed 5-county map with default "Other" (null county -> "Other")."""
    m = F.create_map(*[F.lit(x) for kv in REGION_BY_COUNTY.items() for x in kv])
    return F.coalesce(F.try_element_at(m, _c(county)), F.lit(REGION_DEFAULT))


def agent_code(agent_id) -> Column:
    return F.upper(F.substring(_c(agent_id).cast("string"), 1, 8))


def is_active(status) -> Column:
    """status == 'Active', null -> false."""
    return _c(status).eqNullSafe(F.lit("Active"))


def calendar_attributes(date_col="date_key") -> list[Column]:
    """The 13 dim_date columns for a date column."""
    d = _c(date_col)
    q = F.quarter(d)
    return [
        d.alias("date_key"),
        F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        q.alias("quarter"),
        F.format_string("Q%d %d", q, F.year(d)).alias("quarter_name"),
        F.year(d).alias("year"),
        (F.weekday(d) + 1).alias("day_of_week"),  # ISO: Monday = 1
        F.date_format(d, "EEEE").alias("day_name"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        (F.dayofmonth(d) == 1).alias("is_month_start"),
        (d == F.last_day(d)).alias("is_month_end"),
        F.weekofyear(d).alias("week_of_year"),  # ISO week
    ]


def period_label(month_name, year) -> Column:
    """'Jan 2024': first three letters of the month name and the year."""
    return F.concat_ws(" ", F.substring(_c(month_name), 1, 3), _c(year).cast("string"))


def kes_label(x) -> Column:
    """Tiered money label: >=1e6 'KES 1.2M', >=1e3 'KES 12K', else 'KES 12'."""
    v = _c(x).cast("double")
    return (F.when(v >= 1_000_000, F.format_string("KES %.1fM", v / 1_000_000))
            .when(v >= 1_000, F.format_string("KES %.0fK", v / 1_000))
            .otherwise(F.format_string("KES %.0f", v)))


def kes_millions(x, digits: int = 2) -> Column:
    return F.format_string(f"KES %.{digits}fM", _c(x).cast("double") / 1_000_000)


def loss_ratio_tier(pct) -> Column:
    """>100 danger, >70 warning, otherwise (including null) success."""
    p = _c(pct)
    return (F.when(p > LOSS_DANGER_PCT, "danger")
            .when(p > LOSS_WARNING_PCT, "warning")
            .otherwise("success"))


def thousands(x, digits: int = 2) -> Column:
    """'1,234,567.89'."""
    return F.format_number(_c(x), digits)
