"""Column expressions: buckets, safe ratios, calendar and formatting helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(c: ColumnOrName) -> Column:
    return col(c).cast("double")


def total(c: ColumnOrName) -> Column:
    """Sum as a double; an empty group sums to 0. Decimal input is summed exactly."""
    return F.coalesce(F.sum(col(c)).cast("double"), F.lit(0.0))


def total_long(c: ColumnOrName) -> Column:
    return F.coalesce(F.sum(col(c)), F.lit(0)).cast("bigint")


def mean(c: ColumnOrName) -> Column:
    return F.avg(as_double(c))


def share_pct(c: ColumnOrName) -> Column:
    """Percentage of rows where a 0/1 or boolean column holds."""
    return mean(col(c).cast("int")) * 100.0


def ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """Double division that gives NULL on a zero denominator."""
    return as_double(numerator) / F.nullif(as_double(denominator), F.lit(0.0))


def clip_low(c: ColumnOrName, low: float) -> Column:
    """Raise values below ``low`` to it; NULL stays NULL."""
    return F.when(col(c) < low, F.lit(low)).otherwise(col(c))


def clip(c: ColumnOrName, low: float, high: float) -> Column:
    return F.when(col(c) < low, F.lit(low)).when(col(c) > high, F.lit(high)).otherwise(col(c))


def month_label(d: ColumnOrName) -> Column:
    """Month as yyyy-MM; cut from the date's text, which is cheaper than a format pattern."""
    return F.substring(col(d).cast("date").cast("string"), 1, 7)


def month_number(d: ColumnOrName) -> Column:
    """Consecutive number of a date's month."""
    return F.year(col(d)) * 12 + F.month(col(d))


def is_weekend(d: ColumnOrName) -> Column:
    return F.weekday(col(d)) >= 5


# Bucket edges and labels of the derived columns.
FAST_BELOW_MS, MEDIUM_BELOW_MS = 400, 800
OVER_BUDGET_USD = 0.005
PEAK_HOURS = (9, 17)
FIRST_WEEK_DAYS = (0, 7)
NOT_RATED = "Not Rated"
RISK_BANDS = ("Low (0–25)", "Moderate (25–50)", "High (50–75)", "Critical (75–100)")


def response_speed_tier(latency: ColumnOrName) -> Column:
    """Fast, Medium or Slow; a missing latency counts as Slow."""
    latency = col(latency)
    return F.when(latency < FAST_BELOW_MS, "Fast").when(latency < MEDIUM_BELOW_MS, "Medium").otherwise("Slow")


def satisfaction_bucket(score: ColumnOrName) -> Column:
    """Left-closed bands at 3.5 and 4.5; a missing score has its own band."""
    score = col(score)
    return (
        F.when(score.isNull(), NOT_RATED)
        .when(score < 3.5, "Low(<3.5)")
        .when(score < 4.5, "Mid(3.5-4.4)")
        .otherwise("High(4.5-5.0)")
    )


def client_age_cohort(days: ColumnOrName) -> Column:
    """Right-closed bands at 30, 90 and 180 days; negative ages fall in the first."""
    days = col(days)
    return (
        F.when(days <= 30, "0-30 days")
        .when(days <= 90, "31-90 days")
        .when(days <= 180, "91-180 days")
        .when(days.isNotNull(), "180+ days")
    )


def risk_band(score: ColumnOrName) -> Column:
    """Right-closed bands at 25, 50, 75 and 100, open below -1; others are NULL."""
    score = col(score)
    return (
        F.when((score <= -1) | (score > 100), F.lit(None).cast("string"))
        .when(score <= 25, RISK_BANDS[0])
        .when(score <= 50, RISK_BANDS[1])
        .when(score <= 75, RISK_BANDS[2])
        .when(score <= 100, RISK_BANDS[3])
    )


def format_number(c: ColumnOrName, decimals: int = 0) -> Column:
    """Thousands separators and a fixed number of decimals, as text."""
    return F.format_number(as_double(c), decimals)
