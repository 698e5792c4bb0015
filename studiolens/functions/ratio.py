"""Ratios, rounding and flags with one policy for missing and zero divisors: NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(38,10)"


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_half_up(col: Column | str, places: int) -> Column:
    """Round in decimal, so that a value printed as 1.005 becomes 1.01."""
    return F.round(_col(col).cast("double").cast(EXACT), places).cast("double")


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def per_unit(total: Column | str, units: Column | str, places: int = 1) -> Column:
    return round_half_up(safe_ratio(total, units), places)


def pct_change(now: Column | str, before: Column | str) -> Column:
    """Change in percent, one decimal place."""
    return round_half_up((safe_ratio(now, before) - F.lit(1.0)) * F.lit(100.0), 1)


def exact_mean(col: Column | str) -> Column:
    """Unweighted mean over an exact sum: the result does not depend on row order."""
    col = _col(col)
    return F.try_divide(F.sum(col.cast("decimal(18,8)")).cast("double"), F.count(col).cast("double"))


def threshold_flag(col: Column | str, low: float, high: float) -> Column:
    """'down' at or below ``low``, else 'up' at or above ``high``, else 'flat'; NULL stays NULL.

    The order matters when both bounds are 0: no change counts as down.
    """
    col = _col(col)
    return (
        F.when(col.isNull(), F.lit(None).cast("string"))
        .when(col <= F.lit(low), F.lit("down"))
        .when(col >= F.lit(high), F.lit("up"))
        .otherwise(F.lit("flat"))
    )


# Percent thresholds of the totals and of the detail tables, and the
# riders-per-class bands around a half-full room.
TOTALS_THRESHOLD = 0
DETAIL_THRESHOLD = 10
LOW_RIDERS = 15
HIGH_RIDERS = 23
