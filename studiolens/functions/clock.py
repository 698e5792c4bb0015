"""Calendar rules: every window edge used by an operator is made here.

Windows are written as half-open ranges against DATE literals. The literal takes the
type of the column, so the comparison reaches the Parquet scan as a pushed filter and
works alike for DATE, TIMESTAMP and TIMESTAMP_NTZ columns.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000


def as_day(value: str | dt.date) -> dt.date:
    """The calendar day of an ISO string, date or datetime."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value[:10])


def shift(as_of: str | dt.date, days: int) -> dt.date:
    return as_day(as_of) + dt.timedelta(days=days)


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def half_open(col: Column | str, start: str | dt.date | None, end: str | dt.date | None) -> Column:
    """``start <= col < end``; a missing end leaves that side open."""
    col = _col(col)
    test = None
    if start is not None:
        test = col >= F.lit(as_day(start))
    if end is not None:
        upper = col < F.lit(as_day(end))
        test = upper if test is None else test & upper
    return col.isNotNull() if test is None else test


def whole_days(col: Column | str, as_of: str | dt.date, lo: int | None, hi: int | None) -> Column:
    """Days ``as_of+lo`` to ``as_of+hi``, both included whole."""
    return half_open(
        col,
        None if lo is None else shift(as_of, lo),
        None if hi is None else shift(as_of, hi + 1),
    )


def up_to(col: Column | str, as_of: str | dt.date, lo: int | None, hi: int | None) -> Column:
    """From the start of ``as_of+lo`` up to, not including, the day ``as_of+hi``."""
    return half_open(
        col,
        None if lo is None else shift(as_of, lo),
        None if hi is None else shift(as_of, hi),
    )


def on_day(col: Column | str, as_of: str | dt.date, offset: int = 0) -> Column:
    return whole_days(col, as_of, offset, offset)


def micros_between(end: Column | str, start: Column | str) -> Column:
    """``end - start`` in whole microseconds (bigint, so sums of it are exact)."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end))


def month_key(col: Column | str) -> Column:
    return F.date_format(_col(col), "yyyy-MM")


def weekday_number(col: Column | str) -> Column:
    """0 = Sunday to 6 = Saturday."""
    return F.dayofweek(_col(col)) - 1


def monday_week(col: Column | str) -> Column:
    """Year and week of the year, weeks starting on Monday, days before the first are week 00."""
    col = _col(col)
    week = ((F.dayofyear(col) - 1 + 7 - F.weekday(col)) / 7).cast("int")
    return F.concat(F.date_format(col, "yyyy"), F.lit("-"), F.lpad(week.cast("string"), 2, "0"))


def clock_minute(col: Column | str) -> Column:
    return F.date_format(_col(col), "HH:mm")


# Names of the days in the order of weekday_number.
DAY_NAMES = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]


def day_name(number: Column | str) -> Column:
    """Name of a day by its number."""
    return F.get(F.array(*[F.lit(n) for n in DAY_NAMES]), _col(number).cast("int"))
