"""Classes, instructors and time slots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studiolens.functions import clock
from studiolens.functions.ratio import pct_change, per_unit
from studiolens.operators.retention import ENROLLED

# Offsets in days of the compared windows, both ends included.
LAST_30, PREV_30 = (-31, -1), (-62, -32)
LAST_7, PREV_7 = (-8, -1), (-16, -9)


def _enrolled(attend: DataFrame) -> DataFrame:
    return attend.where(F.col("status") == ENROLLED)


def attend_by_month(attend: DataFrame) -> DataFrame:
    """Enrolled rides by customer and month, with the name where attendance has one."""
    names = [c for c in ("firstname", "lastname") if c in attend.columns]
    return (
        _enrolled(attend)
        .groupBy("custid", F.trunc("classdate", "MM").alias("__month"))
        .agg(F.count(F.lit(1)).alias("cnt"), *[F.min(c).alias(c) for c in names])
        .select("custid", *names, F.date_format("__month", "MM-yyyy").alias("mmyy"), "cnt")
    )


def classes(attend: DataFrame) -> DataFrame:
    """Enrolled riders by class time alone: rooms running at once are one class here."""
    return (
        _enrolled(attend)
        .groupBy("classdate")
        .agg(
            F.min("classtype").alias("classtype"),
            F.min("inst").alias("inst"),
            F.min("room").alias("room"),
            F.count(F.lit(1)).alias("enrolled"),
        )
    )


def class_stats(attend: DataFrame) -> DataFrame:
    """Enrolled riders by instructor and class time: the base of the statistics below."""
    return (
        _enrolled(attend).groupBy("inst", "classdate").agg(F.count(F.lit(1)).alias("numriders"))
    )


def _stats(riders: str = "numriders", test: Column | None = None, prefix: str = "") -> list[Column]:
    """numclasses and totalriders, optionally of the rows that pass a test."""
    one, some = F.lit(1), F.col(riders)
    if test is not None:
        one, some = F.when(test, one), F.when(test, some)
    return [
        F.count(one).alias(f"{prefix}numclasses"),
        F.sum(some).alias(f"{prefix}totalriders"),
    ]


def _per_class(df: DataFrame, prefix: str = "") -> DataFrame:
    return df.withColumn(
        f"{prefix}ridersperclass", per_unit(f"{prefix}totalriders", f"{prefix}numclasses")
    )


def instr_weekly(attend: DataFrame) -> DataFrame:
    week = clock.monday_week("classdate").alias("week")
    return _per_class(class_stats(attend).groupBy("inst", week).agg(*_stats()))


def instr_monthly(attend: DataFrame) -> DataFrame:
    month = F.trunc("classdate", "MM").alias("__month")
    stats = _per_class(class_stats(attend).groupBy("inst", month).agg(*_stats()))
    return stats.withColumn("yymm", clock.month_key("__month")).drop("__month")


def _slot() -> list[Column]:
    return [
        clock.weekday_number("classdate").alias("dow"),
        clock.clock_minute("classdate").alias("hhmm"),
    ]


def slot_stats(
    attend: DataFrame,
    as_of: str | dt.date | None = None,
    lo: int | None = None,
    hi: int | None = None,
    by_inst: bool = False,
) -> DataFrame:
    """By day of week and time of day (and instructor), over everything or whole days."""
    if as_of is not None:
        attend = attend.where(clock.whole_days("classdate", as_of, lo, hi))
    keys = _slot() + ([F.col("inst")] if by_inst else [])
    return _per_class(class_stats(attend).groupBy(*keys).agg(*_stats()))


def instr_window(attend: DataFrame, as_of: str | dt.date, lo: int, hi: int) -> DataFrame:
    """By instructor over whole days ``as_of+lo`` to ``as_of+hi``."""
    stats = (
        class_stats(attend.where(clock.whole_days("classdate", as_of, lo, hi)))
        .groupBy("inst")
        .agg(
            F.min("classdate").alias("minclassdate"),
            F.max("classdate").alias("maxclassdate"),
            *_stats(),
        )
    )
    return _per_class(stats)


def instr_alltime(attend: DataFrame, min_classes: int = 10) -> DataFrame:
    """By instructor over all classes, for those with more than ``min_classes``."""
    stats = (
        classes(attend)
        .groupBy("inst")
        .agg(F.count(F.lit(1)).alias("numclasses"), F.sum("enrolled").alias("ttlenrolled"))
        .where(F.col("numclasses") > min_classes)
    )
    return stats.withColumn("ridersperclass", per_unit("ttlenrolled", "numclasses"))


def _compared(attend: DataFrame, keys: list[Column], as_of: str | dt.date) -> DataFrame:
    """Both 30-day windows from one scan; rows of keys with a class in the last one."""
    last = clock.whole_days("classdate", as_of, *LAST_30)
    prev = clock.whole_days("classdate", as_of, *PREV_30)
    both = (
        class_stats(attend.where(clock.whole_days("classdate", as_of, PREV_30[0], LAST_30[1])))
        .groupBy(*keys)
        .agg(*_stats(test=prev, prefix="p_"), *_stats(test=last, prefix="t_"))
        .where(F.col("t_numclasses") > 0)
        .withColumn("p_numclasses", F.nullif("p_numclasses", F.lit(0)))
    )
    return _per_class(_per_class(both, "p_"), "t_")


def slot_change(attend: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Riders per class by slot against the window before; a zero divisor counts as 1."""
    before = F.when(F.col("p_ridersperclass") == 0, F.lit(1.0)).otherwise(F.col("p_ridersperclass"))
    return _compared(attend, _slot(), as_of).withColumn(
        "pctchange", pct_change("t_ridersperclass", before)
    )


def instr_change(attend: DataFrame, as_of: str | dt.date, min_classes: int = 10) -> DataFrame:
    """Riders per class by instructor against the window before, with all-time classes."""
    alltime = instr_alltime(attend, min_classes).select(
        "inst", F.col("numclasses").alias("a_numclasses")
    )
    return (
        _compared(attend, [F.col("inst")], as_of)
        .join(alltime, "inst", "left")
        .withColumn("pctchange", pct_change("t_ridersperclass", "p_ridersperclass"))
    )


def frequent_riders(
    attend: DataFrame, first: str | dt.date, last: str | dt.date, n: int = 5
) -> DataFrame:
    """Names enrolled more than ``n`` times on the whole days from ``first`` to ``last``."""
    return (
        _enrolled(attend)
        .where(clock.half_open("classdate", first, clock.shift(last, 1)))
        .groupBy("firstname", "lastname")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .where(F.col("cnt") > n)
    )
