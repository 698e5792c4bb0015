"""Customers: age, birthdays, new customers, age brackets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studiolens.functions import clock
from studiolens.functions.ratio import pct_change

# The age brackets, ends included; the first one holds unknown ages.
AGE_BRACKETS = [
    ("0-12", 0, 12),
    ("13-19", 13, 19),
    ("20-29", 20, 29),
    ("30-39", 30, 39),
    ("40-49", 40, 49),
    ("50-59", 50, 59),
    ("60-69", 60, 69),
    ("70+", 70, None),
]
NO_BIRTHDAY, NO_AGE = "no birthday", "no age"

# The edges of the wide form, ends included.
WIDE_BRACKETS = [
    ("age_0_20", 0, 20),
    ("age_21_30", 21, 30),
    ("age_31_40", 31, 40),
    ("age_41_50", 41, 50),
    ("age_51_60", 51, 60),
    ("age_61_70", 61, 70),
    ("age_70_plus", 71, None),
]

# Offsets in days of the two windows of new customers, ends included.
NEW_LAST, NEW_PREV = (-31, -1), (-62, -32)


def _age(as_of: str | dt.date, birthdate: str = "birthdate") -> Column:
    days = F.datediff(F.lit(clock.as_day(as_of)), F.col(birthdate))
    return (days / F.lit(365.25)).cast("int")


def with_age(cust: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Age in years of 365.25 days, truncated; NULL without a birthdate."""
    return cust.withColumn("age", _age(as_of))


def age_between(cust: DataFrame, lo: float, hi: float, as_of: str | dt.date) -> DataFrame:
    """Customers with ``lo <= age < hi`` in years of 365 days.

    The test is done in whole days on the birthdate itself, so it can reach the scan:
    ``days/365 >= lo`` is ``days >= ceil(365*lo)``, and ``days/365 < hi`` is ``days < ceil(365*hi)``.
    """
    fewest, too_many = -int(-(365 * lo) // 1), -int(-(365 * hi) // 1)
    years = F.datediff(F.lit(clock.as_day(as_of)), F.col("birthdate")) / F.lit(365.0)
    born_after = clock.shift(as_of, -too_many)
    born_by = clock.shift(as_of, -fewest)
    return cust.where(
        (F.col("birthdate") > F.lit(born_after)) & (F.col("birthdate") <= F.lit(born_by))
    ).withColumn("years", years)


def with_birthday(cust: DataFrame, as_of: str | dt.date, wrap: bool = False) -> DataFrame:
    """The birthday in the year of ``as_of``; 29 February is 1 March in other years.

    With ``wrap`` a birthday already over is moved to next year.
    """
    year = clock.as_day(as_of).year

    def in_year(y: int) -> Column:
        day = F.concat(F.lit(f"{y:04d}"), F.date_format("birthdate", "-MM-dd"))
        leap_day = F.date_format("birthdate", "MM-dd") == "02-29"
        return F.coalesce(
            F.try_to_date(day, "yyyy-MM-dd"), F.when(leap_day, F.lit(dt.date(y, 3, 1)))
        )

    birthday = in_year(year)
    if wrap:
        birthday = F.when(birthday < F.lit(clock.as_day(as_of)), in_year(year + 1)).otherwise(birthday)
    return cust.withColumn("birthday", birthday)


def upcoming_birthdays(cust: DataFrame, as_of: str | dt.date, n: int = 7) -> DataFrame:
    """Birthdays strictly between ``as_of`` and ``as_of+n``."""
    return with_birthday(cust, as_of).where(
        (F.col("birthday") > F.lit(clock.as_day(as_of)))
        & (F.col("birthday") < F.lit(clock.shift(as_of, n)))
    )


def new_customers(cust: DataFrame, as_of: str | dt.date, lo: int = -31, hi: int = -1) -> DataFrame:
    """Customers created on whole days ``as_of+lo`` to ``as_of+hi``."""
    return with_age(cust.where(clock.whole_days("datecreated", as_of, lo, hi)), as_of)


def new_customer_change(cust: DataFrame, as_of: str | dt.date) -> DataFrame:
    """New customers of the two windows and the change, one row from one scan."""
    counts = cust.where(clock.whole_days("datecreated", as_of, NEW_PREV[0], NEW_LAST[1])).agg(
        F.count(F.when(clock.whole_days("datecreated", as_of, *NEW_PREV), 1)).alias("p_cnt"),
        F.count(F.when(clock.whole_days("datecreated", as_of, *NEW_LAST), 1)).alias("t_cnt"),
    )
    return counts.withColumn("pctchange", pct_change("t_cnt", "p_cnt"))


def customers_by_age(cust: DataFrame, as_of: str | dt.date) -> DataFrame:
    return with_age(cust, as_of).groupBy("age").agg(F.count(F.lit(1)).alias("cnt"))


def rides_by_age(attend: DataFrame, cust: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Enrolled rides by age of the rider; rides are counted per customer before the join."""
    rides = (
        attend.where(F.col("status") == "Enrolled")
        .groupBy(F.col("custid").alias("id"))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    ages = with_age(cust.select("id", "birthdate"), as_of)
    return rides.join(ages, "id").groupBy("age").agg(F.sum("__n").alias("cnt"))


def _bracket(brackets: list[tuple[str, int, int | None]], unknown: str) -> Column:
    out = F.when(F.col("age").isNull(), unknown)
    for label, lo, hi in brackets:
        test = F.col("age") >= lo
        out = out.when(test if hi is None else test & (F.col("age") <= hi), label)
    return out


def _by_bracket(by_age: DataFrame, unknown: str) -> DataFrame:
    """One row per bracket, NULL when nobody is in it."""
    labels = [unknown] + [label for label, _, _ in AGE_BRACKETS]
    counted = by_age.groupBy(_bracket(AGE_BRACKETS, unknown).alias("bracket")).agg(
        F.sum("cnt").alias("cnt")
    )
    # Nine literal rows: a fixed dimension.
    dimension = by_age.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(label) for label in labels])).alias("bracket")
    )
    return F.broadcast(dimension).join(counted, "bracket", "left")


def customers_by_age_bracket(cust: DataFrame, as_of: str | dt.date) -> DataFrame:
    return _by_bracket(customers_by_age(cust, as_of), NO_BIRTHDAY)


def rides_by_age_bracket(attend: DataFrame, cust: DataFrame, as_of: str | dt.date) -> DataFrame:
    return _by_bracket(rides_by_age(attend, cust, as_of), NO_AGE)


def customers_by_age_bracket_wide(cust: DataFrame, as_of: str | dt.date) -> DataFrame:
    """The wide form with its own edges, one row."""
    by_age = customers_by_age(cust, as_of)
    columns = [F.sum(F.when(F.col("age").isNull(), F.col("cnt"))).alias("none")]
    for name, lo, hi in WIDE_BRACKETS:
        test = F.col("age") >= lo
        test = test if hi is None else test & (F.col("age") <= hi)
        columns.append(F.sum(F.when(test, F.col("cnt"))).alias(name))
    return by_age.agg(*columns)
