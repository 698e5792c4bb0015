"""Retention: first rides, birthdays, trending, lapsed and stalled customers.

Ride counts of several windows come from one grouped scan of attendance. Per-customer
rows meet the customer table only after grouping, so a customer with a large share of the
rows is reduced map-side first.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studiolens.functions import clock
from studiolens.functions.keys import CONTACT, key_set, with_contacts
from studiolens.functions.ratio import pct_change
from studiolens.operators.customers import with_birthday
from studiolens.operators.sales import COMP

ENROLLED = "Enrolled"

# Window offsets in days. Rides run from the start of the first day up to,
# not including, the second; future bookings of a week count as recent on purpose.
RIDES_LAST_30, RIDES_LAST_31, RIDES_PREV_30 = (-30, 7), (-31, 7), (-60, -30)
# Active customers count whole days, both ends included; the last window has no end.
ACTIVE_PREV, ACTIVE_LAST = (-59, -30), (-29, None)


def _enrolled() -> Column:
    return F.col("status") == ENROLLED


def _count_if(test: Column, name: str) -> Column:
    return F.count(F.when(test, 1)).alias(name)


# --- first rides and birthdays --------------------------------------------------------


def first_timers(attend: DataFrame, cust: DataFrame, as_of: str | dt.date, offset: int = 0) -> DataFrame:
    """Ride number 1 taken on the day ``as_of+offset``, any status."""
    firsts = attend.where((F.col("num") == 1) & clock.on_day("classdate", as_of, offset))
    return with_contacts(firsts.select("custid", "classdate"), cust)


def birthday_riders_window(
    cust: DataFrame, attend: DataFrame, as_of: str | dt.date, days: int = 7
) -> DataFrame:
    """Birthdays of the next ``days`` days, each with the classes booked in that time.

    A customer without a class has one row with NULLs. This is a left join done as an inner
    join plus the customers without a match: in an outer join neither the small side could
    be broadcast nor a customer with very many bookings be split.
    """
    who = with_birthday(cust, as_of).where(clock.whole_days("birthday", as_of, 0, days))
    who = who.select("id", *CONTACT, "birthdate", "birthday")
    booked = attend.where(clock.up_to("classdate", as_of, 0, days)).select(
        F.col("custid").alias("id"), "classdate"
    )
    midnight = F.col("birthday").cast("timestamp_ntz")
    away = F.abs(clock.micros_between("classdate", midnight)) / F.lit(float(clock.DAY_MICROS))
    riding = who.join(booked, "id").withColumn("ndays", F.round(away))
    idle = (
        who.join(key_set(booked, "id"), "id", "left_anti")
        .withColumn("classdate", F.lit(None).cast(booked.schema["classdate"].dataType))
        .withColumn("ndays", F.lit(None).cast("double"))
    )
    return riding.unionByName(idle)


def riding_on_birthday(
    cust: DataFrame, attend: DataFrame, as_of: str | dt.date, days: int = 7
) -> DataFrame:
    return birthday_riders_window(cust, attend, as_of, days).where(
        F.col("birthday") == F.to_date("classdate")
    )


def nearest_birthday_class(
    cust: DataFrame, attend: DataFrame, as_of: str | dt.date, days: int = 7
) -> DataFrame:
    """Per customer the class nearest to the birthday; equally near classes all stay.

    The rows go on by customer and class: grouped by customer right where they were joined,
    a customer with very many bookings could not be split in the join.
    """
    riding = (
        birthday_riders_window(cust, attend, as_of, days)
        .where(F.col("classdate").isNotNull())
        .repartition("id", "classdate")
    )
    nearest = riding.groupBy("id").agg(F.min("ndays").alias("ndays"))
    return riding.join(nearest, ["id", "ndays"])


# --- who never came, never paid, stopped coming ---------------------------------------


def buyers_of(sale: DataFrame, cust: DataFrame, items: list[str]) -> DataFrame:
    """Customers who ever bought one of the items."""
    buyers = key_set(sale.where(F.col("item").isin(items)), "custid", "id")
    return cust.select("id", "firstname", "lastname").join(buyers, "id", "left_semi").distinct()


def _without(cust: DataFrame, keys: DataFrame) -> DataFrame:
    return cust.join(keys, "id", "left_anti")


def never_enrolled(
    cust: DataFrame,
    attend: DataFrame,
    sale: DataFrame,
    items: list[str],
    created: Column,
) -> DataFrame:
    """Customers created in a window, never enrolled, who bought none of the items."""
    fresh = cust.where(created)
    enrolled = key_set(attend.where(_enrolled() & F.col("classdate").isNotNull()), "custid", "id")
    bought = key_set(sale.where(F.col("item").isin(items)), "custid", "id")
    out = _without(_without(fresh, enrolled), bought)
    return out.select("id", *CONTACT, "datecreated")


def stalled(
    cust: DataFrame,
    attend: DataFrame,
    sale: DataFrame,
    items: list[str],
    as_of: str | dt.date,
    n: int = 7,
) -> DataFrame:
    """The same for customers created on exactly the day ``as_of-n``."""
    return never_enrolled(cust, attend, sale, items, clock.on_day("datecreated", as_of, -n))


def never_enrolled_since(
    cust: DataFrame, attend: DataFrame, sale: DataFrame, items: list[str], since: str | dt.date
) -> DataFrame:
    """The same for customers created on or after a day."""
    return never_enrolled(cust, attend, sale, items, clock.half_open("datecreated", since, None))


def never_attended(cust: DataFrame, attend: DataFrame, as_of: str | dt.date, n: int = 7) -> DataFrame:
    """Customers created after the day ``as_of-n`` without an attendance of any status."""
    fresh = cust.where(clock.whole_days("datecreated", as_of, -n + 1, None))
    seen = key_set(attend.where(F.col("classdate").isNotNull()), "custid", "id")
    return _without(fresh, seen).select("id", *CONTACT, "datecreated")


def winback_series(
    sale: DataFrame, cust: DataFrame, openseries: DataFrame, items: list[str]
) -> DataFrame:
    """Addresses that bought a package in the past and hold none now."""
    buyers = key_set(sale.where(F.col("item").isin(items)), "custid", "id")
    addresses = key_set(cust.join(buyers, "id", "left_semi"), "emailaddress")
    return addresses.join(key_set(openseries, "emailaddress"), "emailaddress", "left_anti")


def lapsed_between(
    cust: DataFrame,
    attend: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    after: str | dt.date,
    n: int = 0,
    cmp: str = ">",
) -> DataFrame:
    """Enrolled more than (or exactly) ``n`` times in ``[start, end)`` and never since ``after``."""
    if cmp not in (">", "="):
        raise ValueError("cmp is '>' or '='")
    counts = (
        attend.where(_enrolled())
        .groupBy(F.col("custid").alias("id"))
        .agg(
            _count_if(clock.half_open("classdate", start, end), "__then"),
            _count_if(clock.half_open("classdate", after, None), "__since"),
        )
    )
    then, since = F.coalesce("__then", F.lit(0)), F.coalesce("__since", F.lit(0))
    return (
        cust.select("id", "emailaddress")
        .join(counts, "id", "left")
        .where((then > n if cmp == ">" else then == n) & (since == 0))
        .select("id", "emailaddress")
    )


def lapsed_no_open(
    cust: DataFrame,
    attend: DataFrame,
    openseries: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    after: str | dt.date,
) -> DataFrame:
    """Lapsed customers without an open series under their address."""
    return lapsed_between(cust, attend, start, end, after).join(
        key_set(openseries, "emailaddress"), "emailaddress", "left_anti"
    )


def rode_never_paid(
    cust: DataFrame, attend: DataFrame, sale: DataFrame, as_of: str | dt.date
) -> DataFrame:
    """Customers with attendance, sales adding up to nothing, and no booking from ``as_of`` on."""
    past_only = (
        attend.groupBy(F.col("custid").alias("id"))
        .agg(_count_if(clock.half_open("classdate", as_of, None), "__ahead"))
        .where(F.col("__ahead") == 0)
        .select("id")
    )
    spent = sale.groupBy(F.col("custid").alias("id")).agg(F.sum("total").alias("__spent"))
    return (
        cust.select("id", "firstname", "lastname")
        .join(past_only, "id")
        .join(spent, "id", "left")
        .where(F.coalesce("__spent", F.lit(0)) == 0)
        .select("id", "firstname", "lastname")
    )


# --- last touch, activity -------------------------------------------------------------


def last_attend(cust: DataFrame, attend: DataFrame) -> DataFrame:
    """Customers with their latest enrolled class, NULL if none."""
    latest = (
        attend.where(_enrolled())
        .groupBy(F.col("custid").alias("id"))
        .agg(F.max("classdate").alias("lastattend"))
    )
    return cust.join(latest, "id", "left")


def last_touch(cust: DataFrame, sale: DataFrame, attend: DataFrame) -> DataFrame:
    """The latest class and the latest sale that is not a comp."""
    latest = (
        sale.where(F.col("pmtype") != COMP)
        .groupBy(F.col("custid").alias("id"))
        .agg(F.max("dt").alias("lastsale"))
    )
    return last_attend(cust, attend).join(latest, "id", "left")


def touched_in_window(
    cust: DataFrame, sale: DataFrame, attend: DataFrame, as_of: str | dt.date, window: str = "last"
) -> DataFrame:
    """Customers whose last touch falls into the ``last`` or ``prev`` window."""
    lo, hi = {"last": ACTIVE_LAST, "prev": ACTIVE_PREV}[window]
    return last_touch(cust, sale, attend).where(
        clock.whole_days("lastsale", as_of, lo, hi) | clock.whole_days("lastattend", as_of, lo, hi)
    )


def active_change(attend: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Distinct customers of the two windows and the change, one row.

    Grouping by customer first keeps this a plain two-step aggregate instead of a
    distinct count that would copy each row per window.
    """
    seen = (
        attend.where(clock.whole_days("classdate", as_of, ACTIVE_PREV[0], None))
        .groupBy("custid")
        .agg(
            F.max(clock.whole_days("classdate", as_of, *ACTIVE_PREV)).alias("__p"),
            F.max(clock.whole_days("classdate", as_of, *ACTIVE_LAST)).alias("__t"),
        )
    )
    counts = seen.agg(_count_if(F.col("__p"), "p_cnt"), _count_if(F.col("__t"), "t_cnt"))
    return counts.withColumn("pctchange", pct_change("t_cnt", "p_cnt"))


# --- rides per window, trends ---------------------------------------------------------


def rides_in_window(
    attend: DataFrame, cust: DataFrame, start: str | dt.date, end: str | dt.date
) -> DataFrame:
    """Enrolled rides per customer in ``[start, end)``."""
    rides = (
        attend.where(_enrolled() & clock.half_open("classdate", start, end))
        .groupBy("custid")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    return with_contacts(rides, cust).select(
        "custid", *CONTACT, "cnt",
        F.lit(clock.as_day(start)).alias("start"), F.lit(clock.as_day(end)).alias("end"),
    )


def rides_recent(
    attend: DataFrame, cust: DataFrame, as_of: str | dt.date, window: tuple[int, int] = RIDES_LAST_30
) -> DataFrame:
    return rides_in_window(
        attend, cust, clock.shift(as_of, window[0]), clock.shift(as_of, window[1])
    )


def top_recent(attend: DataFrame, cust: DataFrame, as_of: str | dt.date, k: int = 20) -> DataFrame:
    """The ``k`` customers with the most recent rides."""
    return rides_recent(attend, cust, as_of).orderBy(F.desc("cnt"), "custid").limit(k)


def _ride_counts(attend: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Rides of the windows ``prev30``, ``last30`` and ``last31`` from one scan."""
    return (
        attend.where(_enrolled() & clock.up_to("classdate", as_of, RIDES_PREV_30[0], RIDES_LAST_30[1]))
        .groupBy("custid")
        .agg(
            _count_if(clock.up_to("classdate", as_of, *RIDES_PREV_30), "prev30"),
            _count_if(clock.up_to("classdate", as_of, *RIDES_LAST_30), "last30"),
            _count_if(clock.up_to("classdate", as_of, *RIDES_LAST_31), "last31"),
        )
        .where(F.col("prev30") > 0)
    )


def trending_up(attend: DataFrame, cust: DataFrame, as_of: str | dt.date, k: int = 20) -> DataFrame:
    """More rides than in the window before: largest gain first, then most rides."""
    gained = _ride_counts(attend, as_of).where(F.col("last30") > F.col("prev30")).drop("last31")
    return (
        with_contacts(gained, cust)
        .orderBy(F.desc(F.col("last30") - F.col("prev30")), F.desc("last30"), "custid")
        .limit(k)
    )


def trending_down(attend: DataFrame, cust: DataFrame, as_of: str | dt.date, k: int = 20) -> DataFrame:
    """Fewer rides than before, but some: largest loss first."""
    lost = (
        _ride_counts(attend, as_of)
        .where((F.col("last30") > 0) & (F.col("prev30") > F.col("last30")))
        .drop("last31")
    )
    return (
        with_contacts(lost, cust)
        .orderBy(F.desc(F.col("prev30") - F.col("last30")), "custid")
        .limit(k)
    )


def lapsed(attend: DataFrame, cust: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Rides in the window before, none since."""
    gone = _ride_counts(attend, as_of).where(F.col("last30") == 0)
    return with_contacts(gone.select("custid", "prev30"), cust)


def lapsed_today(attend: DataFrame, cust: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Lapsed customers who were not lapsed yesterday."""
    gone = _ride_counts(attend, as_of).where((F.col("last30") == 0) & (F.col("last31") > 0))
    return with_contacts(gone.select("custid", "prev30"), cust)


def future_bookings(attend: DataFrame, cust: DataFrame, as_of: str | dt.date, days: int = 7) -> DataFrame:
    """Customers enrolled in the next days, with the first such class."""
    ahead = (
        attend.where(_enrolled() & clock.up_to("classdate", as_of, 0, days))
        .groupBy("custid")
        .agg(F.min("classdate").alias("classdate"))
    )
    return with_contacts(ahead, cust)


def doubles(attend: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Several bookings of a customer on one day from ``as_of`` on, any status.

    ``same_class`` tells several spots in one class from several classes.
    """
    per_day = (
        attend.where(clock.whole_days("classdate", as_of, 0, None))
        .groupBy("custid", F.to_date("classdate").alias("day"))
        .agg(
            F.min("firstname").alias("firstname"),
            F.min("lastname").alias("lastname"),
            F.min("emailaddress").alias("emailaddress"),
            F.min("classdate").alias("firstclass"),
            F.max("classdate").alias("lastclass"),
            F.count(F.lit(1)).alias("cnt"),
        )
        .where(F.col("cnt") > 1)
    )
    same = F.date_trunc("minute", "firstclass") == F.date_trunc("minute", "lastclass")
    return per_day.withColumn("same_class", same)
