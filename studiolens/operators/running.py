"""Running ride counts and the milestones built on them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from studiolens.functions import clock
from studiolens.functions.keys import with_contacts
from studiolens.functions.prefix import TASK_ROWS, instant, prefix_before, time_levels
from studiolens.operators.retention import ENROLLED

# Ride milestones (every STEP rides, announced APPROACH rides before, up to
# MAX_RIDES), and the studio count that is celebrated.
STEP, APPROACH, MAX_RIDES = 100, 5, 1000
STUDIO_STEP, STUDIO_PARTY = 100, 10_000

ORDER = ["classdate", "datein", "id"]


def _one() -> Column:
    """1 for an enrolled ride, 0 for a row that only carries the count."""
    return F.when(F.col("status") == ENROLLED, 1).otherwise(0)


def with_ride_number(
    attend: DataFrame, stored: DataFrame | None = None, task_rows: int = TASK_ROWS
) -> DataFrame:
    """``num``: enrolled rides of the customer so far, in order of class and booking time.

    Rows of another status carry the count. ``stored`` is the table loaded so far; its
    counts go on. Rows without a customer are counted together, as those of one customer.
    """
    start = None
    if stored is not None:
        start = stored.groupBy("custid").agg(F.max("num").alias("num"))
    counted = prefix_before(
        attend.drop("num"),
        ["custid"],
        time_levels(["classdate", "datein"], "id"),
        ORDER,
        {"num": ("sum", _one())},
        start,
        task_rows,
    )
    return counted.withColumn("num", F.col("num") + _one())


def with_studio_number(
    attend: DataFrame,
    stored: DataFrame | None = None,
    task_rows: int = TASK_ROWS,
    same_rows: DataFrame | None = None,
) -> DataFrame:
    """``totnum``: the same count over all customers.

    What came before a day is known from the day totals. Only these, one row per calendar
    day, are ordered in a single task; the days are then counted like customers.
    ``same_rows`` are the rows before columns were added to them, if any were.
    """

    def dated(df: DataFrame) -> DataFrame:
        return df.drop("totnum").withColumn("__date", instant("classdate", "day"))

    days = dated(attend)
    plain = days if same_rows is None else dated(same_rows)
    earlier = Window.orderBy("__date").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("__n").over(earlier), F.lit(0))
    if stored is not None:
        before = before + F.coalesce(stored.agg(F.max("totnum")).scalar(), F.lit(0))
    start = (
        plain.groupBy("__date")
        .agg(F.sum(_one()).alias("__n"))
        .select("__date", before.alias("totnum"))
    )
    # The day is the key here. Bookings of one class come over weeks, so they are cut by day and
    # hour before they are cut by second: each level orders few buckets of the one above it.
    second, block = time_levels(["classdate", "datein"], "id")[1:]
    levels = [
        {"__hour": instant("classdate", "hour")},
        {"__at": second.pop("__at"), "__booked_day": instant("datein", "day")},
        {"__booked_hour": instant("datein", "hour")},
        second,
        block,
    ]
    counted = prefix_before(
        days, ["__date"], levels, ORDER, {"totnum": ("sum", _one())}, start, task_rows, plain
    )
    return counted.drop("__date").withColumn("totnum", F.col("totnum") + _one())


def with_both_numbers(
    attend: DataFrame, stored: DataFrame | None = None, task_rows: int = TASK_ROWS
) -> DataFrame:
    """``num`` and ``totnum``; the totals are read from the rows as they came."""
    rides = with_ride_number(attend, stored, task_rows)
    return with_studio_number(rides, stored, task_rows, same_rows=attend)


def milestones_next(
    attend: DataFrame,
    cust: DataFrame,
    as_of: str | dt.date,
    step: int = STEP,
    approach: int = APPROACH,
    limit: int = MAX_RIDES,
    enrolled_only: bool = False,
) -> DataFrame:
    """Rides of the next week near or at a milestone, and milestones reached today."""
    num = F.col("num")
    near = (
        clock.up_to("classdate", as_of, 0, 7)
        & num.between(step - approach, limit)
        & ((num % step >= step - approach) | (num % step == 0))
    )
    today = (num % step == 0) & (num > 0) & clock.on_day("classdate", as_of)
    # Both arms lie in this week; said once so that the scan can prune by it.
    hits = attend.where(clock.up_to("classdate", as_of, 0, 7) & (near | today))
    if enrolled_only:
        hits = hits.where(F.col("status") == ENROLLED)
    return with_contacts(hits.select("custid", "classdate", "num"), cust)


def studio_milestones_next(
    attend: DataFrame,
    cust: DataFrame,
    as_of: str | dt.date,
    step: int = STUDIO_STEP,
    party: int = STUDIO_PARTY,
) -> DataFrame:
    """Rides of the next week with a round studio count."""
    hits = attend.where(clock.up_to("classdate", as_of, 0, 7) & (F.col("totnum") % step == 0))
    return with_contacts(hits.select("custid", "classdate", "num", "totnum"), cust).withColumn(
        "celebrate", F.col("totnum") % party == 0
    )


def _ride_totals(attend: DataFrame, as_of: str | dt.date, ahead: int) -> DataFrame:
    upto = clock.whole_days("classdate", as_of, None, ahead)
    return (
        attend.where((F.col("status") == ENROLLED) & upto)
        .groupBy("custid")
        .agg(F.count(F.lit(1)).alias("cnt"), F.max("classdate").alias("classdate"))
    )


def milestone_riders(
    attend: DataFrame, cust: DataFrame, as_of: str | dt.date, step: int = 50, ahead: int = 10
) -> DataFrame:
    """Customers whose rides up to ``as_of+ahead`` are a multiple of ``step``."""
    exact = _ride_totals(attend, as_of, ahead).where(F.col("cnt") % step == 0)
    return with_contacts(exact, cust)


def near_milestone_riders(
    attend: DataFrame,
    cust: DataFrame,
    as_of: str | dt.date,
    step: int = STEP,
    within: int = 10,
    limit: int = MAX_RIDES,
    ahead: int = 10,
) -> DataFrame:
    """Customers less than ``within`` rides before, or at, a multiple of ``step``."""
    cnt = F.col("cnt")
    near = (cnt % step > step - within) | (cnt % step == 0)
    totals = _ride_totals(attend, as_of, ahead).where(
        near & (cnt > step - within) & (cnt <= limit)
    )
    return with_contacts(totals, cust)


def rides_by_name(attend: DataFrame) -> DataFrame:
    """Attendance rows per name and the latest class day."""
    return attend.groupBy("firstname", "lastname").agg(
        F.count(F.lit(1)).alias("cnt"), F.max(F.to_date("classdate")).alias("asof")
    )


def ride_number_on_read(
    attend: DataFrame, as_of: str | dt.date, back: int = 7, fwd: int = 7
) -> DataFrame:
    """Ride numbers computed at read time: enrolled rides up to and including the class time.

    Rides of one customer at one class time share the number. Counting per class first
    leaves one row per customer and class for the running sum.
    """
    enrolled = attend.where(F.col("status") == ENROLLED)
    per_class = enrolled.groupBy("custid", "classdate").agg(F.count(F.lit(1)).alias("__here"))
    numbered = prefix_before(
        per_class,
        ["custid"],
        [{"__day": instant("classdate", "day")}],
        ["classdate"],
        {"num": ("sum", F.col("__here"))},
    ).select("custid", "classdate", (F.col("num") + F.col("__here")).alias("num"))
    window = clock.whole_days("classdate", as_of, -back, fwd)
    return (
        enrolled.where(window)
        .join(numbered.where(window), ["custid", "classdate"])
        .select("id", "custid", "firstname", "lastname", "classdate", "num")
    )


def last_known_or_upcoming(
    attend: DataFrame, as_of: str | dt.date, lo: int = 97, hi: int = 100, ahead: int = 8
) -> DataFrame:
    """Customers without a future class whose count is near a milestone, and upcoming
    rides near it."""
    columns = ["custid", "firstname", "lastname", "classdate", "num"]
    near = F.col("num").between(lo, hi)
    coming = F.when(
        clock.up_to("classdate", as_of, 0, ahead) & near, F.struct(*columns[1:])
    )
    # One pass over the numbered rows: upcoming ones stand by themselves, with their number of
    # copies, the others of a customer are one row.
    groups = attend.groupBy("custid", coming.alias("__coming")).agg(
        F.min("firstname").alias("firstname"),
        F.min("lastname").alias("lastname"),
        F.max("classdate").alias("classdate"),
        F.max("num").alias("num"),
        F.count(F.lit(1)).alias("__n"),
    )
    stands = F.col("__coming").isNotNull()
    some = F.max(stands).over(Window.partitionBy("custid"))
    last = ~F.col("__some") & clock.half_open("classdate", None, as_of) & near
    copies = F.explode(F.sequence(F.lit(1), F.when(stands, F.col("__n")).otherwise(F.lit(1))))
    return (
        groups.withColumn("__some", some)
        .where(stands | last)
        .select(*columns, copies.alias("__copy"))
        .select(*columns)
    )
