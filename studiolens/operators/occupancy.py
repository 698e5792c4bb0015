"""Seat occupancy: classes, days, months, and the counting of seats in page text."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studiolens.functions import clock
from studiolens.functions.ratio import exact_mean, per_unit, round_half_up
from studiolens.sources.tables import newest_per_key


def _pct() -> Column:
    taken, seats = F.col("unavail").cast("double"), F.col("total").cast("double")
    return F.try_divide(taken, seats) * F.lit(100.0)


def with_occupancy(occ: DataFrame) -> DataFrame:
    """Percent of seats taken, NULL for a class without seats."""
    return occ.withColumn("pct", _pct())


def site_rank(df: DataFrame, order: list[str], column: str = "site") -> DataFrame:
    """Sort position of a site: listed sites first, in that order, then the others.

    Sort by ``(site_rank, site)``.
    """
    rank = F.coalesce(
        *[F.when(F.col(column) == name, F.lit(i + 1)) for i, name in enumerate(order)],
        F.lit(len(order) + 1),
    )
    return df.withColumn("site_rank", rank)


def normalise_instr(
    df: DataFrame, initial: str = "S", exceptions: list[str] | None = None, column: str = "instr"
) -> DataFrame:
    """Strip a leading studio initial from the name, unless it starts with an exception."""
    name = F.col(column)
    out = F.when(name.startswith(initial), name.substr(F.lit(len(initial) + 1), F.length(name)))
    keep = F.lit(False)
    for word in exceptions or []:
        keep = keep | name.startswith(word)
    return df.withColumn("instrex", F.when(keep, name).otherwise(F.coalesce(out, name)))


def _sums() -> list[Column]:
    return [F.sum("unavail").alias("unavail"), F.sum("total").alias("total")]


def occ_by_day(occ: DataFrame) -> DataFrame:
    """Classes, seats and the unweighted mean of the class percentages, by day and site."""
    return (
        with_occupancy(occ)
        .groupBy(F.to_date("dt").alias("day"), "site")
        .agg(F.count(F.lit(1)).alias("cnt"), *_sums(), exact_mean("pct").alias("pct"))
    )


def _summary(occ: DataFrame, *keys: Column | str, per_day: Column | None = None) -> DataFrame:
    grouped = (
        with_occupancy(occ)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("numclasses"),
            F.sum("unavail").alias("enrolled"),
            F.sum("total").alias("avail"),
            round_half_up(exact_mean("pct"), 1).alias("occupancy"),
        )
        .withColumn("ridersperclass", per_unit("enrolled", "numclasses"))
    )
    return grouped if per_day is None else grouped.withColumn("ridersperday", per_day)


def occ_alltime(occ: DataFrame) -> DataFrame:
    return _summary(occ, "site")


def occ_by_month(occ: DataFrame, as_of: str | dt.date) -> DataFrame:
    """By month and site, with riders per elapsed day of the month."""
    month = F.trunc("dt", "MM")
    elapsed = (
        F.datediff(
            F.least(F.lit(clock.as_day(as_of)), F.last_day("__month")), F.col("__month")
        )
        + 1
    )
    out = _summary(
        occ.withColumn("__month", month), "__month", "site", per_day=per_unit("enrolled", elapsed)
    )
    return out.withColumn("yymm", clock.month_key("__month")).drop("__month")


def occ_by_month_instr(occ: DataFrame, instr: str = "instr") -> DataFrame:
    month = F.trunc("dt", "MM").alias("__month")
    out = _summary(occ, month, "site", F.col(instr).alias("instrex"))
    return out.withColumn("yymm", clock.month_key("__month")).drop("__month")


def occ_by_instr(occ: DataFrame) -> DataFrame:
    return (
        with_occupancy(occ)
        .groupBy("instr")
        .agg(F.count(F.lit(1)).alias("cnt"), exact_mean("pct").alias("avgpct"))
    )


def occ_window(occ: DataFrame, as_of: str | dt.date, n: int = 7) -> DataFrame:
    """Classes and seats by site over whole days ``as_of-n`` to ``as_of``."""
    return (
        occ.where(clock.whole_days("dt", as_of, -n, 0))
        .groupBy("site")
        .agg(
            F.count(F.lit(1)).alias("ttlcnt"),
            F.sum("unavail").alias("ttlunavail"),
            F.sum("total").alias("ttltotal"),
        )
    )


def occ_daily_report(
    occ: DataFrame, day: str | dt.date, order: list[str] | None = None
) -> DataFrame:
    """The classes of one day and a summary row per site (``is_summary``)."""
    today = with_occupancy(occ.where(clock.on_day("dt", day)))

    def line(is_summary: bool, dt: Column, label: Column) -> Column:
        return F.struct(
            F.lit(is_summary).alias("is_summary"), dt.alias("dt"), label.alias("label"),
            F.col("unavail").cast("bigint").alias("unavail"),
            F.col("total").cast("bigint").alias("total"), "pct",
        )

    # The classes of a site on one day are few; they are read once for lines and sums.
    classes = F.collect_list(line(False, F.col("dt"), F.col("instr"))).alias("__lines")
    sums = today.groupBy("site").agg(
        classes, F.count(F.lit(1)).alias("cnt"), *_sums(), exact_mean("pct").alias("pct")
    )
    start = F.lit(clock.as_day(day)).cast(occ.schema["dt"].dataType)
    summary = line(True, start, F.concat(F.col("cnt").cast("string"), F.lit(" classes")))
    rows = sums.select("site", F.inline(F.concat("__lines", F.array(summary))))
    return site_rank(rows, order or [])


def _since_month(occ: DataFrame, as_of: str | dt.date, months: int) -> DataFrame:
    day = clock.as_day(as_of)
    first = day.year * 12 + day.month - 1 - months
    return occ.where(F.col("dt") >= F.lit(dt.date(first // 12, first % 12 + 1, 1)))


def occ_history(occ: DataFrame, as_of: str | dt.date, months: int = 2) -> DataFrame:
    """Month history by site: the last ``months`` months and the current one, NULLs as 0."""
    out = occ_by_month(_since_month(occ, as_of, months), as_of)
    return out.na.fill(0)


def occ_history_instr(occ: DataFrame, as_of: str | dt.date, months: int = 1) -> DataFrame:
    return occ_by_month_instr(_since_month(occ, as_of, months)).na.fill(0)


# --- observations ---------------------------------------------------------------------


def with_capacity(rows: DataFrame, capacity: DataFrame) -> DataFrame:
    """``__seats`` of the row's site; a site without any is an error."""
    seats = capacity.select("site", F.col("seats").alias("__seats"))
    missing = F.raise_error(F.concat(F.lit("no capacity for site "), F.col("site"))).cast("int")
    return rows.join(seats, "site", "left").withColumn(
        "__seats", F.coalesce(F.col("__seats"), missing)
    )


def occ_snapshot(obs: DataFrame, capacity: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Usable observations: no later than tomorrow, in a full-size room.

    A sold-out class shows no seats; all seats of the site are taken then. A class with
    fewer seats than the site runs in another room and is left out. ``capacity`` has a row
    per site; a site without one is an error.
    """
    known = with_capacity(obs.where(clock.whole_days("dt", as_of, None, 1)), capacity)
    full = F.col("soldout")
    return (
        known.withColumn("unavail", F.when(full, F.col("__seats")).otherwise(F.col("unavail")))
        .withColumn("total", F.when(full, F.col("__seats")).otherwise(F.col("total")))
        .where(F.col("total") >= F.col("__seats"))
        .drop("__seats", "soldout")
    )


def occ_latest(obs: DataFrame, polled: str = "poll_ts") -> DataFrame:
    """The latest snapshot per class time and site."""
    return newest_per_key(obs, ["dt", "site"], polled)


# --- counting seats in page text ------------------------------------------------------


def _with_seats(pages: DataFrame, taken: Column, seats: Column) -> DataFrame:
    return with_occupancy(
        pages.select("page_id", "url", taken.alias("unavail"), seats.alias("total"))
    )


def marker_occupancy(
    pages: DataFrame, taken: str, full: str, capacity: int | DataFrame, html: str = "html"
) -> DataFrame:
    """Count a marker of taken seats; the marker of a full class takes all of them.

    Both markers are plain text, upper and lower case alike. ``capacity`` is one number, or a
    table of ``seats`` by ``site`` for pages with a ``site``; a site without seats is an error.
    """
    count = F.regexp_count(F.col(html), F.lit("(?i)" + re.escape(taken)))
    is_full = F.contains(F.lower(html), F.lit(full.lower()))
    if isinstance(capacity, int):
        seats = F.lit(capacity)
    else:
        pages = with_capacity(pages, capacity)
        seats = F.col("__seats")
    return _with_seats(pages, F.when(is_full, seats).otherwise(count), seats)


def spot_occupancy(
    pages: DataFrame, enrolled: str, seat: str, html: str = "html"
) -> DataFrame:
    """Count enrolled seats among all seats, both given as regular expressions.

    A held seat is a seat but not an enrolled one, so it counts as free.
    """
    return _with_seats(
        pages,
        F.regexp_count(F.col(html), F.lit(enrolled)),
        F.regexp_count(F.col(html), F.lit(seat)),
    )
