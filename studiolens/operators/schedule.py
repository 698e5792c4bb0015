"""Schedules: class times from text, schedule lines, daily digests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studiolens.functions import clock
from studiolens.functions.clock import DAY_NAMES

# The class type left unsaid in a digest, the longest text that still gets a
# link, and the separator of schedule lines.
DEFAULT_TYPE = "cycle"
MAX_TEXT = 118
SEPARATOR = " - "


def _hour(text: Column) -> Column:
    """Hour of a 12-hour time; an afternoon adds 12 below 12, and 12 AM stays 12."""
    hour = F.regexp_extract(text, r"^\s*(\d+):", 1).cast("int")
    afternoon = F.upper(F.regexp_extract(text, r"(?i)\d\s*([AP]M)", 1)) == "PM"
    return F.when(afternoon & (hour < 12), hour + 12).otherwise(hour)


def _minute(text: Column) -> Column:
    return F.regexp_extract(text, r":(\d{2})", 1).cast("int")


def _at(year: Column, month: Column, day: Column, text: Column) -> Column:
    made = F.try_make_timestamp_ntz(year, month, day, _hour(text), _minute(text), F.lit(0))
    return made


def parse_class_time(
    df: DataFrame,
    as_of: str | dt.date,
    time: str = "time_text",
    month: str | None = "month",
    day: str = "day",
    out: str = "classdate",
) -> DataFrame:
    """Class time from texts like ``11:00 AM60min`` and a day without a year.

    With a month, the next such date from ``as_of`` on. Without one (``month=None``), the
    next such day of a month from ``as_of`` on. A date that does not exist gives NULL.
    """
    today = clock.as_day(as_of)
    text, d = F.col(time), F.col(day)
    if month is None:
        this = F.lit(today.year * 12 + today.month - 1)
        index = F.when(d >= today.day, this).otherwise(this + 1)
        year, m = (index / 12).cast("int"), index % 12 + 1
    else:
        m = F.col(month)
        over = (m < today.month) | ((m == today.month) & (d < today.day))
        year = F.lit(today.year) + F.when(over, 1).otherwise(0)
    return df.withColumn(out, _at(year, m, d, text))


def bookable_soon(df: DataFrame, now: dt.datetime, classdate: str = "classdate") -> DataFrame:
    """Classes not yet started, no later than tomorrow."""
    started = F.col(classdate).cast("timestamp_ntz") < F.lit(now.isoformat(" ")).cast("timestamp_ntz")
    return df.where(~started & clock.whole_days(classdate, now.date(), None, 1))


def split_schedule(df: DataFrame, line: str = "line", on_bad: str = "raise") -> DataFrame:
    """``time - instructor - type`` into its parts.

    A line with fewer parts fails the query, or is marked in ``bad`` with ``on_bad="mark"``.
    """
    parts = F.split(F.col(line), SEPARATOR, 3)
    good = F.size(parts) == 3
    if on_bad == "raise":
        parts = F.when(good, parts).otherwise(
            F.raise_error(F.concat(F.lit("schedule line without three parts: "), F.col(line))).cast(
                "array<string>"
            )
        )
    out = df.withColumn("__parts", parts).select(
        *df.columns,
        F.date_format(
            F.try_to_timestamp(F.get("__parts", F.lit(0)), F.lit("h:mm a")), "HH:mm"
        ).alias("class_time"),
        F.get("__parts", F.lit(1)).alias("instructor"),
        F.get("__parts", F.lit(2)).alias("classtype"),
        (~good).alias("bad"),
    )
    return out.drop("bad") if on_bad == "raise" else out


def _clock_text(ts: Column) -> Column:
    hour, minute = F.hour(ts), F.minute(ts)
    shown = F.when(hour > 12, hour - 12).otherwise(hour)
    return F.concat(
        shown.cast("string"),
        F.when(minute > 0, F.concat(F.lit(":"), F.lpad(minute.cast("string"), 2, "0"))).otherwise(""),
        F.when(hour < 12, "a").otherwise("p"),
    )


def schedule_digest(
    classes: DataFrame,
    link: str,
    default_type: str = DEFAULT_TYPE,
    max_text: int = MAX_TEXT,
    by: list[str] | None = None,
) -> DataFrame:
    """One line per day: ``MON 7/8: 6a Ann, 7:30p Bob (power)`` and a link if it fits.

    ``classes`` has ``classdate, instructor, classtype`` and the columns named by ``by``,
    e.g. a site. Repeated rows of a class are removed first, so what comes together for a
    line is the timetable of one day and site.
    """
    by = by or []

    def entry(one: Column) -> Column:
        return F.concat(
            _clock_text(one["classdate"]),
            F.lit(" "),
            one["instructor"],
            F.when(
                F.lower(one["classtype"]) != default_type.lower(),
                F.concat(F.lit(" ("), one["classtype"], F.lit(")")),
            ).otherwise(""),
        )

    # Sets merge before the shuffle: what is sent is no larger than the timetable.
    listed = F.array_sort(F.collect_set(F.struct("classdate", "instructor", "classtype")))
    day = F.col("day")
    names = F.array(*[F.lit(n.upper()) for n in DAY_NAMES])
    head = F.concat(
        F.get(names, F.dayofweek(day) - 1), F.lit(" "),
        F.month(day).cast("string"), F.lit("/"), F.dayofmonth(day).cast("string"), F.lit(": "),
    )
    text = F.concat(head, F.array_join(F.transform("__listed", entry), ", "))
    return (
        classes.groupBy(*by, F.to_date("classdate").alias("day"))
        .agg(listed.alias("__listed"))
        .withColumn("__text", text)
        .select(
            *by,
            "day",
            F.when(
                F.length("__text") <= max_text, F.concat(F.col("__text"), F.lit(" " + link))
            )
            .otherwise(F.col("__text"))
            .alias("digest"),
        )
    )
