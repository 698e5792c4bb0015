"""Window edges, calendar rules, ratios and flags."""

import datetime as dt

import pytest
from frames import ts
from pyspark.sql import functions as F

from studiolens.functions import clock
from studiolens.functions.ratio import exact_mean, pct_change, per_unit, round_half_up, threshold_flag

AS_OF = "2014-07-08"


@pytest.fixture(scope="module")
def edges(spark):
    times = [
        "2014-07-07 23:59:59", "2014-07-08 00:00:00", "2014-07-08 12:00:00",
        "2014-07-14 23:59:59", "2014-07-15 00:00:00", "2014-07-15 23:59:59",
        "2014-07-16 00:00:00",
    ]
    return spark.createDataFrame([(ts(t),) for t in times], "t timestamp_ntz")


def _kept(df, test):
    return [r.t.isoformat(" ") for r in df.where(test).orderBy("t").collect()]


def test_whole_days_hold_the_last_day_whole(edges):
    kept = _kept(edges, clock.whole_days("t", AS_OF, 0, 7))
    assert kept[0] == "2014-07-08 00:00:00" and kept[-1] == "2014-07-15 23:59:59"


def test_up_to_leaves_the_last_day_out(edges):
    kept = _kept(edges, clock.up_to("t", AS_OF, 0, 7))
    assert kept[0] == "2014-07-08 00:00:00" and kept[-1] == "2014-07-14 23:59:59"


def test_open_ends_and_single_day(edges):
    assert len(_kept(edges, clock.whole_days("t", AS_OF, None, -1))) == 1
    assert len(_kept(edges, clock.whole_days("t", AS_OF, 0, None))) == 6
    assert len(_kept(edges, clock.on_day("t", AS_OF))) == 2


def test_thirty_days_are_thirty_one(spark):
    days = spark.sql("select explode(sequence(date'2014-05-01', date'2014-07-20')) t")
    assert days.where(clock.whole_days("t", AS_OF, -31, -1)).count() == 31
    assert days.where(clock.whole_days("t", AS_OF, -62, -32)).count() == 31
    assert days.where(clock.whole_days("t", AS_OF, -8, -1)).count() == 8
    assert days.where(clock.up_to("t", AS_OF, -60, -30)).count() == 30


def test_week_and_weekday_numbers_match_the_c_library(spark):
    days = spark.sql("select explode(sequence(date'2010-01-01', date'2020-12-31')) t")
    rows = days.select(
        "t", clock.monday_week("t").alias("w"), clock.weekday_number("t").alias("d")
    ).collect()
    assert all(r.w == r.t.strftime("%Y-%W") and r.d == int(r.t.strftime("%w")) for r in rows)


def test_day_names(spark):
    days = spark.sql("select explode(sequence(date'2014-07-06', date'2014-07-12')) t")
    rows = days.select("t", clock.day_name(clock.weekday_number("t")).alias("n")).collect()
    assert [r.n for r in sorted(rows)] == ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]


def test_as_day_takes_text_dates_and_datetimes():
    want = dt.date(2014, 7, 8)
    assert clock.as_day(AS_OF) == clock.as_day(want) == clock.as_day(ts("2014-07-08 10:00:00")) == want


def _one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_ratios_without_divisor_are_null(spark):
    assert _one(spark, pct_change(F.lit(5), F.lit(0))) is None
    assert _one(spark, pct_change(F.lit(5), F.lit(None).cast("int"))) is None
    assert _one(spark, per_unit(F.lit(5), F.lit(0))) is None


def test_rounding_is_half_up_on_the_printed_value(spark):
    assert _one(spark, round_half_up(F.lit(1.005), 2)) == 1.01
    assert _one(spark, round_half_up(F.lit(2.25), 1)) == 2.3
    assert _one(spark, pct_change(F.lit(3), F.lit(7))) == -57.1


def test_mean_is_unweighted(spark):
    df = spark.createDataFrame([(10.0,), (20.0,), (None,)], "p double")
    assert df.agg(exact_mean("p").alias("m")).first().m == 15.0


@pytest.mark.parametrize(
    "value,low,high,want",
    [(0.0, 0, 0, "down"), (0.1, 0, 0, "up"), (-10.0, -10, 10, "down"), (10.0, -10, 10, "up"),
     (9.9, -10, 10, "flat"), (None, -10, 10, None)],
)
def test_flags(spark, value, low, high, want):
    assert _one(spark, threshold_flag(F.lit(value).cast("double"), low, high)) == want
