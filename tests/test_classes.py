"""Class, slot and instructor statistics, occupancy, schedules, memberships."""

import datetime as dt

import pytest
from frames import attend, day, ts, values
from pyspark.sql import functions as F

from studiolens.operators import classes, membership, occupancy, schedule

AS_OF = "2014-07-08"


def _classes(spark, *rows):
    """(classdate, inst, riders) as attendance rows."""
    out, n = [], 0
    for at, inst, riders in rows:
        for _ in range(riders):
            n += 1
            out.append((n, n, "Enrolled", at, None, inst, inst))
    return attend(spark, out)


def test_rooms_at_one_time_are_one_class_or_two(spark):
    df = _classes(spark, ("2014-07-01 06:00:00", "Ann", 2), ("2014-07-01 06:00:00", "Bob", 3))
    assert values(classes.classes(df), "inst", "enrolled") == [("Ann", 5)]
    assert values(classes.class_stats(df), "inst", "numriders") == [("Ann", 2), ("Bob", 3)]


def test_ten_classes_are_not_more_than_ten(spark):
    ten = [(f"2014-01-{d:02d} 06:00:00", "Ann", 1) for d in range(1, 11)]
    eleven = [(f"2014-02-{d:02d} 06:00:00", "Bob", 2) for d in range(1, 12)]
    got = classes.instr_alltime(_classes(spark, *ten, *eleven))
    assert values(got, "inst", "numclasses", "ttlenrolled", "ridersperclass") == [("Bob", 11, 22, 2.0)]


def test_changes_need_a_class_in_the_last_window(spark):
    df = _classes(
        spark,
        ("2014-07-07 06:00:00", "Ann", 3), ("2014-05-26 06:00:00", "Ann", 2),  # Mondays
        ("2014-07-01 07:30:00", "Bob", 1),
        ("2014-06-06 06:00:00", "Cid", 4),  # only before
    )
    got = values(classes.instr_change(df, AS_OF, min_classes=1), "inst", "a_numclasses", "p_numclasses",
                 "t_ridersperclass", "pctchange")
    assert got == [("Ann", 2, 1, 3.0, 50.0), ("Bob", None, None, 1.0, None)]
    slots = values(classes.slot_change(df, AS_OF), "dow", "hhmm", "p_numclasses", "pctchange")
    assert slots == [(1, "06:00", 1, 50.0), (2, "07:30", None, None)]


def test_frequent_riders_hold_whole_days(spark):
    df = attend(spark, [(i, 1, "Enrolled", f"2014-07-{d:02d} 23:00:00") for i, d in enumerate((1, 22, 23))])
    assert values(classes.frequent_riders(df, "2014-07-01", "2014-07-22", 1), "cnt") == [(2,)]
    assert classes.frequent_riders(df, "2014-07-01", "2014-07-22", 2).count() == 0


@pytest.fixture(scope="module")
def occ(spark):
    rows = [("2014-07-01 06:00:00", "b", "SAnn", 5, 10), ("2014-07-01 07:00:00", "b", "Sally", 10, 10),
            ("2014-07-08 06:00:00", "b", "Bob", 3, 4), ("2014-07-08 09:00:00", "a", "Bob", 0, 0),
            ("2014-06-30 09:00:00", "a", "Bob", 6, 10)]
    return spark.createDataFrame(
        [(ts(r[0]), *r[1:]) for r in rows],
        "dt timestamp_ntz, site string, instr string, unavail int, total int",
    )


def test_occupancy_by_day_is_a_mean_of_classes(occ):
    got = values(occupancy.occ_by_day(occ), "day", "site", "cnt", "pct")
    assert (day("2014-07-01"), "b", 2, 75.0) in got
    assert (day("2014-07-08"), "a", 1, None) in got


def test_riders_per_elapsed_day(occ):
    got = {(r.yymm, r.site): r for r in occupancy.occ_by_month(occ, AS_OF).collect()}
    assert got["2014-07", "b"].ridersperday == 2.3  # 18 riders in 8 days
    assert got["2014-06", "a"].ridersperday == 0.2  # 6 riders in 30 days
    assert got["2014-07", "a"].occupancy is None
    history = {(r.yymm, r.site): r for r in occupancy.occ_history(occ, AS_OF, 0).collect()}
    assert set(history) == {("2014-07", "a"), ("2014-07", "b")}
    assert history["2014-07", "a"].occupancy == 0.0


def test_daily_report_orders_sites_and_adds_summaries(occ):
    got = occupancy.occ_daily_report(occ, AS_OF, ["b"]).orderBy("site_rank", "site", "is_summary", "dt")
    assert [(r.site, r.label, r.is_summary) for r in got.collect()] == [
        ("b", "Bob", False), ("b", "1 classes", True), ("a", "Bob", False), ("a", "1 classes", True)
    ]


def test_names_lose_the_initial_but_for_exceptions(occ):
    got = occupancy.normalise_instr(occ, "S", ["Sally"])
    assert {r.instr: r.instrex for r in got.collect()} == {"SAnn": "Ann", "Sally": "Sally", "Bob": "Bob"}


def test_snapshot_rules(spark):
    obs = spark.createDataFrame(
        [(ts(d), s, "Ann", full, n, total) for d, s, full, n, total in [
            ("2014-07-08 06:00:00", "a", False, 3, 10), ("2014-07-09 23:00:00", "a", True, 0, 0),
            ("2014-07-10 06:00:00", "a", False, 3, 10), ("2014-07-08 07:00:00", "a", False, 3, 9)]],
        "dt timestamp_ntz, site string, instr string, soldout boolean, unavail int, total int",
    )
    seats = spark.createDataFrame([("a", 10)], "site string, seats int")
    got = occupancy.occ_snapshot(obs, seats, AS_OF)
    assert values(got, "dt", "unavail", "total") == [
        (ts("2014-07-08 06:00:00"), 3, 10), (ts("2014-07-09 23:00:00"), 10, 10)
    ]
    with pytest.raises(Exception, match="no capacity for site a"):
        occupancy.occ_snapshot(obs, seats.where("false"), AS_OF).collect()


def test_seats_in_page_text(spark):
    pages = spark.createDataFrame(
        [(1, "u", 'x Seat Taken. seat taken'), (2, "u", "Sorry, the class is FULL"), (3, "u", "")],
        "page_id bigint, url string, html string",
    )
    got = occupancy.marker_occupancy(pages, "seat taken", "class is full", 8)
    assert values(got, "page_id", "unavail", "total", "pct") == [
        (1, 2, 8, 25.0), (2, 8, 8, 100.0), (3, 0, 8, 0.0)
    ]
    # A marker is text: its dot is a dot.
    assert occupancy.marker_occupancy(pages, "taken.", "zzz", 8).where("unavail = 1").count() == 1
    spots = occupancy.spot_occupancy(pages, "(?i)seat taken", "(?i)seat|class")
    assert values(spots, "page_id", "unavail", "total", "pct") == [
        (1, 2, 2, 100.0), (2, 0, 1, 0.0), (3, 0, 0, None)
    ]


@pytest.mark.parametrize(
    "text,month,d,want",
    [
        ("11:00 AM60min", 7, 8, "2014-07-08 11:00:00"),
        ("5:30 PM45min", 7, 7, "2015-07-07 17:30:00"),
        ("12:15 PM60min", 12, 31, "2014-12-31 12:15:00"),
        ("12:00 AM60min", 8, 1, "2014-08-01 12:00:00"),
        ("6:00 AM60min", 2, 30, None),
    ],
)
def test_class_times_with_a_month(spark, text, month, d, want):
    df = spark.createDataFrame([(text, month, d)], "time_text string, month int, day int")
    assert schedule.parse_class_time(df, AS_OF).first().classdate == ts(want)


@pytest.mark.parametrize(
    "as_of,d,want",
    [
        ("2014-07-08", 8, "2014-07-08 17:30:00"),
        ("2014-07-08", 7, "2014-08-07 17:30:00"),
        ("2014-11-20", 3, "2014-12-03 17:30:00"),
        ("2014-12-31", 1, "2015-01-01 17:30:00"),
    ],
)
def test_class_times_with_a_day_only(spark, as_of, d, want):
    df = spark.createDataFrame([("5:30PM", d)], "time_text string, day int")
    assert schedule.parse_class_time(df, as_of, month=None).first().classdate == ts(want)


def test_bookable_soon(spark):
    times = ["2014-07-08 11:59:00", "2014-07-08 12:00:00", "2014-07-09 23:00:00", "2014-07-10 00:00:00"]
    df = spark.createDataFrame([(ts(t),) for t in times], "classdate timestamp_ntz")
    got = schedule.bookable_soon(df, dt.datetime(2014, 7, 8, 12))
    assert values(got, "classdate") == [(ts(times[1]),), (ts(times[2]),)]


def test_schedule_lines(spark):
    df = spark.createDataFrame([("6:00 AM - Ann - Cycle - Power",), ("7:30 PM - Bob",)], "line string")
    with pytest.raises(Exception, match="without three parts: 7:30 PM - Bob"):
        schedule.split_schedule(df).collect()
    got = schedule.split_schedule(df, on_bad="mark")
    assert values(got.where("not bad"), "class_time", "instructor", "classtype") == [
        ("06:00", "Ann", "Cycle - Power")
    ]
    assert got.where("bad").count() == 1


def test_digest_text_and_link(spark):
    rows = [("2014-07-07 06:00:00", "Ann", "Cycle"), ("2014-07-07 19:30:00", "Bob", "Power"),
            ("2014-07-07 12:05:00", "Cid", "cycle"), ("2014-07-07 06:00:00", "Ann", "Cycle")]
    rows += [(f"2014-07-08 {h:02d}:00:00", "Somebody", "Cycle") for h in range(5, 20)]
    df = spark.createDataFrame(
        [(ts(a), b, c) for a, b, c in rows], "classdate timestamp_ntz, instructor string, classtype string"
    )
    got = dict(values(schedule.schedule_digest(df, "x.example"), "day", "digest"))
    assert got[day("2014-07-07")] == "MON 7/7: 6a Ann, 12:05p Cid, 7:30p Bob (Power) x.example"
    assert got[day("2014-07-08")].startswith("TUE 7/8: 5a Somebody, 6a Somebody")
    assert not got[day("2014-07-08")].endswith("x.example")


def test_membership_forecast(spark):
    paid = [("past", "2014-01-01")] * 4 + [("new", "2014-08-01")] + [("mid", "2014-07-08")] * 5
    paid += [("old", "2014-07-09")] * 12
    df = spark.createDataFrame([(m, day(e)) for m, e in paid], "member string, expiry date")
    averages = membership.average_tenure(df, AS_OF)
    assert values(averages, "current", "members", "avg_months") == [(False, 1, 4.0), (True, 3, 6.0)]
    got = membership.forecast(df, AS_OF, price=100.0)
    assert values(got, "member", "path", "guaranteed", "expected") == [
        ("mid", "reaches average", 0.0, 100.0), ("new", "expires", 200.0, 300.0),
        ("old", "beyond average", 0.0, 240.0),
    ]
    assert tuple(membership.forecast_totals(df, AS_OF, price=100.0).first()) == (3, 200.0, 640.0)
    assert df.where(F.col("member") == "past").count() == 4
