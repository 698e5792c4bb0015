"""Retention rules on tiny tables."""

from frames import attend, cust, openseries, sale, ts, values

from studiolens.operators import retention, running

AS_OF = "2014-07-08"


def _people(spark, *ids, created="2014-01-01"):
    return cust(spark, [(i, None, created) for i in ids])


def _rides(spark, *rides):
    """(custid, date) pairs, enrolled at 6."""
    return attend(
        spark, [(n, c, "Enrolled", f"{d} 06:00:00") for n, (c, d) in enumerate(rides)]
    )


def test_first_timers_of_today_and_yesterday(spark):
    rides = _rides(spark, (1, "2014-07-07"), (1, "2014-07-08"), (2, "2014-07-08"))
    numbered, people = running.with_ride_number(rides), _people(spark, 1, 2)
    assert values(retention.first_timers(numbered, people, AS_OF), "custid") == [(2,)]
    assert values(retention.first_timers(numbered, people, AS_OF, -1), "custid") == [(1,)]


def test_trends_and_lapsing(spark):
    rides = _rides(
        spark,
        (1, "2014-06-01"), (1, "2014-06-20"), (1, "2014-07-10"),  # up: 1 -> 2
        (2, "2014-06-01"), (2, "2014-06-02"), (2, "2014-07-01"),  # down: 2 -> 1
        (3, "2014-06-01"),  # lapsed
        (4, "2014-06-07"),  # lapsed today: its last ride just left the window
        (5, "2014-07-01"),  # new: nothing before
        (6, "2014-05-08"),  # too long ago
        (7, "2014-06-01"), (7, "2014-07-15"),  # a booking on the last day does not count
        (9, "2014-06-01"),  # not a known customer
    )
    people = _people(spark, 1, 2, 3, 4, 5, 6, 7)
    assert values(retention.trending_up(rides, people, AS_OF), "custid", "prev30", "last30") == [(1, 1, 2)]
    assert values(retention.trending_down(rides, people, AS_OF), "custid", "prev30", "last30") == [(2, 2, 1)]
    assert values(retention.lapsed(rides, people, AS_OF), "custid") == [(3,), (4,), (7,)]
    assert values(retention.lapsed_today(rides, people, AS_OF), "custid") == [(4,)]


def test_lists_are_cut_at_k_with_ties_by_customer(spark):
    rides = _rides(spark, *[(c, "2014-07-01") for c in (3, 1, 2)], (2, "2014-07-02"))
    got = retention.top_recent(rides, _people(spark, 1, 2, 3), AS_OF, k=2).collect()
    assert [(r.custid, r.cnt) for r in got] == [(2, 2), (1, 1)]


def test_birthday_window_keeps_idle_customers_and_ties(spark):
    people = cust(spark, [(1, "1990-07-10", "2014-01-01"), (2, "1990-07-15", "2014-01-01"),
                          (3, "1990-07-16", "2014-01-01")])
    rides = attend(spark, [(1, 1, "Enrolled", "2014-07-09 00:00:00"),
                           (2, 1, "Cancelled", "2014-07-11 00:00:00"),
                           (3, 1, "Enrolled", "2014-07-14 00:00:00"),
                           (4, 2, "Enrolled", "2014-07-15 00:00:00")])
    window = retention.birthday_riders_window(people, rides, AS_OF)
    assert values(window, "id", "ndays") == [(1, 1.0), (1, 1.0), (1, 4.0), (2, None)]
    nearest = retention.nearest_birthday_class(people, rides, AS_OF)
    assert values(nearest, "id", "classdate") == [
        (1, ts("2014-07-09 00:00:00")), (1, ts("2014-07-11 00:00:00"))
    ]
    assert retention.riding_on_birthday(people, rides, AS_OF).count() == 0


def test_stalled_customers(spark):
    people = cust(spark, [(i, None, "2014-07-01 10:00:00") for i in (1, 2, 3, 4)]
                  + [(5, None, "2014-07-02 10:00:00")])
    rides = attend(spark, [(1, 1, "Enrolled", "2014-07-05 06:00:00"),
                           (2, 2, "Cancelled", "2014-07-05 06:00:00")])
    sales = sale(spark, [("2014-07-01 10:00:00", 3, "Card", "5.00", "Ticket", "event")])
    got = retention.stalled(people, rides, sales, ["Ticket"], AS_OF)
    assert values(got, "id") == [(2,), (4,)]
    since = retention.never_enrolled_since(people, rides, sales, ["Ticket"], "2014-07-01")
    assert values(since, "id") == [(2,), (4,), (5,)]
    assert values(retention.never_attended(people, rides, AS_OF), "id") == [(5,)]


def test_winback_ignores_customers_without_an_address(spark):
    people = _people(spark, 1, 2, 3)
    people = people.selectExpr(
        "id", "nullif(emailaddress, 'c3@example.test') as emailaddress"
    )
    sales = sale(spark, [("2014-01-01 10:00:00", c, "Card", "5.00", "Ten", "series") for c in (1, 2, 3)])
    series = openseries(spark, [("c1@example.test", "Ten", 10, 5), (None, "Ten", 10, 5)])
    assert values(retention.winback_series(sales, people, series, ["Ten"]), "emailaddress") == [
        ("c2@example.test",)
    ]


def test_lapsed_between_counts(spark):
    rides = _rides(spark, (1, "2015-01-01"), (1, "2015-02-27"), (2, "2015-01-01"),
                   (3, "2015-01-01"), (3, "2015-03-01"), (4, "2015-02-28"))
    people = _people(spark, 1, 2, 3, 4, 5)
    span = ("2015-01-01", "2015-02-28", "2015-03-01")
    assert values(retention.lapsed_between(people, rides, *span), "id") == [(1,), (2,)]
    assert values(retention.lapsed_between(people, rides, *span, n=1), "id") == [(1,)]
    assert values(retention.lapsed_between(people, rides, *span, n=1, cmp="="), "id") == [(2,)]
    assert values(retention.lapsed_between(people, rides, *span, n=0, cmp="="), "id") == [(4,), (5,)]
    series = openseries(spark, [("c1@example.test", "Ten", 10, 5)])
    assert values(retention.lapsed_no_open(people, rides, series, *span), "id") == [(2,)]


def test_rode_never_paid(spark):
    rides = _rides(spark, (1, "2014-07-01"), (2, "2014-07-01"), (3, "2014-07-01"),
                   (3, "2014-07-09"), (4, "2014-07-01"))
    sales = sale(spark, [("2014-01-01 10:00:00", 2, "Card", "5.00", "x", "t"),
                         ("2014-01-01 10:00:00", 4, "Card", "5.00", "x", "t"),
                         ("2014-01-02 10:00:00", 4, "Card", "-5.00", "x", "t")])
    got = retention.rode_never_paid(_people(spark, 1, 2, 3, 4, 5), rides, sales, AS_OF)
    assert values(got, "id") == [(1,), (4,)]


def test_last_touch_and_activity(spark):
    rides = attend(spark, [(1, 1, "Enrolled", "2014-06-09 00:00:00"),
                           (2, 1, "Cancelled", "2014-08-01 00:00:00"),
                           (3, 3, "Enrolled", "2014-06-08 23:00:00")])
    sales = sale(spark, [("2014-07-01 10:00:00", 2, "Comp", "0.00", "x", "t"),
                         ("2014-05-10 10:00:00", 2, "Card", "1.00", "x", "t")])
    people = _people(spark, 1, 2, 3, 4)
    touch = retention.last_touch(people, sales, rides)
    assert values(touch, "id", "lastattend", "lastsale") == [
        (1, ts("2014-06-09 00:00:00"), None), (2, None, ts("2014-05-10 10:00:00")),
        (3, ts("2014-06-08 23:00:00"), None), (4, None, None),
    ]
    assert values(retention.touched_in_window(people, sales, rides, AS_OF), "id") == [(1,)]
    assert values(retention.touched_in_window(people, sales, rides, AS_OF, "prev"), "id") == [(2,), (3,)]
    assert tuple(retention.active_change(rides, AS_OF).first()) == (1, 1, 0.0)


def test_several_bookings_on_a_day(spark):
    rides = attend(spark, [(1, 1, "Enrolled", "2014-07-08 06:00:00"),
                           (2, 1, "Enrolled", "2014-07-08 06:00:30"),
                           (3, 2, "Enrolled", "2014-07-08 06:00:00"),
                           (4, 2, "Cancelled", "2014-07-08 18:00:00"),
                           (5, 3, "Enrolled", "2014-07-07 06:00:00"),
                           (6, 3, "Enrolled", "2014-07-07 07:00:00"),
                           (7, 4, "Enrolled", "2014-07-08 06:00:00")])
    got = values(retention.doubles(rides, AS_OF), "custid", "cnt", "same_class")
    assert got == [(1, 2, True), (2, 2, False)]


def test_future_bookings(spark):
    rides = _rides(spark, (1, "2014-07-09"), (1, "2014-07-08"), (2, "2014-07-15"), (3, "2014-07-07"))
    got = retention.future_bookings(rides, _people(spark, 1, 2, 3), AS_OF)
    assert values(got, "custid", "classdate") == [(1, ts("2014-07-08 06:00:00"))]
