"""Ages, birthdays and brackets."""

import datetime as dt

from frames import attend, cust, day, values

from studiolens.operators import customers

AS_OF = "2014-07-08"


def test_age_truncates_and_blank_birthdates_have_none(spark):
    people = cust(spark, [(1, "1984-07-08", "2014-01-01"), (2, "1984-07-10", "2014-01-01"),
                          (3, None, "2014-01-01"), (4, "2014-12-01", "2014-01-01")])
    assert values(customers.with_age(people, AS_OF), "id", "age") == [
        (1, 29), (2, 29), (3, None), (4, 0)
    ]


def test_age_range_is_half_open_in_years_of_365_days(spark):
    edge = day(AS_OF)
    rows = [(n, (edge - dt.timedelta(days=n)).isoformat(), "2014-01-01")
            for n in (7299, 7300, 7301, 10949, 10950)]
    rows.append((1, None, "2014-01-01"))
    got = customers.age_between(cust(spark, rows), 20, 30, AS_OF)
    assert values(got, "id") == [(10949,), (7300,), (7301,)]


def test_age_range_with_fractions(spark):
    edge = day(AS_OF)
    rows = [(n, (edge - dt.timedelta(days=n)).isoformat(), "2014-01-01") for n in range(150, 420)]
    got = {r.id for r in customers.age_between(cust(spark, rows), 0.5, 1.1, AS_OF).collect()}
    assert got == {n for n in range(150, 420) if 0.5 <= n / 365.0 < 1.1}


def test_leap_day_birthdays(spark):
    people = cust(spark, [(1, "2000-02-29", "2014-01-01")])
    assert customers.with_birthday(people, "2014-02-01").first().birthday == day("2014-03-01")
    assert customers.with_birthday(people, "2016-02-01").first().birthday == day("2016-02-29")


def test_no_wrap_over_the_year_unless_asked(spark):
    people = cust(spark, [(1, "1990-01-02", "2014-01-01")])
    assert customers.upcoming_birthdays(people, "2014-12-30").count() == 0
    wrapped = customers.with_birthday(people, "2014-12-30", wrap=True).first().birthday
    assert wrapped == day("2015-01-02")


def test_upcoming_birthdays_leave_both_ends_out(spark):
    people = cust(spark, [(1, "1990-07-08", "2014-01-01"), (2, "1990-07-09", "2014-01-01"),
                          (3, "1990-07-14", "2014-01-01"), (4, "1990-07-15", "2014-01-01")])
    assert values(customers.upcoming_birthdays(people, AS_OF), "id") == [(2,), (3,)]


def test_new_customer_windows_and_change(spark):
    people = cust(spark, [(1, None, "2014-07-08 00:00:00"), (2, None, "2014-07-07 23:59:59"),
                          (3, None, "2014-06-07 00:00:00"), (4, None, "2014-06-06 23:59:59"),
                          (5, None, "2014-05-07 00:00:00"), (6, None, "2014-05-06 12:00:00")])
    assert values(customers.new_customers(people, AS_OF), "id") == [(2,), (3,)]
    assert values(customers.new_customers(people, AS_OF, -62, -32), "id") == [(4,), (5,)]
    assert tuple(customers.new_customer_change(people, AS_OF).first()) == (2, 2, 0.0)


def test_each_bracket_has_a_row(spark):
    people = cust(spark, [(1, None, "2014-01-01"), (2, "1984-01-01", "2014-01-01"),
                          (3, "1930-01-01", "2014-01-01")])
    got = dict(values(customers.customers_by_age_bracket(people, AS_OF), "bracket", "cnt"))
    assert len(got) == 9
    assert {k: v for k, v in got.items() if v} == {"no birthday": 1, "30-39": 1, "70+": 1}
    assert got["0-12"] is None
    rides = attend(spark, [(1, 2, "Enrolled", "2014-01-01 06:00:00"),
                           (2, 2, "Cancelled", "2014-01-02 06:00:00"),
                           (3, 1, "Enrolled", "2014-01-01 06:00:00"),
                           (4, 99, "Enrolled", "2014-01-01 06:00:00")])
    got = dict(values(customers.rides_by_age_bracket(rides, people, AS_OF), "bracket", "cnt"))
    assert {k: v for k, v in got.items() if v} == {"no age": 1, "30-39": 1}


def test_wide_brackets(spark):
    people = cust(spark, [(1, None, "2014-01-01"), (2, "1984-01-01", "2014-01-01")])
    row = customers.customers_by_age_bracket_wide(people, AS_OF).first().asDict()
    assert row.pop("none") == 1 and row.pop("age_21_30") == 1 and set(row.values()) == {None}
