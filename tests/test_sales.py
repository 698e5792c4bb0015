"""Sales rules on tiny tables."""

from decimal import Decimal as D

import pytest
from frames import attend, cust, openseries, sale, ts, values

from studiolens.operators import running, sales

AS_OF = "2014-07-08"


@pytest.fixture(scope="module")
def sold(spark):
    return sale(
        spark,
        [
            ("2014-07-07 23:59:59", 1, "Card", "30.00", "Shirt", "retail"),
            ("2014-06-07 00:00:00", 1, "Card", "10.00", "Shirt", "retail"),
            ("2014-06-06 12:00:00", 2, "Card", "20.00", "Shirt", "retail"),
            ("2014-07-01 09:00:00", 2, "Comp", "0.00", "Ten", "series"),
            ("2014-05-07 09:00:00", 3, "Card", "50.00", "Ticket", "event"),
            ("2014-07-08 09:00:00", 3, "Card", "-5.00", "Shirt", "retail"),
            ("2014-07-02 09:00:00", 4, "Store Credit", "9.00", "Bar", "food"),
            ("2014-05-10 09:00:00", 4, "Card", "0.00", "Bar", "food"),
        ],
    )


def test_types_only_sold_before_are_left_out(sold):
    got = values(sales.sales_type_change(sold, AS_OF), "typ", "p_cnt", "p_total", "t_cnt", "t_total", "pctchange")
    assert got == [
        ("food", 1, D("0.00"), 1, D("9.00"), None),
        ("retail", 1, D("20.00"), 2, D("40.00"), 100.0),
        ("series", None, None, 1, D("0.00"), None),
    ]


def test_total_row_is_the_sum_of_parts(sold):
    change = sales.sales_type_change(sold, AS_OF)
    total = sales.with_total(change).where("typ = 'TOTAL'").first()
    parts = change.collect()
    for column in ("p_cnt", "p_total", "t_cnt", "t_total"):
        assert total[column] == sum(r[column] or 0 for r in parts)
    assert total.pctchange == 145.0
    # Without any sales there is still a TOTAL row, of NULLs.
    empty = sales.with_total(sales.sales_type_change(sold.where("false"), AS_OF)).collect()
    assert [tuple(r) for r in empty] == [("TOTAL", None, None, None, None, None)]


def test_items_of_both_windows(sold):
    got = values(sales.sales_item_change(sold, AS_OF), "item", "p_cnt", "t_cnt", "pctchange")
    assert got == [
        ("Bar", 1, 1, None), ("Shirt", 1, 2, 100.0), ("Ten", None, 1, None), ("Ticket", 1, None, None)
    ]


def test_active_customers_by_spend(spark, sold):
    people = cust(spark, [(i, None, "2014-01-01") for i in (1, 2, 3, 4)])
    got = sales.customer_sales_active(sold, people, AS_OF, days=6, k=2).collect()
    # Customer 2 has nothing recent; customer 4's latest sale is a day too old with 5 days.
    assert [(r.custid, r.cnt, r.total) for r in got] == [(3, 2, D("45.00")), (1, 2, D("40.00"))]
    assert sales.customer_sales_active(sold, people, AS_OF, days=5, k=None).count() == 2


def test_refunds_comps_and_price_points(spark, sold):
    people = cust(spark, [(i, None, "2014-01-01") for i in (1, 2, 3, 4)])
    assert values(sales.refunds(sold, people, AS_OF), "custid", "total") == [(3, D("-5.00"))]
    assert values(sales.comps(sold, people, AS_OF), "custid", "item", "cnt") == [(2, "Ten", 1)]
    prices = [("Ticket", "50.00"), ("Shirt", "20.00"), ("Shirt", "99.00")]
    assert sales.price_point_sales(sold, people, prices).count() == 2
    assert values(sales.price_point_counts(sold, prices), "item", "price", "cnt") == [
        ("Shirt", D("20.00"), 1), ("Shirt", D("99.00"), 0), ("TOTAL", None, 2), ("Ticket", D("50.00"), 1)
    ]


def test_latest_comp_of_an_item(spark):
    free = sale(spark, [("2014-07-03 09:00:00", 1, "Comp", "0.00", "Ten", "series"),
                        ("2014-07-05 09:00:00", 1, "Comp", "7.00", "Ten", "series")])
    people = cust(spark, [(1, None, "2014-01-01")])
    assert values(sales.comps(free, people, AS_OF), "cnt", "dt", "total") == [
        (2, ts("2014-07-05 09:00:00"), D("7.00"))
    ]


def test_sales_of_unknown_customers_stay_in_the_wide_form(spark, sold):
    people = cust(spark, [(1, None, "2014-01-01")])
    wide = sales.sales_wide(sold, people)
    assert wide.count() == 8 and wide.where("c_id is null").count() == 6
    assert values(sales.sales_by_city(sold, people), "city", "total") == [
        (None, D("74.00")), ("town", D("40.00"))
    ]


def test_revenue_per_ride(spark):
    people = cust(spark, [(1, None, "2014-01-01"), (2, None, "2014-01-01"), (3, None, "2014-01-01")])
    bought = sale(spark, [("2014-01-01 09:00:00", 1, "Card", "90.00", "Ten", "series"),
                          ("2014-01-01 09:00:00", 1, "Card", "5.00", "Bar", "food"),
                          ("2014-01-01 09:00:00", 3, "Card", "50.00", "Ten", "series")])
    rides = running.with_ride_number(
        attend(spark, [(1, 1, "Enrolled", "2014-01-02 06:00:00"), (2, 1, "Enrolled", "2014-01-03 06:00:00"),
                       (3, 3, "Cancelled", "2014-01-03 06:00:00")])
    )
    got = values(sales.avg_cost_per_ride(bought, people, rides), "id", "seriesrevenue", "numrides", "avgcostperride")
    assert got == [(1, D("90.00"), 2, 45.0), (2, None, None, None), (3, D("50.00"), 0, None)]
    top = sales.avg_cost_per_ride(bought, people, rides, k=1).collect()
    assert [r.id for r in top] == [1]


def test_rides_per_month(spark):
    people = cust(spark, [(1, None, "2014-01-01"), (2, None, "2014-01-01")])
    rides = attend(spark, [(1, 1, "Enrolled", "2014-01-01 06:00:00"), (2, 1, "Cancelled", "2014-01-31 06:00:00"),
                           (3, 1, "Enrolled", "2014-03-02 06:00:00")])
    base = sales.rides_and_months(people, rides)
    assert values(base, "id", "numrides", "months") == [(1, 3, 2.0), (2, 0, None)]
    # Two series of one kind count the customer twice, as a row each does.
    held = openseries(spark, [("c1@example.test", "Ten", 10, 1), ("c1@example.test", "Ten", 10, 2),
                              ("c2@example.test", "One", 1, 1)])
    assert sales.rides_per_month(people, rides, held).count() == 3
    got = sales.rides_per_month_by_series(people, rides, held)
    assert values(got, "series", "numrides", "months", "avgridespermonth") == [
        ("One", 0, None, None), ("Ten", 6, 4.0, 1.5)
    ]


def test_open_series_total(spark):
    held = openseries(spark, [("a", "Ten", 10, 4), ("b", "Ten", 10, 0), ("c", "One", 1, 1)])
    got = values(sales.open_series_total(held), "series", "cnt", "totalclasses", "usedclasses", "remainingclasses")
    assert got == [("One", 1, 1, 0, 1), ("TOTAL", 3, 21, 16, 5), ("Ten", 2, 20, 16, 4)]


def test_counts_of_one_item_and_of_a_year(sold):
    assert tuple(sales.item_count_window(sold, "Shirt", AS_OF).first()) == (2, 2)
    got = values(sales.year_sales(sold, 2014), "item", "cnt")
    assert got == [("Bar", 1), ("Shirt", 4), ("Ticket", 1)]
    assert tuple(sales.total_sales(sold, AS_OF, 7).first()) == (3, D("34.00"))
