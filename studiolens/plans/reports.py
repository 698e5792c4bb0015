"""The mailed reports as named tables; the caller decides where they go."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from studiolens.functions import clock
from studiolens.functions.ratio import (
    DETAIL_THRESHOLD,
    HIGH_RIDERS,
    LOW_RIDERS,
    TOTALS_THRESHOLD,
    threshold_flag,
)
from studiolens.operators import classes, customers, occupancy, retention, running, sales


def _flagged(df: DataFrame, threshold: float) -> DataFrame:
    return df.withColumn("flag", threshold_flag("pctchange", -threshold, threshold))


def _room_flags(df: DataFrame) -> DataFrame:
    for prefix in ("p", "t"):
        flag = threshold_flag(f"{prefix}_ridersperclass", LOW_RIDERS, HIGH_RIDERS)
        df = df.withColumn(f"{prefix}_flag", flag)
    return _flagged(df, DETAIL_THRESHOLD)


def rider_report(
    attend: DataFrame,
    cust: DataFrame,
    sale: DataFrame,
    as_of: str | dt.date,
    ticket_items: list[str],
    k: int = 20,
) -> dict[str, DataFrame]:
    """The daily report on riders. ``attend`` carries both running counts."""
    return {
        "first_ride_today": retention.first_timers(attend, cust, as_of),
        "first_ride_yesterday": retention.first_timers(attend, cust, as_of, -1),
        "birthdays": retention.nearest_birthday_class(cust, attend, as_of),
        "studio_milestones": running.studio_milestones_next(attend, cust, as_of),
        "rider_milestones": running.milestones_next(attend, cust, as_of),
        "several_bookings": retention.doubles(attend, as_of).orderBy("firstclass"),
        "top_riders": retention.top_recent(attend, cust, as_of, k),
        "trending_up": retention.trending_up(attend, cust, as_of, k),
        "trending_down": retention.trending_down(attend, cust, as_of, k),
        "lapsed_today": retention.lapsed_today(attend, cust, as_of),
        "stalled": retention.stalled(cust, attend, sale, ticket_items, as_of),
    }


def management_report(
    attend: DataFrame,
    cust: DataFrame,
    sale: DataFrame,
    openseries: DataFrame,
    as_of: str | dt.date,
    k: int | None = None,
) -> dict[str, DataFrame]:
    """The weekly report on sales and classes; ``k`` adds the top customers by spend."""
    report = {
        "active_customers": _flagged(retention.active_change(attend, as_of), TOTALS_THRESHOLD),
        "new_customers": _flagged(customers.new_customer_change(cust, as_of), TOTALS_THRESHOLD),
        "sales_30": _flagged(
            sales.with_total(sales.sales_type_change(sale, as_of, 30)), TOTALS_THRESHOLD
        ),
        "sales_7": _flagged(
            sales.with_total(sales.sales_type_change(sale, as_of, 7)), TOTALS_THRESHOLD
        ),
        "sales_items": _flagged(sales.sales_item_change(sale, as_of), DETAIL_THRESHOLD),
        "open_series": sales.open_series_total(openseries),
        "instructors": _room_flags(classes.instr_change(attend, as_of)),
        "time_slots": _room_flags(classes.slot_change(attend, as_of)).withColumn(
            "day_name", clock.day_name("dow")
        ),
    }
    if k:
        report["top_customers"] = sales.customer_sales_active(sale, cust, as_of, k=k)
    return report


def occupancy_report(
    occ: DataFrame, as_of: str | dt.date, site_order: list[str]
) -> dict[str, DataFrame]:
    """Classes of today and tomorrow, and the history by site and by instructor."""

    def ordered(df: DataFrame, *columns: str) -> DataFrame:
        if "site_rank" not in df.columns:
            df = occupancy.site_rank(df, site_order)
        return df.orderBy(*columns).drop("site_rank")

    by_day = ("site_rank", "site", "is_summary", "dt")
    by_month = ("yymm", "site_rank", "site")
    return {
        "today": ordered(occupancy.occ_daily_report(occ, as_of, site_order), *by_day),
        "tomorrow": ordered(
            occupancy.occ_daily_report(occ, clock.shift(as_of, 1), site_order), *by_day
        ),
        "by_site": ordered(occupancy.occ_history(occ, as_of), *by_month),
        "by_instructor": ordered(
            occupancy.occ_history_instr(occ, as_of), *by_month, "instrex"
        ),
    }
