"""The registered queries: every operator over whole role tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from studiolens import schema
from studiolens.functions import clock
from studiolens.functions.ratio import (
    DETAIL_THRESHOLD,
    HIGH_RIDERS,
    LOW_RIDERS,
    TOTALS_THRESHOLD,
    threshold_flag,
)
from studiolens.operators import (
    alerts,
    classes,
    customers,
    membership,
    occupancy,
    retention,
    running,
    sales,
    schedule,
)
from studiolens.plans import load
from studiolens.session import work_dir
from studiolens.sources import exports, roles, tables, versions
from studiolens.streaming import files, outages, rides
from studiolens.streaming import polls as polls_job

Query = Callable[[SparkSession, str], DataFrame]

# Dates and values that give rows on the test tables.
SALES_DAY = "1998-06-15"
LATE_DAY = "2001-07-20"
EVENTS_DAY = "2024-01-22"
MEMBERS_DAY = "2001-07-15"
ITEMS = ["small ring"]
PACKAGES = ["small ring", "old rod", "hot plate"]
PRICES = [("old ring", "34143.45"), ("old anvil", "80815.91")]
LINK = "studio.example/reserve"
SITES = ["site3", "site1"]
BOOKING_NOW = dt.datetime(2024, 1, 15, 10, 30)
STEP, APPROACH = 50, 5

_QUERIES: dict[str, Query] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Money as double, once all sums are done in decimal."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        _QUERIES[name] = lambda spark, sf_dir: _plain(build(spark, sf_dir))
        return build

    return register


def _simple(name: str, build: Callable[..., DataFrame], *role_names: str, **params) -> None:
    """A query that passes role tables, then parameters, to an operator."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(*[getattr(roles, r)(spark, sf_dir) for r in role_names], **params)

    query(name)(run)


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event attendance with both running counts."""
    return running.with_both_numbers(roles.attend_ev(spark, sf_dir))


def ride_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.with_ride_number(roles.attend_ev(spark, sf_dir))


# --- B: projections, filters ----------------------------------------------------------

_simple("customer_age", customers.with_age, "cust", as_of=SALES_DAY)
_simple("customers_by_age_range", customers.age_between, "cust", lo=20, hi=30, as_of=SALES_DAY)
_simple("birthday_this_year", customers.with_birthday, "cust", as_of=SALES_DAY)
_simple("birthday_this_year_wrapped", customers.with_birthday, "cust", as_of=SALES_DAY, wrap=True)
_simple("upcoming_birthdays", customers.upcoming_birthdays, "cust", as_of=SALES_DAY)
_simple("occupancy_pct", occupancy.with_occupancy, "occ")
_simple("new_customers_window", customers.new_customers, "cust", as_of=SALES_DAY)
_simple("new_customers_prev", customers.new_customers, "cust", as_of=SALES_DAY, lo=-62, hi=-32)
_simple("new_customers_of_day", customers.new_customers, "cust", as_of=SALES_DAY, lo=-1, hi=-1)
_simple("refunds_recent", sales.refunds, "sale", "cust", as_of=SALES_DAY)
_simple("refunds_recent_until", sales.refunds, "sale", "cust", as_of=SALES_DAY, until=0)
_simple("price_point_sales", sales.price_point_sales, "sale", "cust", prices=PRICES)
_simple("price_point_counts", sales.price_point_counts, "sale", prices=PRICES)


@query("first_timers")
def _first_timers(spark, sf_dir):
    attend, cust = ride_numbered(spark, sf_dir), roles.cust(spark, sf_dir)
    return retention.first_timers(attend, cust, "2024-01-02")


@query("first_timers_yesterday")
def _first_timers_yesterday(spark, sf_dir):
    attend, cust = ride_numbered(spark, sf_dir), roles.cust(spark, sf_dir)
    return retention.first_timers(attend, cust, "2024-01-02", offset=-1)


@query("threshold_flag")
def _flags(spark, sf_dir):
    change = classes.instr_change(roles.attend_ship(spark, sf_dir), SALES_DAY)
    return change.select(
        "inst",
        threshold_flag("pctchange", -TOTALS_THRESHOLD, TOTALS_THRESHOLD).alias("total_flag"),
        threshold_flag("pctchange", -DETAIL_THRESHOLD, DETAIL_THRESHOLD).alias("detail_flag"),
        threshold_flag("t_ridersperclass", LOW_RIDERS, HIGH_RIDERS).alias("room_flag"),
    )


@query("custom_site_order")
def _site_order(spark, sf_dir):
    ranked = occupancy.site_rank(occupancy.occ_alltime(roles.occ(spark, sf_dir)), SITES)
    return ranked.select("site", "site_rank").orderBy("site_rank", "site")


@query("day_name_label")
def _day_names(spark, sf_dir):
    slots = classes.slot_stats(roles.attend_ship(spark, sf_dir))
    return slots.select("dow", "hhmm", clock.day_name("dow").alias("day_name"))


@query("instructor_name_normalise")
def _names(spark, sf_dir):
    occ = roles.occ(spark, sf_dir)
    return occupancy.normalise_instr(occ, initial="I", exceptions=["I3"])


# --- C: joins, correlated predicates --------------------------------------------------

_simple("sales_with_customer", sales.sales_wide, "sale", "cust")
_simple(
    "birthday_riders_window",
    retention.birthday_riders_window, "cust", "attend_ship", as_of=SALES_DAY,
)
_simple(
    "riding_on_birthday",
    retention.riding_on_birthday, "cust", "attend_ship", as_of=SALES_DAY, days=60,
)
_simple(
    "nearest_class_to_birthday",
    retention.nearest_birthday_class, "cust", "attend_ship", as_of=SALES_DAY, days=60,
)
_simple("event_ticket_customers", retention.buyers_of, "sale", "cust", items=ITEMS)
_simple(
    "stalled_new_customers",
    retention.stalled, "cust", "attend_ev", "sale", items=ITEMS, as_of=SALES_DAY,
)
_simple(
    "never_enrolled_since",
    retention.never_enrolled_since, "cust", "attend_ev", "sale", items=ITEMS, since="1998-03-01",
)
_simple("never_attended", retention.never_attended, "cust", "attend_ev", as_of=SALES_DAY)


@query("never_enrolled_count")
def _never_count(spark, sf_dir):
    cust, attend = roles.cust(spark, sf_dir), roles.attend_ev(spark, sf_dir)
    since = clock.shift(SALES_DAY, -360)
    sale = roles.sale(spark, sf_dir)
    return retention.never_enrolled_since(cust, attend, sale, ITEMS, since).agg(
        F.count(F.lit(1)).alias("cnt")
    )


_simple("bought_series_none_open", retention.winback_series, "sale", "cust", "openseries", items=PACKAGES)
_simple(
    "lapsed_between",
    retention.lapsed_between, "cust", "attend_ship",
    start="1998-01-01", end="1998-02-28", after="2001-03-01",
)
_simple(
    "lapsed_between_once",
    retention.lapsed_between, "cust", "attend_ship",
    start="1998-01-01", end="1998-02-28", after="2001-03-01", n=1, cmp="=",
)
_simple(
    "lapsed_between_no_open",
    retention.lapsed_no_open, "cust", "attend_ship", "openseries",
    start="1998-01-01", end="1998-02-28", after="2001-03-01",
)


@query("rode_never_paid")
def _never_paid(spark, sf_dir):
    # Every test customer has bought something, but not at each studio.
    cust, attend = roles.cust(spark, sf_dir), roles.attend_ship(spark, sf_dir)
    paid = roles.sale(spark, sf_dir).where(F.col("studio") == "P")
    return retention.rode_never_paid(cust, attend, paid, LATE_DAY)


_simple("last_attendance", retention.last_attend, "cust", "attend_ship")
_simple("last_sale_or_class", retention.last_touch, "cust", "sale", "attend_ship")
_simple(
    "touched_last_window",
    retention.touched_in_window, "cust", "sale", "attend_ship", as_of=LATE_DAY,
)
_simple(
    "touched_prev_window",
    retention.touched_in_window, "cust", "sale", "attend_ship", as_of=LATE_DAY, window="prev",
)


@query("series_revenue_per_customer")
def _series_revenue(spark, sf_dir):
    sale, cust = roles.sale(spark, sf_dir), roles.cust(spark, sf_dir)
    return sales.series_revenue(sale, cust, ride_numbered(spark, sf_dir))


@query("avg_cost_per_ride")
def _cost_per_ride(spark, sf_dir):
    sale, cust = roles.sale(spark, sf_dir), roles.cust(spark, sf_dir)
    return sales.avg_cost_per_ride(sale, cust, ride_numbered(spark, sf_dir))


@query("avg_cost_per_ride_top")
def _cost_per_ride_top(spark, sf_dir):
    sale, cust = roles.sale(spark, sf_dir), roles.cust(spark, sf_dir)
    return sales.avg_cost_per_ride(sale, cust, ride_numbered(spark, sf_dir), k=20)


@query("rides_and_months")
def _rides_and_months(spark, sf_dir):
    cust, attend = roles.cust(spark, sf_dir), roles.attend_ship(spark, sf_dir)
    return sales.rides_and_months(cust, attend).drop("span_us")


_simple("rides_per_month", sales.rides_per_month, "cust", "attend_ship", "openseries")
_simple(
    "rides_per_month_by_series",
    sales.rides_per_month_by_series, "cust", "attend_ship", "openseries",
)
_simple("future_bookings", retention.future_bookings, "attend_ship", "cust", as_of=SALES_DAY)

# --- D: aggregations ------------------------------------------------------------------

_simple("attendance_by_month", classes.attend_by_month, "attend_ship")
_simple("attendance_by_month_named", classes.attend_by_month, "attend_ev")
_simple(
    "rides_in_window",
    retention.rides_in_window, "attend_ship", "cust", start="1997-01-20", end="1998-06-16",
)
_simple("rides_in_window_last30", retention.rides_recent, "attend_ship", "cust", as_of=SALES_DAY)
_simple(
    "rides_in_window_last31",
    retention.rides_recent, "attend_ship", "cust", as_of=SALES_DAY,
    window=retention.RIDES_LAST_31,
)
_simple(
    "rides_in_window_prev30",
    retention.rides_recent, "attend_ship", "cust", as_of=SALES_DAY,
    window=retention.RIDES_PREV_30,
)
_simple("multi_bookings_per_day", retention.doubles, "attend_ev", as_of=EVENTS_DAY)
_simple("class_roster_size", classes.classes, "attend_ship")
_simple("riders_per_class", classes.class_stats, "attend_ship")
_simple("instructor_weekly", classes.instr_weekly, "attend_ship")
_simple("instructor_monthly", classes.instr_monthly, "attend_ship")
_simple("slot_stats", classes.slot_stats, "attend_ship")
_simple("slot_stats_by_instructor", classes.slot_stats, "attend_ship", by_inst=True)
_simple("slot_stats_last30", classes.slot_stats, "attend_ship", as_of=SALES_DAY, lo=-31, hi=-1)
_simple("slot_stats_prev30", classes.slot_stats, "attend_ship", as_of=SALES_DAY, lo=-62, hi=-32)
for _name, (_lo, _hi) in {
    "last7": classes.LAST_7,
    "prev7": classes.PREV_7,
    "last30": classes.LAST_30,
    "prev30": classes.PREV_30,
}.items():
    _simple(
        f"instructor_window_stats_{_name}",
        classes.instr_window, "attend_ship", as_of=SALES_DAY, lo=_lo, hi=_hi,
    )
_simple("instructor_alltime", classes.instr_alltime, "attend_ship")
_simple(
    "customer_sales_alltime_active", sales.customer_sales_active, "sale", "cust", as_of=LATE_DAY
)
_simple("customer_sales_recent", sales.customer_sales_recent, "sale", "cust", as_of=LATE_DAY, n=30)
_simple("customer_sales_recent7", sales.customer_sales_recent, "sale", "cust", as_of=LATE_DAY, n=7)
_simple("item_sales", sales.item_sales, "sale")
_simple("item_sales_recent", sales.item_sales, "sale", as_of=LATE_DAY, n=30)
_simple("item_sales_recent7", sales.item_sales, "sale", as_of=LATE_DAY, n=7)
_simple("total_sales", sales.total_sales, "sale", as_of=LATE_DAY, n=30)
_simple("total_sales7", sales.total_sales, "sale", as_of=LATE_DAY, n=7)
_simple("comps_recent", sales.comps, "sale", "cust", as_of=SALES_DAY)
_simple("comps_recent_until", sales.comps, "sale", "cust", as_of=SALES_DAY, until=0)
_simple("sales_by_type_alltime", sales.sales_by, "sale", dim="typ")
for _dim in ("typ", "item"):
    for _name, (_lo, _hi) in {
        "last30": sales.LAST_30,
        "prev30": sales.PREV_30,
        "last7": sales.LAST_7,
        "prev7": sales.PREV_7,
    }.items():
        _simple(
            f"sales_by_dim_window_{_dim}_{_name}",
            sales.sales_window, "sale", dim=_dim, as_of=SALES_DAY, lo=_lo, hi=_hi,
        )
_simple("year_sales_by_item", sales.year_sales, "sale", year=1998)
_simple("item_sales_alltime_any", sales.sales_by_item, "sale")
_simple("sales_by_city", sales.sales_by_city, "sale", "cust")
_simple("sales_by_city_month", sales.sales_by_city, "sale", "cust", by_month=True)
_simple(
    "sales_by_city_month_selected",
    sales.sales_by_city, "sale", "cust", by_month=True, cities=["NATION_5", "Nation_7"],
)
_simple("sales_by_date", sales.sales_by_date, "sale")
_simple("open_series_summary", sales.open_series, "openseries")
_simple("customers_by_age", customers.customers_by_age, "cust", as_of=SALES_DAY)
_simple("customers_by_age_bracket", customers.customers_by_age_bracket, "cust", as_of=SALES_DAY)
_simple(
    "customers_by_age_bracket_wide",
    customers.customers_by_age_bracket_wide, "cust", as_of=SALES_DAY,
)
_simple("rides_by_age", customers.rides_by_age, "attend_ship", "cust", as_of=SALES_DAY)
_simple(
    "rides_by_age_bracket", customers.rides_by_age_bracket, "attend_ship", "cust", as_of=SALES_DAY
)
_simple("monthly_pass_count", sales.item_count_window, "sale", item="small ring", as_of=LATE_DAY)
_simple(
    "frequent_riders_window",
    classes.frequent_riders, "attend_ev", first="2024-01-01", last="2024-01-22", n=5,
)
_simple("occupancy_by_day", occupancy.occ_by_day, "occ")
_simple("occupancy_alltime", occupancy.occ_alltime, "occ")
_simple("occupancy_by_month", occupancy.occ_by_month, "occ", as_of=SALES_DAY)
_simple("occupancy_by_month_instr", occupancy.occ_by_month_instr, "occ")
_simple("occupancy_by_instr", occupancy.occ_by_instr, "occ")
_simple("occupancy_window_totals", occupancy.occ_window, "occ", as_of=SALES_DAY)
_simple("occupancy_window_totals60", occupancy.occ_window, "occ", as_of=SALES_DAY, n=60)

# --- E: period over period, totals ----------------------------------------------------

_simple("active_customers_change", retention.active_change, "attend_ship", as_of=SALES_DAY)
_simple("new_customers_change", customers.new_customer_change, "cust", as_of=SALES_DAY)
for _days in (30, 7):
    _simple(f"sales_type_change{_days}", sales.sales_type_change, "sale", as_of=SALES_DAY, days=_days)


def _type_change_total(days: int) -> Query:
    def run(spark, sf_dir):
        sale = roles.sale(spark, sf_dir)
        return sales.with_total(sales.sales_type_change(sale, SALES_DAY, days))

    return run


query("sales_type_change_total")(_type_change_total(30))
query("sales_type_change_total7")(_type_change_total(7))
_simple("sales_item_change", sales.sales_item_change, "sale", as_of=SALES_DAY)
_simple("slot_change", classes.slot_change, "attend_ship", as_of=SALES_DAY)
_simple("instructor_change", classes.instr_change, "attend_ship", as_of=SALES_DAY)
_simple("riders_trending_up", retention.trending_up, "attend_ship", "cust", as_of=SALES_DAY)
_simple("riders_trending_down", retention.trending_down, "attend_ship", "cust", as_of=SALES_DAY)
_simple("riders_lapsed", retention.lapsed, "attend_ship", "cust", as_of=SALES_DAY)
_simple("riders_lapsed_today", retention.lapsed_today, "attend_ship", "cust", as_of=SALES_DAY)
_simple("open_series_with_total", sales.open_series_total, "openseries")
_simple(
    "daily_occupancy_with_subtotals",
    occupancy.occ_daily_report, "occ", day=SALES_DAY, order=SITES,
)
_simple("recent_month_history", occupancy.occ_history, "occ", as_of=SALES_DAY)
_simple("recent_month_history_instr", occupancy.occ_history_instr, "occ", as_of=SALES_DAY)
_simple("top_recent_riders", retention.top_recent, "attend_ship", "cust", as_of=SALES_DAY)

# --- F: running state -----------------------------------------------------------------


@query("running_ride_number")
def _ride_number(spark, sf_dir):
    out = ride_numbered(spark, sf_dir)
    return out.select("id", "custid", "status", "classdate", "datein", "num")


@query("running_ride_number_continued")
def _ride_number_continued(spark, sf_dir):
    """Two loads, the second going on from the counts of the first, as one table."""
    attend = roles.attend_ev(spark, sf_dir)
    first = running.with_ride_number(attend.where(clock.half_open("classdate", None, EVENTS_DAY)))
    second = running.with_ride_number(
        attend.where(clock.half_open("classdate", EVENTS_DAY, None)), stored=first
    )
    return first.unionByName(second).select("id", "custid", "num")


@query("running_studio_number")
def _studio_number(spark, sf_dir):
    return running.with_studio_number(roles.attend_ev(spark, sf_dir)).select(
        "id", "custid", "status", "classdate", "datein", "totnum"
    )


@query("rider_milestones_next")
def _milestones(spark, sf_dir):
    attend, cust = ride_numbered(spark, sf_dir), roles.cust(spark, sf_dir)
    return running.milestones_next(attend, cust, EVENTS_DAY, step=STEP, approach=APPROACH)


@query("studio_milestones_next")
def _studio_milestones(spark, sf_dir):
    attend, cust = numbered(spark, sf_dir), roles.cust(spark, sf_dir)
    return running.studio_milestones_next(attend, cust, EVENTS_DAY, party=1000)


_simple("milestone_riders_count", running.milestone_riders, "attend_ev", "cust", as_of="2024-01-14", step=25)
_simple(
    "milestone_riders_near",
    running.near_milestone_riders, "attend_ev", "cust", as_of=EVENTS_DAY, step=50,
)
_simple("rides_by_name", running.rides_by_name, "attend_ev")
_simple("ride_number_on_read", running.ride_number_on_read, "attend_ev", as_of=EVENTS_DAY)


@query("ride_number_last_or_upcoming")
def _last_or_upcoming(spark, sf_dir):
    return running.last_known_or_upcoming(ride_numbered(spark, sf_dir), EVENTS_DAY, lo=45, hi=50)


_simple("membership_tenure", membership.tenure, "memberships", as_of=MEMBERS_DAY)
_simple("membership_tenure_averages", membership.average_tenure, "memberships", as_of=MEMBERS_DAY)
_simple("membership_revenue_forecast", membership.forecast, "memberships", as_of=MEMBERS_DAY)
_simple("membership_forecast_totals", membership.forecast_totals, "memberships", as_of=MEMBERS_DAY)

# --- G: text, schedules, alerts -------------------------------------------------------

_simple(
    "marker_occupancy",
    occupancy.marker_occupancy, "pages", taken="<LI>", full="href=\"/The\"", capacity=40,
)


@query("marker_occupancy_by_site")
def _markers_by_site(spark, sf_dir):
    site = F.concat(F.lit("site"), (F.col("page_id") % 5).cast("string"))
    pages = roles.table(spark, sf_dir, "pages").withColumn("site", site)
    return occupancy.marker_occupancy(pages, "<LI>", "href=\"/The\"", roles.capacity(spark))


_simple("spot_occupancy", occupancy.spot_occupancy, "pages", enrolled="<li>", seat="<(li|p)>")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occupancy as observed by a poll: some classes are sold out and show no seats."""
    soldout = F.col("unavail") == F.col("total") - 2
    return roles.occ(spark, sf_dir).select(
        "dt", "site", "instr", soldout.alias("soldout"),
        F.when(soldout, 0).otherwise(F.col("unavail")).cast("bigint").alias("unavail"),
        F.when(soldout, 0).otherwise(F.col("total")).cast("bigint").alias("total"),
    )


@query("occupancy_snapshot_filter")
def _snapshot(spark, sf_dir):
    return occupancy.occ_snapshot(
        observations(spark, sf_dir), roles.capacity(spark), SALES_DAY
    )


def schedule_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attended classes as the texts a schedule page shows."""
    return roles.attend_ev(spark, sf_dir).select(
        "id",
        F.concat(F.date_format("classdate", "hh:mm a"), F.lit("60min")).alias("time_text"),
        F.month("classdate").alias("month"),
        F.dayofmonth("classdate").alias("day"),
    )


@query("schedule_time_parse")
def _time_parse(spark, sf_dir):
    return schedule.parse_class_time(schedule_texts(spark, sf_dir), "2023-01-15")


@query("schedule_time_parse_day_only")
def _time_parse_day(spark, sf_dir):
    texts = schedule_texts(spark, sf_dir).drop("month")
    return schedule.parse_class_time(texts, "2023-11-15", month=None)


def schedule_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.attend_ev(spark, sf_dir).select(
        F.to_date("classdate").alias("day"),
        F.concat_ws(
            " - ", F.date_format("classdate", "h:mm a"), F.col("inst"), F.col("classtype")
        ).alias("line"),
    )


@query("schedule_bookable_soon")
def _bookable(spark, sf_dir):
    rows = roles.attend_ev(spark, sf_dir).select("id", "classdate")
    return schedule.bookable_soon(rows, BOOKING_NOW)


@query("schedule_line_split")
def _line_split(spark, sf_dir):
    return schedule.split_schedule(schedule_lines(spark, sf_dir))


@query("daily_schedule_digest")
def _digest(spark, sf_dir):
    rows = roles.attend_ship(spark, sf_dir).select(
        "classdate", F.col("inst").alias("instructor"), "classtype"
    )
    return schedule.schedule_digest(rows, LINK, default_type="n")


_simple("outage_alerts", alerts.outage_alerts, "probes")


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event seen as one poll of a class."""
    return polls_from(roles.attend_ev(spark, sf_dir))


def polls_from(attend: DataFrame) -> DataFrame:
    return attend.select(
        F.col("classdate").alias("dt"),
        F.concat(F.lit("site"), (F.col("custid") % 5).cast("string")).alias("site"),
        F.col("inst").alias("instr"),
        (F.col("custid") % 7).alias("unavail"),
        F.lit(10).cast("bigint").alias("total"),
        F.col("datein").alias("poll_ts"),
    )


@query("occupancy_latest_batch")
def _latest(spark, sf_dir):
    return occupancy.occ_latest(polls(spark, sf_dir))


# --- A: sources and loads -------------------------------------------------------------

_simple("file_time_bounds", tables.time_bounds, "sale", column="dt")
_simple("rolling_extract_window", exports.extract_window, "sale", ts="dt", as_of=SALES_DAY)
_simple(
    "rolling_extract_window_attendance",
    exports.extract_window, "attend_ship", ts="classdate", as_of=SALES_DAY,
    **exports.ATTENDANCE_EXTRACT,
)


def _round_trip(df: DataFrame, table: T.StructType, name: str) -> DataFrame:
    """Write rows as an export and read them back through the strict reader."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    exports.write_export(df, path, table)
    return exports.read_export(spark, path, table)


@query("csv_source_strict")
def _csv(spark, sf_dir):
    return _round_trip(roles.sale(spark, sf_dir), schema.SALES, "sales-export")


@query("full_refresh_load")
def _full_refresh(spark, sf_dir):
    """A table loaded twice holds the rows of the second load."""
    path = work_dir(spark, "openseries")
    series = roles.openseries(spark, sf_dir)
    versions.full_refresh(series.where(F.col("remaining") > 5), path)
    versions.full_refresh(series, path)
    return versions.current(spark, path)


@query("full_refresh_refused")
def _refused(spark, sf_dir):
    """A table whose second load has a bad row holds the rows of the first."""
    path = work_dir(spark, "openseries")
    series = roles.openseries(spark, sf_dir)
    versions.full_refresh(series.where(F.col("remaining") > 5), path)
    bad = F.raise_error(F.lit("bad row")).cast("string")
    broken = F.when(F.col("remaining") == 5, bad).otherwise(F.col("series"))
    try:
        versions.full_refresh(series.withColumn("series", broken), path)
    except PySparkException:
        return versions.current(spark, path)
    raise AssertionError("the bad row was loaded")


def reloaded_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days of one extract again, refunds taken out and totals doubled."""
    week = exports.extract_window(roles.sale(spark, sf_dir), "dt", SALES_DAY)
    return week.where(F.col("total") > 0).withColumn(
        "total", (F.col("total") * 2).cast("decimal(18,2)")
    )


@query("range_replace_load")
def _range_replace(spark, sf_dir):
    path = work_dir(spark, "sale")
    tables.replace_range_at(spark, path, roles.sale(spark, sf_dir), "dt", grain="month")
    tables.replace_range_at(spark, path, reloaded_sales(spark, sf_dir), "dt", grain="month")
    return tables.read_table(spark, path)


def untimed(df: DataFrame, key: str, ts: str) -> DataFrame:
    """A tenth of the rows without their time."""
    return df.withColumn(ts, F.when(F.col(key) % 10 != 0, F.col(ts)))


@query("range_replace_untimed")
def _range_untimed(spark, sf_dir):
    path = work_dir(spark, "sale")
    for batch in (roles.sale(spark, sf_dir), reloaded_sales(spark, sf_dir)):
        tables.replace_range_at(spark, path, untimed(batch, "custid", "dt"), "dt", grain="month")
    return tables.read_table(spark, path)


@query("key_upsert_untimed")
def _upsert_untimed(spark, sf_dir):
    path = work_dir(spark, "attend")
    for batch in (roles.attend_ev(spark, sf_dir), changed_attendance(spark, sf_dir)):
        tables.upsert_at(spark, path, untimed(batch, "id", "classdate"), ["id"], "classdate")
    return tables.read_table(spark, path)


@query("range_replace_frames")
def _range_replace_frames(spark, sf_dir):
    return tables.replace_range(
        roles.sale(spark, sf_dir), reloaded_sales(spark, sf_dir), "dt"
    )


def changed_attendance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one extract again: all cancelled, classes of one instructor a day later."""
    window = exports.extract_window(
        roles.attend_ev(spark, sf_dir), "classdate", EVENTS_DAY, **exports.ATTENDANCE_EXTRACT
    )
    later = F.col("classdate") + F.make_dt_interval(F.lit(1))
    return window.withColumn("status", F.lit("Cancelled")).withColumn(
        "classdate", F.when(F.col("inst") == "I1", later).otherwise(F.col("classdate"))
    )


@query("key_upsert_load")
def _key_upsert(spark, sf_dir):
    path = work_dir(spark, "attend")
    attend, changed = roles.attend_ev(spark, sf_dir), changed_attendance(spark, sf_dir)
    tables.upsert_at(spark, path, attend, ["id"], "classdate")
    tables.upsert_at(spark, path, changed, ["id"], "classdate")
    return tables.read_table(spark, path)


@query("key_upsert_frames")
def _key_upsert_frames(spark, sf_dir):
    return tables.upsert(roles.attend_ev(spark, sf_dir), changed_attendance(spark, sf_dir), ["id"])


def loaded_sites(spark: SparkSession, sf_dir: str, nights: list[tuple[Column, Column]]) -> str:
    """Two sites, each with four exports a night, loaded into one store; ``nights`` are the sales
    and the attendance that each night brings."""
    store = work_dir(spark, "store")
    home = F.col("custid") % 2
    for sold, attended in nights:
        parts = {
            "series": (roles.openseries(spark, sf_dir), F.length("emailaddress") % 2, schema.OPEN_SERIES),
            "customers": (roles.cust(spark, sf_dir), F.col("id") % 2, schema.CUSTOMERS),
            "sales": (roles.sale(spark, sf_dir).where(sold), home, schema.SALES),
            "attendance": (roles.attend_ev(spark, sf_dir).where(attended), home, schema.ATTENDANCE),
        }
        places = {}
        for name, (rows, at, table) in parts.items():
            header = schema.ATTENDANCE_HEADER if name == "attendance" else None
            folder = work_dir(spark, name)
            places[name] = exports.write_site_exports(rows, at, [0, 1], folder, table, header)
        for site in (0, 1):
            paths = {name: at[site] for name, at in places.items()}
            load.ingest(spark, f"site{site}", load.SiteFiles(**paths), store, grain="month")
    return store


@query("per_site_load_rows")
def _per_site_rows(spark, sf_dir):
    """Two nights at two sites: every attendance with its counts, the second night's going on."""
    nights = [
        (clock.half_open("dt", *sold), clock.half_open("classdate", *attended))
        for sold, attended in (((None, SALES_DAY), (None, EVENTS_DAY)), ((SALES_DAY, None), (EVENTS_DAY, None)))
    ]
    store = loaded_sites(spark, sf_dir, nights)
    return spark.read.parquet(f"{store}/attend").select("site", "id", "custid", "num", "totnum")


@query("per_site_load")
def _per_site(spark, sf_dir):
    """One night at two sites; rows per table and site."""
    store = loaded_sites(spark, sf_dir, [(F.lit(True), F.lit(True))])

    def counted(table: str, amount: Column) -> DataFrame:
        refreshed = versions.current_sites(spark, f"{store}/{table}")
        return (
            (spark.read.parquet(f"{store}/{table}") if refreshed is None else refreshed)
            .groupBy("site")
            .agg(F.count(F.lit(1)).alias("cnt"), F.sum(amount).cast("double").alias("amount"))
            .select(F.lit(table).alias("table_name"), "site", "cnt", "amount")
        )

    return (
        counted("openseries", F.col("remaining"))
        .unionByName(counted("cust", F.col("id")))
        .unionByName(counted("sale", F.col("total")))
        .unionByName(counted("attend", F.col("num") + F.col("totnum")))
    )


@query("email_list_sink")
def _email_list(spark, sf_dir):
    path = work_dir(spark, "emails")
    people = customers.age_between(roles.cust(spark, sf_dir), 20, 30, SALES_DAY)
    exports.write_lines(people, path)
    return spark.read.text(path).withColumnRenamed("value", "emailaddress")


# --- G: streams, run over the whole table until nothing is left ------------------------


# Events before each of these days, and those after the last, arrive in a batch of their own.
ARRIVALS = ("2024-01-08", "2024-01-16", "2024-01-24")


def in_batches(
    spark: SparkSession, sf_dir: str, start: Callable[[DataFrame], StreamingQuery]
) -> None:
    """Runs a job again and again over a folder to which events are added in time order."""
    path = work_dir(spark, "events")
    events = roles.table(spark, sf_dir, "events")
    for first, end in zip((None, *ARRIVALS), (*ARRIVALS, None), strict=True):
        events.where(clock.half_open("ts", first, end)).write.mode("append").parquet(path)
        start(files.parquet_stream(spark, path, roles.SCHEMAS["events"])).awaitTermination()


@query("running_ride_number_stream")
def _ride_stream(spark, sf_dir):
    home = work_dir(spark, "rides")

    def start(events: DataFrame) -> StreamingQuery:
        attend = roles.attend_from(events)
        return rides.stream_ride_number(attend, f"{home}/out", f"{home}/late", f"{home}/checkpoint")

    in_batches(spark, sf_dir, start)
    return spark.read.parquet(f"{home}/out").select("id", "custid", "num", "late")


@query("occupancy_latest_stream")
def _latest_stream(spark, sf_dir):
    home = work_dir(spark, "polls")

    def start(events: DataFrame) -> StreamingQuery:
        seen = polls_from(roles.attend_from(events))
        return polls_job.keep_latest(seen, f"{home}/occ", f"{home}/checkpoint")

    in_batches(spark, sf_dir, start)
    return tables.read_table(spark, f"{home}/occ")


@query("outage_alerts_stream")
def _outage_stream(spark, sf_dir):
    home = work_dir(spark, "outages")

    def start(events: DataFrame) -> StreamingQuery:
        return outages.stream_outage_alerts(
            roles.probes_from(events), f"{home}/out", f"{home}/late", f"{home}/checkpoint"
        )

    in_batches(spark, sf_dir, start)
    return outages.alerts_of(spark.read.parquet(f"{home}/out"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)

