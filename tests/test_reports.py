"""The reports as a whole, and the shape of the plans behind them."""

import re

import pytest

from studiolens.operators import classes, occupancy, retention, running, sales
from studiolens.plans import catalog, reports
from studiolens.session import work_dir
from studiolens.sources import roles

SF_DIR = "/root/testdata/sf0.001"


def test_reports_have_all_their_sections(spark):
    cust, sale = roles.cust(spark, SF_DIR), roles.sale(spark, SF_DIR)
    attend = catalog.numbered(spark, SF_DIR)
    riders = reports.rider_report(attend, cust, sale, catalog.EVENTS_DAY, ["small ring"])
    assert len(riders) == 11
    management = reports.management_report(
        roles.attend_ship(spark, SF_DIR), cust, sale, roles.openseries(spark, SF_DIR),
        catalog.SALES_DAY, k=20,
    )
    assert len(management) == 9
    seats = reports.occupancy_report(roles.occ(spark, SF_DIR), catalog.SALES_DAY, ["site3"])
    assert list(seats) == ["today", "tomorrow", "by_site", "by_instructor"]
    for section in ("first_ride_today", "several_bookings", "stalled"):
        riders[section].collect()
    for section in ("active_customers", "sales_30", "instructors", "time_slots"):
        rows = management[section].collect()
        assert rows and all(r.flag in (None, "up", "down", "flat") for r in rows)
    months = [r.yymm for r in seats["by_site"].collect()]
    assert months == sorted(months)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["sales_type_change_total", "refunds_recent", "total_sales", "year_sales_by_item",
     "customer_sales_recent", "comps_recent_until"],
)
def test_sales_windows_reach_the_scan(spark, name):
    plan = _plan(catalog.queries()[name](spark, SF_DIR))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", plan)


def test_class_windows_reach_the_scan_of_a_stored_table(spark):
    path = work_dir(spark, "attend")
    catalog.numbered(spark, SF_DIR).write.parquet(path)
    attend, cust = spark.read.parquet(path), roles.cust(spark, SF_DIR)
    day = catalog.EVENTS_DAY
    for df in [
        retention.rides_recent(attend, cust, day),
        retention.trending_up(attend, cust, day),
        retention.active_change(attend, day),
        retention.doubles(attend, day),
        retention.first_timers(attend, cust, day),
        retention.birthday_riders_window(cust, attend, day),
        classes.slot_change(attend, day),
        classes.instr_window(attend, day, -31, -1),
        running.milestones_next(attend, cust, day),
        running.studio_milestones_next(attend, cust, day),
    ]:
        assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(classdate", _plan(df))


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_join_without_a_key(spark, name):
    if name.endswith(("_load", "_stream", "_sink", "_strict", "_frames")):
        return  # these run jobs of their own
    plan = _plan(catalog.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_ride_counts_of_all_windows_read_attendance_once(spark):
    cust, attend = roles.cust(spark, SF_DIR), roles.attend_ship(spark, SF_DIR)
    plan = _plan(retention.trending_up(attend, cust, catalog.SALES_DAY))
    assert plan.count("lineitem.parquet") == 1


def test_both_sales_windows_read_sales_once(spark):
    plan = _plan(sales.sales_item_change(roles.sale(spark, SF_DIR), catalog.SALES_DAY))
    assert plan.count("lineitem.parquet") == 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_studio_count_orders_days_only_in_one_task(spark):
    plan = _plan(running.with_studio_number(roles.attend_ev(spark, SF_DIR)))
    single = plan.split("Exchange SinglePartition")[1:]
    # Below each single partition there are the totals per day.
    assert single and all(
        re.match(r"[^\n]*\n[^\n]*HashAggregate\(keys=\[__date", below) for below in single
    )


def test_capacity_is_broadcast_by_its_size(spark):
    obs = catalog.observations(spark, SF_DIR)
    plan = _plan(occupancy.occ_snapshot(obs, roles.capacity(spark), catalog.SALES_DAY))
    assert "BroadcastHashJoin" in plan
