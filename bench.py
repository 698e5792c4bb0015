"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Each query runs once to
warm up, then BENCH_RUNS (3) times; its time is the median. The whole result is computed
and written to the no-op sink, so nothing but the query is measured.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from studiolens.plans import catalog  # noqa: E402
from studiolens.session import build_session  # noqa: E402

HEADLINE = [
    "sales_type_change_total",
    "sales_item_change",
    "sales_with_customer",
    "customer_sales_alltime_active",
    "sales_by_city_month",
    "instructor_change",
    "slot_change",
    "instructor_weekly",
    "riders_trending_up",
    "riders_lapsed_today",
    "active_customers_change",
    "rides_by_age_bracket",
    "birthday_riders_window",
    "series_revenue_per_customer",
    "running_ride_number",
    "running_studio_number",
    "rider_milestones_next",
    "occupancy_by_month",
    "daily_occupancy_with_subtotals",
    "membership_revenue_forecast",
    "daily_schedule_digest",
    "marker_occupancy",
    "outage_alerts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in HEADLINE:
        build = catalog.queries()[name]
        measured = []
        for run in range(runs + 1):
            begin = time.perf_counter()
            build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if run:
                measured.append(time.perf_counter() - begin)
        times[name] = round(statistics.median(measured), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "studio analytics headline queries, sum of medians",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
