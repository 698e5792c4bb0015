"""Sales: period reports, comps, refunds, revenue per ride, open series."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studiolens.functions import clock
from studiolens.functions.keys import with_contacts
from studiolens.functions.ratio import pct_change, safe_ratio

# Payment types left out of revenue, the type of class packages, and the
# offsets in days of the compared windows, both ends included.
COMP = "Comp"
STORE_CREDIT = "Store Credit"
SERIES_TYPE = "series"
LAST_30, PREV_30 = (-31, -1), (-62, -32)
LAST_7, PREV_7 = (-8, -1), (-16, -9)

PERIODS = {30: (LAST_30, PREV_30), 7: (LAST_7, PREV_7)}


def _paid() -> Column:
    return F.col("pmtype") != COMP


def _totals() -> list[Column]:
    return [F.count(F.lit(1)).alias("cnt"), F.sum("total").alias("total")]


# --- joined forms ---------------------------------------------------------------------


def sales_wide(sale: DataFrame, cust: DataFrame) -> DataFrame:
    """Every sale with its customer, if known; customer columns carry ``c_``."""
    renamed = cust.select(*[F.col(c).alias(f"c_{c}") for c in cust.columns])
    return sale.join(renamed, F.col("custid") == F.col("c_id"), "left")


def refunds(
    sale: DataFrame,
    cust: DataFrame,
    as_of: str | dt.date,
    n: int = 7,
    until: int | None = None,
) -> DataFrame:
    """Negative sales since ``as_of-n``, with contact columns."""
    recent = sale.where((F.col("total") < 0) & clock.whole_days("dt", as_of, -n, until))
    return with_contacts(recent.select("dt", "custid", "item", "pmtype", "total"), cust)


def _price_match(prices: list[tuple[str, str | Decimal]]) -> Column:
    test = F.lit(False)
    for item, price in prices:
        test = test | ((F.col("item") == item) & (F.col("total") == F.lit(Decimal(str(price)))))
    return test


def price_point_sales(
    sale: DataFrame, cust: DataFrame, prices: list[tuple[str, str | Decimal]]
) -> DataFrame:
    """Sales of given items at given prices, with contact columns."""
    hits = sale.where(_price_match(prices)).select("custid", "item", "total", "dt", "pmtype")
    return with_contacts(hits, cust).drop("phone", "phone2")


def price_point_counts(sale: DataFrame, prices: list[tuple[str, str | Decimal]]) -> DataFrame:
    """Number of sales per (item, price), 0 included, and a ``TOTAL`` row; one scan."""
    counts = sale.where(_price_match(prices)).agg(
        *[F.count(F.when(_price_match([pair]), 1)).alias(f"n{i}") for i, pair in enumerate(prices)],
        F.count(F.lit(1)).alias("n"),
    )
    rows = [
        F.struct(
            F.lit(item).alias("item"),
            F.lit(Decimal(str(price))).cast("decimal(18,2)").alias("price"),
            F.col(f"n{i}").alias("cnt"),
        )
        for i, (item, price) in enumerate(prices)
    ]
    total = F.struct(
        F.lit("TOTAL").alias("item"),
        F.lit(None).cast("decimal(18,2)").alias("price"),
        F.col("n").alias("cnt"),
    )
    return counts.select(F.inline(F.array(*rows, total)))


# --- per customer ---------------------------------------------------------------------


def customer_sales_active(
    sale: DataFrame, cust: DataFrame, as_of: str | dt.date, days: int = 60, k: int | None = 20
) -> DataFrame:
    """Spend of customers whose latest sale of any kind is not older than ``days``."""
    per_customer = (
        sale.groupBy("custid")
        .agg(
            F.max("dt").alias("__latest"),
            F.count(F.when(_paid(), 1)).alias("cnt"),
            F.sum(F.when(_paid(), F.col("total"))).alias("total"),
        )
        .where((F.col("cnt") > 0) & clock.up_to("__latest", as_of, -days, None))
        .drop("__latest")
    )
    out = with_contacts(per_customer, cust)
    return out if k is None else out.orderBy(F.desc("total"), "custid").limit(k)


def customer_sales_recent(
    sale: DataFrame, cust: DataFrame, as_of: str | dt.date, n: int = 30
) -> DataFrame:
    per_customer = (
        sale.where(_paid() & clock.whole_days("dt", as_of, -n, None))
        .groupBy("custid")
        .agg(*_totals())
    )
    return with_contacts(per_customer, cust)


def comps(
    sale: DataFrame,
    cust: DataFrame,
    as_of: str | dt.date,
    n: int = 7,
    until: int | None = None,
) -> DataFrame:
    """Free sales by customer and item: how many, and the latest one."""
    free = (F.col("pmtype") == COMP) | (F.col("total") == 0)
    per_item = (
        sale.where(free & clock.whole_days("dt", as_of, -n, until))
        .groupBy("custid", "item")
        .agg(F.count(F.lit(1)).alias("cnt"), F.max(F.struct("dt", "total")).alias("__last"))
        .select("custid", "item", "cnt", "__last.dt", "__last.total")
    )
    return with_contacts(per_item, cust)


def series_revenue(sale: DataFrame, cust: DataFrame, attend: DataFrame) -> DataFrame:
    """Class-package revenue and highest ride number per customer, NULL when none."""
    revenue = (
        sale.where(F.col("typ") == SERIES_TYPE)
        .groupBy(F.col("custid").alias("id"))
        .agg(F.sum("total").alias("seriesrevenue"))
    )
    rides = attend.groupBy(F.col("custid").alias("id")).agg(F.max("num").alias("numrides"))
    return (
        cust.select("id", "firstname", "lastname", "emailaddress")
        .join(revenue, "id", "left")
        .join(rides, "id", "left")
    )


def avg_cost_per_ride(
    sale: DataFrame, cust: DataFrame, attend: DataFrame, k: int | None = None
) -> DataFrame:
    """Revenue per ride; with ``k``, the customers who paid the most per ride."""
    out = series_revenue(sale, cust, attend).withColumn(
        "avgcostperride", safe_ratio("seriesrevenue", "numrides")
    )
    return out if k is None else out.orderBy(F.desc_nulls_last("avgcostperride"), "id").limit(k)


def rides_and_months(cust: DataFrame, attend: DataFrame) -> DataFrame:
    """Attendance rows (any status) and months of 30 days from first to last class.

    ``span_us`` is the same span in microseconds: add that up, not the fractions.
    """
    spans = attend.groupBy(F.col("custid").alias("id")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("classdate").alias("first"),
        F.max("classdate").alias("last"),
    )
    span = clock.micros_between("last", "first")
    return (
        cust.select("id", "firstname", "lastname", "emailaddress")
        .join(spans, "id", "left")
        .select(
            "id", "firstname", "lastname", "emailaddress",
            F.coalesce("n", F.lit(0)).alias("numrides"),
            _months(span).alias("months"),
            span.alias("span_us"),
        )
    )


def _months(micros: Column) -> Column:
    return micros.cast("double") / F.lit(float(clock.DAY_MICROS)) / F.lit(30.0)


def rides_per_month(cust: DataFrame, attend: DataFrame, openseries: DataFrame) -> DataFrame:
    """Average rides per month, one row per customer and open series."""
    series = openseries.select("emailaddress", "series")
    return (
        rides_and_months(cust, attend)
        .join(series, "emailaddress")
        .select(
            "firstname", "lastname", "emailaddress", "numrides", "months",
            safe_ratio("numrides", "months").alias("avgridespermonth"), "series",
        )
    )


def rides_per_month_by_series(
    cust: DataFrame, attend: DataFrame, openseries: DataFrame
) -> DataFrame:
    """The same by series, as a ratio of sums.

    Open series are counted per e-mail first, so a shared address meets each customer once.
    """
    held = openseries.groupBy("emailaddress", "series").agg(F.count(F.lit(1)).alias("held"))
    sums = (
        rides_and_months(cust, attend)
        .join(held, "emailaddress")
        .groupBy("series")
        .agg(
            F.sum(F.col("numrides") * F.col("held")).alias("numrides"),
            F.sum(F.col("span_us").cast("decimal(20,0)") * F.col("held")).alias("__us"),
        )
    )
    months = _months(F.col("__us"))
    return sums.select(
        "series", "numrides", months.alias("months"),
        safe_ratio("numrides", months).alias("avgridespermonth"),
    )


# --- grouped totals -------------------------------------------------------------------


def sales_by(sale: DataFrame, dim: str) -> DataFrame:
    """Count and sum by one column over everything."""
    return sale.groupBy(dim).agg(*_totals())


def sales_window(
    sale: DataFrame, dim: str, as_of: str | dt.date, lo: int, hi: int | None
) -> DataFrame:
    """Count and sum by one column over whole days ``as_of+lo`` to ``as_of+hi``."""
    return sales_by(sale.where(clock.whole_days("dt", as_of, lo, hi)), dim)


def item_sales(sale: DataFrame, as_of: str | dt.date | None = None, n: int | None = None) -> DataFrame:
    """Paid sales by item, all of them or since ``as_of-n``."""
    paid = sale.where(_paid())
    if n is not None:
        paid = paid.where(clock.whole_days("dt", as_of, -n, None))
    return sales_by(paid, "item")


def total_sales(sale: DataFrame, as_of: str | dt.date, n: int = 30) -> DataFrame:
    return sale.where(_paid() & clock.whole_days("dt", as_of, -n, None)).agg(*_totals())


def year_sales(sale: DataFrame, year: int) -> DataFrame:
    """Sales by item in a calendar year, without comps and store credit."""
    in_year = clock.half_open("dt", dt.date(year, 1, 1), dt.date(year + 1, 1, 1))
    return sales_by(sale.where(in_year & ~F.col("pmtype").isin(COMP, STORE_CREDIT)), "item")


def sales_by_item(sale: DataFrame) -> DataFrame:
    """Sum of all sales by item."""
    return sale.groupBy("item").agg(F.sum("total").alias("total"))


def sales_by_city(
    sale: DataFrame, cust: DataFrame, by_month: bool = False, cities: list[str] | None = None
) -> DataFrame:
    """Sales by the customer's city in lower case, positive sums only.

    Sales are added up per customer (and month) before they meet the customer table.
    """
    months = [F.trunc("dt", "MM").alias("__month")] if by_month else []
    per_customer = sale.groupBy("custid", *months).agg(F.sum("total").alias("__total"))
    places = cust.select(F.col("id").alias("custid"), F.lower("city").alias("city"))
    if cities:
        places = places.where(F.col("city").isin([c.lower() for c in cities]))
    joined = per_customer.join(places, "custid", "inner" if cities else "left")
    sums = (
        joined.groupBy(*(["__month"] if by_month else []), "city")
        .agg(F.sum("__total").alias("total"))
        .where(F.col("total") > 0)
    )
    if not by_month:
        return sums
    return sums.select(clock.month_key("__month").alias("yymm"), "city", "total")


def sales_by_date(sale: DataFrame) -> DataFrame:
    """Sum of sales per exact time of sale."""
    return sale.groupBy("dt").agg(F.sum("total").alias("total"))


def item_count_window(sale: DataFrame, item: str, as_of: str | dt.date) -> DataFrame:
    """Sales of one item since ``as_of-30`` against ``[-61, -31]``, in one pass."""
    return (
        sale.where((F.col("item") == item) & clock.whole_days("dt", as_of, -61, None))
        .agg(
            F.count(F.when(clock.whole_days("dt", as_of, -61, -31), 1)).alias("prev_cnt"),
            F.count(F.when(clock.whole_days("dt", as_of, -30, None), 1)).alias("last_cnt"),
        )
    )


# --- period over period ---------------------------------------------------------------


def _compared(sale: DataFrame, dim: str, as_of: str | dt.date, days: int) -> DataFrame:
    """Both windows of a dimension from one scan; a window without sales gives NULLs."""
    (last_lo, last_hi), (prev_lo, prev_hi) = PERIODS[days]
    last = clock.whole_days("dt", as_of, last_lo, last_hi)
    prev = clock.whole_days("dt", as_of, prev_lo, prev_hi)
    return (
        sale.where(clock.whole_days("dt", as_of, prev_lo, last_hi))
        .groupBy(dim)
        .agg(
            F.count(F.when(prev, 1)).alias("__p"),
            F.sum(F.when(prev, F.col("total"))).alias("p_total"),
            F.count(F.when(last, 1)).alias("__t"),
            F.sum(F.when(last, F.col("total"))).alias("t_total"),
        )
        .select(
            dim,
            F.nullif("__p", F.lit(0)).alias("p_cnt"),
            "p_total",
            F.nullif("__t", F.lit(0)).alias("t_cnt"),
            "t_total",
            pct_change("t_total", "p_total").alias("pctchange"),
        )
    )


def sales_type_change(sale: DataFrame, as_of: str | dt.date, days: int = 30) -> DataFrame:
    """Last window against the one before, by type; types without a recent sale are left out."""
    return _compared(sale, "typ", as_of, days).where(F.col("t_cnt").isNotNull())


def with_total(change: DataFrame, dim: str = "typ") -> DataFrame:
    """Add a TOTAL row: sums of the columns, and the change of the sums."""
    total = change.agg(
        F.lit("TOTAL").alias(dim),
        *[F.sum(c).alias(c) for c in ("p_cnt", "p_total", "t_cnt", "t_total")],
    ).withColumn("pctchange", pct_change("t_total", "p_total"))
    return change.unionByName(total)


def sales_item_change(sale: DataFrame, as_of: str | dt.date, days: int = 30) -> DataFrame:
    """By item, with the items sold in either window."""
    return _compared(sale, "item", as_of, days).where(
        F.col("t_cnt").isNotNull() | F.col("p_cnt").isNotNull()
    )


# --- open series ----------------------------------------------------------------------


def open_series(openseries: DataFrame) -> DataFrame:
    """Packages by series: how many, classes in them, used and left."""
    return openseries.groupBy("series").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.sum("count").alias("totalclasses"),
        (F.sum("count") - F.sum("remaining")).alias("usedclasses"),
        F.sum("remaining").alias("remainingclasses"),
    )


def open_series_total(openseries: DataFrame) -> DataFrame:
    """The same with a TOTAL row."""
    by_series = open_series(openseries)
    columns = [c for c in by_series.columns if c != "series"]
    total = by_series.agg(F.lit("TOTAL").alias("series"), *[F.sum(c).alias(c) for c in columns])
    return by_series.unionByName(total)


