"""One customer with a large share of the rows: joins split it, results stay whole."""

import pytest
from pyspark.sql import functions as F

from studiolens.operators import retention, sales

N = 300_000
SMALL = {
    # As on a session of others: no splitting at the price of another shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
}


@pytest.fixture
def small_limits(spark):
    """Limits of a cluster, scaled down to the test."""
    before = {key: spark.conf.get(key, None) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def people(spark):
    name = F.concat(F.lit("n"), F.col("id").cast("string"))
    return spark.range(2_000).select(
        "id", *[name.alias(c) for c in ("firstname", "lastname", "emailaddress", "phone", "phone2", "city")],
        F.lit("1990-07-10").cast("date").alias("birthdate"),
    )


@pytest.fixture(scope="module")
def hot(spark):
    return spark.range(0, N, 1, 8).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 2_000).cast("bigint").alias("custid"),
        F.lit("2014-07-08 06:00:00").cast("timestamp_ntz").alias("dt"),
        F.timestamp_seconds(F.lit(1_404_820_800) + F.col("id")).cast("timestamp_ntz").alias("classdate"),
        F.lit("Card").alias("pmtype"),
        F.col("id").cast("string").alias("item"),
        (-F.col("id") - 1).cast("decimal(18,2)").alias("total"),
    )


def _check(df, rows):
    seen = df.groupBy().agg(F.count(F.lit(1)).alias("n"))
    # The join itself, without the count on top, is what runs at scale.
    assert len(df.collect()) == rows
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    assert seen.first().n == rows


def test_wide_sales(spark, small_limits, hot, people):
    _check(sales.sales_wide(hot, people), N)


def test_refunds(spark, small_limits, hot, people):
    _check(sales.refunds(hot, people, "2014-07-08"), N)


def test_birthdays_with_very_many_bookings(spark, small_limits, hot, people):
    window = retention.birthday_riders_window(people, hot, "2014-07-08")
    # The 1000 even ids have no booking.
    _check(window, N + 1_000)


def test_nearest_class_of_very_many(spark, small_limits, hot, people):
    nearest = retention.nearest_birthday_class(people, hot, "2014-07-08")
    rows = nearest.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max("ndays")).collect()
    plan = nearest._jdf.queryExecution()
    assert nearest.collect() and "skew=true" in plan.executedPlan().toString()
    # Every customer with bookings has some within half a day of the birthday.
    assert len(rows) == 1_000 and {r["max(ndays)"] for r in rows} == {0.0}
