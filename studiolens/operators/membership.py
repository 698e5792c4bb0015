"""Monthly memberships: tenure and revenue forecast."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studiolens.functions import clock
from studiolens.functions.ratio import round_half_up, safe_ratio

# Monthly price, committed months, and the share of the months so far that
# is expected from a member beyond both averages.
PRICE = 199.99
MIN_MONTHS = 3
BEYOND_SHARE = 0.2


def tenure(memberships: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Paid months per member, and whether any of them runs to ``as_of`` or later."""
    return memberships.groupBy("member").agg(
        F.count(F.lit(1)).alias("months"),
        F.max(F.col("expiry") >= F.lit(clock.as_day(as_of))).alias("current"),
    )


def average_tenure(memberships: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Members and mean months, for past and for current members."""
    return (
        tenure(memberships, as_of)
        .groupBy("current")
        .agg(
            F.count(F.lit(1)).alias("members"),
            safe_ratio(F.sum("months"), F.count(F.lit(1))).alias("avg_months"),
        )
    )


def forecast(
    memberships: DataFrame,
    as_of: str | dt.date,
    price: float = PRICE,
    min_months: int = MIN_MONTHS,
) -> DataFrame:
    """Revenue still to come from each current member.

    ``guaranteed`` is the rest of the commitment. ``expected`` depends on whether the member
    is below the mean of past members, below that of current ones, or beyond both.
    """
    members = tenure(memberships, as_of)
    current, months = F.col("current"), F.col("months")
    # Both means from one pass, as a scalar subquery of one row.
    means = members.agg(
        F.struct(
            safe_ratio(
                F.sum(F.when(~current, months)), F.count(F.when(~current, months))
            ).alias("past"),
            safe_ratio(
                F.sum(F.when(current, months)), F.count(F.when(current, months))
            ).alias("curr"),
        ).alias("means")
    ).scalar()
    price_ = F.lit(float(price))
    mean_past, mean_curr = F.col("__means.past"), F.col("__means.curr")
    path = (
        F.when(months < mean_past, "expires")
        .when(months < mean_curr, "reaches average")
        .otherwise("beyond average")
    )
    expected = (
        F.when(F.col("path") == "expires", (mean_past - months) * price_)
        .when(F.col("path") == "reaches average", (mean_curr - months) * price_)
        .otherwise(price_ * months * F.lit(BEYOND_SHARE))
    )
    committed = F.when(months < min_months, (F.lit(min_months) - months) * price_)
    return (
        members.where(current)
        .withColumn("__means", means)
        .withColumn("path", path)
        .select(
            "member", "months", "path",
            F.coalesce(committed, F.lit(0.0)).alias("guaranteed"),
            expected.alias("expected"),
        )
    )


def forecast_totals(
    memberships: DataFrame,
    as_of: str | dt.date,
    price: float = PRICE,
    min_months: int = MIN_MONTHS,
) -> DataFrame:
    """Current members, guaranteed and expected revenue, in cents."""

    def cents(column: str):
        return round_half_up(F.sum(F.col(column).cast("decimal(18,6)")), 2)

    return forecast(memberships, as_of, price, min_months).agg(
        F.count(F.lit(1)).alias("members"),
        cents("guaranteed").alias("guaranteed"),
        cents("expected").alias("expected"),
    )
