"""Outage alerts from probe samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studiolens.functions.prefix import TASK_ROWS, Mark, prefix_before, time_levels

ORDER = ["ts", "event_id"]


def probe_states(
    probes: DataFrame, state: DataFrame | None = None, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Per sample the length of the run of failures, and whether to alert.

    Alerts go out on every second failure in a row, on the first success after two or more
    failures, and on the first sample of a target. ``state`` holds ``target, downcount`` at
    the end of earlier samples; its targets are not new.

    A run may be as long as the table, so runs are not gathered: samples are counted, a success
    marks the count, and a run is the distance from the last mark. Both come from one pass.
    """
    start = None
    if state is not None:
        # A run that goes on looks like a last success that many samples ago.
        ago = (-F.col("downcount")).cast("bigint")
        start = state.select("target", F.lit(0).cast("bigint").alias("__seq"), ago.alias("__up"))
    ran = prefix_before(
        probes.select("target", "ts", "event_id", "down"),
        ["target"],
        time_levels(["ts"], "event_id"),
        ORDER,
        {"__seq": ("sum", F.lit(1)), "__up": Mark("__seq", F.col("down") == 0)},
        start,
        task_rows,
    )
    failures_before = F.col("__seq") - F.coalesce("__up", F.lit(0))
    out = ran.withColumn(
        "downcount", F.when(F.col("down") == 1, failures_before + 1).otherwise(F.lit(0))
    ).withColumn(
        "reason",
        F.when((F.col("down") == 1) & (F.col("downcount") % 2 == 0), "down")
        .when((F.col("down") == 0) & (failures_before >= 2), "recovered")
        # Only a target without earlier samples or state has no success and no start.
        .when((F.col("__seq") == 0) & F.col("__up").isNull(), "first"),
    )
    return out.select(
        "target", "ts", "event_id", "down", "downcount",
        F.col("reason").isNotNull().alias("alert"), "reason",
    )


def outage_alerts(probes: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """The samples that raise an alert."""
    return probe_states(probes, state).where(F.col("alert")).drop("alert")


def last_state(states: DataFrame) -> DataFrame:
    """``target, downcount`` after the last sample of each target."""
    return (
        states.groupBy("target")
        .agg(F.max(F.struct("ts", "event_id", "downcount")).alias("__last"))
        .select("target", "__last.ts", "__last.event_id", "__last.downcount")
    )
