"""Side tables kept with a fact table, so that a nightly load does not read its history.

The *ranges* hold the first and last id of each partition, one row per day; a load looks ids up only in
partitions whose range meets that of its batch. The *counters* hold, per customer, the highest
counts over all partitions before a day; a load reads them and the partitions from that day on.

Both are written before a load changes the table, as versions with a marker (``versions``), and stay
right if it is broken off: ranges only grow, so they cover what the load adds and what it takes
away, and counters end before the first day the load touches. A load that does not keep them
(``tables.upsert_at`` without ``near``, ``tables.replace_range_at``) removes them first; the next one that does
makes them anew from the whole table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studiolens.sources import versions
from studiolens.sources.tables import COUNTERS, NO_DAY, PART, RANGES


def _ranges(rows: DataFrame, id_column: str) -> DataFrame:
    return rows.groupBy(PART).agg(
        F.min(id_column).alias("first_id"), F.max(id_column).alias("last_id")
    )


def near_parts(
    spark: SparkSession, path: str, stored: DataFrame | None, batch: DataFrame, id_column: str
) -> list[dt.date]:
    """Partitions that may hold an id of a batch; the batch's own ids are noted for later loads.

    ``batch`` has the partition column. The result has at most one date per stored day.
    """
    place = f"{path}/{RANGES}"
    known = versions.current(spark, place)
    if known is None and stored is not None:
        known = _ranges(stored, id_column)
    own = _ranges(batch, id_column)
    both = own if known is None else known.unionByName(own)
    merged = both.groupBy(PART).agg(
        F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id")
    )
    versions.full_refresh(merged.coalesce(1), place)
    first, last = own.agg(F.min("first_id"), F.max("last_id")).first()
    if first is None:
        return []
    meets = (F.col("last_id") >= F.lit(first)) & (F.col("first_id") <= F.lit(last))
    hits = versions.current(spark, place).where(meets).select(PART)
    return sorted(row[PART] for row in hits.collect())


def counts_without(
    spark: SparkSession,
    path: str,
    stored: DataFrame,
    touched: set[dt.date],
    ids: DataFrame,
    key: str,
    counts: list[str],
) -> DataFrame:
    """Rows of ``key`` and ``counts`` whose maxima are those of the stored rows without ``ids``.

    Rows with one of the ids lie in ``touched``. What lies before the first touched day comes from the counters,
    which move on to that day; if it lies before theirs, they are made from the table. Rows
    without a time are in a partition of their own and are read each time.
    """
    place = f"{path}/{COUNTERS}"
    known = versions.current(spark, place)
    upto = None if known is None else known.agg(F.max("before")).first()[0]
    first = min(touched - {NO_DAY}, default=upto)
    part, untimed = F.col(PART), F.col(PART) == F.lit(NO_DAY)
    if first is None:
        return stored.join(ids, ids.columns, "left_anti").select(key, *counts)
    if upto != first:
        older = stored.where(~untimed & (part < F.lit(first)))
        if upto is not None and upto < first:
            older = older.where(part >= F.lit(upto)).select(key, *counts)
            older = older.unionByName(known.select(key, *counts))
        highest = older.groupBy(key).agg(*[F.max(c).alias(c) for c in counts])
        versions.full_refresh(highest.withColumn("before", F.lit(first)), place)
    recent = stored.where(untimed | (part >= F.lit(first))).join(ids, ids.columns, "left_anti")
    settled = versions.current(spark, place)
    return recent.select(key, *counts).unionByName(settled.select(key, *counts))
