"""Ride numbers of arriving attendance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from studiolens.functions.prefix import TASK_ROWS
from studiolens.operators.retention import ENROLLED
from studiolens.operators.running import with_ride_number
from studiolens.streaming.keyed import MISSING, Columns, behind, with_carried, write_batches

DELAY = "30 days"


def carry_count(frames: Iterator[Columns], state: GroupState) -> Iterator[Columns]:
    """The count stored for a customer, beside each of its rows of one batch.

    A row whose class lies before the last counted one of an earlier batch, or behind the
    watermark, is late: it keeps no number and is not counted. Nothing here needs an order.
    """
    before, last = state.get if state.exists else (0, MISSING)
    num, newest = before, last
    for rows in frames:
        at = rows["__at"]
        late = ((at < last) & (at != MISSING)) | behind(at, state)
        num += int(rows["__one"][~late].sum())
        newest = max(newest, int(at[~late].max(initial=MISSING)))
        yield {"__before": np.full(len(at), before), "late": late}
    state.update((num, newest))


def with_stored_count(events: DataFrame, delay: str = DELAY) -> DataFrame:
    """Arriving attendance with the count of its customer before the batch, and ``late``.

    Counts are states per customer and are never dropped. Rows pass frame by frame.
    """
    work = {"__one": F.when(F.col("status") == ENROLLED, 1).otherwise(0)}
    added = {"__before": "bigint", "late": "boolean"}
    rows = events.drop("num", *added)
    return with_carried(
        rows, ["custid"], "classdate", delay, work, added, "num bigint, last bigint", carry_count
    )


def number_rows(batch: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """``num`` of a batch's rows, on from the count before; a late row has none.

    Like :func:`~studiolens.operators.running.with_ride_number`, no task orders more than ``task_rows``
    rows of a customer.
    """
    counted = with_ride_number(batch.where(~F.col("late")), task_rows=task_rows)
    counted = counted.withColumn("num", F.col("num") + F.col("__before"))
    behind_rows = batch.where("late").withColumn("num", F.lit(None).cast("bigint"))
    rest = [c for c in batch.columns if c not in ("__before", "late")]
    return counted.unionByName(behind_rows).select(*rest, "num", "late")


def stream_ride_number(
    events: DataFrame, out: str, late_out: str, checkpoint: str, every: str | None = None, delay: str = DELAY
) -> StreamingQuery:
    """Append numbered attendance to ``out``, one folder per batch, and late rows to ``late_out``, too."""
    rows = with_stored_count(events, delay)
    return write_batches(rows, number_rows, F.col("late"), out, late_out, checkpoint, every)
