"""Streams with one state per key in Spark's state store.

A batch reads and writes the states of the keys it touches and no others; the checkpoint holds their
versions, so a batch that is run again starts from the same state and gives the same rows.

Rows reach the state function as pandas frames. There integers with nulls would become
floats, so all columns of the stream travel as text and are cast back; only the columns that the
function works on are numbers, and these are never NULL.

What needs no order is done by :func:`with_carried`, which never holds a key's rows: frames pass one
by one. What needs one is done by the batch operators when a batch is written (:func:`write_batches`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from studiolens.session import remove_dir
from studiolens.streaming.files import run_batches

# Stands for a missing time or id; such rows come first.
MISSING = -(1 << 62)

Step = Callable[[pd.DataFrame, GroupState], pd.DataFrame]

# The work columns of each frame as arrays, and the state, to the added columns of each frame.
Columns = dict[str, np.ndarray]
Carry = Callable[[Iterator[Columns], GroupState], Iterator[Columns]]


def micros(column: str) -> Column:
    """A time as microseconds, never NULL."""
    return F.coalesce(F.unix_micros(F.col(column).cast("timestamp")), F.lit(MISSING))


def number(column: str) -> Column:
    return F.coalesce(F.col(column).cast("bigint"), F.lit(MISSING))


def _marked(stream: DataFrame, time: str, delay: str) -> DataFrame:
    """A stream of columns that survive as text, with a watermark."""
    plain = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    for field in stream.schema:
        if not isinstance(field.dataType, plain):
            raise TypeError(f"{field.name}: {field.dataType.simpleString()} does not survive as text")
    # Spark wants a watermark on a time with zone.
    return stream.withColumn("__time", F.col(time).cast("timestamp")).withWatermark("__time", delay)


def with_state(
    stream: DataFrame,
    keys: list[str],
    time: str,
    delay: str,
    work: dict[str, Column],
    added: dict[str, str],
    state: str,
    step: Step,
) -> DataFrame:
    """``stream`` through ``step``, which gets a key's rows of a batch and its state.

    ``work`` are the columns ``step`` computes with, the columns ``added`` (name: type) those it
    adds; it returns the rows to go on with. ``time`` has a watermark of ``delay``. A row behind it is not
    lost: ``step`` sees it and decides. States stay, as Spark drops late rows where states end by event time.
    """
    names = stream.columns
    rows = _marked(stream, time, delay).select(
        *[F.col(c).cast("string").alias(c) for c in names], *[c.alias(n) for n, c in work.items()], "__time"
    )
    schema = ", ".join([*[f"`{c}` string" for c in names], *[f"`{c}` {t}" for c, t in added.items()]])
    kept = [*names, *added]

    def run(_key: tuple, frames: Iterator[pd.DataFrame], own: GroupState) -> Iterator[pd.DataFrame]:
        yield step(pd.concat(list(frames), ignore_index=True), own)[kept]

    done = rows.groupBy(*keys).applyInPandasWithState(run, schema, state, "append", GroupStateTimeout.NoTimeout)
    return done.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in stream.schema], *added)


def with_carried(
    stream: DataFrame,
    keys: list[str],
    time: str,
    delay: str,
    work: dict[str, Column],
    added: dict[str, str],
    state: str,
    carry: Carry,
) -> DataFrame:
    """``stream`` with the columns ``added`` (name: type) by ``carry``, for any number of rows of a key.

    ``carry`` gets ``__at`` (``time``) and the ``work`` columns of a key's rows of a batch, frame by frame and in no order, and its
    state; it gives the added columns of each frame. Frames have few columns, as each costs every key
    some time: a row travels as one text. For ``time`` and late rows see :func:`with_state`.
    """
    text = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in stream.columns]))
    groups = [F.col(k).cast("string").alias(f"__key_{k}") for k in keys]
    marked = _marked(stream, time, delay)
    # The time goes as a number, with the mark of the watermark: a pandas time takes longer than all the rest.
    at = micros("__time").alias("__at", metadata=marked.schema["__time"].metadata)
    rows = marked.select(*groups, text.alias("__row"), at, *[c.alias(n) for n, c in work.items()])
    numbers = ["__at", *work]
    schema = ", ".join(["__row string", *[f"`{c}` {t}" for c, t in added.items()]])

    def run(_key: tuple, frames: Iterator[pd.DataFrame], own: GroupState) -> Iterator[pd.DataFrame]:
        texts = []

        def arrays() -> Iterator[Columns]:
            for frame in frames:
                texts.append(frame["__row"].to_numpy())
                yield {c: frame[c].to_numpy() for c in numbers}

        for columns in carry(arrays(), own):
            yield pd.DataFrame({"__row": texts.pop(), **columns}, copy=False)

    done = rows.groupBy(*[f"__key_{k}" for k in keys]).applyInPandasWithState(run, schema, state, "append", GroupStateTimeout.NoTimeout)
    strings = T.StructType([T.StructField(c, T.StringType()) for c in stream.columns])
    parsed = done.select(F.from_json("__row", strings).alias("__row"), *added)
    return parsed.select(
        *[F.col("__row").getField(f.name).cast(f.dataType).alias(f.name) for f in stream.schema], *added
    )


def behind(times: np.ndarray, state: GroupState) -> np.ndarray:
    """Whether rows lie behind the watermark; rows without a time do not."""
    return (times < state.getCurrentWatermarkMs() * 1000) & (times != MISSING)


def write_batches(
    rows: DataFrame,
    ordered: Callable[[DataFrame], DataFrame],
    late: Column,
    out: str,
    late_out: str,
    checkpoint: str,
    every: str | None,
) -> StreamingQuery:
    """Append ``ordered`` of each batch to ``out/epoch=N``, and its late rows by themselves to ``late_out/epoch=N``."""

    # The session of a batch does not adapt its plans.
    spark = rows.sparkSession

    def each(batch: DataFrame, epoch: int) -> None:
        place = f"{out}/_rows-{epoch}"
        # Written first, so that the states are computed once; hidden from readers.
        batch.write.mode("overwrite").parquet(place)
        done = ordered(spark.read.schema(batch.schema).parquet(place))
        done.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
        written = spark.read.schema(done.schema).parquet(f"{out}/epoch={epoch}")
        written.where(late).write.mode("overwrite").parquet(f"{late_out}/epoch={epoch}")
        remove_dir(spark, place)

    return run_batches(rows, each, checkpoint, every=every)
