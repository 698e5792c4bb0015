"""The latest occupancy snapshot per class, from repeated polling."""

from __future__ import annotations

from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from studiolens.sources import tables
from studiolens.sources.tables import newest_per_key
from studiolens.streaming.files import run_batches
from studiolens.streaming.keyed import Step, behind, micros, with_state

KEYS = ["dt", "site"]
DELAY = "3 days"


def _newest(rest: list[str], exact: dict[str, type]) -> Step:
    """A step that lets a class's newest poll go on, if the batch brought one, and late polls.

    Polls of the same time are ordered by the columns ``rest``, NULL first; ``exact`` tells which
    of them are numbers.
    """

    def value(column: str, text: str | None) -> tuple:
        if not isinstance(text, str):
            return (False,)
        return (True, exact[column](text) if column in exact else text.encode())

    def step(rows: pd.DataFrame, state: GroupState) -> pd.DataFrame:
        late = behind(rows["__at"], state)
        out, fresh = rows[late].assign(late=True), rows[~late]
        if not len(fresh):
            return out
        polled = fresh["__poll"].max()
        best = fresh[fresh["__poll"] == polled]
        row = max(best.index, key=lambda i: [value(c, best.at[i, c]) for c in rest])
        own = [best.at[row, c] for c in rest]
        if state.exists:
            before, *stored = state.get
            if (before, [value(c, t) for c, t in zip(rest, stored, strict=True)]) >= (
                polled,
                [value(c, t) for c, t in zip(rest, own, strict=True)],
            ):
                return out
        state.update((int(polled), *[t if isinstance(t, str) else None for t in own]))
        return pd.concat([best.loc[[row]].assign(late=False), out])

    return step


def stream_occ_latest(obs: DataFrame, polled: str = "poll_ts", delay: str = DELAY) -> DataFrame:
    """The newest observation per class time and site, again whenever a newer one comes, and ``late``.

    The watermark is on the class time. A poll of a class behind it is late: it goes on with
    its mark and is compared with nothing here. ``delay`` has to cover how far ahead classes are polled.
    """
    rest = [c for c in obs.columns if c not in (*KEYS, polled)]
    exact: dict[str, type] = {}
    for field in obs.schema:
        if isinstance(field.dataType, T.IntegralType):
            exact[field.name] = int
        elif isinstance(field.dataType, T.NumericType):
            exact[field.name] = Decimal if isinstance(field.dataType, T.DecimalType) else float
    work = {"__at": micros("dt"), "__poll": micros(polled)}
    fields = ["poll bigint", *[f"`{c}` string" for c in rest]]
    step = _newest(rest, exact)
    return with_state(obs, KEYS, "dt", delay, work, {"late": "boolean"}, ", ".join(fields), step)


def keep_latest(
    obs: DataFrame,
    table: str,
    checkpoint: str,
    polled: str = "poll_ts",
    every: str | None = None,
    delay: str = DELAY,
    late_out: str | None = None,
) -> StreamingQuery:
    """Keep the latest snapshot per class and site in a stored table.

    What is newest is known from the state of the class, so the table is written but not read. None is
    lost: late polls are written to ``late_out``, if given, and compared with the stored rows of
    their days, so the newest stays however late it comes. Writing a batch twice gives the same rows.
    """

    def each(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        late = batch.where("late").drop("late")
        newest = batch.where("NOT late").drop("late")
        if not late.isEmpty():
            if late_out:
                late.write.mode("overwrite").parquet(f"{late_out}/epoch={epoch}")
            newest = newest.unionByName(late)
            stored = tables.stored_in_days_of(spark, table, late, "dt")
            if stored is not None:
                newest = newest.unionByName(stored.select(*newest.columns))
            newest = newest_per_key(newest, KEYS, polled)
        tables.upsert_at(spark, table, newest, KEYS, "dt")
        batch.unpersist()

    return run_batches(stream_occ_latest(obs, polled, delay), each, checkpoint, every=every)
