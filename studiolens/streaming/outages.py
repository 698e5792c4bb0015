"""Outage alerts from arriving probe samples."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from studiolens.operators.alerts import outage_alerts
from studiolens.streaming.keyed import MISSING, Columns, behind, number, with_carried, write_batches

DELAY = "1 day"


class _Run:
    """The run of failures at the end of a target's samples, which come in no order.

    Only samples after the last success so far are kept, 16 bytes each.
    """

    def __init__(self, run: int, last: tuple[int, int]):
        self.run, self.last, self.down = run, last, 0
        self.success: tuple[int, int] | None = None
        self.after: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, at: np.ndarray, own: np.ndarray, down: np.ndarray) -> None:
        order = np.lexsort([own, at])
        at, own, down = at[order], own[order], down[order]
        if (at[-1], own[-1]) >= self.last:
            self.last, self.down = (int(at[-1]), int(own[-1])), int(down[-1])
        up = np.flatnonzero(down == 0)
        if len(up) and (self.success is None or (at[up[-1]], own[up[-1]]) >= self.success):
            self.success = int(at[up[-1]]), int(own[up[-1]])
            # Of samples alike, those that came first stand first.
            self.after = [(a[k], o[k]) for a, o in self.after if (k := self._beyond(a, o, False)).any()]
            at, own = at[up[-1] + 1 :], own[up[-1] + 1 :]
        elif self.success is not None:
            keep = self._beyond(at, own, True)
            at, own = at[keep], own[keep]
        if len(at):
            self.after.append((at.copy(), own.copy()))

    def _beyond(self, at: np.ndarray, own: np.ndarray, alike: bool) -> np.ndarray:
        time, sample = self.success
        return (at > time) | ((at == time) & ((own >= sample) if alike else (own > sample)))

    def end(self) -> int:
        if self.down != 1:
            return 0
        return sum(len(a) for a, _ in self.after) + (self.run if self.success is None else 0)


def carry_run(frames: Iterator[Columns], state: GroupState) -> Iterator[Columns]:
    """The run of failures stored for a target, or that it is new, beside each of its samples of one batch.

    A sample before the last one of an earlier batch, or behind the watermark, is late.
    """
    known = state.exists
    before, last_id, last = state.get if known else (0, MISSING, MISSING)
    run, some = _Run(before, (last, last_id)), False
    for rows in frames:
        at, own, down = rows["__at"], rows["__id"], rows["__down"]
        late = behind(at, state)
        if known:
            late |= (at < last) | ((at == last) & (own < last_id))
        if not late.all():
            some = True
            run.add(at[~late], own[~late], down[~late])
        yield {"run": np.full(len(at), before), "new": np.full(len(at), not known), "late": late}
    if some:
        state.update((run.end(), run.last[1], run.last[0]))


def with_stored_run(probes: DataFrame, delay: str = DELAY) -> DataFrame:
    """Arriving samples with the ``run`` of failures of their target before the batch, ``new`` and ``late``.

    A sample that lies before the last one of its target in an earlier batch, or behind the
    watermark, is late and changes no run.
    """
    samples = probes.select("target", "ts", "event_id", "down")
    work = {
        "__id": number("event_id"),
        "__down": F.coalesce(F.col("down").cast("int"), F.lit(-1)),
    }
    added = {"run": "bigint", "new": "boolean", "late": "boolean"}
    state = "downcount bigint, last_id bigint, last bigint"
    return with_carried(samples, ["target"], "ts", delay, work, added, state, carry_run)


def alert_rows(batch: DataFrame) -> DataFrame:
    """The alerts of a batch, and its late samples.

    Runs go on from the ``run`` before; like those of a table, they are not gathered in one task.
    """
    fresh = batch.where(~F.col("late"))
    known = fresh.where(~F.col("new")).groupBy("target").agg(F.max("run").alias("downcount"))
    found = outage_alerts(fresh, known)
    behind_rows = batch.where("late").select(
        "target", "ts", "event_id", "down",
        F.lit(None).cast("bigint").alias("downcount"), F.lit("late").alias("reason"),
    )
    return found.unionByName(behind_rows)


def stream_outage_alerts(
    probes: DataFrame, out: str, late_out: str, checkpoint: str, every: str | None = None, delay: str = DELAY
) -> StreamingQuery:
    """Append alerts and late samples to ``out``, and late samples to ``late_out``, too."""
    rows = with_stored_run(probes, delay)
    return write_batches(rows, alert_rows, F.col("reason") == "late", out, late_out, checkpoint, every)


def alerts_of(written: DataFrame) -> DataFrame:
    """The alerts a stream has written, without the late samples."""
    return written.where(F.col("reason") != "late").drop("epoch")
