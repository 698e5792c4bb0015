"""Load modes: range replace and key upsert. A full refresh is in ``versions``.

Each mode has a DataFrame form (old rows, new rows -> rows after the load) and a form for
tables at rest. Stored fact tables are Parquet folders partitioned by ``day``; a load reads
and rewrites only the days it touches, never the whole history.

A load first writes its batch into the table's folder, hidden from readers, with a note of what is
to be done. From then on it will be finished: one that is broken off is done again by
:func:`recover`, with which every load begins. Doing it twice gives what doing it once gives.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studiolens.session import children, read_text, remove_dir, write_text


def time_bounds(df: DataFrame, column: str) -> DataFrame:
    """First and last timestamp of a batch, one row (NULL when the batch is empty)."""
    return df.agg(F.min(column).alias("first_ts"), F.max(column).alias("last_ts"))


def replace_range(target: DataFrame, incoming: DataFrame, ts: str) -> DataFrame:
    """Drop target rows from the first to the last time of ``incoming``, then append it."""
    first, last = time_bounds(incoming, ts).first()
    if first is None:
        kept = target
    else:
        column = F.col(ts)
        kept = target.where(column.isNull() | (column < F.lit(first)) | (column > F.lit(last)))
    return kept.unionByName(incoming)


def newest_per_key(df: DataFrame, keys: list[str], latest_by: str) -> DataFrame:
    """The last row per key; ties on ``latest_by`` are broken by the other columns."""
    rest = [c for c in df.columns if c not in keys and c != latest_by]
    best = df.groupBy(*keys).agg(F.max(F.struct(latest_by, *rest)).alias("__row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__row.{c}") for c in df.columns])


def upsert(
    target: DataFrame, incoming: DataFrame, keys: list[str], latest_by: str | None = None
) -> DataFrame:
    """Delete by key, then insert: the incoming row wins."""
    if latest_by:
        incoming = newest_per_key(incoming, keys, latest_by)
    return target.join(incoming.select(*keys).distinct(), keys, "left_anti").unionByName(
        incoming.select(*target.columns)
    )


# --- tables at rest -------------------------------------------------------------------

PART = "part_day"

# The partition of rows without a time. It may hold rows of this day, too.
NO_DAY = dt.date(1900, 1, 1)

# Side tables of a load that keeps them (``kept``), hidden from readers.
RANGES, COUNTERS = "_ranges", "_counters"


def stored_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, None before its first load."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def part_of(column: Column, grain: str) -> Column:
    """The partition of a time: its day, or the first day of its month; never NULL."""
    return F.coalesce(F.to_date(F.date_trunc(grain, column)), F.lit(NO_DAY))


def _parts_in(df: DataFrame) -> set[dt.date]:
    """Distinct partitions of a batch: one value per day of the batch, small by nature."""
    return {row[PART] for row in df.select(PART).distinct().collect()}


# A load under way: its batch, what to do with it, and the empty marker that says both are whole.
_BATCH, _NOTE, _READY = "_batch-", "_note-", "_ready-"


def _begin(spark: SparkSession, path: str, incoming: DataFrame, note: dict) -> str:
    """Write a batch and what to do with it; the name of the load.

    The batch is read several times, it may come from the table about to change, and a bad
    row in it must fail before anything changes.
    """
    recover(spark, path)
    load = uuid.uuid4().hex
    if note.get("near") is None:
        for side in {RANGES, COUNTERS}.intersection(children(spark, path)):
            remove_dir(spark, f"{path}/{side}")
    try:
        rows = incoming.withColumn(PART, part_of(F.col(note["ts"]), note["grain"]))
        rows.write.parquet(f"{path}/{_BATCH}{load}")
    except Exception:
        remove_dir(spark, f"{path}/{_BATCH}{load}")
        raise
    stored = stored_rows(spark, path)
    untimed = 0 if stored is None else _untimed(stored, note["ts"])
    write_text(spark, f"{path}/{_NOTE}{load}", json.dumps({**note, "untimed": untimed}))
    write_text(spark, f"{path}/{_READY}{load}")
    return load


def _untimed(rows: DataFrame, ts: str) -> int:
    return rows.where((F.col(PART) == F.lit(NO_DAY)) & F.col(ts).isNull()).count()


def _finish(spark: SparkSession, path: str, load: str) -> None:
    """Do what the note of a load says, then take the load away."""
    note = json.loads(read_text(spark, f"{path}/{_NOTE}{load}"))
    incoming = spark.read.parquet(f"{path}/{_BATCH}{load}")
    if note["keys"]:
        _upsert_parts(spark, path, incoming, note["keys"], note["ts"], note.get("near"))
    else:
        _replace_parts(spark, path, incoming, note["ts"], note["grain"], note["untimed"])
    for kind in (_READY, _NOTE, _BATCH):
        remove_dir(spark, f"{path}/{kind}{load}")


def recover(spark: SparkSession, path: str) -> None:
    """Finish a load of the table that was broken off, if there is one."""
    for name in children(spark, path):
        if name.startswith(_READY):
            _finish(spark, path, name.removeprefix(_READY))


def _swap_parts(
    spark: SparkSession,
    path: str,
    kept: DataFrame | None,
    incoming: DataFrame,
    touched: set[dt.date],
) -> None:
    """Rewrite the touched partitions as ``kept`` and ``incoming`` rows.

    Dynamic overwrite stages the new files and swaps folders on commit: the old rows are
    there to be read while the job runs, and stay if it fails. The rebalance hint brings a
    partition's rows together and still splits a large one. Touched partitions left
    without a row are removed at the end.
    """
    emptied = touched - _parts_in(incoming)
    rows = incoming
    if kept is not None:
        if emptied:
            emptied -= _parts_in(kept.where(F.col(PART).isin(sorted(emptied))))
        rows = kept.unionByName(incoming.select(*kept.columns))
    (
        rows.hint("rebalance", F.col(PART))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PART)
        .parquet(path)
    )
    for part in sorted(emptied):
        remove_dir(spark, f"{path}/{PART}={part.isoformat()}")


def replace_range_at(
    spark: SparkSession, path: str, incoming: DataFrame, ts: str, grain: str = "day"
) -> None:
    """Range replace on a partitioned table; reads the partitions of the range only.

    Rows without a time lie in no range: stored ones stay, new ones are added.
    """
    note = {"ts": ts, "grain": grain, "keys": None}
    _finish(spark, path, _begin(spark, path, incoming, note))


def _replace_parts(
    spark: SparkSession, path: str, incoming: DataFrame, ts: str, grain: str, untimed: int
) -> None:
    """``untimed`` rows without a time were stored before the load began."""
    stored = stored_rows(spark, path)
    if stored is not None and _untimed(stored, ts) > untimed:
        # The load is done again, and its rows without a time have been added already.
        incoming = incoming.where(F.col(ts).isNotNull())
    touched = _parts_in(incoming)
    if stored is None:
        _swap_parts(spark, path, None, incoming, set())
    elif touched:
        first, last = time_bounds(incoming, ts).first()
        part, time = F.col(PART), F.col(ts)
        within, kept = F.lit(False), time.isNull()
        if first is not None:
            within = part.between(*[part_of(F.lit(edge), grain) for edge in (first, last)])
            kept = kept | (time < F.lit(first)) | (time > F.lit(last))
        if NO_DAY in touched:
            within = within | (part == F.lit(NO_DAY))
        old = stored.where(within)
        _swap_parts(spark, path, old.where(kept), incoming, touched | _parts_in(old))


def upsert_at(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: list[str],
    ts: str,
    latest_by: str | None = None,
    grain: str = "day",
    near: list[dt.date] | None = None,
) -> None:
    """Key upsert on a partitioned table; rewrites the partitions that hold a matching key
    or receive a row. ``near`` are the partitions that may hold one, if side tables are kept."""
    if latest_by:
        incoming = newest_per_key(incoming, keys, latest_by)
    days = None if near is None else [day.isoformat() for day in near]
    note = {"ts": ts, "grain": grain, "keys": keys, "near": days}
    _finish(spark, path, _begin(spark, path, incoming, note))


def matching(stored: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows that may have a key of a batch: those within the range of its first key.

    The range is a literal, so files and row groups whose statistics lie outside are not read.
    Ids that grow with time leave the recent files of a nightly batch.
    """
    first, last = incoming.agg(F.min(keys[0]), F.max(keys[0])).first()
    if first is None:
        return stored.limit(0)
    return stored.where(F.col(keys[0]).between(F.lit(first), F.lit(last)))


def touched_parts(
    stored: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    ts: str,
    near: list[dt.date] | None = None,
) -> set[dt.date]:
    """Partitions that receive a row of a batch or hold a stored row with one of its keys."""
    touched = _parts_in(incoming)
    if ts not in keys:
        # The stored row of a key may lie in another partition than the new one.
        found = matching(stored.select(PART, *keys), incoming, keys)
        if near is not None:
            found = found.where(F.col(PART).isin(near))
        touched |= _parts_in(found.join(incoming.select(*keys).distinct(), keys, "left_semi"))
    return touched


def _upsert_parts(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: list[str],
    ts: str,
    near: list[str] | None,
) -> None:
    stored = stored_rows(spark, path)
    if stored is None:
        _swap_parts(spark, path, None, incoming, set())
        return
    days = None if near is None else [dt.date.fromisoformat(day) for day in near]
    touched = touched_parts(stored, incoming, keys, ts, days)
    ids = incoming.select(*keys).distinct()
    kept = stored.where(F.col(PART).isin(sorted(touched))).join(ids, keys, "left_anti")
    _swap_parts(spark, path, kept.select(*stored.columns), incoming, touched)


def stored_in_days_of(
    spark: SparkSession, path: str, batch: DataFrame, ts: str, grain: str = "day"
) -> DataFrame | None:
    """The stored rows in the partitions that a batch falls into, None before the first load."""
    stored = stored_rows(spark, path)
    if stored is None:
        return None
    parts = _parts_in(batch.select(part_of(F.col(ts), grain).alias(PART)))
    return stored.where(F.col(PART).isin(sorted(parts))).drop(PART)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table without its partition column."""
    return spark.read.parquet(path).drop(PART)
