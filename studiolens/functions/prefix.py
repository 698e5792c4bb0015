"""Running aggregates that no single task has to hold.

A window over one customer or one probe target puts all rows of that key into one task.
That is the best plan for keys of ordinary size, and it is what happens to them here. Keys
with more rows than a task should hold are cut into buckets instead: days, instants, blocks
of ids. Their running aggregate is composed of what came before the day, before the instant
within the day, before the block within the instant, and before the row within the block.
Where there are large keys, their rows are read once more for the totals of their buckets.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of one key that a task may order by itself. A key counts as large beyond it.
TASK_ROWS = 1_000_000

# The set of large keys is broadcast. However many rows there are, it has the largest ones, at
# most this many; any other key holds less than this part of all rows and is one partition.
MOST_LARGE = 100_000

# Stands for a missing time in bucket columns only; NULL times sort first, as it does.
_FIRST = "0001-01-01 00:00:00"

_AGG = {"sum": F.sum, "max": F.max}


class Mark(NamedTuple):
    """A value for :func:`prefix_before`: the sum ``of`` as it stood after the last flagged row."""

    of: str
    flag: Column


def _zero(part: Column) -> Column:
    return F.coalesce(part, F.lit(0))


def instant(col: Column | str, unit: str | None = None) -> Column:
    """A bucket column from a time: truncated to ``unit``, never NULL."""
    col = F.col(col) if isinstance(col, str) else col
    if unit:
        col = F.date_trunc(unit, col)
    return F.coalesce(col.cast("timestamp_ntz"), F.lit(_FIRST).cast("timestamp_ntz"))


def time_levels(times: list[str], id_column: str) -> list[dict[str, Column]]:
    """Buckets for rows ordered by one or two times and a numeric id.

    Day of the first time; its exact value with the second of the last time; then the exact
    last time with a block of about a million ids. Copies of a row that differ in nothing
    but the id are split by the last level.
    """
    first, last = times[0], times[-1]
    exact = {} if first == last else {"__at": instant(first)}
    block = F.coalesce(F.shiftright(id_column, 20), F.lit(-(2**62)))
    return [
        {"__day": instant(first, "day")},
        {**exact, "__second": instant(last, "second")},
        {"__exact": instant(last), "__block": block},
    ]


def prefix_before(
    df: DataFrame,
    keys: list[str],
    levels: list[dict[str, Column]],
    order: list[str],
    values: dict[str, tuple[str, Column] | Mark],
    start: DataFrame | None = None,
    task_rows: int = TASK_ROWS,
    same_rows: DataFrame | None = None,
) -> DataFrame:
    """Add, per row, aggregates of the rows of the same key that come before it.

    Rows with a NULL key are one key like any other. ``levels`` name the buckets from coarse to fine; their columns
    must not be NULL and must agree with ``order`` (rows of an earlier bucket come first).
    ``values`` maps a new column to ``("sum" | "max", expression)`` or to a :class:`Mark` of a sum that does not fall.
    ``start`` holds one row per key with a starting value per new column, e.g. counters stored by an
    earlier load. A sum starts at 0, a max and a mark at NULL. ``same_rows`` are the rows of ``df`` before columns were
    added to them: keys are counted there, which spares computing those columns for it.
    """
    result = [*df.columns, *values]
    kinds = {f.name: f.dataType for f in df.schema}
    # As a struct a key is never NULL: it joins with itself, and is cut into buckets if it is large.
    key = F.struct(*keys)
    df = df.withColumn("__key", key)
    same_rows = None if same_rows is None else same_rows.withColumn("__key", key)
    if start is not None:
        own = F.struct(*[F.col(c).cast(kinds[c]).alias(c) for c in keys])
        start = start.select(own.alias("__key"), *values)
    keys = ["__key"]
    inputs = {name: f"__in_{name}" for name in values}
    buckets = {c: expr for level in levels for c, expr in level.items()}
    names = [list(level) for level in levels]
    upto = [keys + [c for part in names[: i + 1] for c in part] for i in range(len(names))]

    marks = {n: value for n, value in values.items() if isinstance(value, Mark)}
    plain = {n: value for n, value in values.items() if n not in marks}
    rows = df.withColumns({inputs[n]: expr for n, (_, expr) in plain.items()})
    # A row is a bucket of one row: a mark is a place within its bucket, NULL if there is none.
    rows = rows.withColumns({inputs[n]: F.when(m.flag, F.col(inputs[m.of])) for n, m in marks.items()})
    counts = (df if same_rows is None else same_rows).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n")
    )
    large = counts.where(F.col("__n") > task_rows).orderBy(F.desc("__n"), *keys)
    large = large.limit(MOST_LARGE).select(*keys)

    def before(bucketed: DataFrame, partition: list[str], ordering: list[str]) -> DataFrame:
        """Add what comes before each row or bucket within the bucket around it."""
        frame = (
            Window.partitionBy(*partition)
            .orderBy(*ordering)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        sums = {f"__here_{n}": _AGG[kind](inputs[n]).over(frame) for n, (kind, _) in plain.items()}
        places = {
            f"__here_{n}": F.max(_zero(F.col(f"__here_{m.of}")) + F.col(inputs[n])).over(frame)
            for n, m in marks.items()
        }
        bucketed = bucketed.withColumns(sums)
        return bucketed.withColumns(places) if places else bucketed

    def merged(n: str, carried: bool) -> Column:
        """What comes before within the bucket, and before the bucket."""
        here, carry = F.col(f"__here_{n}"), F.col(f"__carry_{n}")
        if n in marks:
            if not carried:
                return here
            return F.coalesce(_zero(F.col(f"__carry_{marks[n].of}")) + here, carry)
        if values[n][0] == "sum":
            return _zero(here) + _zero(carry) if carried else _zero(here)
        return F.greatest(here, carry) if carried else here

    # Bucket totals of the large keys, the coarser ones from the finer ones. Sums and maxima
    # need no order; for a mark the parts of a bucket are put in order.
    source = rows.join(F.broadcast(large), keys, "left_semi").withColumns(buckets)
    totals: list[DataFrame] = []
    for columns, inner in zip(reversed(upto), reversed([*names[1:], order]), strict=True):
        aggs = [_AGG[kind](inputs[n]).alias(inputs[n]) for n, (kind, _) in plain.items()]
        if marks:
            source = before(source, columns, inner)
        aggs += [
            F.max(_zero(F.col(f"__here_{m.of}")) + F.col(inputs[n])).alias(inputs[n])
            for n, m in marks.items()
        ]
        source = source.groupBy(*columns).agg(*aggs)
        totals.insert(0, source)

    # What comes before each bucket.
    carry = start
    for i, columns in enumerate(upto):
        parents = keys if i == 0 else upto[i - 1]
        here = before(totals[i], parents, names[i])
        carried = carry is not None
        if carried:
            outer = carry.select(*parents, *[F.col(n).alias(f"__carry_{n}") for n in values])
            here = here.join(outer, parents, "left")
        carry = here.select(*columns, *[merged(n, carried).alias(n) for n in values])

    # Rows of other keys keep one value in all bucket columns: their bucket is the key.
    last = upto[-1]
    flagged = rows.join(F.broadcast(large.withColumn("__large", F.lit(True))), keys, "left")
    bucket_types = df.select(*[expr.alias(c) for c, expr in buckets.items()]).schema
    whole = {
        f.name: F.lit(_FIRST if f.dataType.typeName().startswith("timestamp") else 0).cast(f.dataType)
        for f in bucket_types
    }
    bucketed = flagged.withColumns(
        {c: F.when(F.col("__large"), expr).otherwise(whole[c]) for c, expr in buckets.items()}
    )
    if start is not None:
        small = start.join(F.broadcast(large), keys, "left_anti").withColumns(whole)
        carry = carry.unionByName(small.select(*last, *values))
    outer = carry.select(*last, *[F.col(n).alias(f"__carry_{n}") for n in values])
    return (
        before(bucketed, last, order)
        .join(outer, last, "left")
        .select(
            *[F.col(c) for c in result if c not in values],
            *[merged(n, True).alias(n) for n in values],
        )
    )
