"""Repair of the turn structure of conversations at the least cost.

A conversation is read as a sequence of symbols, one per row: the initial of its role and its
first fault. The cheapest edits that give an allowed order of roles are a shortest path
through four states, so a symbol is a four by four matrix: per state before and after it the
least cost and, among equal costs, the least audit (the letters of the edits). Such matrices are multiplied with
(+, min) on costs; audits are ropes that share their parts.

Different sequences are solved once. A task takes many of them, builds a grammar over them by
Re-Pair (frequent neighbours become a symbol, again and again), computes one matrix per rule from the bottom up, and
a sequence is the product of the few symbols that are left of it. Two audits of equal cost
between the same states are never a proper prefix of one another, as the longer one would hold more
inserted rows and cost more; so the least of a product is made of the least of its factors.

Rows are sorted with a range shuffle and cut into sequences of at most ``CHUNK`` symbols, so a
conversation of any length is spread over tasks; texts do not travel with the symbols. The chunks of such a conversation are
put together by a stream that holds four audits. Writing out repaired rows, or their digest, follows the order
of a conversation, so one task streams all its rows, sorted on disk; it holds one batch and the audit.

Defined cases: a null role or text is one blank; rows of the same turn are ordered by role, then by the first 32 characters
of their text, then by its digest; rows without a turn come first; a null conv_id is a conversation like any other; a
role without s, u or a as its first letter fits nowhere and is edited. Texts count as equal if their 128-bit digests
are. An empty table gives no rows. Other columns of the input are left out.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studiolens.llm.shared import SPACE, staged

KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
TRUNCATED = 3

# Faults in the order in which the first one counts, after 0 for none.
_TRUNCATED, _BLANK, _DUPLICATE = 1, 2, 3

# States: nothing yet, after the system row, after a user row, after an assistant row. An empty
# conversation and one that ends with an assistant row are whole.
_STATES, _WHOLE = 4, (0, 3)
_AFTER = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
_ROLES = {"u": "user", "a": "assistant"}
_LEGAL = {(0, 1), (1, 2), (2, 1)}  # su, ua, au

# Symbols of one sequence, and of the sequences that share a grammar; neither changes a result.
CHUNK = 4096
SHARED = 1_000_000
_ROUNDS = 64


class Rope:
    """A text made of two others; its letters are put together when they are first asked for."""

    __slots__ = ("left", "right", "text")

    def __init__(self, left: Rope | None, right: Rope | None, text: str | None = None):
        self.left, self.right, self.text = left, right, text

    def letters(self) -> str:
        if self.text is None:
            parts, todo = [], [self]
            while todo:
                rope = todo.pop()
                if rope.text is None:
                    todo += [rope.right, rope.left]
                else:
                    parts.append(rope.text)
            self.text, self.left, self.right = "".join(parts), None, None
        return self.text

    def __lt__(self, other: Rope) -> bool:
        return self.letters() < other.letters()


Entry = tuple[int, Rope]  # cost and audit; None where there is no way
Matrix = list[list[Entry | None]]


def _better(new: Entry, old: Entry | None) -> bool:
    return old is None or new[0] < old[0] or (new[0] == old[0] and new[1] < old[1])


def times(left: list[list[Entry | None]], right: Matrix) -> list[list[Entry | None]]:
    """(+, min) product; ``left`` may have any number of rows."""
    out: list[list[Entry | None]] = []
    for row in left:
        best: list[Entry | None] = [None] * _STATES
        for middle, here in enumerate(row):
            if here is None:
                continue
            for to, there in enumerate(right[middle]):
                if there is None:
                    continue
                cost, old = here[0] + there[0], best[to]
                if old is None or cost <= old[0]:
                    new = (cost, Rope(here[1], there[1]))
                    if _better(new, old):
                        best[to] = new
        out.append(best)
    return out


def _inserted() -> Matrix:
    """Rows inserted at one place: none, one or two."""
    table: Matrix = [[None] * _STATES for _ in range(_STATES)]
    for begin in range(_STATES):
        state = begin
        for count in range(3):
            if table[begin][state] is None:
                table[begin][state] = (INSERT * count, Rope(None, None, "I" * count))
            state = _AFTER["a" if state == 2 else "u"][state]
    return table


def symbol_matrix(symbol: int) -> Matrix:
    """Rows inserted before a row, then its own edit. The symbol is 4 x place of the initial in "sua" + fault."""
    role, fault = divmod(symbol, 4)
    own: Matrix = [[None] * _STATES for _ in range(_STATES)]

    def put(state: int, to: int, cost: int, letter: str) -> None:
        new = (cost, Rope(None, None, letter))
        if _better(new, own[state][to]):
            own[state][to] = new

    for state in range(_STATES):
        put(state, state, DELETE, "D")
        if fault in (_BLANK, _DUPLICATE):
            continue
        more = TRUNCATED if fault == _TRUNCATED else 0
        for initial in "ua":
            if state in _AFTER[initial]:
                put(state, _AFTER[initial][state], REROLE + more, "R")
        if role < 3 and state in _AFTER["sua"[role]]:
            put(state, _AFTER["sua"[role]][state], KEEP + more, "K")
    return times(_inserted(), own)


_START: list[Entry | None] = [(0, Rope(None, None, "")), None, None, None]


def finished(reached: list[Entry | None]) -> Entry:
    """The cheapest whole end from what was reached per state."""
    (ends,) = times([reached], _inserted())
    best = None
    for state in _WHOLE:
        if ends[state] is not None and _better(ends[state], best):
            best = ends[state]
    return best


def grammar(sequences: list[bytes], rounds: int = _ROUNDS) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Re-Pair over all sequences: (pair of symbols per rule, what is left of each sequence).

    Rule i is symbol 16 + i. A round takes the most frequent pairs that share no symbol, so
    that they can be replaced together.
    """
    parts = [np.frombuffer(s, np.uint8).astype(np.int64) for s in sequences]
    text = np.concatenate([x for p in parts for x in (p, [-1])]) if parts else np.zeros(0, np.int64)
    rules: list[tuple[int, int]] = []
    for _ in range(rounds):
        left, right = text[:-1], text[1:]
        at = np.flatnonzero((left >= 0) & (right >= 0))
        width = 16 + len(rules)
        codes, counts = np.unique(left[at] * width + right[at], return_counts=True)
        order = np.argsort(-counts, kind="stable")
        used: set[int] = set()
        chosen = []
        for code in codes[order[counts[order] > 1]].tolist():
            pair = divmod(code, width)
            if used.isdisjoint(pair):
                used.update(pair)
                chosen.append((code, pair))
        if not chosen:
            break
        chosen.sort()
        named = np.array([code for code, _ in chosen])
        place = np.minimum(np.searchsorted(named, left[at] * width + right[at]), len(named) - 1)
        hit = named[place] == left[at] * width + right[at]
        at, place = at[hit], place[hit]
        # Of a run of one symbol every second pair.
        begins = np.concatenate([[True], np.diff(at) > 1])
        run = np.flatnonzero(begins)[np.cumsum(begins) - 1] if len(at) else at
        even = (np.arange(len(at)) - run) % 2 == 0
        at, place = at[even], place[even]
        text[at] = width + place
        rules += [pair for _, pair in chosen]
        text = np.delete(text, at + 1)
    ends = np.flatnonzero(text == -1).tolist()
    begins = [0, *[e + 1 for e in ends]]
    return rules, [text[a:b].tolist() for a, b in zip(begins, ends, strict=False)]


def solved(sequences: list[bytes], whole: list[bool]) -> Iterator[tuple[Entry, Matrix | None]]:
    """Per sequence its cheapest repair and, unless it is a ``whole`` conversation, its matrix."""
    rules, left = grammar(sequences)
    matrices = [symbol_matrix(s) for s in range(16)]
    for a, b in rules:
        matrices.append(times(matrices[a], matrices[b]))
    nothing: Matrix = [[(0, Rope(None, None, "")) if a == b else None for b in range(_STATES)] for a in range(_STATES)]
    for symbols, complete in zip(left, whole, strict=True):
        table = [_START] if complete else nothing
        for symbol in symbols:
            table = times(table, matrices[symbol])
        yield finished(table[0]), None if complete else table


def counts_of(symbols: bytes) -> tuple[int, int, int, int]:
    """Blank, duplicate and truncated rows, and neighbours whose roles do not follow each other."""
    roles, faults = [s >> 2 for s in symbols], [s & 3 for s in symbols]
    illegal = sum(pair not in _LEGAL for pair in zip(roles, roles[1:], strict=False))
    return faults.count(_BLANK), faults.count(_DUPLICATE), faults.count(_TRUNCATED), illegal


class Ends:
    """The cheapest way to each state through the chunks so far, put together chunk by chunk.

    Of each two ways only what follows their common beginning is compared: one letter each
    once they differ, else the rows that one has inserted at its end.
    """

    def __init__(self) -> None:
        self.costs: list[int | None] = [0, None, None, None]
        self.pieces: list[tuple | None] = [(), None, None, None]
        self.rests = {(a, b): ("", "") for a in range(_STATES) for b in range(_STATES)}

    def add(self, costs: list[int | None], audits: list[str | None]) -> None:
        new: list[tuple[int, int, str] | None] = [None] * _STATES
        for to in range(_STATES):
            for middle in range(_STATES):
                there = costs[_STATES * middle + to]
                if self.costs[middle] is None or there is None:
                    continue
                cost, piece = self.costs[middle] + there, audits[_STATES * middle + to]
                old = new[to]
                if old is not None and cost == old[0]:
                    own, other = self.rests[middle, old[1]]
                    if own + piece >= other + old[2]:
                        continue
                elif old is not None and cost > old[0]:
                    continue
                new[to] = (cost, middle, piece)
        rests = {}
        for a, one in enumerate(new):
            for b, two in enumerate(new):
                if one is None or two is None:
                    continue
                own, other = self.rests[one[1], two[1]]
                own, other = own + one[2], other + two[2]
                same = len(os.path.commonprefix((own, other))) if a != b else len(own)
                own, other = own[same:], other[same:]
                rests[a, b] = (own[:1], other[:1]) if own and other else (own, other)
        self.costs = [n and n[0] for n in new]
        self.pieces = [n and (self.pieces[n[1]], n[2]) for n in new]
        self.rests = rests

    def best(self) -> tuple[int, str]:
        entries: list[Entry | None] = []
        for cost, chain in zip(self.costs, self.pieces, strict=True):
            parts = []
            while chain:
                chain, piece = chain
                parts.append(piece)
            entries.append(None if cost is None else (cost, Rope(None, None, "".join(reversed(parts)))))
        cost, audit = finished(entries)
        return cost, audit.letters()


# --- tables ---------------------------------------------------------------------------


def _rows(conversations: DataFrame) -> DataFrame:
    """The columns that count, without nulls in role and text."""
    blank = F.lit(" ")
    return conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by ``crc32("conv_id:turn") % 20``, to repair them again.

    0 drops a row, 1 empties its text, 2 takes out full stops, exclamation and question marks, 3
    repeats it, 4 gives it to the user; others stay. A null conv_id, turn, role or text is one blank.
    """
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(name[0], F.lit(":"), name[1])) % 20
    rows = _rows(conversations).withColumn("kind", kind).where("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


ORDER = ["conv_id", "turn", "role", "head", "digest"]


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("head", F.substring("text", 1, 32)).withColumn("digest", F.unhex(F.md5("text")))


def _runs(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn as one: their number, the symbol of the first and of the others."""
    trimmed = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\f\r"))
    fault = F.when(trimmed == "", _BLANK).when(~F.substring(trimmed, -1, 1).isin(*".!?"), _TRUNCATED).otherwise(0)
    initial = F.substring("role", 1, 1)
    place = F.when(initial == "s", 0).when(initial == "u", 4).when(initial == "a", 8).otherwise(12)
    slim = _keyed(rows).select(*ORDER, place.alias("place"), fault.alias("fault"))
    runs = slim.groupBy(*ORDER, "place", "fault").agg(F.count(F.lit(1)).alias("n"))
    first = (
        runs.groupBy("conv_id", "role", "digest")
        .agg(F.min(F.struct(F.col("turn").isNotNull().alias("timed"), "turn")).alias("first"))
        .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), F.col("first.turn").alias("first"))
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    again = F.when(F.col("fault") == _BLANK, _BLANK).otherwise(_DUPLICATE)
    own = F.when(F.col("turn").eqNullSafe(F.col("first")), F.col("fault")).otherwise(again)
    return runs.join(first, same).select(
        *ORDER, (F.col("place") + own).alias("symbol"), (F.col("place") + again).alias("others"), "n"
    )


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def _sequences(runs: DataFrame, chunk: int) -> DataFrame:
    """Symbols in order, at most ``chunk`` a row: conv_id, part, number, symbols, whole.

    ``whole`` are conversations that begin and end within a part and fit a chunk.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        held, owner, started, kind = bytearray(), None, False, None
        # The first conversation of a part may go on from the one before.
        inner = False
        out: list[tuple] = []

        def close(last: bool) -> None:
            nonlocal number, inner
            out.append((owner, part, number, bytes(held), inner and last))
            number += 1
            held.clear()
            inner = last

        def add(symbol: int, times: int) -> None:
            while times:
                if len(held) == chunk:
                    close(False)
                taken = min(times, chunk - len(held))
                held.extend(bytes([symbol]) * taken)
                times -= taken

        def batch_of() -> pa.RecordBatch:
            columns = [pa.array([row[i] for row in out], t) for i, t in enumerate((kind, pa.int32(), pa.int64(), pa.binary(), pa.bool_()))]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "part", "number", "symbols", "whole"])

        for batch in batches:
            kind = batch.column(0).type
            for conv, symbol, others, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not started or conv != owner:
                    if started:
                        close(True)
                    owner, started = conv, True
                add(symbol, 1)
                add(others, n - 1)
            if out:
                yield batch_of()
        if started:
            # The last one may go on in the next part.
            inner = False
            close(True)
            yield batch_of()

    ordered = runs.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).select("conv_id", "symbol", "others", "n")
    return ordered.mapInArrow(
        cut, f"conv_id {_type(runs, 'conv_id')}, part int, number bigint, symbols binary, whole boolean"
    )


_SOLVED = (
    "symbols binary, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string,"
    " costs array<bigint>, audits array<string>"
)


def _solutions(sequences: DataFrame, shared: int) -> DataFrame:
    """Each different sequence solved once, many by one grammar."""
    different = sequences.groupBy("symbols").agg(F.min("whole").alias("whole"))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.binary(), *[pa.int64()] * 5, pa.string(), pa.list_(pa.int64()), pa.list_(pa.string())]
        names = [field.split()[0] for field in _SOLVED.split(", ")]

        def batch_of(group: list[tuple[bytes, bool]]) -> pa.RecordBatch:
            texts, whole = [s for s, _ in group], [w for _, w in group]
            rows = []
            for text, (best, table) in zip(texts, solved(texts, whole), strict=True):
                cells = [] if table is None else [cell for row in table for cell in row]
                rows.append(
                    (
                        text, *counts_of(text), best[0], best[1].letters(),
                        [c and c[0] for c in cells], [c and c[1].letters() for c in cells],
                    )
                )
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            return pa.RecordBatch.from_arrays(columns, names)

        group, held = [], 0
        for batch in batches:
            for text, whole in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                group.append((text, whole))
                held += len(text)
                if held >= shared:
                    yield batch_of(group)
                    group, held = [], 0
        if group:
            yield batch_of(group)

    return different.mapInArrow(solve, _SOLVED)


_REPORT = ("blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _joined(chunks: DataFrame) -> DataFrame:
    """The report of conversations in several chunks, read in order."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        owner, ends, sums, last, started = None, Ends(), [0] * 4, None, False
        out: list[tuple] = []

        def close() -> None:
            out.append((owner, *sums, *ends.best()))

        def batch_of() -> pa.RecordBatch:
            types = (kind, *[pa.int64()] * 5, pa.string())
            columns = [pa.array([row[i] for row in out], t) for i, t in enumerate(types)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["conv_id", *_REPORT])

        for batch in batches:
            kind = batch.column(0).type
            for conv, symbols, *counts, costs, audits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not started or conv != owner:
                    if started:
                        close()
                    owner, ends, sums, last, started = conv, Ends(), [0] * 4, None, True
                ends.add(costs, audits)
                sums = [a + b for a, b in zip(sums, counts, strict=True)]
                if last is not None and (last, symbols[0] >> 2) not in _LEGAL:
                    sums[3] += 1
                last = symbols[-1] >> 2
            if out:
                yield batch_of()
        if started:
            close()
            yield batch_of()

    columns = ["conv_id", "symbols", *_REPORT[:4], "costs", "audits"]
    ordered = chunks.repartition("conv_id").sortWithinPartitions("conv_id", "part", "number").select(*columns)
    fields = [f"conv_id {_type(chunks, 'conv_id')}", *[f"{c} bigint" for c in _REPORT[:5]], "audit string"]
    return ordered.mapInArrow(join, ", ".join(fields))


def report(conversations: DataFrame, chunk: int = CHUNK, shared: int = SHARED) -> DataFrame:
    """Per conversation with rows: ``gaps`` (turns missing between the first and the last), rows that are
    ``blank``, ``duplicate``, ``truncated``, neighbours with ``illegal`` roles, and the least ``cost``
    with its ``audit``."""
    runs = staged(_runs(_rows(conversations)), "runs")
    sequences = staged(_sequences(runs, chunk), "sequences")
    solutions = staged(_solutions(sequences, shared), "solutions")
    both = sequences.join(solutions, "symbols")
    whole = both.where("whole").select("conv_id", *_REPORT)
    found = whole.unionByName(_joined(both.where("!whole")))
    gaps = runs.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("bigint").alias("gaps")
    )
    gaps = gaps.withColumnRenamed("conv_id", "c")
    return found.join(gaps, F.col("conv_id").eqNullSafe(F.col("c"))).select("conv_id", "gaps", *_REPORT)


def repaired(conversations: DataFrame, reported: DataFrame) -> DataFrame:
    """The rows after the edits of ``reported``: conv_id, place (from 0), edit, role, text.

    A partition holds whole conversations, one after the other, in order.
    """

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        owner, audit, at, state, place, started = None, "", 0, 0, 0, False
        out: list[tuple] = []

        def put(letter: str, role: str, text: str) -> None:
            nonlocal state, place
            out.append((owner, place, letter, role, text))
            state, place = _AFTER[role[0]][state], place + 1

        def insert() -> None:
            nonlocal at
            while audit[at : at + 1] == "I":
                put("I", _ROLES["a" if state == 2 else "u"], "")
                at += 1

        def batch_of() -> pa.RecordBatch:
            types = (kind, pa.int64(), pa.string(), pa.string(), pa.string())
            columns = [pa.array([row[i] for row in out], t) for i, t in enumerate(types)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "place", "edit", "role", "text"])

        for batch in batches:
            kind = batch.column(0).type
            for conv, steps, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if steps is not None:
                    if started:
                        insert()
                    owner, audit, at, state, place, started = conv, steps, 0, 0, 0, True
                    continue
                insert()
                letter, at = audit[at], at + 1
                if letter != "D":
                    put(letter, role if letter == "K" else _ROLES["a" if state == 2 else "u"], text)
            if out:
                yield batch_of()
        if started:
            insert()
            if out:
                yield batch_of()

    rows = _keyed(_rows(conversations)).withColumn("audit", F.lit(None).cast("string")).withColumn("row", F.lit(1))
    heads = reported.select("conv_id", "audit").withColumn("row", F.lit(0))
    stream = rows.unionByName(heads, allowMissingColumns=True)
    ordered = stream.repartition("conv_id").sortWithinPartitions("conv_id", "row", *ORDER[1:])
    fields = f"conv_id {_type(rows, 'conv_id')}, place bigint, edit string, role string, text string"
    return ordered.select("conv_id", "audit", "role", "text").mapInArrow(edit, fields)


def digests(rows: DataFrame) -> DataFrame:
    """Per conversation ``sha256`` of its ``role:text`` lines, of rows as :func:`repaired` gives them."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, sha, out, kind = None, None, [], None

        def batch_of() -> pa.RecordBatch:
            columns = [pa.array([row[0] for row in out], kind), pa.array([row[1] for row in out], pa.string())]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "sha256"])

        for batch in batches:
            kind = batch.column(0).type
            for conv, place, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if place == 0:
                    if sha is not None:
                        out.append((owner, sha.hexdigest()))
                    owner, sha = conv, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            if out:
                yield batch_of()
        if sha is not None:
            out.append((owner, sha.hexdigest()))
            yield batch_of()

    return rows.select("conv_id", "place", "role", "text").mapInArrow(
        digest, f"conv_id {_type(rows, 'conv_id')}, sha256 string"
    )
