"""Repaired conversations against a plain search over all edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from studiolens.llm import catalog, repair

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
NEXT = {"s": {"": "s"}, "u": {"": "u", "s": "u", "a": "u"}, "a": {"u": "a"}}


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def plain_faults(rows):
    """Rows of one conversation in order, each with its first fault."""
    digest = lambda text: hashlib.md5(text.encode()).digest()
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3][:32].encode(), digest(r[3])))
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.strip(SPACE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def plain_repair(rows):
    """Dijkstra over (cost, audit): the first whole state taken from the heap is the answer."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, last, lines = heapq.heappop(heap)
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(rows) and last in ("", "a"):
            return cost, audit, list(lines)
        for initial, role in (("u", "user"), ("a", "assistant")):
            if last in NEXT[initial]:
                heapq.heappush(heap, (cost + 3, audit + "I", at, initial, (*lines, f"{role}:")))
        if at == len(rows):
            continue
        role, text, fault = rows[at]
        heapq.heappush(heap, (cost + 4, audit + "D", at + 1, last, lines))
        if fault in ("blank", "duplicate"):
            continue
        more = 3 if fault == "truncated" else 0
        for initial, name in (("u", "user"), ("a", "assistant")):
            if last in NEXT[initial]:
                heapq.heappush(heap, (cost + 3 + more, audit + "R", at + 1, initial, (*lines, f"{name}:{text}")))
        if role[:1] in NEXT and last in NEXT[role[:1]]:
            heapq.heappush(heap, (cost + more, audit + "K", at + 1, role[0], (*lines, f"{role}:{text}")))


def plain(rows):
    """The contract's rows."""
    groups = {row[0]: [] for row in rows}
    for row in plain_damage(rows):
        groups[row[0]].append(row)
    out = {}
    for conv, own in groups.items():
        turns = {r[1] for r in own} - {None}
        marked = plain_faults(own)
        faults, initials = [f for _, _, f in marked], [r[:1] for r, _, _ in marked]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit, lines = plain_repair(marked)
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, sha)
    return out


def result(df):
    columns = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[c] for c in columns) for r in rows}


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").collect()]
    assert result(catalog.op13_conversation_repair(spark, "/root/testdata/sf0.01")) == plain(rows)


def stored(spark, tmp_path, rows):
    # A clashing column in the table must not matter.
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("digest", "kind", "place", "audit", "c", "row")})
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    return str(tmp_path)


def random_rows(draw, conversations, length):
    texts = ["Yes.", "no", "Why?", " ", "", "ok!\n", "…", "a. b", "Yes.", None, "\x1c", "x" * 40 + ".", "x" * 40 + "y"]
    roles = ["system", "user", "assistant", "assistant", "user", "tool", "", "User", None]
    rows = []
    for conv in range(conversations):
        turns = [draw.choice([*range(30), None]) if draw.random() < 0.2 else t for t in range(draw.randrange(1, length))]
        rows += [(conv if conv else None, t, draw.choice(roles), draw.choice(texts)) for t in turns]
    return rows


def test_nulls_ties_and_odd_rows(spark, tmp_path):
    rows = random_rows(random.Random(5), 150, 12)
    rows += rows[:20]
    assert result(catalog.op13_conversation_repair(spark, stored(spark, tmp_path, rows))) == plain(rows)


def test_hot_conversation_in_small_chunks(spark):
    """A conversation of a third of all rows over many tasks, cut every few symbols."""
    draw = random.Random(6)
    rows = [(7, t, draw.choice(["user", "assistant", "assistant", "tool"]), f"{draw.randrange(900)}" + draw.choice(["", ".", "?"])) for t in range(600)]
    rows += [(9, 3, "user", "again.")] * 100
    rows += [(100 + i, t, "user", "Hm.") for i in range(50) for t in range(3)]
    want = plain(rows)
    df = repair.damaged(spark.createDataFrame(rows, SCHEMA))
    for chunk, shared in ((1, 3), (7, 50), (64, 10**6)):
        report = repair.report(df, chunk, shared).cache()
        got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) for r in report.collect()}
        assert got == {c: w[:-1] for c, w in want.items() if c in got}
        assert set(want) - set(got) == {c for c, w in want.items() if w[6] == ""}
    shas = {r.conv_id: r.sha256 for r in repair.digests(repair.repaired(df, report)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert {c: shas.get(c, empty) for c in want} == {c: w[-1] for c, w in want.items()}


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Hi."), (1, 3, "user", " ")]
    df = spark.createDataFrame(rows, SCHEMA)
    report = repair.report(df)
    (one,) = report.collect()
    assert (one.cost, one.audit) == (10, "KIKKDI")  # D sorts before I
    assert [tuple(r)[1:] for r in repair.repaired(df, report).collect()] == [
        (0, "K", "system", "Be brief."), (1, "I", "user", ""), (2, "K", "assistant", "Hello."),
        (3, "K", "user", "Hi."), (4, "I", "assistant", ""),
    ]


@pytest.mark.parametrize("seed", range(4))
def test_grammar_expands_to_its_sequences(seed):
    draw = random.Random(seed)
    sequences = [bytes(draw.choice([4, 4, 8, 5]) for _ in range(draw.randrange(1, 60))) for _ in range(40)] + [bytes([4] * 101)]
    rules, left = repair.grammar(sequences)

    def expand(symbol):
        return bytes([symbol]) if symbol < 16 else expand(rules[symbol - 16][0]) + expand(rules[symbol - 16][1])

    assert [b"".join(map(expand, x)) for x in left] == sequences
    assert rules
    assert sum(map(len, left)) < sum(map(len, sequences)) / 2


def test_empty_table(spark, tmp_path):
    assert result(catalog.op13_conversation_repair(spark, stored(spark, tmp_path, []))) == {}
