"""Secrets in texts, found by one automaton for all rules.

The regexes of all rules are compiled into one deterministic automaton over bytes
(:mod:`studiolens.llm.automaton`). One pass over the bytes of many texts marks where a match of
any rule may end. From such a place the rule's reversed automaton gives the match's start, and its own the
longest end, so only the neighbourhood of a match is read again. Matches of a rule are
taken from left to right and do not overlap: the one that can end first, from its leftmost
start, as long as possible. Rules do not see each other, so matches of different ones may overlap.

Texts are read in slices of bounded size, the state is carried from one to the next, so a
text may be as long as a value can be. Nothing is shuffled; a lost task is done again.

Defined cases: null and empty texts hold nothing; repeated rows get the same spans; an empty table
gives no rows. Columns of the input are kept, ``spans`` is replaced. Places count code points, the end is exclusive;
spans are ordered by start, then in the order of the rules.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studiolens.llm.automaton import Automaton, compiled, longest, longest_back, parse, reversed_node, scanner


@dataclass(frozen=True)
class Rule:
    """``least`` counts the places at which a match may end: the first and those by which it
    was prolonged. For a pattern that ends in a repeated class it is the least length of that end.
    A match that has fewer is dropped, and what it covers is not searched again."""

    kind: str
    pattern: str
    least: int = 1


# Formats of keys, fixed values. Runs of hexadecimal digits need no prefix; their length is counted by
# the automaton, which is the same as dropping shorter runs and marks fewer places.
BASE = (
    Rule(
        "assign",
        "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9+/_.=-]+",
        6,
    ),
    Rule("access", "AKIA[A-Z0-9]+", 16),
    Rule("hex", "[0-9a-f]{24,}"),
)
# Each of these may go on inside another one, and the automaton holds all such states: 1891 with the
# four, but over thirty thousand with web tokens and logins, too.
MORE = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", 36),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 10),
    Rule("google", "AIza[A-Za-z0-9_-]+", 35),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + MORE

SPANS = "array<struct<kind:string,at:bigint,end:bigint>>"

# Bytes that are scanned at once.
SLICE = 4 << 20


@lru_cache(maxsize=8)
def tables(rules: tuple[Rule, ...]) -> tuple[Automaton, list[Automaton], list[Automaton]]:
    """The automaton of all rules, and each rule's own one forwards and backwards."""
    if len(rules) > 32:
        raise ValueError("an automaton tells 32 rules apart")
    nodes = [parse(rule.pattern) for rule in rules]
    forwards = [compiled([node], anchored=True) for node in nodes]
    backwards = [compiled([reversed_node(node)], anchored=True) for node in nodes]
    return compiled(nodes, anchored=False), forwards, backwards


class Scanner:
    """Finds the matches of ``rules``, compiled by :func:`tables`, in byte strings."""

    def __init__(self, rules: tuple[Rule, ...], automata: tuple, size: int = SLICE, lanes: int = 4096):
        together, forwards, backwards = automata
        self.rules, self.size = rules, size
        self._classes, self._between = together.classes, bytes([together.step.shape[1] - 1])
        self._scan = scanner(together, lanes)
        self._end = [longest(a) for a in forwards]
        self._start = [longest_back(a) for a in backwards]

    def matches(self, texts: list[bytes]) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """(index of the text, its (start, rule, end) in bytes) for texts with matches."""
        data = self._between.join([t.translate(self._classes) for t in texts])
        begins = np.cumsum([0, *[len(t) + 1 for t in texts]])
        places, marks, state = [], [], 0
        for at in range(0, len(data), self.size):
            found, which, state = self._scan(data[at : at + self.size], state)
            places.append(found + at)
            marks.append(which)
        if not places:
            return
        ends, which = np.concatenate(places), np.concatenate(marks)
        owner = np.searchsorted(begins, ends, side="right") - 1
        edges = np.flatnonzero(np.diff(owner, prepend=-1, append=-1))
        for low, high in zip(edges, edges[1:], strict=False):
            i = int(owner[low])
            spans = []
            for rule in range(len(self.rules)):
                own = ends[low:high][which[low:high] >> rule & 1 > 0] - begins[i]
                spans += self._of_rule(texts[i], rule, own.tolist())
            if spans:
                yield i, sorted(spans)

    def _of_rule(self, text: bytes, rule: int, ends: list[int]) -> Iterator[tuple[int, int, int]]:
        floor, least = 0, self.rules[rule].least
        for first in ends:
            if first <= floor:
                continue
            start = self._start[rule](text, floor, first)
            if start < 0:  # it would have to begin within the match before
                continue
            end = self._end[rule](text, start, len(text))
            floor = end
            if end - first + 1 >= least:
                yield start, rule, end


def code_points(text: bytes, places: list[int]) -> list[int]:
    """How many code points of a UTF-8 text lie before each place."""
    if text.isascii():
        return places
    first = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    return np.concatenate([[0], np.cumsum(first)])[places].tolist()


def spans_of(text: Column, rules: tuple[Rule, ...] = RULES, size: int = SLICE) -> Column:
    """The secrets of each text, as an array of (kind, at, end)."""
    automata = tables(rules)  # compiled once, by the driver; executors get the arrays

    @F.arrow_udf(SPANS)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scan = Scanner(rules, automata, size)
        names = [rule.kind for rule in rules]
        for batch in batches:
            found: list[list[dict]] = [[] for _ in range(len(batch))]
            for low, high in _slices(batch, size):
                texts = [t or b"" for t in batch.slice(low, high - low).cast(pa.binary()).to_pylist()]
                for i, spans in scan.matches(texts):
                    at = code_points(texts[i], [s for s, _, _ in spans])
                    to = code_points(texts[i], [e for _, _, e in spans])
                    rows = zip(spans, at, to, strict=True)
                    found[low + i] = [{"kind": names[rule], "at": a, "end": b} for (_, rule, _), a, b in rows]
            yield pa.array(found, _SPANS)

    return find(text)


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("at", pa.int64()), ("end", pa.int64())]))


def _slices(batch: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``size`` bytes of text each."""
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False)
    low, held = 0, 0
    for i, length in enumerate(lengths.tolist()):
        held += length
        if held >= size:
            yield low, i + 1
            low, held = i + 1, 0
    if low < len(lengths):
        yield low, len(lengths)


def with_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``spans``, the secrets of its text."""
    return docs.withColumn("spans", spans_of(F.col("text"), rules))


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with each secret of its text replaced by its kind in angle brackets.

    Where secrets overlap, the first one's kind stands for all they cover together.
    """

    @F.arrow_udf("string")
    def cut(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, spans in texts:
            pairs = zip(text.to_pylist(), spans.to_pylist(), strict=True)
            yield pa.array([_without(t, s) if s else t for t, s in pairs], pa.string())

    return with_secrets(docs, rules).withColumn("text", cut("text", "spans")).drop("spans")


def _without(text: str, spans: list[dict]) -> str:
    parts, to = [], 0
    for span in spans:
        if span["at"] >= to:
            parts += [text[to : span["at"]], f"<{span['kind']}>"]
        to = max(to, span["end"])
    return "".join([*parts, text[to:]])
