"""Regular expressions over bytes as transition arrays.

A pattern is read into a tree, the tree becomes a nondeterministic automaton, and subset
construction with minimisation makes it deterministic. Bytes that no pattern tells apart
share a class, so an automaton is an array of states by classes.

Patterns may hold literal characters, ``.``, classes (``[a-f]``, ``[^"]``), escapes (``\\.``, ``\\x20``, ``\\d``, ``\\w``,
``\\s``, of ASCII), groups, ``(?i:...)`` for ASCII letters of either case, ``|``, and ``?``, ``*``, ``+``, ``{m,n}``.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

_ALL = (1 << 256) - 1
_ESCAPES = {"d": "0-9", "w": "A-Za-z0-9_", "s": " \\x09-\\x0D", "n": "\\x0A", "t": "\\x09", "r": "\\x0D"}


def _span(low: int, high: int) -> int:
    return (1 << high + 1) - (1 << low)


@dataclass(frozen=True)
class Node:
    """``bytes`` (a set as 256 bits), or ``all`` / ``any`` of ``parts``, or ``parts[0]`` repeated."""

    kind: str
    bytes: int = 0
    parts: tuple[Node, ...] = ()
    least: int = 0
    most: int | None = None


class _Reader:
    def __init__(self, pattern: str):
        self.rest, self.pattern = pattern, pattern

    def fail(self, why: str) -> ValueError:
        return ValueError(f"{why} in {self.pattern!r}")

    def take(self, expression: str) -> re.Match | None:
        found = re.match(expression, self.rest)
        if found:
            self.rest = self.rest[found.end() :]
        return found

    def choice(self, fold: bool = False) -> Node:
        parts = [self.sequence(fold)]
        while self.take(r"\|"):
            parts.append(self.sequence(fold))
        return parts[0] if len(parts) == 1 else Node("any", parts=tuple(parts))

    def sequence(self, fold: bool) -> Node:
        parts = []
        while self.rest and self.rest[0] not in "|)":
            node = self.item(fold)
            while times := self.take(r"[?*+]|\{(\d+)(,?)(\d*)\}"):
                if times[1] is None:
                    least, most = int(times[0] == "+"), 1 if times[0] == "?" else None
                else:
                    least = int(times[1])
                    most = int(times[3]) if times[3] else None if times[2] else least
                node = Node("times", parts=(node,), least=least, most=most)
            parts.append(node)
        return Node("all", parts=tuple(parts))

    def item(self, fold: bool) -> Node:
        if group := self.take(r"\((\?i:|\?:|(?!\?))"):
            node = self.choice(fold or group[1] == "?i:")
            if not self.take(r"\)"):
                raise self.fail("open group")
            return node
        if self.take(r"\["):
            flip, chosen = self.take(r"\^"), 0
            first = True
            while first or not self.take(r"\]"):
                first = False
                low = self.one()
                if (dash := self.take(r"-(?!\])")) and low.bit_count() == 1:
                    high = self.one()
                    chosen |= _span(low.bit_length() - 1, high.bit_length() - 1)
                else:
                    chosen |= low | (1 << ord("-") if dash else 0)
            chosen = self.folded(chosen, fold)
            return Node("bytes", _ALL & ~chosen if flip else chosen)
        if self.take(r"\."):
            return Node("bytes", _ALL & ~(1 << 10))
        if self.rest[0] in "?*+{":
            raise self.fail("nothing to repeat")
        return Node("bytes", self.folded(self.one(), fold))

    def one(self) -> int:
        """The set of the next character or escape."""
        if code := self.take(r"\\x([0-9A-Fa-f]{2})"):
            return 1 << int(code[1], 16)
        if name := self.take(r"\\([dwsntr])"):
            inner = _Reader(f"[{_ESCAPES[name[1]]}]")
            return inner.item(False).bytes
        found = self.take(r"\\([^A-Za-z0-9])|([^\\])")
        if not found:
            raise self.fail("unknown escape or end")
        char = ord(found[1] or found[2])
        if char > 127:
            raise self.fail("a character beyond ASCII")
        return 1 << char

    @staticmethod
    def folded(chosen: int, fold: bool) -> int:
        if fold:
            upper, lower = chosen & _span(65, 90), chosen & _span(97, 122)
            chosen |= upper << 32 | lower >> 32
        return chosen


def parse(pattern: str) -> Node:
    reader = _Reader(pattern)
    node = reader.choice()
    if reader.rest:
        raise reader.fail("unmatched parenthesis")
    return node


def reversed_node(node: Node) -> Node:
    """Matches the same strings read backwards."""
    parts = tuple(reversed_node(p) for p in node.parts)
    return Node(node.kind, node.bytes, parts[::-1] if node.kind == "all" else parts, node.least, node.most)


class _Nfa:
    """States with edges that read nothing, and at most one that reads a byte of a set."""

    def __init__(self) -> None:
        self.free: list[list[int]] = []
        self.edge: list[tuple[int, int] | None] = []

    def state(self) -> int:
        self.free.append([])
        self.edge.append(None)
        return len(self.free) - 1

    def add(self, node: Node, begin: int) -> int:
        """Appends ``node`` after the state ``begin``; returns the state at its end."""
        if node.kind == "bytes":
            end = self.state()
            read = self.state()
            self.free[begin].append(read)
            self.edge[read] = (node.bytes, end)
            return end
        if node.kind == "all":
            for part in node.parts:
                begin = self.add(part, begin)
            return begin
        if node.kind == "any":
            end = self.state()
            for part in node.parts:
                self.free[self.add(part, begin)].append(end)
            return end
        (part,) = node.parts
        for _ in range(node.least):
            begin = self.add(part, begin)
        end = self.state()
        self.free[begin].append(end)
        if node.most is None:
            loop = self.state()
            self.free[begin].append(loop)
            after = self.add(part, loop)
            self.free[after] += [loop, end]
        else:
            for _ in range(node.most - node.least):
                begin = self.add(part, begin)
                self.free[begin].append(end)
        return end

    def closure(self, states: set[int]) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for other in self.free[todo.pop()]:
                if other not in found:
                    found.add(other)
                    todo.append(other)
        return frozenset(s for s in found if self.edge[s] is not None or not self.free[s])


@dataclass(frozen=True)
class Automaton:
    """``step[state, class]`` is the next state, ``accept[state]`` has bit i if pattern i ends
    there. State 0 is the start. ``classes`` maps bytes to classes; the last class of ``step`` stands
    for the end of a text and leads to the start. ``dead`` is the state without return, or -1."""

    classes: bytes
    step: np.ndarray
    accept: np.ndarray
    dead: int


def compiled(nodes: list[Node], anchored: bool) -> Automaton:
    """One automaton for all patterns; unless ``anchored``, a match may begin at any byte."""
    nfa = _Nfa()
    begins = [nfa.state() for _ in nodes]
    ends = {nfa.add(node, begin): i for i, (node, begin) in enumerate(zip(nodes, begins, strict=True))}
    start = nfa.closure(set(begins))
    if start & ends.keys():
        raise ValueError("a pattern that matches the empty string")
    # Bytes in the same sets share a class.
    sets = sorted({edge[0] for edge in nfa.edge if edge})
    marks = [tuple(s >> byte & 1 for s in sets) for byte in range(256)]
    number = {mark: i for i, mark in enumerate(dict.fromkeys(marks))}
    classes = bytes(number[m] for m in marks)
    samples = [classes.index(c) for c in range(len(number))]

    found, todo, rows = {start: 0}, [start], []
    while todo:
        here = todo.pop(0)
        row = []
        for byte in samples:
            reached = {nfa.edge[s][1] for s in here if nfa.edge[s] and nfa.edge[s][0] >> byte & 1}
            after = nfa.closure(reached if anchored else reached | set(begins))
            if after not in found:
                found[after] = len(found)
                todo.append(after)
            row.append(found[after])
        rows.append([*row, 0])
    accept = np.array([sum(1 << ends[s] for s in own if s in ends) for own in found], np.uint32)
    step, accept = minimised(np.array(rows), accept)
    if len(step) > 1 << 16:
        raise ValueError(f"{len(step)} states; write long repeats as a least length of the rule")
    loops = np.flatnonzero((step[:, :-1] == np.arange(len(step))[:, None]).all(axis=1) & (accept == 0))
    return Automaton(classes, step.astype(np.uint16), accept, int(loops[0]) if anchored and len(loops) else -1)


def minimised(step: np.ndarray, accept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Puts together states that nothing read afterwards tells apart; state 0 stays first."""
    group = np.unique(accept, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([group, group[step]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == group.max():
            break
        group = finer
    # Number the groups in the order of their first states.
    first = np.unique(group, return_index=True)[1]
    order = np.empty(len(first), np.int64)
    order[np.argsort(first)] = np.arange(len(first))
    kept = np.sort(first)
    return order[group[step[kept]]], accept[kept]


def scanner(automaton: Automaton, lanes: int = 4096) -> Callable[[bytes, int], tuple[np.ndarray, np.ndarray, int]]:
    """A function from classes of bytes and a state to (places after which patterns end, which, state).

    The bytes are cut into lanes that are read side by side, each from the start state. Where a
    lane ends in another state, the next one is read again from there until both readings agree.
    """
    width = automaton.step.shape[1]
    flat, accept = automaton.step.ravel().astype(np.int32), automaton.accept
    rows = automaton.step.tolist()

    def scan(data: bytes, state: int) -> tuple[np.ndarray, np.ndarray, int]:
        length = max(64, -(-len(data) // lanes))
        n = -(-len(data) // length)
        codes = np.zeros(n * length, np.uint8)
        codes[: len(data)] = np.frombuffer(data, np.uint8)
        columns = np.ascontiguousarray(codes.reshape(n, length).T)
        states = np.zeros((length, n), np.uint16)
        here = np.zeros(n, np.int32)
        here[:1] = state
        for i in range(length):
            here = flat[here * width + columns[i]]
            states[i] = here
        states = np.ascontiguousarray(states.T).ravel()
        for begin in range(length, len(data), length):
            state = int(states[begin - 1])
            if state == 0:
                continue
            for i in range(begin, min(begin + length, len(data))):
                state = rows[state][data[i]]
                if states[i] == state:
                    break
                states[i] = state
        states = states[: len(data)]
        ended = accept[states]
        places = np.flatnonzero(ended)
        return places + 1, ended[places], int(states[-1]) if len(states) else state

    return scan


def longest(automaton: Automaton) -> Callable[[bytes, int, int], int]:
    """A function from (bytes, begin, end) to where the longest match from ``begin`` ends, or -1."""
    rows = [[row[c] for c in automaton.classes] for row in automaton.step.tolist()]
    ends, dead = (automaton.accept > 0).tolist(), automaton.dead

    def match(data: bytes, begin: int, end: int) -> int:
        state, last = 0, -1
        for place in range(begin, end):
            state = rows[state][data[place]]
            if state == dead:
                break
            if ends[state]:
                last = place + 1
        return last

    return match


def longest_back(automaton: Automaton) -> Callable[[bytes, int, int], int]:
    """The same for an automaton of reversed patterns, from ``end`` back to ``begin``."""
    rows = [[row[c] for c in automaton.classes] for row in automaton.step.tolist()]
    ends, dead = (automaton.accept > 0).tolist(), automaton.dead

    def match(data: bytes, begin: int, end: int) -> int:
        state, last = 0, -1
        for place in range(end - 1, begin - 1, -1):
            state = rows[state][data[place]]
            if state == dead:
                break
            if ends[state]:
                last = place
        return last

    return match
