"""Regular expressions over bytes as one minimal deterministic automaton.

A rule is a small regular expression: literals, escapes, ``.``, classes, groups, ``|``, and the
repetitions ``? * + {m} {m,} {m,n}``. All are greedy, and none looks around. ``compile_rules`` builds one
nondeterministic automaton of all rules, makes it deterministic by subset construction and merges
equal states (Moore's refinement). The result is a transition array over byte classes, and a bit
mask of the rules that each state accepts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Tree of an expression: ("set", bytes) | ("cat", parts) | ("alt", parts) | ("rep", part, low, high or None)
Tree = tuple

ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "f": "\f", "v": "\v"}
NAMED = {"d": "0123456789", "w": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_", "s": " \t\n\r\f\v"}


class _Reader:
    """A recursive reader of one expression."""

    def __init__(self, source: str, ignore_case: bool):
        self.source, self.at, self.ignore_case = source, 0, ignore_case

    def peek(self) -> str:
        return self.source[self.at : self.at + 1]

    def take(self) -> str:
        char = self.peek()
        if not char:
            raise ValueError(f"{self.source!r} ends too early")
        self.at += 1
        return char

    def choice(self) -> Tree:
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def sequence(self) -> Tree:
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated(self.atom()))
        return ("cat", parts)

    def repeated(self, part: Tree) -> Tree:
        while self.peek() in ("?", "*", "+", "{") and self.peek():
            sign = self.take()
            if sign == "{":
                end = self.source.index("}", self.at)
                low, comma, high = self.source[self.at : end].partition(",")
                self.at = end + 1
                part = ("rep", part, int(low), int(high) if high else None if comma else int(low))
            else:
                part = ("rep", part, int(sign == "+"), 1 if sign == "?" else None)
        return part

    def atom(self) -> Tree:
        char = self.take()
        if char == "(":
            if self.source[self.at : self.at + 2] == "?:":
                self.at += 2
            inner = self.choice()
            if self.take() != ")":
                raise ValueError(f"{self.source!r}: a group stays open")
            return inner
        if char == "[":
            return ("set", self.charset())
        if char == ".":
            return ("set", frozenset(range(256)) - {10})
        if char in "?*+{":
            raise ValueError(f"{self.source!r}: nothing to repeat at {self.at}")
        members = self.escape() if char == "\\" else char.encode()
        if len(members) > 1 and char != "\\":  # a character of several bytes
            return ("cat", [("set", frozenset([b])) for b in members])
        return ("set", self.cased(members))

    def escape(self) -> bytes:
        char = self.take()
        if char == "x":
            code = self.take() + self.take()
            return bytes([int(code, 16)])
        return NAMED.get(char, ESCAPES.get(char, char)).encode()

    def charset(self) -> frozenset[int]:
        negated = self.peek() == "^"
        if negated:
            self.take()
        found: set[int] = set()
        first = True
        while first or self.peek() != "]":
            first = False
            char = self.take()
            low = self.escape() if char == "\\" else char.encode()
            if self.peek() == "-" and self.source[self.at + 1 : self.at + 2] != "]":
                self.take()
                char = self.take()
                high = self.escape() if char == "\\" else char.encode()
                found |= set(range(low[0], high[0] + 1))
            else:
                found |= set(low)
        self.take()
        return self.cased(frozenset(range(256)) - found if negated else found)

    def cased(self, members) -> frozenset[int]:
        found = set(members)
        if self.ignore_case:
            found |= {b ^ 32 for b in found if chr(b).isascii() and chr(b).isalpha()}
        return frozenset(found)


def read(source: str, ignore_case: bool = False) -> Tree:
    reader = _Reader(source, ignore_case)
    tree = reader.choice()
    if reader.peek():
        raise ValueError(f"{source!r}: {reader.peek()!r} at {reader.at} closes nothing")
    return tree


def mirrored(tree: Tree) -> Tree:
    """The expression of all reversed strings."""
    kind = tree[0]
    if kind == "set":
        return tree
    if kind == "rep":
        return ("rep", mirrored(tree[1]), *tree[2:])
    parts = [mirrored(part) for part in tree[1]]
    return (kind, parts[::-1] if kind == "cat" else parts)


class _States:
    """A nondeterministic automaton: moves on byte sets, and silent moves."""

    def __init__(self):
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.silent: list[list[int]] = []

    def new(self) -> int:
        self.moves.append([])
        self.silent.append([])
        return len(self.moves) - 1

    def build(self, tree: Tree, start: int) -> int:
        """Add ``tree`` from ``start``; returns where it ends."""
        kind = tree[0]
        if kind == "set":
            end = self.new()
            self.moves[start].append((tree[1], end))
            return end
        if kind == "cat":
            for part in tree[1]:
                start = self.build(part, start)
            return start
        if kind == "alt":
            end = self.new()
            for part in tree[1]:
                self.silent[self.build(part, start)].append(end)
            return end
        _, part, low, high = tree
        for _ in range(low):
            start = self.build(part, start)
        if high is None:
            loop = self.new()
            self.silent[start].append(loop)
            self.silent[self.build(part, loop)].append(loop)
            return loop
        end = self.new()
        self.silent[start].append(end)
        for _ in range(high - low):
            start = self.build(part, start)
            self.silent[start].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        found, open_ = set(states), list(states)
        while open_:
            for other in self.silent[open_.pop()]:
                if other not in found:
                    found.add(other)
                    open_.append(other)
        return frozenset(found)


@dataclass(frozen=True)
class Automaton:
    """``step[state * classes + of_byte[byte]]`` is the next state. Accepting states are the last ones:
    a state below ``first_accepting`` accepts no rule. ``accepts`` holds each state's rules as bits."""

    step: np.ndarray
    of_byte: np.ndarray
    classes: int
    start: int
    first_accepting: int
    accepts: np.ndarray
    dead: int  # the state that nothing leaves and that accepts nothing, or -1

    @property
    def states(self) -> int:
        return len(self.accepts)


def compile_rules(trees: list[Tree], anywhere: bool) -> Automaton:
    """The minimal automaton of all rules together. With ``anywhere`` a match may begin at any byte."""
    nfa = _States()
    root = nfa.new()
    ends = {}
    for rule, tree in enumerate(trees):
        start = nfa.new()
        nfa.silent[root].append(start)
        end = nfa.build(tree, start)
        ends[end] = ends.get(end, 0) | (1 << rule)
    sets = sorted({members for moves in nfa.moves for members, _ in moves}, key=sorted)
    marks = [tuple(byte in members for members in sets) for byte in range(256)]
    kinds = {mark: k for k, mark in enumerate(dict.fromkeys(marks))}
    of_byte = np.array([kinds[mark] for mark in marks], np.uint8)
    sample = [int(np.argmax(of_byte == k)) for k in range(len(kinds))]

    first = nfa.closure([root])
    number, open_, table = {first: 0}, [first], []
    for subset in open_:
        row = []
        for byte in sample:
            reached = [to for state in subset for members, to in nfa.moves[state] if byte in members]
            following = nfa.closure(reached + [root] if anywhere else reached)
            if following not in number:
                number[following] = len(number)
                open_.append(following)
            row.append(number[following])
        table.append(row)
    step = np.array(table)
    accepts = np.zeros(len(open_), np.int64)
    for subset, k in number.items():
        for state in subset:
            accepts[k] |= ends.get(state, 0)
    return _minimal(step, accepts, of_byte)


def _minimal(step: np.ndarray, accepts: np.ndarray, of_byte: np.ndarray) -> Automaton:
    """Merge states with equal behaviour: split groups by where their moves lead until none splits."""
    _, group = np.unique(accepts, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([group, group[step]]), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == group.max():
            break
        group = finer
    count = int(group.max()) + 1
    member = np.zeros(count, int)
    member[group] = np.arange(len(group))
    order = np.argsort(accepts[member] > 0, kind="stable")  # accepting groups last
    name = np.empty(count, int)
    name[order] = np.arange(count)
    merged = name[group[step[member[order]]]]
    accepted = accepts[member[order]]
    stuck = np.flatnonzero((merged == np.arange(count)[:, None]).all(axis=1) & (accepted == 0))
    classes = merged.shape[1]
    return Automaton(
        merged.astype(np.int32).ravel(), of_byte, classes, int(name[group[0]]), int((accepted == 0).sum()), accepted, int(stuck[0]) if len(stuck) else -1
    )


def forgetting_pairs(automaton: Automaton) -> np.ndarray:
    """For each pair of byte classes read one after the other: the one state they lead to from every
    state, or -1 where that depends on the state before. A scan may start afresh behind such a pair."""
    step = automaton.step.reshape(automaton.states, automaton.classes)
    found = np.full((automaton.classes, automaton.classes), -1, np.int32)
    for first in range(automaton.classes):
        reached = step[np.unique(step[:, first])]
        same = (reached == reached[0]).all(axis=0)
        found[first, same] = reached[0, same]
    return found
