r"""Regular expressions as deterministic byte automata in transition arrays.

``parse`` reads the usual notation (literals, escapes, classes, groups,
``| * + ? {m,n}``) into a small tree over byte sets; a case-insensitive rule
folds ASCII letters. ``compile_rules`` builds one nondeterministic automaton
of all rules, makes it deterministic by subset construction, merges equal states
by partition refinement, and renumbers the rest so that accepting states come
last. Bytes that no rule tells apart share a column of the arrays.

Patterns are over bytes of UTF-8 text; ``.`` and negated classes take any byte
but those listed (``.`` all but a newline). A class lists ASCII characters only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EVERY = frozenset(range(256))
SETS = {"d": frozenset(b"0123456789"), "s": frozenset(b" \t\n\r\f\v"),
        "w": frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_")}
SIGNS = {"n": 10, "r": 13, "t": 9, "f": 12, "v": 11}
#: Copies that one counted repeat may ask for; more would make large tables.
MOST_REPEATS = 256


class _Parser:
    """Tree nodes: ("set", bytes), ("cat", [...]), ("alt", [...]), ("rep", node, low, high or None)."""

    def __init__(self, pattern: str, fold: bool):
        self.p, self.at, self.fold = pattern, 0, fold

    def peek(self) -> str:
        return self.p[self.at:self.at + 1]

    def take(self) -> str:
        c = self.peek()
        if not c:
            raise ValueError(f"pattern ends too soon: {self.p!r}")
        self.at += 1
        return c

    def leaf(self, values: frozenset) -> tuple:
        if self.fold:
            values = values | {v ^ 32 for v in values if chr(v).isalpha() and v < 128}
        return ("set", frozenset(values))

    def alternatives(self) -> tuple:
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def sequence(self) -> tuple:
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated(self.atom()))
        return ("cat", parts)

    def repeated(self, node: tuple) -> tuple:
        while self.peek() and self.peek() in "*+?{":
            c = self.take()
            low, high = {"*": (0, None), "+": (1, None), "?": (0, 1)}.get(c, (0, 0))
            if c == "{":
                body = ""
                while self.peek() != "}":
                    body += self.take()
                self.take()
                a, comma, b = body.partition(",")
                low, high = int(a or 0), (int(b) if b else None) if comma else int(a)
            if max(low, high or 0) > MOST_REPEATS or (high is not None and high < low):
                raise ValueError(f"repeat of {low} to {high} in {self.p!r}")
            node = ("rep", node, low, high)
        return node

    def atom(self) -> tuple:
        c = self.take()
        if c == "(":
            if self.p.startswith("?:", self.at):
                self.at += 2
            node = self.alternatives()
            if self.take() != ")":
                raise ValueError(f"group without an end in {self.p!r}")
            return node
        if c == "[":
            return self.leaf(self.bracket())
        if c == ".":
            return ("set", EVERY - {10})
        if c == "\\":
            return self.leaf(self.escape())
        if c in "^$*+?{":
            raise ValueError(f"{c!r} has no meaning here: {self.p!r}")
        if ord(c) > 127:
            return ("cat", [("set", frozenset([b])) for b in c.encode()])
        return self.leaf(frozenset([ord(c)]))

    def escape(self) -> frozenset:
        c = self.take()
        if c in SETS:
            return SETS[c]
        if c == "x":
            return frozenset([int(self.take() + self.take(), 16)])
        if c in SIGNS:
            return frozenset([SIGNS[c]])
        if c.isalnum():
            raise ValueError(f"escape \\{c} in {self.p!r}")
        return frozenset([ord(c)])

    def bracket(self) -> frozenset:
        negated = self.peek() == "^"
        if negated:
            self.take()
        found: set[int] = set()
        while self.peek() != "]":
            c = self.take()
            low = self.escape() if c == "\\" else frozenset([ord(c)])
            if max(low) > 127:
                raise ValueError(f"classes list ASCII characters only: {self.p!r}")
            if self.peek() == "-" and self.p[self.at + 1:self.at + 2] != "]" and len(low) == 1:
                self.take()
                c = self.take()
                high = self.escape() if c == "\\" else frozenset([ord(c)])
                found.update(range(min(low), max(high) + 1))
            else:
                found |= low
        self.take()
        if self.fold:
            found |= {v ^ 32 for v in found if chr(v).isalpha() and v < 128}
        return EVERY - found if negated else frozenset(found)


def parse(pattern: str, fold: bool = False) -> tuple:
    parser = _Parser(pattern, fold)
    node = parser.alternatives()
    if parser.peek():
        raise ValueError(f"closing bracket without a start in {pattern!r}")
    return node


def reverse(node: tuple) -> tuple:
    """The tree of the mirrored pattern."""
    if node[0] == "cat":
        return ("cat", [reverse(x) for x in reversed(node[1])])
    if node[0] == "alt":
        return ("alt", [reverse(x) for x in node[1]])
    if node[0] == "rep":
        return ("rep", reverse(node[1]), *node[2:])
    return node


def trigger(node: tuple) -> tuple:
    """The tree with an open repeat of one set at its end cut to its least count:
    every match of the rule is one of the trigger's and more of that set."""
    if node[0] == "cat" and node[1] and (last := node[1][-1])[0] == "rep" and last[1][0] == "set" \
            and last[2] and last[3] is None:
        return ("cat", [*node[1][:-1], (*last[:3], last[2])])
    return node


class _States:
    """A nondeterministic automaton: byte-set moves and empty moves per state."""

    def __init__(self):
        self.moves: list[list[tuple[frozenset, int]]] = []
        self.empty: list[list[int]] = []

    def new(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def add(self, node: tuple, at: int) -> int:
        """States for ``node`` entered at ``at``; returns where it is left."""
        if node[0] == "set":
            to = self.new()
            self.moves[at].append((node[1], to))
            return to
        if node[0] == "cat":
            for part in node[1]:
                at = self.add(part, at)
            return at
        if node[0] == "alt":
            out = self.new()
            for part in node[1]:
                start = self.new()
                self.empty[at].append(start)
                self.empty[self.add(part, start)].append(out)
            return out
        _, part, low, high = node
        for _ in range(low):
            at = self.add(part, at)
        out = self.new()
        if high is None:
            loop = self.new()
            self.empty[at].append(loop)
            self.empty[loop].append(out)
            self.empty[self.add(part, loop)].append(loop)
            return out
        self.empty[at].append(out)
        for _ in range(high - low):
            at = self.add(part, at)
            self.empty[at].append(out)
        return out

    def closure(self, states: frozenset) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for x in self.empty[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)


@dataclass
class Automaton:
    """``table[state, column]`` is the next state, ``column[byte]`` a byte's column;
    ``accepts[state]`` has bit r set where rule r ends. States from ``accepting``
    on accept something. In the ``start`` of an unanchored automaton no match is
    under way; ``dead`` is a state that is never left, or -1."""

    table: np.ndarray
    column: np.ndarray
    accepts: np.ndarray
    accepting: int
    start: int
    dead: int


def _columns(sets: list[frozenset]) -> tuple[np.ndarray, list[int]]:
    """Column of each byte, and one byte of each column."""
    marks = np.zeros((256, max(1, len(sets))), bool)
    for k, values in enumerate(sets):
        marks[list(values), k] = True
    _, first, column = np.unique(marks, axis=0, return_index=True, return_inverse=True)
    return column.reshape(-1).astype(np.uint8), [int(b) for b in first]


def _merged(table: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Class of each state by partition refinement (Moore): states are equal if
    their labels are and all their moves lead to equal states."""
    _, label = np.unique(label, axis=0, return_inverse=True)
    label = label.reshape(-1)
    while True:
        _, new = np.unique(np.column_stack([label, label[table]]), axis=0, return_inverse=True)
        new = new.reshape(-1)
        if new.max() == label.max():
            return new
        label = new


def compile_rules(trees: list[tuple], anchored: bool = False) -> Automaton:
    """One automaton of all rules. Unanchored, a match may begin at every byte, and
    the state tells which rules have a match that ends here; the start state is
    kept apart from states that only look like it, so that in it no match is
    under way."""
    nfa = _States()
    start, ends = nfa.new(), {}
    for r, tree in enumerate(trees):
        entry = nfa.new()
        nfa.empty[start].append(entry)
        ends[nfa.add(tree, entry)] = r
    column, samples = _columns(sorted({values for m in nfa.moves for values, _ in m}, key=sorted))
    fresh = nfa.closure(frozenset([start]))
    step: dict[tuple[int, int], frozenset] = {}
    for s, moves in enumerate(nfa.moves):
        for k, b in enumerate(samples):
            if to := [t for values, t in moves if b in values]:
                step[s, k] = nfa.closure(frozenset(to))
    number, rows, todo = {fresh: 0}, [], [fresh]
    for states in todo:  # grows while it is read
        row = []
        for k in range(len(samples)):
            to = frozenset().union(*(step[s, k] for s in states if (s, k) in step))
            if not anchored:
                to = to | fresh
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            row.append(number[to])
        rows.append(row)
    table = np.array(rows, np.int64)
    accepts = np.array([sum(1 << r for e, r in ends.items() if e in states) for states in todo], np.int64)
    apart = (np.arange(len(todo)) == 0) & (not anchored)
    label = _merged(table, np.column_stack([accepts, apart]))
    _, first = np.unique(label, return_index=True)
    order = np.argsort(accepts[first] != 0, kind="stable")  # accepting states last
    place = np.empty(len(first), np.int64)
    place[order] = np.arange(len(first))
    small = place[label[table[first[order]]]]
    told = accepts[first[order]]
    stuck = np.flatnonzero((small == np.arange(len(small))[:, None]).all(axis=1) & (told == 0)) if anchored else []
    return Automaton(small.astype(np.int32), column, told, int((told == 0).sum()), int(place[label[0]]),
                     int(stuck[0]) if len(stuck) else -1)
