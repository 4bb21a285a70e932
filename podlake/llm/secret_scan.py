r"""Secret scans (operator 11): one deterministic automaton for all rules.

All rules are compiled by subset construction and merging of equal states into
one transition array (``automaton``). Every byte of every text goes through it
once, whatever the number of rules. The bytes of a step of texts, one after the
other with an end sign behind each, are cut into ``LANES`` lanes that run side by side,
one numpy step per place; a lane that was entered in another state than the
idle one is run again from its real state until both runs agree, so the states
are those of one run from front to back.

In that automaton a rule that ends in an open repeat, such as ``[a-z]+``, stops
at its least count (its trigger), which keeps the number of states small. Where
a state accepts, the stretch since the idle state before it (in which no match
is under way) is resolved for the rules that were told: a mirrored automaton marks
where a trigger begins, and from the leftmost beginning the rule's own automaton
finds the longest end. Matches of a rule do not overlap; one that fails the rule's
check is left out and its characters are not tried again for that rule. An
assignment inside a failed one (``password: token: value``) is of the kind
``nested``.

The three base rules come first, ``MORE`` adds others; a span of those, or a
nested one, stays unless it overlaps a base span.

Defined results: null text is empty; offsets are code points; repeated rows and
rows that share a doc_id are each reported; an empty table gives no rows; long
texts are scanned whole, in memory of a few times their bytes. Columns beyond
doc_id and text are ignored. Rules match in UTF-8 bytes and begin and end at
ASCII characters, so never within a character.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import Automaton, compile_rules, parse, reverse, trigger
from .common import in_arrow
from .tokens import steps, text_bytes

LANES = 2048


def assigned(match: str) -> str:
    """The value of an assignment: what follows the first : or = , its blanks and
    its quote."""
    at = min(k for k in (match.find(":"), match.find("=")) if k >= 0)
    value = match[at + 1:].lstrip(" ")
    return value[1:] if value[:1] in ("'", '"') else value


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    check: Callable[[str], bool] | None = None
    fold: bool = False


KEYWORDS = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
VALUE = "[A-Za-z0-9+/_.=-]"
#: The base rules. A run of 24 hexadecimal digits or more is one match.
BASE = (
    Rule("assign", KEYWORDS + VALUE + "+", lambda m: len(assigned(m)) >= 6, True),
    Rule("access", "AKIA[A-Z0-9]+", lambda m: len(m) >= 20),
    Rule("hex", "[0-9a-f]{24,}"),
)
#: Further kinds of secrets.
MORE = (
    Rule("private_key", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", lambda m: len(m) >= 40),
    Rule("forge_token", r"(gh[pousr]_|glpat-)[A-Za-z0-9_-]+", lambda m: len(m) >= 24),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]+", lambda m: len(m) >= 20),
    Rule("map_key", r"AIza[A-Za-z0-9_-]+", lambda m: len(m) >= 39),
    Rule("pay_key", r"[rs]k_(live|test)_[A-Za-z0-9]+", lambda m: len(m) >= 24),
    Rule("url_login", r"://[A-Za-z0-9._%-]+:[A-Za-z0-9._%!-]+@"),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9._~+/=-]+", lambda m: len(m) >= 27, True),
)
NESTED = "nested"


@dataclass
class Scanner:
    rules: tuple[Rule, ...]
    base: int
    whole: Automaton
    forward: list[Automaton]
    mirrored: list[Automaton]

    @property
    def kinds(self) -> list[str]:
        return [*(r.kind for r in self.rules), NESTED]


@lru_cache(maxsize=8)
def scanner(base: tuple[Rule, ...] = BASE, more: tuple[Rule, ...] = MORE) -> Scanner:
    """The compiled rules. Every worker compiles them for itself, once."""
    rules = base + more
    trees = [parse(r.pattern, r.fold) for r in rules]
    triggers = [trigger(t) for t in trees]
    forward = [compile_rules([t], anchored=True) for t in trees]
    for r, auto in zip(rules, forward, strict=True):
        if auto.accepts[auto.start]:
            raise ValueError(f"rule {r.kind} matches the empty text")
    return Scanner(rules, len(base), compile_rules(triggers), forward, [compile_rules([reverse(t)]) for t in triggers])


def states(auto: Automaton, data: np.ndarray, lanes: int = LANES) -> np.ndarray:
    """The state after every value of ``data`` (columns; the last column is the end
    sign, after which the state is the start), run in lanes side by side."""
    width = auto.table.shape[1] + 1
    ends = np.full((len(auto.table), 1), auto.start, np.int32)
    flat = (np.hstack([auto.table, ends]) * width).astype(np.int32).reshape(-1)  # states times width
    n = len(data)
    lanes = max(1, min(lanes, n // 64))
    length = -(-n // lanes)
    cols = np.full(lanes * length, width - 1, np.int32)
    cols[:n] = data
    cols = np.ascontiguousarray(cols.reshape(lanes, length).T)
    out = np.empty((length, lanes), np.int32)
    idle = auto.start * width
    now = np.full(lanes, idle, np.int32)
    for k in range(length):
        now = out[k] = flat[now + cols[k]]
    entered = np.full(lanes, idle, np.int32)
    while True:
        real = np.concatenate([[idle], out[-1, :-1]]).astype(np.int32)
        wrong = np.flatnonzero(real != entered)
        if not len(wrong):
            break
        entered[wrong] = now = real[wrong]
        for k in range(length):
            now = flat[now + cols[k, wrong]]
            changed = now != out[k, wrong]
            if not changed.any():
                break
            out[k, wrong] = now
    return (out.T.reshape(-1)[:n] // width)


def begins(auto: Automaton, data: bytes, lo: int, hi: int) -> list[int]:
    """Places of data[lo:hi] where a trigger begins that ends in it, by the mirrored
    automaton."""
    table, column, state = auto.table, auto.column, auto.start
    out = []
    for k in range(hi - 1, lo - 1, -1):
        state = table[state, column[data[k]]]
        if state >= auto.accepting:
            out.append(k)
    return out[::-1]


def longest(auto: Automaton, data: bytes, begin: int) -> int:
    """End of the longest match that begins at ``begin``."""
    table, column, state, end = auto.table, auto.column, auto.start, begin
    for k in range(begin, len(data)):
        state = table[state, column[data[k]]]
        if state == auto.dead:
            break
        if state >= auto.accepting:
            end = k + 1
    return end


@dataclass
class Progress:
    """How far a rule is in a text: the place from which it may match again, whether
    its last match failed, and the end of what was tried inside that one."""

    free: int = 0
    failed: bool = False
    tried: int = 0


def resolve(s: Scanner, rule: int, data: bytes, lo: int, hi: int, so_far: Progress) -> list[tuple[int, int, int]]:
    """Leftmost longest matches (start, rule, end) of a rule whose triggers lie in
    data[lo:hi], less those that fail its check. Passing matches that begin inside
    a failed one and reach beyond it are nested."""
    check, out = s.rules[rule].check, []
    passes = lambda a, b: check is None or check(data[a:b].decode("ascii", "replace"))
    for begin in begins(s.mirrored[rule], data, lo, hi):
        if begin >= so_far.free:
            end = longest(s.forward[rule], data, begin)
            so_far.free = so_far.tried = end
            so_far.failed = not passes(begin, end)
            if not so_far.failed:
                out.append((begin, rule, end))
        elif so_far.failed and (end := longest(s.forward[rule], data, begin)) > so_far.tried and passes(begin, end):
            out.append((begin, len(s.rules), end))
            so_far.tried = end
    return out


def matches(s: Scanner, data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Per row the (start, rule, end) byte spans that pass their checks."""
    rows = len(offsets) - 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(rows)]
    auto = s.whole
    sign = auto.table.shape[1]  # the column of the end sign
    if not len(data):
        return out
    # one end sign behind every row
    stream = np.full(len(data) + rows, sign, np.uint8)
    at = np.arange(len(data)) + np.repeat(np.arange(rows), np.diff(offsets))
    stream[at] = auto.column[data]
    trace = states(auto, stream)
    hits = np.flatnonzero(trace >= auto.accepting)
    if not len(hits):
        return out
    idle = np.flatnonzero(trace == auto.start)
    right = np.searchsorted(idle, hits)  # the last row's end sign is idle, so there is one
    until = idle[right]
    since = np.where(right > 0, idle[np.maximum(right, 1) - 1] + 1, 0)
    first = np.flatnonzero(np.concatenate([[True], until[1:] != until[:-1]]))
    told = np.bitwise_or.reduceat(auto.accepts[trace[hits]], first)
    row_of = np.searchsorted(offsets[1:] + np.arange(rows), since[first])  # by places of the end signs
    held, text, progress = -1, b"", {}
    for a, b, mask, row in zip(since[first].tolist(), until[first].tolist(), told.tolist(), row_of.tolist(), strict=True):
        if row != held:
            held, text, progress = row, data[offsets[row]:offsets[row + 1]].tobytes(), defaultdict(Progress)
        shift = int(offsets[row]) + row
        for r in range(len(s.rules)):
            if mask >> r & 1:
                out[row] += resolve(s, r, text, a - shift, b - shift, progress[r])
    return out


def code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte spans as code point spans."""
    if text.isascii():
        return spans
    before = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [(int(before[a]), r, int(before[b])) for a, r, b in spans]


def joined(s: Scanner, spans: list[tuple[int, int, int]]) -> str:
    kinds = s.kinds
    return ",".join(f"{kinds[r]}:{a}:{b}" for a, r, b in sorted(spans))


def found_in(s: Scanner, column: pa.Array) -> Iterator[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """Per row of a text column its base spans and its added ones."""
    for lo, hi in steps(column):
        data, offsets = text_bytes(column.slice(lo, hi - lo))
        for i, spans in enumerate(matches(s, data, offsets)):
            if spans:
                spans = code_points(data[offsets[i]:offsets[i + 1]].tobytes(), spans)
            base = [x for x in spans if x[1] < s.base]
            yield base, [x for x in spans if x[1] >= s.base and all(x[2] <= a or x[0] >= b for a, _, b in base)]


def find(docs: DataFrame, base: tuple[Rule, ...] = BASE, more: tuple[Rule, ...] = MORE) -> DataFrame:
    """The operator: doc_id, n_<kind> of every base rule, base (its spans as a
    string) and spans (all of them)."""
    scanner(base, more)  # a bad rule fails here, not in a task
    kinds = [r.kind for r in base]
    rules = None if (base, more) == (BASE, MORE) else (base, more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scanner(*(rules or (BASE, MORE)))
        for batch in batches:
            rows = []
            for spans, added in found_in(s, batch.column("text")):
                told = [r for _, r, _ in spans]
                rows.append([*(told.count(k) for k in range(s.base)), joined(s, spans), joined(s, spans + added)])
            cols = list(zip(*rows, strict=True)) if rows else [[]] * (s.base + 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:-2]),
                 *(pa.array(c, pa.string()) for c in cols[-2:])],
                names=["doc_id", *(f"n_{k}" for k in kinds), "base", "spans"])

    counts = "".join(f"n_{k} long, " for k in kinds)
    return in_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, f"doc_id long, {counts}base string, spans string")


def op11_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select("doc_id", *[f"n_{r.kind}" for r in BASE], F.sha2("base", 256).alias("base_sha256"), "spans")
