r"""Personal data (operator 4): patterns plus a character-level BiLSTM-CRF.

Base spans come from four patterns with checks (e-mail, IP address, payment card,
phone). A bidirectional LSTM over characters with a linear-chain CRF on top is
trained in numpy from labelled spans and adds spans that the patterns miss
(numbers without a plus sign, cards and addresses written with other signs in
between); an added span must be plausible for its kind. Every window of every text is run through the network: windows of ``WINDOW``
characters overlap by ``OVERLAP``; each is decoded by itself, every character
takes its tag from the window in whose middle it lies, and spans are then read
from the tags of the whole text, so one that crosses a seam comes out whole.

Training: the labelled rows are windows around base spans (and windows without)
of at most about ``TRAIN_DOCS`` documents, chosen by a hash of the document; the
bound is the only sample here. The trained network (a few kilobytes) goes to the
tasks with the closure.

Speed: gates use piecewise linear squashing (clip), the input side of the gates
is one table row per character class, and windows run side by side, one numpy
step per character position. A window whose best tag is "none" everywhere needs
no decoding: the CRF keeps none-to-none as its best transition, so "none"
throughout is the best path, exactly.

Defined results: null text is empty; offsets are code points of the text as
given; repeated rows and rows that share a doc_id are each reported; an empty
table gives no rows and trains nothing; without any labelled span only base
spans are returned. Columns beyond doc_id and text are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow
from .tokens import steps

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + len(KINDS)  # 0: none
WINDOW, OVERLAP = 256, 32
HIDDEN = 8
TRAIN_DOCS = 12_000
TRAIN_LENGTH = 96
EPOCHS = 14
RATE = 0.02
SEED = 4
STEP_WINDOWS = 1024

# --- base patterns ------------------------------------------------------------

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SIGNS = re.compile(r"[0-9@]")
NOT_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, found from
    each @ outwards: linear, whatever the text."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in order of start, then kind."""
    if not SIGNS.search(text):
        return []
    out = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = NOT_DIGITS.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGITS.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# --- the network ----------------------------------------------------------------

def _classes() -> np.ndarray:
    """Character class of each Latin-1 code: 0 is padding; letters of both cases
    share a class; digits share one; ASCII signs have one each; the rest by kind."""
    out = np.empty(256, np.int64)
    for c in range(256):
        ch = chr(c)
        if ch.isascii() and ch.isalpha():
            out[c] = 1 + ord(ch.lower()) - 97
        elif ch.isascii() and ch.isdigit():
            out[c] = 27
        elif ch in " \t":
            out[c] = 28
        elif c in (10, 11, 12, 13):
            out[c] = 29
        elif 33 <= c < 127:
            out[c] = 31 + len([k for k in range(33, c) if not chr(k).isalnum()])
        else:
            out[c] = 30
    return out


CLASS = _classes()
N_CLASSES = int(CLASS.max()) + 1


def codes(text: str) -> np.ndarray:
    return CLASS[np.frombuffer(text.encode("latin-1", "replace"), np.uint8)]


@dataclass
class Network:
    """Gate order: input, forget, output (0 to 1), candidate (-1 to 1)."""
    table: list[np.ndarray]  # per direction: classes x 4 HIDDEN
    u: list[np.ndarray]      # HIDDEN x 4 HIDDEN
    out: list[np.ndarray]    # HIDDEN x TAGS
    bias: np.ndarray         # TAGS
    trans: np.ndarray        # TAGS x TAGS, from row to column

    def parts(self) -> list[np.ndarray]:
        return [*self.table, *self.u, *self.out, self.bias, self.trans]


def fresh(seed: int = SEED) -> Network:
    r = np.random.default_rng(seed)
    tables = [r.normal(0, 0.3, (N_CLASSES, 4 * HIDDEN)).astype("f4") for _ in range(2)]
    for t in tables:
        t[:, HIDDEN:2 * HIDDEN] += 1
    return Network(tables, [r.normal(0, 0.3, (HIDDEN, 4 * HIDDEN)).astype("f4") for _ in range(2)],
                   [r.normal(0, 0.3, (HIDDEN, TAGS)).astype("f4") for _ in range(2)],
                   np.zeros(TAGS, "f4"), (np.eye(TAGS) * 0.5).astype("f4"))


def calm(trans: np.ndarray) -> np.ndarray:
    """None to none stays the best transition."""
    trans = np.minimum(trans, 3.0)
    trans[0, 0] = max(trans.max(), trans[0, 0])
    return trans


def scores(net: Network, x: np.ndarray) -> np.ndarray:
    """Tag scores (position, tag, window) of windows ``x`` (position, window)."""
    length, n = x.shape
    h = HIDDEN
    out = np.empty((length, TAGS, n), "f4")
    out[:] = net.bias[None, :, None]
    for d in range(2):
        table = np.ascontiguousarray(net.table[d].T)
        table[:3 * h] = table[:3 * h] * 0.25 + 0.5  # the linear part of the 0 to 1 gates
        u = np.ascontiguousarray(net.u[d].T)
        u[:3 * h] *= 0.25
        both = np.vstack([u, net.out[d].T])
        state, cell = np.zeros((h, n), "f4"), np.zeros((h, n), "f4")
        z, g, t = np.empty((4 * h + TAGS, n), "f4"), np.empty((4 * h, n), "f4"), np.empty((h, n), "f4")
        order = range(length) if d == 0 else range(length - 1, -1, -1)
        before = None
        for k in order:
            np.matmul(both, state, out=z)
            if before is not None:
                out[before] += z[4 * h:]
            np.take(table, x[k], axis=1, out=g, mode="clip")
            g += z[:4 * h]
            np.clip(g[:3 * h], 0, 1, out=g[:3 * h])
            np.clip(g[3 * h:], -1, 1, out=g[3 * h:])
            np.multiply(g[:h], g[3 * h:], out=t)
            np.multiply(cell, g[h:2 * h], out=cell)
            cell += t
            np.clip(cell, -1, 1, out=t)
            np.multiply(t, g[2 * h:3 * h], out=state)
            before = k
        out[before] += net.out[d].T @ state
    return out


def best_path(s: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Viterbi tags (position, window) of scores (position, tag, window)."""
    length, _, n = s.shape
    back = np.empty((length, TAGS, n), np.int8)
    best = s[0]
    for k in range(1, length):
        step = best[:, None, :] + trans[:, :, None]
        back[k] = step.argmax(axis=0)
        best = step.max(axis=0) + s[k]
    tags = np.empty((length, n), np.int8)
    tags[-1] = best.argmax(axis=0)
    for k in range(length - 1, 0, -1):
        tags[k - 1] = np.take_along_axis(back[k], tags[k][None, :].astype(np.int64), axis=0)[0]
    return tags


# --- training -------------------------------------------------------------------

def _crf_gradient(s: np.ndarray, trans: np.ndarray, gold: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Negative log-likelihood and its gradients, by forward and backward sums."""
    length, k, n = s.shape

    def lse(a, axis):
        m = a.max(axis=axis, keepdims=True)
        return (m + np.log(np.exp(a - m).sum(axis=axis, keepdims=True))).squeeze(axis)

    fwd, bwd = np.empty_like(s), np.zeros_like(s)
    fwd[0] = s[0]
    for t in range(1, length):
        fwd[t] = lse(fwd[t - 1][:, None] + trans[:, :, None], 0) + s[t]
    for t in range(length - 2, -1, -1):
        bwd[t] = lse(trans[:, :, None] + (s[t + 1] + bwd[t + 1])[None], 1)
    z = lse(fwd[-1], 0)
    ds = np.exp(fwd + bwd - z)
    dt = np.zeros_like(trans)
    for t in range(1, length):
        dt += np.exp(fwd[t - 1][:, None] + trans[:, :, None] + (s[t] + bwd[t])[None] - z).sum(axis=2)
    loss = z.sum()
    cols = np.arange(n)
    for t in range(length):
        loss -= s[t, gold[t], cols].sum()
        ds[t, gold[t], cols] -= 1
        if t:
            loss -= trans[gold[t - 1], gold[t]].sum()
            np.add.at(dt, (gold[t - 1], gold[t]), -1)
    return float(loss), ds / n, dt / n


def _lstm_pass(table: np.ndarray, u: np.ndarray, x: np.ndarray):
    """Forward pass of one direction; states and what the backward pass needs."""
    length, n = x.shape
    h = HIDDEN
    state, cell = np.zeros((n, h), "f4"), np.zeros((n, h), "f4")
    keep, states = [], np.empty((length, n, h), "f4")
    for k in range(length):
        z = table[x[k]] + state @ u
        g = np.concatenate([np.clip(z[:, :3 * h] * 0.25 + 0.5, 0, 1), np.clip(z[:, 3 * h:], -1, 1)], axis=1)
        new = cell * g[:, h:2 * h] + g[:, :h] * g[:, 3 * h:]
        squashed = np.clip(new, -1, 1)
        keep.append((state, cell, z, g, new))
        state, cell = squashed * g[:, 2 * h:3 * h], new
        states[k] = state
    return states, keep


def _lstm_back(table, u, x, keep, dstates):
    length, n = x.shape
    h = HIDDEN
    dtable, du = np.zeros_like(table), np.zeros_like(u)
    dh, dc = np.zeros((n, h), "f4"), np.zeros((n, h), "f4")
    for k in range(length - 1, -1, -1):
        state, cell, z, g, new = keep[k]
        dh = dh + dstates[k]
        squashed = np.clip(new, -1, 1)
        dc = dc + dh * g[:, 2 * h:3 * h] * (np.abs(new) < 1)
        dg = np.concatenate([dc * g[:, 3 * h:], dc * cell, dh * squashed, dc * g[:, :h]], axis=1)
        # a small slope outside the linear part keeps units from dying
        slope = np.concatenate([np.where(np.abs(z[:, :3 * h]) < 2, 0.25, 0.02),
                                np.where(np.abs(z[:, 3 * h:]) < 1, 1.0, 0.05)], axis=1)
        dz = (dg * slope).astype("f4")
        np.add.at(dtable, x[k], dz)
        du += state.T @ dz
        dh, dc = dz @ u.T, dc * g[:, h:2 * h]
    return dtable, du


def train(windows: list[tuple[str, list[tuple[int, int, int]]]], epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """Fit on (text, spans); a window longer than TRAIN_LENGTH is cut there."""
    r, net = np.random.default_rng(seed), fresh(seed)
    x = np.zeros((TRAIN_LENGTH, len(windows)), np.int64)
    y = np.zeros((TRAIN_LENGTH, len(windows)), np.int64)
    for i, (text, spans) in enumerate(windows):
        c = codes(text)[:TRAIN_LENGTH]
        x[:len(c), i] = c
        for start, kind, end in spans:
            y[start:end, i] = kind + 1
    parts = net.parts()
    mean, var, count = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
    for epoch in range(epochs):
        order = r.permutation(len(windows))
        for at in range(0, len(order), 64):
            pick = order[at:at + 64]
            xb, yb = x[:, pick], y[:, pick]
            f, kf = _lstm_pass(net.table[0], net.u[0], xb)
            b, kb = _lstm_pass(net.table[1], net.u[1], xb[::-1])
            s = f @ net.out[0] + b[::-1] @ net.out[1] + net.bias
            _, ds, dtrans = _crf_gradient(s.transpose(0, 2, 1).astype("f8"), net.trans.astype("f8"), yb)
            ds = ds.transpose(0, 2, 1).astype("f4")
            douts = [np.einsum("tnh,tnk->hk", f, ds), np.einsum("tnh,tnk->hk", b[::-1], ds)]
            back = [_lstm_back(net.table[0], net.u[0], xb, kf, ds @ net.out[0].T),
                    _lstm_back(net.table[1], net.u[1], xb[::-1], kb, (ds @ net.out[1].T)[::-1])]
            grads = [back[0][0], back[1][0], back[0][1], back[1][1], *douts, ds.sum(axis=(0, 1)), dtrans]
            count += 1
            rate = RATE * (1 - epoch / epochs) + 1e-3
            for p, g, m, v in zip(parts, grads, mean, var, strict=True):
                g = np.clip(g, -1, 1).astype("f4")
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (rate * (m / (1 - 0.9 ** count)) / (np.sqrt(v / (1 - 0.99 ** count)) + 1e-8)).astype("f4")
            net.trans[:] = calm(net.trans)
    return net


# --- whole texts ------------------------------------------------------------------

def tagged(net: Network, texts: list[str]) -> list[np.ndarray]:
    """One tag per character of each text, from overlapping windows."""
    half, stride = OVERLAP // 2, WINDOW - OVERLAP
    owner, place, rows = [], [], []
    coded = [codes(t) for t in texts]
    for i, c in enumerate(coded):
        for at in range(0, max(1, len(c) - OVERLAP), stride) if len(c) else ():
            owner.append(i)
            place.append(at)
    out = [np.zeros(len(c), np.int8) for c in coded]
    for lo in range(0, len(owner), STEP_WINDOWS):
        who, where = owner[lo:lo + STEP_WINDOWS], place[lo:lo + STEP_WINDOWS]
        x = np.zeros((len(who), WINDOW), np.int64)
        for j, (i, at) in enumerate(zip(who, where, strict=True)):
            part = coded[i][at:at + WINDOW]
            x[j, :len(part)] = part
        s = scores(net, np.ascontiguousarray(x.T))
        hot = np.flatnonzero((s[:, 1:].max(axis=1) > s[:, 0]).any(axis=0))
        if not len(hot):
            continue
        tags = best_path(np.ascontiguousarray(s[:, :, hot]), net.trans)
        for j, column in zip(hot, tags.T, strict=True):
            i, at = who[j], where[j]
            n = len(out[i])
            first = at + half if at else 0
            last = min(n, at + WINDOW - half if at + WINDOW < n else n)
            out[i][first:last] = column[first - at:last - at]
    return out


def plausible(kind: int, part: str) -> bool:
    """What a span the network adds must hold: an e-mail an @ between other
    characters, an address four numbers of at most 255, a card 12 to 19 digits
    that pass the check sum, a phone number 9 to 15 digits."""
    digits = NOT_DIGITS.sub("", part)
    if kind == 0:
        return re.search(r"\w\s*@\s*\w", part) is not None
    if kind == 1:
        numbers = re.findall(r"[0-9]+", part)
        return len(numbers) == 4 and all(len(n.lstrip("0")) <= 3 and int(n) <= 255 for n in numbers)
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def added_spans(text: str, tags: np.ndarray, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs of one tag as spans, less white space and signs at their ends; those
    that overlap a base span or aren't plausible are left out."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], tags, [0]])))
    out = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        kind, start, end = int(tags[a]), int(a), int(b)
        if not kind:
            continue
        while start < end and not (text[start].isalnum() or text[start] in "+("):
            start += 1
        while start < end and not text[end - 1].isalnum():
            end -= 1
        if start < end and plausible(kind - 1, text[start:end]) and all(end <= s or start >= e for s, _, e in base):
            out.append((start, kind - 1, end))
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled windows of documents: around each of the first few base spans, or
    around the first digit, or the text's beginning."""
    for batch in batches:
        rows = []
        for h, text in zip(batch.column("h").to_pylist(), batch.column("text").to_pylist(), strict=True):
            text = text or ""
            spans = base_spans(text)
            sign = SIGNS.search(text)
            for k, at in enumerate([s for s, _, _ in spans[:4]] or [sign.start() if sign else 0]):
                lo = max(0, at - (h + 31 * k) % 64)
                cut = text[lo:lo + TRAIN_LENGTH]
                inside = [(s - lo, kind, min(e - lo, TRAIN_LENGTH)) for s, kind, e in spans
                          if s < lo + TRAIN_LENGTH and s >= lo]
                rows.append((h, bool(spans), bool(sign), cut, ",".join(f"{s}:{kd}:{e}" for s, kd, e in inside)))
        yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=["h", "labelled", "signs", "cut", "spans"]).astype(
            {"h": "int64", "labelled": "bool", "signs": "bool", "cut": "object", "spans": "object"}),
            schema=pa.schema([("h", pa.int64()), ("labelled", pa.bool_()), ("signs", pa.bool_()),
                              ("cut", pa.string()), ("spans", pa.string())]), preserve_index=False)


def training_windows(docs: DataFrame, most: int = TRAIN_DOCS) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Labelled windows of about ``most`` documents (the bound of the sample)."""
    share = max(1, docs.count() // most)
    h = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40))
    picked = docs.select(h.alias("h"), "text").where(F.pmod(F.xxhash64("h"), F.lit(share)) == 0)
    rows = picked.transform(in_arrow, _windows, "h long, labelled boolean, signs boolean, cut string, spans string").collect()
    rows.sort(key=lambda r: (r["h"], r["cut"], r["spans"]))
    yes = [r for r in rows if r["labelled"]]
    odd = [r for r in rows if r["signs"] and not r["labelled"]]
    no = [r for r in rows if not r["signs"]][:max(200, len(yes) // 2)]
    return [(r["cut"], [tuple(map(int, s.split(":"))) for s in r["spans"].split(",") if s]) for r in yes + odd + no] \
        if yes else []


def find(docs: DataFrame, net: Network | None) -> DataFrame:
    """The operator: doc_id, base (string), spans (string, base and added), and the
    base counts per kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, rows = batch.column("text"), []
            for lo, hi in steps(column):
                texts = pc.fill_null(column.slice(lo, hi - lo), "").to_pylist()
                tags = tagged(net, texts) if net else None
                for i, text in enumerate(texts):
                    base = base_spans(text)
                    more = added_spans(text, tags[i], base) if net and tags[i].any() else []
                    kinds = [k for _, k, _ in base]
                    rows.append([*(kinds.count(k) for k in range(len(KINDS))), joined(base), joined(base + more)])
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:4]),
                 *(pa.array(c, pa.string()) for c in cols[4:])],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"])

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select(F.col("doc_id").cast("long"), "text").transform(in_arrow, 
        run, f"doc_id long, {counts}, base string, spans string")


def personal_data(docs: DataFrame) -> DataFrame:
    windows = training_windows(docs)
    return find(docs, train(windows) if windows else None)


def op4_pii_tagger(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = personal_data(docs)
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2("base", 256).alias("base_sha256"), "spans")

