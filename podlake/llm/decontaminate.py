"""Benchmark decontamination (operator 9): find benchmark items inside documents.

Texts are compared character by character (code points) after A-Z are lower-cased
and each ASCII white-space character counts as a space. An item of m characters
leaks into a document when some passage of it is within e = floor(BUDGET * m)
edits. The search is a q-gram filter: such a passage shares at least
m - q + 1 - q * e q-grams with the item, and their diagonals (position in the
text less position in the item) differ by at most e. q is eight, or less where an
item's length and budget would leave no shared q-gram (``gram_length``). So every task counts shared
q-grams per item in bands of 2 * (e + 1) diagonals that overlap by half; a band
that reaches the bound is a region, and each region is verified by alignment
inside its band.

The benchmark is the query set: it goes out to the tasks in blocks of at most
about ``BLOCK_CHARS`` characters (the proven bound of each broadcast), one pass
over the documents per block. Documents are scanned where they lie; nothing of
them is shuffled or collected.

Defined results: null texts and items are empty; items of fewer than
``EXACT_BELOW`` characters have no edit budget and are sought as whole words, or,
if they have fewer than ``shortest`` characters, not at all (the query seeks all
of them); repeated items are all
reported; repeated documents are reported each; null ids are kept as null; an
empty benchmark or table gives no leaks. Columns beyond doc_id and text, and
beyond item_id and text, pass through or are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UPPER, in_arrow, stored
from .tokens import steps

Q = 8  # eight one-byte characters are one 64-bit word
BUDGET = 0.1
#: Shorter items are sought without any edit, as whole words.
EXACT_BELOW = 24
BLOCK_CHARS = 4_000_000
BLOCK_ITEMS = 500_000
STEP_ROWS = 50_000  # a row of a step has 16 bits in ``regions``, an item of a block 20
BITS = 22

#: One byte per character for the filter: equal characters stay equal, so it can
#: only let more through. 0 is kept for the gaps between texts.
FILTER_TABLE = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else 1 if c == 0 else c for c in range(256))
FOLD = {ord(c): c.lower() for c in UPPER} | {c: " " for c in (9, 10, 11, 12, 13)}
MIX = np.uint64(0x9E3779B97F4A7C15)


def folded(text: str) -> str:
    return text.translate(FOLD)


def filter_bytes(text: str) -> bytes:
    return text.encode("latin-1", "replace").translate(FILTER_TABLE)


def edit_budget(m: int) -> int:
    return int(BUDGET * m) if m >= EXACT_BELOW else 0


def gram_length(m: int) -> int:
    """Characters of a q-gram for items of m: so many that an item and a passage within
    its budget share one at least (m - q + 1 - q * e >= 1), at most eight."""
    return min(Q, m // (edit_budget(m) + 1))


def whole_words(text: str, start: int, end: int) -> bool:
    """No letter or digit goes on over either end of the passage."""
    return not (start and text[start - 1].isalnum() and text[start].isalnum()
                or end < len(text) and text[end - 1].isalnum() and text[end].isalnum())


def aligned(item: str, region: str, width: int, pad: int = 0) -> tuple[int, int, int]:
    """Fewest edits between ``item`` and a passage of ``region`` whose alignment
    stays on diagonals -pad to width - pad: (edits, start, end), the passage that
    starts first among the best. One numpy row per character of the item. Places
    before and after the region match nothing: using one there costs an edit, as
    leaving out the item's character does."""
    at = region.find(item)
    if 0 <= at <= width - pad:
        return 0, at, at + len(item)
    one = np.int64(1) << np.int64(32)  # cost in the high half, start in the low
    text = np.full(len(item) + width + 1, -1, np.int64)
    chars = np.frombuffer(region.encode("utf-32-le", "surrogatepass"), "<i4")[:max(0, len(text) - pad)]
    text[pad:pad + len(chars)] = chars
    steps_ = np.arange(width + 1, dtype=np.int64) * one
    row = np.arange(width + 1, dtype=np.int64)
    for j, c in enumerate(item):
        new = row + (text[j:j + width + 1] != ord(c)) * one
        np.minimum(new[:-1], row[1:] + one, out=new[:-1])
        row = np.minimum.accumulate(new - steps_) + steps_
    k = int(np.argmin(row >> np.int64(32)))
    start = max(0, int(row[k] & 0xFFFFFFFF) - pad)
    return int(row[k] >> 32), start, max(start, min(len(region), len(item) + k - pad))


class Items:
    """A block of benchmark items of one q-gram length with its index; sent to every task."""

    def __init__(self, ids: list, texts: list[str]):
        self.ids, self.texts = ids, [folded(t) for t in texts]
        q, = {gram_length(len(t)) for t in texts}
        self.mask = np.uint64((1 << 8 * q) - 1)  # the first q characters of a word of eight
        grams, owner, place = [], [], []
        for i, t in enumerate(texts):
            data = np.frombuffer(filter_bytes(t) + bytes(8), np.uint8)
            g = np.ndarray((len(t) - q + 1,), "<u8", data, strides=(1,)) & self.mask
            grams.append(g)
            owner.append(np.full(len(g), i, np.int64))
            place.append(np.arange(len(g), dtype=np.int64))
        g = np.concatenate(grams)
        order = np.argsort(g, kind="stable")
        self.grams, self.first, self.count = np.unique(g[order], return_index=True, return_counts=True)
        self.owner, self.place = np.concatenate(owner)[order], np.concatenate(place)[order]
        self.seen = np.zeros(1 << BITS, bool)
        self.seen[(self.grams * MIX) >> np.uint64(64 - BITS)] = True
        self.m = np.array([len(t) for t in texts], np.int64)
        self.e = np.array([edit_budget(len(t)) for t in texts], np.int64)
        self.bound = self.m - q + 1 - q * self.e

    def regions(self, texts: list[str]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, first diagonal, width) of every band that reaches its bound."""
        starts = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
        data = np.frombuffer(b"\0".join(filter_bytes(t) for t in texts) + bytes(8), np.uint8)
        grams = np.ndarray((max(0, len(data) - Q + 1),), "<u8", data, strides=(1,)) & self.mask
        at = np.flatnonzero(self.seen[(grams * MIX) >> np.uint64(64 - BITS)])
        found = np.minimum(np.searchsorted(self.grams, grams[at]), len(self.grams) - 1)
        ok = self.grams[found] == grams[at]
        at, found = at[ok], found[ok]
        times = self.count[found]
        which = np.repeat(self.first[found], times) + (
            np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times))
        at = np.repeat(at, times)
        row = np.searchsorted(starts, at, side="right") - 1
        item = self.owner[which]
        width = self.e[item] + 1
        band = (at - starts[row] - self.place[which] + self.m[item]) // width + 1
        key = (row.astype(np.uint64) << np.uint64(48)) | (item.astype(np.uint64) << np.uint64(28)) \
            | band.astype(np.uint64)
        order = np.argsort(key, kind="stable")
        key, places = key[order], self.place[which][order]
        keys, first, hits = np.unique(key, return_index=True, return_counts=True)
        if not len(keys):
            return
        # A band is two neighbouring slots of e + 1 diagonals; it starts at each slot
        # that has hits, and before one whose forerunner has none.
        one = np.uint64(1)
        after = np.append((keys[1:] == keys[:-1] + one), False)
        before = np.concatenate([[False], after[:-1]])
        beside = np.where(after, np.append(hits[1:], 0), 0)
        bound = self.bound[((keys >> np.uint64(28)) & np.uint64(0xFFFFF)).astype(np.int64)]
        for k in np.flatnonzero(hits + beside >= bound):
            r, i, b = int(keys[k] >> np.uint64(48)), int(keys[k] >> np.uint64(28)) & 0xFFFFF, int(keys[k]) & 0xFFFFFFF
            # of the hits, each q-gram of the item counts once
            shared = np.unique(places[first[k]:first[k] + hits[k] + beside[k]])
            if len(shared) < bound[k]:
                continue
            w, m = int(self.e[i]) + 1, int(self.m[i])
            yield r, i, (b - 1) * w - m, 2 * w - 1
            if not before[k] and hits[k] >= bound[k]:
                yield r, i, (b - 2) * w - m, 2 * w - 1

    def leaks(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, start, end, edits) of verified passages; of overlapping
        passages of one item the best."""
        best: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        plain: dict[int, str] = {}
        for r, i, diagonal, width in self.regions(texts):
            if r not in plain:
                plain = {r: folded(texts[r])}
            lo = max(0, diagonal)
            region = plain[r][lo:max(lo, diagonal + width + int(self.m[i]))]
            edits, start, end = aligned(self.texts[i], region, width, lo - diagonal)
            if edits <= self.e[i] and (self.m[i] >= EXACT_BELOW or whole_words(plain[r], lo + start, lo + end)):
                best.setdefault((r, i), []).append((edits, lo + start, lo + end))
        out = []
        for (r, i), found in best.items():
            taken: list[tuple[int, int, int]] = []
            for edits, start, end in sorted(found):
                if all(end <= s or start >= t for _, s, t in taken):
                    taken.append((edits, start, end))
                    out.append((r, i, start, end, edits))
        return out


def item_blocks(benchmark: DataFrame, shortest: int) -> list[DataFrame]:
    """The benchmark's items of ``shortest`` characters or more in blocks of about BLOCK_CHARS characters and
    at most about BLOCK_ITEMS items of one q-gram length."""
    m = F.char_length("text")
    e = F.when(m >= EXACT_BELOW, F.floor(m * BUDGET)).otherwise(0)
    items = benchmark.select("item_id", "text").where(m >= max(1, shortest)).withColumn("q", F.least(F.lit(Q), F.floor(m / (e + 1))))
    out = []
    # a row per q-gram length, at most eight
    for r in items.groupBy("q").agg(F.sum(m.cast("long")).alias("chars"), F.count(F.lit(1)).alias("items")).orderBy("q").collect():
        blocks = max(-(-r["chars"] // BLOCK_CHARS), -(-r["items"] // BLOCK_ITEMS))
        place = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
        out += [items.where((F.col("q") == r["q"]) & (place == b)).select("item_id", "text") for b in range(blocks)]
    return out


def _sent(block: DataFrame):
    """A block on every executor; None if no item was dealt into it."""
    rows = block.orderBy("item_id", "text").collect()
    return block.sparkSession.sparkContext.broadcast(Items([r[0] for r in rows], [r[1] for r in rows])) if rows else None


def _texts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    for start, end in steps(column):
        for lo in range(start, end, STEP_ROWS):
            yield lo, pc.fill_null(column.slice(lo, min(STEP_ROWS, end - lo)), "").to_pylist()


def leaks(docs: DataFrame, benchmark: DataFrame, shortest: int = EXACT_BELOW) -> DataFrame:
    """The operator: doc_id, item_id, start, end (code points, end exclusive),
    edits, item_chars; one row per leaked passage."""
    schema = "doc_id long, item_id long, start long, end long, edits long, item_chars long"
    out = docs.sparkSession.createDataFrame([], schema)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    blocks = item_blocks(benchmark, shortest)
    for block in blocks:
        if (sent := _sent(block)) is None:
            continue

        def scan(batches, sent=sent):
            items = sent.value
            for batch in batches:
                ids, rows = batch.column("doc_id"), []
                for lo, texts in _texts(batch.column("text")):
                    rows += [(ids[lo + r].as_py(), items.ids[i], s, e, d, int(items.m[i]))
                             for r, i, s, e, d in items.leaks(texts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[k] for x in rows], pa.int64()) for k in range(6)],
                    names=["doc_id", "item_id", "start", "end", "edits", "item_chars"])

        found = docs.transform(in_arrow, scan, schema)
        if len(blocks) > 1:  # one block at a time on the executors
            found = stored(found, "decontaminate-leaks")
            sent.destroy()
        out = out.unionByName(found)
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, shortest: int = EXACT_BELOW) -> DataFrame:
    """Rows and columns of ``docs`` that no item leaks into."""
    blocks = item_blocks(benchmark, shortest)
    for block in blocks:
        if (sent := _sent(block)) is None:
            continue

        def scan(batches, sent=sent):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for lo, texts in _texts(batch.column("text")):
                    for r, *_ in sent.value.leaks(texts):
                        keep[lo + r] = False
                yield batch.filter(pa.array(keep))

        docs = docs.transform(in_arrow, scan, docs.schema)
        if len(blocks) > 1:
            docs = stored(docs, "decontaminate-clean")
            sent.destroy()
    return docs


def op9_decontaminate(spark, sf_dir: str) -> DataFrame:
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                 spark.read.parquet(f"{sf_dir}/benchmark.parquet"), shortest=1)
