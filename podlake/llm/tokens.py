"""Word and shingle hashes of whole Arrow columns, in numpy.

Words are runs of bytes other than the ASCII white space of the text contracts;
in UTF-8 that splits exactly as on code points. Hashes are 64-bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one step works on; one longer text is one step.
STEP_BYTES = 1 << 20
SHINGLE = 5


def splitmix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer, a bijection of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
BYTE_HASH = splitmix(np.arange(256, dtype=np.uint64) + np.uint64(1 << 40))
BYTE_HASH[SPACE] = 0
FOLDED_HASH = BYTE_HASH[FOLD]
FOLDED_HASH[SPACE] = 0
SHINGLE_WEIGHTS = splitmix(np.arange(SHINGLE, dtype=np.uint64) + np.uint64(1 << 41)) | np.uint64(1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column end to end, and row offsets (rows + 1).
    Nulls are empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return (np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0])


def byte_offsets(column: pa.Array) -> np.ndarray:
    """Row offsets (rows + 1) of a binary column without nulls."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    return offsets - offsets[0]


def steps(column: pa.Array, size: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes of text (or binary) each, one row at least."""
    offsets = text_bytes(column)[1] if not pa.types.is_binary(column.type) else byte_offsets(column)
    at, rows = 0, len(column)
    while at < rows:
        to = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        to = min(rows, max(at + 1, to))
        yield at, to
        at = to


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the number of the first word of
    each row (rows + 1 values). A row's end also ends a word."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~SPACE[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[0] = False
    before[1:] = word[:-1]
    before &= ~cut[:-1]
    after = np.empty(len(data), dtype=bool)
    after[-1] = False
    after[:-1] = word[1:]
    after &= ~cut[1:]
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                table: np.ndarray = FOLDED_HASH) -> np.ndarray:
    """A multilinear hash per word. ``FOLDED_HASH`` ignores the case of A-Z."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    stop = np.empty_like(starts)
    stop[:-1] = starts[1:]
    stop[-1] = len(data)
    seg = stop - starts
    longest = int(lens.max())
    at = np.arange(starts[0], len(data)) - np.repeat(starts, seg)
    np.minimum(at, longest, out=at)  # beyond a word's end: spaces, which count 0
    weights = splitmix(np.arange(longest + 1, dtype=np.uint64)) | np.uint64(1)
    values = table[data[starts[0]:]] * weights[at]
    sums = np.add.reduceat(values, starts - starts[0])
    return splitmix(sums + lens.astype(np.uint64))


def shingles(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of five words within rows, in order, and the number of
    each row's first run (rows + 1 values). A row of one to four words has one
    run, of all of them."""
    counts = np.diff(first)
    runs = np.where(counts >= SHINGLE, counts - SHINGLE + 1, (counts > 0).astype(np.int64))
    out_first = np.zeros(len(first), np.int64)
    np.cumsum(runs, out=out_first[1:])
    total = int(out_first[-1])
    if not total:
        return np.zeros(0, np.uint64), out_first
    at = np.arange(total) + np.repeat(first[:-1] - out_first[:-1], runs)
    length = np.repeat(np.minimum(counts, SHINGLE), runs)
    padded = np.concatenate([words, np.zeros(SHINGLE, np.uint64)])
    sums = length.astype(np.uint64)
    for k in range(SHINGLE):
        part = padded[at + k] * SHINGLE_WEIGHTS[k]
        sums += np.where(k < length, part, np.uint64(0))
    return splitmix(sums), out_first


def column_shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a string column (A-Z folded) and each row's first."""
    data, offsets = text_bytes(column)
    starts, ends, first = word_spans(data, offsets)
    return shingles(word_hashes(data, starts, ends), first)
