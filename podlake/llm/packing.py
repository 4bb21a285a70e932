"""Best-fit packing (operator 3): fill sequences of a fixed number of tokens.

Documents become token ids plus an end id; those longer than a sequence are cut
into whole sequences, the first piece taking the rest. Packing is planned on the
histogram of piece lengths, not on documents: best fit, longest first, where all
pieces of one length are placed at once. The plan is a table of slots, each a
run of pieces of one length (by rank) that go to a run of sequences at one
offset. Pieces get their rank within their length and take their slot by a join.

Scale: only the histogram (at most ``capacity`` rows) reaches the driver and only
the plan is broadcast. The plan's size depends on the capacity alone, never on the
number of documents: placing one length adds at most two runs of sequences, so
there are at most 2 * capacity + 1 runs and as many steps per length. Ranks are
counted in hash buckets of bounded size, so a length that a third of all pieces
have is not sorted in one task: per bucket and length a row number, plus the
number of such pieces in earlier buckets.

Defined results: null or empty text is the end id alone; a null doc_id stays
null; repeated rows are packed each; an empty table gives no rows. Other columns
are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import in_arrow, stored
from .subwords import byte_bpe
from .tokens import steps

CAPACITY = 1024
END_ID = 2
BUCKET_ROWS = 5_000

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
SLOT = "length long, rank_from long, rank_to long, sequence_from long, offset long"


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: the first takes the rest."""
    head = n % capacity or min(n, capacity)
    return [(0, head)] + [(s, capacity) for s in range(head, n, capacity)]


def token_pieces(docs: DataFrame, vocabulary: str = "byte_bpe_50k", capacity: int = CAPACITY,
                 end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and the ids
    (array of int) if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = byte_bpe(vocabulary), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            ids, column = batch.column("doc_id"), batch.column("text")
            for lo, hi in steps(column):
                rows, which, parts = [], [], []
                for r, text in enumerate(pc.fill_null(column.slice(lo, hi - lo), "").to_pylist(), lo):
                    data = memoryview(words.encode(text) + end)
                    for k, (s, n) in enumerate(cuts(len(data) // 4, capacity)):
                        part = data[4 * s:4 * (s + n)]
                        which.append(r)
                        rows.append((k, s, n, zlib.crc32(part)))
                        parts.append(part)
                table = np.array(rows, np.int64).reshape(-1, 4)
                out = [ids.take(pa.array(which, pa.int64())), pa.array(table[:, 0], pa.int32()),
                       *(pa.array(table[:, c], pa.int64()) for c in (1, 2, 3))]
                if with_ids:
                    at = np.concatenate([[0], np.cumsum(table[:, 2])]).astype(np.int32)
                    flat = np.frombuffer(b"".join(parts), "<i4")
                    out.append(pa.ListArray.from_arrays(pa.array(at), pa.array(flat)))
                yield pa.RecordBatch.from_arrays(
                    out, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:len(out)])

    schema = PIECE + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").transform(in_arrow, run, schema)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best fit over counts, longest pieces first: slots (length, rank_from,
    rank_to, sequence_from, offset). Pieces of that length and ranks rank_from
    to rank_to - 1 go to sequences sequence_from onwards, one each, at offset."""
    slots: list[tuple[int, int, int, int, int]] = []
    open_: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free space -> runs of sequences
    frees: list[int] = []
    sequences = 0

    def leave(free: int, first: int, count: int) -> None:
        if free and count:
            if not open_[free]:
                insort(frees, free)
            open_[free].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            k = bisect_left(frees, length)
            if k < len(frees):
                free = frees[k]
                first, count = open_[free].pop()
                if not open_[free]:
                    frees.pop(k)
            else:
                free, first = capacity, sequences
                count = -(-left // (capacity // length))
                sequences += count
            each = free // length  # the fullest sequence stays the best fit
            full, rest = divmod(left, each)
            take = min(count, full)
            for layer in range(each if take else 0):
                slots.append((length, rank, rank + take, first, capacity - free + layer * length))
                rank += take
            left -= take * each
            leave(free - each * length, first, take)
            first, count = first + take, count - take
            if count and 0 < left < each:
                for layer in range(left):
                    slots.append((length, rank, rank + 1, first, capacity - free + layer * length))
                    rank += 1
                leave(free - left * length, first, 1)
                first, count, left = first + 1, count - 1, 0
            leave(free, first, count)
    return slots


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The operator: ``pieces`` (a written table) plus sequence_id and offset."""
    spark = pieces.sparkSession
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # capacity rows at most
    slots = F.broadcast(spark.createDataFrame(plan(histogram, capacity), SLOT).withColumnRenamed("length", "l"))
    buckets = max(1, -(-sum(histogram.values()) // BUCKET_ROWS))
    rows = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    earlier = W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    before = (rows.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("c"))
              .select("length", "bucket", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("before")))
    own = W.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (rows.withColumn("nth", F.row_number().over(own)).join(before, ["length", "bucket"])
              .withColumn("rank", F.col("before") + F.col("nth") - 1))
    on = (ranked["length"] == slots["l"]) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))
    return ranked.join(slots, on).select(
        *pieces.columns, (F.col("sequence_from") + F.col("rank") - F.col("rank_from")).alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    return packed(stored(token_pieces(docs, capacity=capacity), "packing-pieces"), capacity)


def op3_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
