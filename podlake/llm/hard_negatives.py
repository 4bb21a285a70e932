r"""Hard negatives (operator 13): LEMP-style coordinate pruning of inner products.

Vectors are whole numbers (``floor(scale * x)``), scores exact inner products. For
each anchor the ``n_positives`` best rows of its label are its positives; for each
positive the ``n_negatives`` best rows of other labels whose score lies between
``low`` and ``high`` percent of the positive's score are returned.

Method. Rows are dealt into buckets of similar length (``BUCKET_STEP``) and a
bucket into chunks of about ``CHUNK`` rows, so that a bucket with a third of all
rows is many chunks. A chunk holds, for each coordinate, its rows in the order of that
coordinate of the unit vectors. Anchors form blocks of about ``BLOCK``. A block meets every
chunk once, the longest first, in strips of ``STRIP`` chunks that are tasks of
their own. Within a strip an anchor keeps its best rows so far; the worst of
them is its threshold, which with the lengths gives a least cosine for the chunk
(and the upper end of the score window a largest one). If the anchor's unit
vector has cos a at a focus coordinate, a row with cosine at least cos g has that
coordinate between cos(a + g) and cos(a - g); each of the ``FOCUS`` largest coordinates
of the anchor gives such a range by binary search in the sorted lists. A chunk
whose longest row can't reach the threshold is skipped; else the narrowest
range's rows, less those outside another range, are verified by exact inner products. Where the
ranges leave most of a chunk, the whole chunk is verified in one matrix product.
Pruning only leaves out rows that can't be returned; a margin covers rounding.

Scale: anchors and chunks travel as one packed row each, chunks once per block
and blocks once per strip, so memory is a block and a chunk, at any size. The stated
query set meets all rows in blocks; tasks return at most the rows an anchor may keep per strip, which
a row-number window with partial limits reduces.

Defined results: rows with a null vec_id, label or vector, or with a null or
non-finite component take no part; of rows that share a vec_id the one with the
smallest (label, vector) does; shorter vectors count as filled with zeros; empty
vectors score 0. Ties go to the smaller vec_id. An anchor without other rows of
its label has no positives and no result. Scores that do not fit 64 bits are not
supported; sums beyond 2**53 are computed in 64-bit integers. Empty tables give no rows; columns beyond
those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_arrow, ship, stored

BUCKET_STEP = 1.1
CHUNK = 2048
BLOCK = 2048
STRIP = 4
FOCUS = 3
#: Part of a chunk that the ranges must leave out to be worth following.
WORTH = 0.5
#: Added to every range end against rounding of unit vectors.
MARGIN = 1e-5
EXACT = 2.0 ** 53

PACKED = "bucket int, chunk int, dim int, longest double, ids binary, labels binary, vectors binary, orders binary"


def whole_vectors(rows: DataFrame, scale: int = 256, id_col: str = "vec_id", label_col: str = "label",
                  vector_col: str = "embedding") -> DataFrame:
    """(vec_id, label, v array<long>, length) of the rows that take part."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: F.coalesce(c.between(-1.7976931348623157e308, 1.7976931348623157e308) & ~F.isnan(c), F.lit(False)))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), x.alias("x")) \
        .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)))
    rows = rows.select("vec_id", "label", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")
    squares = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    return one.withColumn("length", F.sqrt(squares))

HELD = "array<struct<anchor_id: bigint, positive_id: bigint, positive_score: bigint>>"

# --- packing ----------------------------------------------------------------------

def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """A list column as a matrix of ``dim`` columns, short rows filled with zeros."""
    lists = lists.cast(pa.large_list(pa.int64()))
    values = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), dim), np.int64)
    if len(values):
        row = np.repeat(np.arange(len(lists)), sizes)
        out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    length = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return np.divide(v, length, out=np.zeros_like(v), where=length > 0)


def _pack(sorted_lists: bool):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        dim = max((len(x) for x in table.column("v")), default=0)
        v = np.concatenate([_matrix(c, dim) for c in table.column("v").chunks])
        ids, labels = table.column("vec_id").to_numpy(), table.column("label").to_numpy()
        at = np.argsort(ids, kind="stable")
        ids, labels, v = ids[at], labels[at], v[at]
        small = np.abs(v).max(initial=0) < 2 ** 31
        orders = np.argsort(unit(v), axis=0, kind="stable").T.astype("<u4").tobytes() if sorted_lists else b""
        return pa.table({
            "bucket": pa.array([key[0].as_py()], pa.int32()), "chunk": pa.array([key[1].as_py()], pa.int32()),
            "dim": pa.array([dim], pa.int32()), "longest": pa.array([table.column("length").to_numpy().max(initial=0.0)], pa.float64()),
            "ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()), "labels": pa.array([labels.astype("<i8").tobytes()], pa.binary()),
            "vectors": pa.array([v.astype("<i4" if small else "<i8").tobytes()], pa.binary()), "orders": pa.array([orders], pa.binary())})
    return run


def dealt(rows: DataFrame, size: int) -> DataFrame:
    """With a chunk number: a bucket's rows dealt by a hash into as many chunks as its
    count asks for."""
    counts = rows.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("chunks"))
    return rows.join(counts, "bucket").withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int")).drop("chunks")


def packed(rows: DataFrame, sorted_lists: bool) -> DataFrame:
    """One row per chunk."""
    ship(rows.sparkSession)
    return (rows.select("bucket", "chunk", "vec_id", "label", "v", "length").groupBy("bucket", "chunk")
            .applyInArrow(_pack(sorted_lists), PACKED))


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels, dim = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8"), row["dim"]
    kind = "<i4" if len(row["vectors"]) == 4 * dim * len(ids) else "<i8"
    return ids, labels, np.frombuffer(row["vectors"], kind).reshape(len(ids), dim).astype(np.int64)


# --- pruning ----------------------------------------------------------------------

class Chunk:
    """Rows of similar length with their sorted coordinate lists."""

    def __init__(self, row: dict):
        self.ids, self.labels, self.v = _unpacked(row)
        self.longest, self.dim = row["longest"], row["dim"]
        self.unit = unit(self.v)
        lengths = np.sqrt((self.v.astype(np.float64) ** 2).sum(axis=1))
        self.shortest = float(lengths.min(initial=np.inf))
        self.order = np.frombuffer(row["orders"], "<u4").reshape(self.dim, len(self.ids))
        self.sorted = np.take_along_axis(self.unit.T, self.order.astype(np.int64), axis=1)
        self.exact = self.v.astype(np.float64)
        self.most = float(np.abs(self.exact).max(initial=0.0))

    def candidates(self, q: np.ndarray, length: float, least: float, most: float) -> np.ndarray | None:
        """Rows whose score with an anchor (unit vector and length) may lie in [least,
        most]; None: verify all."""
        n = len(self.ids)
        if not length or not self.shortest:  # rows of length 0 are a bucket of their own
            return None if self.longest and length or least <= 0 <= most else np.zeros(0, np.int64)
        cos_low = least / (length * (self.longest if least > 0 else self.shortest))
        cos_high = most / (length * (self.shortest if most > 0 else self.longest))
        if cos_low > 1 + MARGIN or cos_high < -1 - MARGIN:
            return np.zeros(0, np.int64)
        low_angle, high_angle = np.arccos(np.clip(cos_low, -1, 1)), np.arccos(np.clip(cos_high, -1, 1))
        focus = np.argsort(-np.abs(q), kind="stable")[:FOCUS]
        ranges = []
        for f in focus.tolist():
            a = np.arccos(np.clip(q[f], -1, 1))
            from_angle = max(a - low_angle, high_angle - a, 0.0)
            to_angle = min(a + low_angle, 2 * np.pi - high_angle - a, np.pi)
            lo, hi = np.cos(to_angle) - MARGIN, np.cos(from_angle) + MARGIN
            ranges.append((f, lo, hi, *np.searchsorted(self.sorted[f], [lo, hi], side="left")))
        f, _, _, a, b = min(ranges, key=lambda r: r[4] - r[3])
        if b - a > (1 - WORTH) * n:
            return None
        rows = self.order[f, a:b].astype(np.int64)
        for g, lo, hi, _, _ in ranges:
            if g != f:
                c = self.unit[rows, g]
                rows = rows[(c >= lo) & (c <= hi)]
        return rows


class Block:
    """Anchors, their unit vectors, and what each keeps."""

    def __init__(self, row: dict):
        self.ids, self.labels, self.v = _unpacked(row)
        self.dim = row["dim"]
        self.unit = unit(self.v)
        self.exact = self.v.astype(np.float64)
        self.lengths = np.sqrt((self.exact ** 2).sum(axis=1))

    def scores(self, chunk: Chunk, anchors: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """Exact inner products of anchors with rows (all if None)."""
        d = min(self.dim, chunk.dim)
        most = float(np.abs(self.exact[anchors]).max(initial=0.0))
        if most * chunk.most * max(d, 1) < EXACT:
            right = chunk.exact if rows is None else chunk.exact[rows]
            return (self.exact[anchors, :d] @ right[:, :d].T).astype(np.int64)
        right = chunk.v if rows is None else chunk.v[rows]
        return self.v[anchors, :d] @ right[:, :d].T


def _tiles(block: Block, chunk: Chunk, active: np.ndarray, least: np.ndarray, most: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, rows, scores) of all rows that may matter, per active anchor."""
    d = min(block.dim, chunk.dim)
    dense = []
    for i in active.tolist():
        q = block.unit[i]
        rows = chunk.candidates(q[:chunk.dim] if block.dim >= chunk.dim else np.pad(q, (0, chunk.dim - d)),
                                float(block.lengths[i]), float(least[i]), float(most[i]))
        if rows is None:
            dense.append(i)
        elif len(rows):
            yield i, rows, block.scores(chunk, np.array([i]), rows)[0]
    for at in range(0, len(dense), 256):
        part = np.array(dense[at:at + 256])
        for i, s in zip(part.tolist(), block.scores(chunk, part), strict=True):
            rows = np.flatnonzero((s >= least[i]) & (s <= most[i]))
            if len(rows):
                yield i, rows, s[rows]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(ids) > 4 * k:  # only what reaches the k-th score can be among the best
        fine = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        ids, scores = ids[fine], scores[fine]
    at = np.lexsort((ids, -scores))[:k]
    return ids[at], scores[at]


LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
NONE = (np.zeros(0, np.int64), np.zeros(0, np.int64))


class Positives:
    """The best rows of an anchor's own label."""

    schema = "anchor_id long, positive_id long, positive_score long"

    def __init__(self, row: dict, k: int):
        self.block, self.k = Block(row), k
        self.kept = [NONE] * len(self.block.ids)
        self.least = np.full(len(self.block.ids), LEAST)

    def meet(self, chunk: Chunk) -> None:
        b = self.block
        most = np.full(len(b.ids), MOST)
        for label in np.intersect1d(b.labels, chunk.labels):
            own = chunk.labels == label
            for i, rows, s in _tiles(b, chunk, np.flatnonzero(b.labels == label), self.least, most):
                fine = own[rows] & (chunk.ids[rows] != b.ids[i])
                if fine.any():
                    held = self.kept[i]
                    self.kept[i] = _best(np.concatenate([held[0], chunk.ids[rows[fine]]]), np.concatenate([held[1], s[fine]]), self.k)
                    if len(self.kept[i][0]) == self.k:
                        self.least[i] = self.kept[i][1][-1]

    def told(self) -> dict[str, np.ndarray]:
        n = [len(k[0]) for k in self.kept]
        return {"anchor_id": np.repeat(self.block.ids, n), "positive_id": np.concatenate([NONE[0], *(k[0] for k in self.kept)]),
                "positive_score": np.concatenate([NONE[0], *(k[1] for k in self.kept)])}


class Negatives:
    """For each positive of an anchor the best rows of other labels in its window."""

    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"

    def __init__(self, row: dict, k: int, low: int, high: int):
        self.block, self.k, self.low, self.high = Block(row), k, low, high
        places = {x: i for i, x in enumerate(self.block.ids.tolist())}
        self.positives: list[list[tuple[int, int]]] = [[] for _ in places]
        for p in row["held"]:
            score = p["positive_score"]
            if low * score <= high * score:  # else no score lies in the window
                self.positives[places[p["anchor_id"]]].append((p["positive_id"], score))
        self.kept = [[NONE] * len(p) for p in self.positives]
        self.floor = [[-(-low * s // 100) for _, s in p] for p in self.positives]
        self.top = [[high * s // 100 for _, s in p] for p in self.positives]
        self.active = np.array([i for i, p in enumerate(self.positives) if p], np.int64)
        self.least = np.array([min(x, default=0) for x in self.floor], np.int64)
        self.most = np.array([max(x, default=0) for x in self.top], np.int64)

    def meet(self, chunk: Chunk) -> None:
        b = self.block
        for i, rows, s in _tiles(b, chunk, self.active, self.least, self.most):
            fine = chunk.labels[rows] != b.labels[i]
            ids, s = chunk.ids[rows[fine]], s[fine]
            if not len(ids):
                continue
            at = np.lexsort((ids, -s))
            ids, s = ids[at], s[at]
            least = []
            for p, (floor, top) in enumerate(zip(self.floor[i], self.top[i], strict=True)):
                held = self.kept[i][p]
                full = len(held[0]) == self.k
                a = int(np.searchsorted(-s, -top))
                z = min(int(np.searchsorted(-s, -floor, side="right")), a + self.k)
                if z > a and not (full and s[a] < held[1][-1]):
                    held = self.kept[i][p] = _best(np.concatenate([held[0], ids[a:z]]), np.concatenate([held[1], s[a:z]]), self.k)
                    full = len(held[0]) == self.k
                least.append(max(floor, held[1][-1]) if full else floor)
            self.least[i] = min(least)

    def told(self) -> dict[str, np.ndarray]:
        rows = [(a, p, ps, n, ns) for a, pos, kept in zip(self.block.ids.tolist(), self.positives, self.kept, strict=True)
                for (p, ps), (ids, s) in zip(pos, kept, strict=True) for n, ns in zip(ids.tolist(), s.tolist(), strict=True)]
        cols = zip(*rows, strict=True) if rows else [[]] * 5
        names = ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")
        return {n: np.array(c, np.int64) for n, c in zip(names, cols, strict=True)}


def _meet(make):
    """Batches of one task, a strip at a time: the block first, then its chunks, the longest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                if row["held"] is not None:
                    if now is not None:
                        yield pa.RecordBatch.from_pydict(now.told())
                    now = make(row)
                elif now is not None and len(now.block.ids):
                    now.meet(Chunk(row))
        if now is not None:
            yield pa.RecordBatch.from_pydict(now.told())

    return run


def _strips(blocks: DataFrame, chunks: DataFrame, n_blocks: int, n_strips: int) -> DataFrame:
    """Every block with every strip of chunks, in the order a task reads them."""
    cols = ["dim", "longest", "ids", "labels", "vectors", "orders", "held"]
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = blocks.select("block", every(n_strips).alias("strip"), *cols)
    right = chunks.withColumn("held", F.lit(None).cast(HELD)) \
        .select(every(n_blocks).alias("block"), F.pmod(F.xxhash64("bucket", "chunk"), F.lit(n_strips)).cast("int").alias("strip"), *cols)
    both = left.unionByName(right)
    return (both.repartition(n_blocks * n_strips, "block", "strip")
            .sortWithinPartitions("block", "strip", F.col("held").isNull(), F.desc("longest")).select(*cols))


def hard_negatives(rows: DataFrame, anchors: Column, n_positives: int = 5, n_negatives: int = 10, low: int = 30,
                   high: int = 90) -> DataFrame:
    """The operator over ``whole_vectors`` rows; ``anchors`` is a condition on vec_id:
    (anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    rows = stored(rows, "negatives-vectors")
    length = F.when(F.col("length") > 0, F.floor(F.log(F.col("length")) / float(np.log(BUCKET_STEP)))).otherwise(-1)
    chunks = stored(packed(dealt(rows.withColumn("bucket", length.cast("int")), CHUNK), True), "negatives-chunks")
    owners = stored(dealt(rows.where(anchors).withColumn("bucket", F.lit(0)), BLOCK), "negatives-anchors")
    blocks = stored(packed(owners, False).withColumnRenamed("chunk", "block"), "negatives-blocks")
    n_blocks, n_strips = max(1, blocks.count()), max(1, -(-chunks.count() // STRIP))

    told = in_arrow(_strips(blocks.withColumn("held", F.array().cast(HELD)), chunks, n_blocks, n_strips),
                    _meet(lambda row: Positives(row, n_positives)), Positives.schema)
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    positives = stored(told.withColumn("place", F.row_number().over(best)).where(F.col("place") <= n_positives).drop("place"),
                       "negatives-positives")

    # beside a block its anchors' positives, at most n_positives times BLOCK
    held = (positives.join(owners.select(F.col("vec_id").alias("anchor_id"), F.col("chunk").alias("block")), "anchor_id")
            .groupBy("block").agg(F.sort_array(F.collect_list(F.struct("anchor_id", "positive_id", "positive_score"))).alias("held")))
    told = in_arrow(_strips(blocks.join(held, "block"), chunks, n_blocks, n_strips),
                    _meet(lambda row: Negatives(row, n_negatives, low, high)), Negatives.schema)
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (told.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n_negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(whole_vectors(rows.withColumn("label", moved)), F.col("vec_id") % 100 == 0)


SQL = """
WITH fine AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS own, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM fine a JOIN fine b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 10
"""
