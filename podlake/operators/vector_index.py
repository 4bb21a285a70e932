"""SE5: nearest vectors by cosine with inverted lists and residual codes.

``build`` puts every row into the list of its nearest centroid. The centroids
come from spherical k-means over a sample of at most ``SAMPLE`` rows (the fit
only; every row is indexed). A row's residual to its centroid is kept as one
signed byte per dimension and a scale, with the length of what the code leaves
out (``err``), so for a query q of length one and a row v::

    code score - err <= q . v <= code score + err
    q . v <= q . centroid + radius            (radius: the list's longest residual)

``search`` scores the codes of each query's nearest lists first. The k-th best
lower bound there is the query's threshold: lists whose bound lies below it are
not read, and of the others only rows whose upper bound reaches it are scored
with their full vectors. The result is that of ``cosine_top_k``. The radius is
a worst case: a residual that points anywhere adds about radius / sqrt(dim) to a
score. With ``deviations`` the second bound allows that many of these instead:
fewer lists are read, the result is exact among them and approximate as a whole.

Scale: a list is stored in blocks of about ``BLOCK_ROWS`` rows by a salt whose
number comes from the list's counted size, so a list that holds a third of all
rows is many blocks in many tasks. Queries meet blocks by an equi-join on the
list in groups of ``QUERY_GROUP``. The list table (at most ``MAX_LISTS`` rows)
is the only thing collected or sent to tasks.

Defined results: rows without an id or whose vector is null, empty, of another dimension than the
index, zero, or with a null or non-finite component are not indexed and, as
queries, return nothing; repeated rows are kept as rows; ties go by id after
rounding; an empty table gives an index without lists and no hits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import spread
from ..sources.io import materialize
from .search import SCORE_DIGITS, top_k

#: Rows that the centroids are fitted on, at most.
SAMPLE = 65_536
MAX_LISTS = 4096
BLOCK_ROWS = 1024
QUERY_GROUP = 256
#: Lists whose codes give a query its threshold.
FIRST_LISTS = 4
ROUNDS = 8
#: Widening of all bounds: scores are rounded before they are ranked.
SLACK = 2 * 10.0 ** -SCORE_DIGITS


@dataclass
class VectorIndex:
    dim: int
    centroids: np.ndarray  # one row per list
    radius: np.ndarray     # -1 for a list without rows
    blocks: DataFrame      # list, salt, rows: array<struct<id, scale, err, code>>
    vectors: DataFrame     # id, list, v


def usable(df: DataFrame, id_col: str, vec_col: str, dim: int | None = None) -> DataFrame:
    """id, v (array<double>), u (v at length one) of the rows that take part."""
    rows = df.select(F.col(id_col).alias("id"), F.transform(F.col(vec_col), lambda x: x.cast("double")).alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x)
    rows = rows.withColumn("norm", F.sqrt(square)).where("id IS NOT NULL AND norm > 0 AND norm < double('infinity')")
    if dim is not None:
        rows = rows.where(F.size("v") == dim)
    return rows.select("id", "v", F.transform("v", lambda x: x / F.col("norm")).alias("u"))


def fit(sample: np.ndarray, lists: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means: centroids of length one, started at spread-out rows."""
    at = [0]
    near = sample @ sample[0]
    while len(at) < min(lists, len(sample)):
        at.append(int(near.argmin()))
        near = np.maximum(near, sample @ sample[at[-1]])
    centres = sample[at]
    for _ in range(rounds):
        own = np.concatenate([(sample[lo:lo + 4096] @ centres.T).argmax(1) for lo in range(0, len(sample), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 1e-12, sums / np.maximum(size, 1e-12), centres)
    return centres


def _code(centres: np.ndarray):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            u = batch.column("u").flatten().to_numpy().reshape(batch.num_rows, -1)
            own = (u @ centres.T).argmax(1)
            rest = u - centres[own]
            scale = np.maximum(np.abs(rest).max(1), 1e-30) / 127
            code = np.rint(rest / scale[:, None]).astype(np.int8)
            err = np.linalg.norm(rest - code * scale[:, None], axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), pa.array(own.astype(np.int32)), pa.array(np.linalg.norm(rest, axis=1)),
                 pa.array(scale), pa.array(err), pa.array([c.tobytes() for c in code], pa.binary())],
                names=["id", "v", "list", "length", "scale", "err", "code"])

    return run


def build(spark: SparkSession, corpus: DataFrame, id_col: str, vec_col: str, lists: int | None = None,
          sample: int = SAMPLE) -> VectorIndex:
    """Index every usable row. ``lists``: about the square root of the rows if
    not given; the dimension is the most frequent one."""
    sized = usable(corpus, id_col, vec_col).groupBy(F.size("v").alias("dim")).count()
    first = sized.orderBy(F.desc("count"), "dim").first()
    dim, n = (first["dim"], first["count"]) if first else (1, 0)
    rows = usable(spread(corpus), id_col, vec_col, dim)
    share = min(1.0, sample / max(1, n))
    picked = (rows.where(F.pmod(F.xxhash64("id", "v"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
              .select("u").orderBy(F.xxhash64("u"), "u").limit(sample).collect())
    lists = max(1, min(MAX_LISTS, lists or round(n ** 0.5)))
    centres = fit(np.array([r["u"] for r in picked], float), lists) if picked else np.zeros((0, dim))
    kind = rows.schema["id"].dataType.simpleString()
    coded = materialize(rows.mapInArrow(_code(centres), f"id {kind}, v array<double>, list int, length double, "
                                        "scale double, err double, code binary"), spark, "vector-codes")
    sizes = coded.groupBy("list").agg(F.max("length").alias("radius"), F.count(F.lit(1)).alias("n"))
    radius = np.full(len(centres), -1.0)
    for r in sizes.collect():  # a row per list
        radius[r["list"]] = r["radius"]
    salts = sizes.select("list", F.ceil(F.col("n") / BLOCK_ROWS).alias("salts"))
    blocks = (coded.join(salts, "list").withColumn("salt", F.pmod(F.xxhash64("id", "code"), F.col("salts")))
              .groupBy("list", "salt").agg(F.collect_list(F.struct("id", "scale", "err", "code")).alias("rows")))
    return VectorIndex(dim, centres, radius, materialize(blocks, spark, "vector-blocks"), coded.select("id", "list", "v"))


def _lists(centres: np.ndarray, radius: np.ndarray, deviations: float | None):
    """Per query and list: the bound of its rows and the list's place."""
    share = 1.0 if deviations is None else min(1.0, deviations / centres.shape[1] ** 0.5)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            u = batch.column("u").flatten().to_numpy().reshape(batch.num_rows, -1)
            near = np.where(radius >= 0, u @ centres.T, -np.inf)
            order = np.argsort(-near, axis=1, kind="stable")[:, :int((radius >= 0).sum())]
            row = np.repeat(np.arange(len(u)), order.shape[1])
            at = order.ravel()
            yield pa.RecordBatch.from_arrays(
                [batch.column("query_id").take(pa.array(row)), pa.array(at.astype(np.int32)),
                 pa.array(near[row, at] + share * radius[at]), pa.array(np.tile(np.arange(order.shape[1]), len(u)).astype(np.int32))],
                names=["query_id", "list", "bound", "place"])

    return run


def _score(centres: np.ndarray, k: int | None):
    """Joined rows (a group of queries, a block of codes): with ``k`` the k best
    lower bounds per query, else the rows whose upper bound reaches ``floor``."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                asked, rows = batch.column("asked")[i].values, batch.column("rows")[i].values
                q = asked.field("u").flatten().to_numpy().reshape(len(asked), -1)
                centre = centres[batch.column("list")[i].as_py()]
                code = np.frombuffer(b"".join(rows.field("code").to_pylist()), np.int8).reshape(len(rows), -1)
                err = rows.field("err").to_numpy()
                about = (q @ centre)[:, None] + (q @ code.T.astype(float)) * rows.field("scale").to_numpy()
                if k is not None:
                    low = about - err
                    best = min(k, low.shape[1])
                    value = -np.partition(-low, best - 1, axis=1)[:, :best].ravel()
                    a = np.repeat(np.arange(len(asked)), best)
                    yield pa.RecordBatch.from_arrays([asked.field("query_id").take(pa.array(a)), pa.array(value)], names=["query_id", "low"])
                else:
                    a, b = np.nonzero(about + err >= asked.field("floor").to_numpy()[:, None])
                    yield pa.RecordBatch.from_arrays([asked.field("query_id").take(pa.array(a)), rows.field("id").take(pa.array(b))],
                                                     names=["query_id", "id"])

    return run


def _met(index: VectorIndex, asked: DataFrame) -> DataFrame:
    """Groups of queries (list, query_id, u, floor) beside the blocks of their list;
    the number of groups comes from the queries' counted number per list."""
    asked = materialize(asked, asked.sparkSession, "vector-asked")
    parts = asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERY_GROUP).alias("parts"))
    groups = (asked.join(parts, "list").withColumn("g", F.pmod(F.xxhash64("query_id"), F.col("parts")))
              .groupBy("list", "g").agg(F.collect_list(F.struct("query_id", "u", "floor")).alias("asked")))
    return index.blocks.join(groups, "list").select("list", "asked", "rows")


def candidates(index: VectorIndex, queries: DataFrame, k: int, deviations: float | None = None) -> DataFrame:
    """(query_id, id) of the rows that can be among the best ``k``; ``queries`` is
    a stored table (query_id, u)."""
    spark = queries.sparkSession
    qkind, idkind = queries.schema["query_id"].dataType, index.vectors.schema["id"].dataType
    reach = materialize(queries.mapInArrow(_lists(index.centroids, index.radius, deviations),
                                           f"query_id {qkind.simpleString()}, list int, bound double, place int"), spark, "vector-reach")
    near = reach.where(F.col("place") < FIRST_LISTS).join(queries, "query_id").select("list", "query_id", "u", F.lit(0.0).alias("floor"))
    lows = _met(index, near).mapInArrow(_score(index.centroids, k), f"query_id {qkind.simpleString()}, low double")
    kth = top_k_value(lows, k)
    floor = F.coalesce(F.col("kth") - SLACK, F.lit(-2.0))  # fewer than k rows seen: everything reaches it
    asked = (reach.join(queries, "query_id").join(kth, "query_id", "left").withColumn("floor", floor)
             .where((F.col("bound") + SLACK >= F.col("floor")) | (F.col("place") < FIRST_LISTS)).select("list", "query_id", "u", "floor"))
    return _met(index, asked).mapInArrow(_score(index.centroids, None),
                                         f"query_id {qkind.simpleString()}, id {idkind.simpleString()}").distinct()


def top_k_value(lows: DataFrame, k: int) -> DataFrame:
    """query_id, kth: the k-th largest ``low``; no row where there are fewer."""
    order = Window.partitionBy("query_id").orderBy(F.desc("low"))
    return (lows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
            .where(F.col("r") == k).select("query_id", F.col("low").alias("kth")))


def search(index: VectorIndex, queries: DataFrame, qid: str, qvec: str, k: int = 5,
           deviations: float | None = None) -> DataFrame:
    """(query_id, id, score, rank) by cosine: exact, or among the lists whose bound
    of ``deviations`` reaches the threshold."""
    spark = queries.sparkSession
    asked = materialize(usable(queries, qid, qvec, index.dim).withColumnRenamed("id", "query_id"), spark, "vector-queries")
    if not len(index.centroids):
        return top_k(asked.select("query_id", F.col("query_id").alias("id"), F.lit(0.0).alias("score")).where("false"), k)
    found = materialize(candidates(index, asked.select("query_id", "u"), k, deviations), spark, "vector-candidates")
    norm = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x * x))
    scored = (found.join(index.vectors.select("id", "v"), "id")
              .join(asked.select("query_id", F.col("v").alias("q")), "query_id")
              .select("query_id", "id", (F.aggregate(F.zip_with("q", "v", lambda a, c: a * c), F.lit(0.0), lambda acc, x: acc + x)
                                         / (norm("q") * norm("v"))).alias("score")))
    return top_k(scored, k)
