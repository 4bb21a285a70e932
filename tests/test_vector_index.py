"""The vector index against brute force: exact over all lists, recall of a few lists."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from settings import SF_MID

from podlake import catalog
from podlake.operators import search
from podlake.operators import vector_index as vi

SCHEMA = "id long, v array<float>, list string, u string"


def brute(ids, vectors, asked, k):
    """{query row: [(id, score)]} of plain cosine, ties by id."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    scores = np.round(unit[asked] @ unit.T, search.SCORE_DIGITS)
    return {ids[q]: [(ids[j], s[j]) for j in np.lexsort((ids, -s))[:k]] for q, s in zip(asked, scores, strict=True)}


def hits(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["id"], r["score"]))
    return out


def made(n, dim, groups, seed=0):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(groups, dim))
    # a third of all rows lies in one narrow group
    own = np.where(r.random(n) < 1 / 3, 0, r.integers(0, groups, n))
    return (centre[own] + 0.3 * r.normal(size=(n, dim))).astype(np.float32)


@pytest.mark.parametrize("lists,k", [(None, 10), (1, 3), (500, 7)])
def test_exact_equals_brute_force(spark, monkeypatch, lists, k):
    monkeypatch.setattr(vi, "BLOCK_ROWS", 64)  # the hot list is many blocks
    monkeypatch.setattr(vi, "QUERY_GROUP", 5)
    v = made(2000, 16, 12)
    ids = np.arange(2000) * 3
    df = spark.createDataFrame([(int(i), x.tolist(), "x", "y") for i, x in zip(ids, v, strict=True)], SCHEMA)
    index = vi.build(spark, df, "id", "v", lists=lists)
    asked = df.where("id % 120 = 0")
    got = hits(vi.search(index, asked, "id", "v", k))
    want = brute(ids, v.astype(float), np.flatnonzero(ids % 120 == 0), k)
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=1e-9)


def test_bounds_hold_and_prune(spark):
    v = made(3000, 32, 20, seed=1)
    df = spark.createDataFrame([(i, x.tolist(), "", "") for i, x in enumerate(v)], SCHEMA)
    index = vi.build(spark, df, "id", "v")
    q = vi.usable(df.where("id % 50 = 0"), "id", "v").select(F.col("id").alias("query_id"), "u")
    found = vi.candidates(index, q, 10).count()
    # full vectors are read for little more than the answers
    assert 60 * 10 <= found < 60 * 40
    assert index.blocks.groupBy("list").count().count() > 20


def test_recall_on_all_embeddings(spark):
    table = pq.read_table(f"{SF_MID}/embeddings.parquet")
    ids = table.column("vec_id").to_numpy()
    v = np.array(table.column("embedding").to_pylist(), float)
    want = brute(ids, v, np.flatnonzero(ids % 20 == 0), catalog.NEIGHBOURS)
    got = {}
    for r in catalog.q_vector_index_probed(spark, SF_MID).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    recall = np.mean([len(got[q] & {i for i, _ in want[q]}) / len(want[q]) for q in want])
    assert set(got) == set(want) and recall >= 0.9, recall


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0]), (4, None), (5, []), (6, [0.0, 0.0]),
            (7, [nan, 1.0]), (8, [1.0, None]), (9, [1.0, 2.0, 3.0]), (10, [inf, 1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA)
    index = vi.build(spark, df, "id", "v")
    got = hits(vi.search(index, df.where("id IN (1, 4, 5, 6, 7, 8, 9, 10)"), "id", "v", k=3))
    assert {q: [i for i, _ in h] for q, h in got.items()} == {1: [1, 2, 2]}
    none = vi.build(spark, df.limit(0), "id", "v")
    assert vi.search(none, df, "id", "v").count() == 0
