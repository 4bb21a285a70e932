import math
import random

import numpy as np
import pytest
from podlake.llm import hard_negatives as H
from podlake.oracle.compare import compare, duck
from pyspark.sql import functions as F

ROW = "vec_id long, embedding array<double>, label int, v string, length int, chunk int, bucket int, held int"


def plain(rows, is_anchor, n_positives=5, n_negatives=10, low=30, high=90, scale=256):
    best = {}
    for i, x, label in rows:
        if i is None or x is None or label is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        row = (label, [math.floor(scale * c) for c in x])
        best[i] = min(best.get(i, row), row)
    score = lambda a, b: sum(p * q for p, q in zip(best[a][1], best[b][1]))
    out = set()
    for a in filter(is_anchor, best):
        own = sorted((-score(a, i), i) for i in best if i != a and best[i][0] == best[a][0])[:n_positives]
        other = sorted((-score(a, i), i) for i in best if best[i][0] != best[a][0])
        for ps, p in own:
            fine = [(-s, i) for s, i in other if low * -ps <= 100 * -s <= high * -ps][:n_negatives]
            out |= {(a, p, k + 1, i, -ps, s) for k, (s, i) in enumerate(fine)}
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3, 4) for r in rows], ROW)


def told(df):
    rows = [tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def made(kind, n=400, dim=12, seed=0):
    r = np.random.default_rng(seed)
    centers = r.normal(size=(6, dim))
    rows = []
    for i in range(n):
        v = {"spread": r.normal(size=dim), "clusters": centers[i % 6] + r.normal(size=dim) * 0.15,
             "lengths": r.normal(size=dim) * 3 ** r.normal(), "sparse": r.normal(size=dim) * (r.random(dim) < 0.2),
             "ties": r.integers(-1, 2, dim) / 4, "negative": -np.abs(r.normal(size=dim)), "copies": centers[i % 3] * (0.5 + 0.5 * (i % 4 == 0))}[kind]
        rows.append((i, [float(x) for x in v], int(r.integers(0, 4)) if kind != "clusters" else i % 5))
    return rows


@pytest.mark.parametrize("kind", ["spread", "clusters", "lengths", "sparse", "ties", "negative", "copies"])
def test_against_brute_force(spark, monkeypatch, kind):
    """Small chunks, blocks and strips, so that thresholds run and ranges prune."""
    for name, value in (("CHUNK", 40), ("BLOCK", 7), ("STRIP", 3)):
        monkeypatch.setattr(H, name, value)
    rows = made(kind)
    got = told(H.hard_negatives(H.whole_vectors(frame(spark, rows)), F.col("vec_id") % 20 == 0))
    assert got == plain(rows, lambda i: i % 20 == 0) and got


def test_ranges_hold_every_row_that_scores_in_the_window(monkeypatch):
    """The pruning bound itself, followed whatever it leaves, and that it prunes."""
    monkeypatch.setattr(H, "WORTH", 0)
    pruned = 0
    for seed, kind in enumerate(["spread", "clusters", "lengths", "sparse", "negative"]):
        rows = made(kind, 300, 8, seed)
        v = np.array([[math.floor(256 * x) for x in r[1]] for r in rows])
        table = H._pack(True)((pa_scalar(0), pa_scalar(0)), pa_table(v))
        chunk = H.Chunk({n: table.column(n)[0].as_py() for n in table.column_names})
        for i in range(0, 300, 7):
            s, length = chunk.v @ v[i], float(np.sqrt((v[i].astype(float) ** 2).sum()))
            if not length:
                continue
            for least, most in ((np.quantile(s, 0.9), np.inf), (np.quantile(s, 0.97), np.quantile(s, 0.99)), (-np.inf, np.quantile(s, 0.02))):
                found = chunk.candidates(H.unit(v[i:i + 1])[0], length, least, most)
                if found is not None:
                    assert set(np.flatnonzero((s >= least) & (s <= most))) <= set(found)
                    pruned += 1
    assert pruned > 20


def pa_scalar(x):
    import pyarrow as pa
    return pa.scalar(x, pa.int32())


def pa_table(v):
    import pyarrow as pa
    lengths = np.sqrt((v.astype(float) ** 2).sum(axis=1))
    return pa.table({"bucket": [0] * len(v), "chunk": [0] * len(v), "vec_id": np.arange(len(v)), "label": np.zeros(len(v), np.int64),
                     "v": pa.array(v.tolist(), pa.list_(pa.int64())), "length": lengths})


def test_edge_rows(spark):
    r = random.Random(3)
    rows = [(i, [r.uniform(-1, 1) for _ in range(4)], i % 3) for i in range(60)]
    rows += [(None, [1.0] * 4, 1), (61, None, 1), (62, [1.0, None, 0.0, 0.0], 1), (63, [math.nan] * 4, 0), (64, [math.inf, 0.0, 0.0, 0.0], 0),
             (65, [1.0] * 4, None), (66, [], 0), (67, [0.0] * 4, 1), (68, [0.5, 0.5], 2), (69, [0.1] * 6, 0), (70, [], 2), (80, [0.0] * 4, 2),
             (20, [0.9] * 4, 1), (20, [0.9] * 4, 1), (21, [0.9] * 4, 1), (-100, [0.3] * 4, 1), (90, [3e6, 4e6, 1e6, -2e6], 1),
             (100, [0.2] * 4, 77)]
    rows += rows[:5]
    df = frame(spark, rows)
    assert told(H.hard_negatives(H.whole_vectors(df), F.col("vec_id") % 10 == 0)) == plain(rows, lambda i: i % 10 == 0)
    assert told(H.hard_negatives(H.whole_vectors(df.limit(0)), F.col("vec_id") % 10 == 0)) == set()
    assert told(H.hard_negatives(H.whole_vectors(df), F.col("vec_id") == 5000)) == set()


def test_sums_beyond_double_precision(spark):
    rows = [(i, [float(2 ** 22 + i), float(2 ** 22 - 3 * i), 1.0 / 256], i % 2) for i in range(30)]
    got = told(H.hard_negatives(H.whole_vectors(frame(spark, rows)), F.col("vec_id") % 10 == 0, low=30, high=101))
    assert got == plain(rows, lambda i: i % 10 == 0, high=101) and got


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_query_matches_sql(spark, sf):
    ok, message = compare(H.op13_hard_negatives(spark, sf), duck(sf), H.SQL)
    assert ok, message
