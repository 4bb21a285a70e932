import collections
import math
import re

import numpy as np
from samples import DOC_SCHEMA, doc, prose
from podlake.llm import quality_rules as q


def statistics(text):
    t = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = np.zeros(len(w), bool)
    for i in range(len(w) - 7):
        if grams[tuple(w[i:i + 8])] > 1:
            covered[i:i + 8] = True
    rep = int(covered.sum())
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), rep,
            len(w) < 20 or 100 * rep > 30 * len(w))


def names(r):
    return tuple(r[f"__q_{c}"] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                         "base_failed"))


def test_statistics_match_brute_force(spark, edge_docs):
    extra = [doc(20, "a b c d e f g h " * 4), doc(21, "x " * 30), doc(22, "same line\nsame line\n \nsame line | # $"),
             doc(23, " ".join(map(str, range(40))) + " " + " ".join(map(str, range(5, 17))))]
    df = edge_docs.unionByName(spark.createDataFrame(extra, DOC_SCHEMA))
    for r in q.with_statistics(df).collect():
        assert names(r) == statistics(r["text"]), r["doc_id"]


def mcd(x):
    """The estimate of one group, step by step in numpy."""
    floor = np.array(q.FLOORS)
    fixed = np.round(x * q.SCALE) / q.SCALE

    def low(v, share):
        return np.sort(v)[math.ceil(share * len(v) - 1e-9) - 1]
    med = np.array([low(fixed[:, j], 0.5) for j in range(q.DIMS)])
    mad = np.array([low(np.abs(fixed[:, j] - med[j]), 0.5) for j in range(q.DIMS)])
    mean, cov = med, np.diag((1.4826 * mad) ** 2 + floor ** 2)
    d2 = lambda: np.einsum("ij,jk,ik->i", fixed - mean, np.linalg.inv(cov), fixed - mean)
    for _ in range(q.STEPS):
        bins = np.floor(np.log1p(d2()) * 1000)
        near = fixed[bins <= low(bins, q.SUPPORT)]
        widen = max(1.0, math.expm1(low(bins, 0.5) / 1000) / q.CHI2_MEDIAN)
        mean = near.mean(axis=0)
        cov = np.cov(near.T, bias=True) * widen + np.diag(floor ** 2)
    return d2()


def vectors(stats):
    n, chars, sym, dup, rep, lines = stats
    return [math.log((chars + 5 * q.SMOOTH) / (n + q.SMOOTH)), math.sqrt(sym / (n + q.SMOOTH)),
            math.sqrt(rep / (n + q.SMOOTH)), math.sqrt(dup / (lines + 5))]


def test_outliers_match_numpy(spark):
    rows = [doc(i, prose(i, 40 + i % 90) + (" #" * (i % 4)), "en", "a" if i % 3 else "b") for i in range(240)]
    rows += [doc(1000 + i, " ".join(w + "###" for w in prose(i, 60).split()), "en", "a") for i in range(12)]
    rows += [doc(2000, prose(7, 50), "fr", None)]
    out = {r["doc_id"]: r for r in q.judged(spark.createDataFrame(rows, DOC_SCHEMA)).collect()}
    for source in ("a", "b"):
        ids = [r[0] for r in rows if r[3] == source]
        x = np.array([vectors([out[i][f"__q_{c}"] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                            "n_repeat_words", "lines")]) for i in ids])
        want = mcd(x)
        assert np.allclose([out[i]["__q_d2"] for i in ids], want, rtol=1e-6, atol=1e-6)
    assert not any(out[1000 + i]["__q_kept"] for i in range(12))
    assert all(out[i]["__q_kept"] for i in range(240))
    assert out[2000]["__q_kept"]  # a group of one uses the estimate of the table


def test_edges_and_filter(edge_docs, no_docs):
    kept = q.kept_documents(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(map(str, ids)) == sorted(map(str, [1, 2, 2, 3, None, 9, 10, 12, 12, 13, 14]))
    assert q.kept_documents(no_docs).collect() == []
    assert q.judged(no_docs).collect() == []


def test_plan_is_native(spark):
    from samples import SF
    plan = q.op10_quality_rules(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
