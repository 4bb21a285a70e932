"""The pipeline against a plain-Python version of its five stages."""

import collections
import math

import numpy as np
import pytest
from brute import near_components
from samples import DOC_SCHEMA, SF, doc, prose
from podlake.llm import decontaminate, packing
from podlake.llm import quality_rules as q
from test_line_dedup import brute as brute_lines
from test_packing import check as check_pieces
from test_quality_rules import mcd, statistics, vectors

import corpus_pipeline as pipeline


def plain_quality(rows):
    """rows: (doc_id, text, lang, source)."""
    stats = {}
    for i, t, *_ in rows:
        n, chars, sym, dup, rep, failed = statistics(t)
        lines = sum(bool(x.strip(" \t\n\x0b\x0c\r")) for x in (t or "").split("\n"))
        stats[i] = (vectors((n, chars, sym, dup, rep, lines)), failed)
    good = [r for r in rows if not stats[r[0]][1]]
    keep = set()
    for i, _, lang, source in good:
        for same in (lambda r: r[2:] == (lang, source), lambda r: r[2] == lang, lambda r: True):  # noqa: B023
            ids = [r[0] for r in good if same(r)]
            if len(ids) >= q.MIN_GROUP:
                key = tuple(ids)
                if key not in plain_quality.seen:
                    plain_quality.seen[key] = dict(zip(ids, mcd(np.array([stats[k][0] for k in ids]))))
                if plain_quality.seen[key][i] <= q.CUTOFF:
                    keep.add(i)
                break
        else:
            keep.add(i)
    return keep


plain_quality.seen = {}


@pytest.fixture(scope="module")
def run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in pipeline.STAGES:
        df = stage(spark, out[-1], SF)
        out.append(spark.createDataFrame(df.collect(), df.schema))
    return out


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stage_names_and_columns(run):
    assert len(pipeline.STAGES) == 5 and pipeline.ORACLE_SQL is None
    for df in run[1:-1]:
        assert df.columns == run[0].columns and dict(df.dtypes) == dict(run[0].dtypes)


def test_quality(run):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in run[0].collect()]
    assert {r["doc_id"] for r in run[1].collect()} == plain_quality(rows)


def test_lines(run):
    want = {i: kept for i, _, _, kept in brute_lines(texts(run[1]))}
    assert dict(texts(run[2])) == want
    assert all(r["n_chars"] == len(r["text"]) for r in run[2].collect())


def test_near_copies(run):
    component = near_components(texts(run[2]))
    assert {i for i, _ in texts(run[3])} == {i for i, c in component.items() if i == c}


def test_benchmark(run, spark):
    items = [decontaminate.folded(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {i for i, t in texts(run[3]) if not any(x in decontaminate.folded(t) for x in items)}
    assert {i for i, _ in texts(run[4])} == want and len(want) < len(texts(run[3]))


def test_packing(run):
    rows = run[5].collect()
    check_pieces(rows, texts(run[4]))
    need = math.ceil(sum(r["length"] for r in rows) / packing.CAPACITY)
    assert len({r["sequence_id"] for r in rows}) <= need + max(2, need // 50)


def test_run_gives_the_last_stage(run, spark):
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    got = pipeline.run(spark, SF).collect()
    assert collections.Counter(map(key, got)) == collections.Counter(map(key, run[5].collect()))


def test_stages_handle_edges(spark, edge_docs, no_docs, tmp_path):
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for start in (edge_docs, no_docs):
        docs = start
        for _, stage in pipeline.STAGES:
            df = stage(spark, docs, str(tmp_path))
            docs = spark.createDataFrame(df.collect(), df.schema)
            assert df.columns == start.columns or stage is pipeline.STAGES[-1][1]
        assert (docs.count() == 0) == (start is no_docs)


def test_near_copies_from_a_similarity_of_80(spark):
    rows = []
    for g in range(12):
        w = prose(40 + g, 55).split()
        rows += [doc(2 * g, " ".join(w)), doc(2 * g + 1, " ".join([*w[:25], "changed", *w[26:]]))]
    near = near_components([(r[0], r[1]) for r in rows], 80)
    assert len(set(near.values())) == 12 and len(set(near_components([(r[0], r[1]) for r in rows], 85).values())) == 24
    left = pipeline.near_copies(spark, spark.createDataFrame(rows, DOC_SCHEMA), SF).collect()
    assert {r["doc_id"] for r in left} == {i for i, c in near.items() if i == c}


def test_near_copies_of_the_small_table_at_80(run):
    component = near_components(texts(run[2]), 80)
    assert {i for i, _ in texts(run[3])} == {i for i, c in component.items() if i == c}
