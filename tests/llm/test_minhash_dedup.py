import random

import numpy as np
import pyarrow as pa
import pytest
from brute import near_components, shingle_set, words
from samples import DOC_SCHEMA, SF, doc, prose
from podlake.llm import minhash_dedup as m
from podlake.llm import tokens
from podlake.llm.links import components


def edited(text, n, seed):
    r, w = random.Random(seed), text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
    return " ".join(w)


def check(df, rows):
    want = near_components(rows)
    got = m.near_duplicates(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == want[r["doc_id"]], r
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    sizes = sorted(len(shingle_set(t)) for _, t in rows)
    assert sorted(r["n_shingles"] for r in got) == sizes


def test_words_and_shingles_match_plain_python():
    texts = ["", None, " a  b ", "One two\tTHREE four\x0bfive six", "é É x y z q", "end ", "a b c d"]
    column = pa.array(texts)
    data, offsets = tokens.text_bytes(column)
    starts, ends, first = tokens.word_spans(data, offsets)
    found = [bytes(data[s:e]).decode() for s, e in zip(starts, ends)]
    assert found == [x for t in texts for x in tokens_of(t)]
    hashes, at = tokens.column_shingles(column)
    assert [len(set(hashes[a:b].tolist())) for a, b in zip(at[:-1], at[1:])] == [len(shingle_set(t)) for t in texts]
    same, _ = tokens.column_shingles(pa.array(["ONE two Three FOUR five six"]))
    again, _ = tokens.column_shingles(pa.array(["x", "one TWO three four five SIX"]).slice(1))
    assert same.tolist() == again.tolist()


def tokens_of(t):
    import re
    return [x for x in re.split(r"[\x20\x09-\x0D]+", t or "") if x]


def test_signature_agreement_is_the_similarity():
    r = np.random.default_rng(0)
    for n, shared in ((2000, 1700), (60, 51), (12, 10)):
        agree = []
        for _ in range(60):
            pool = np.unique(r.integers(0, 2**63, 2 * n - shared, dtype=np.uint64))
            a, b = np.sort(pool[:n]), np.sort(pool[n - shared:])
            agree.append((m.signature(a) == m.signature(b)).mean())
        want = shared / (2 * n - shared)
        assert abs(np.mean(agree) - want) < 0.05
    assert (m.signature(np.array([5], np.uint64)) == 5).all()


def test_groups_of_copies(spark):
    base = [prose(s, 80) for s in range(5)]
    rows = [(10 * k + j, edited(base[k], j % 4, 100 * k + j)) for k in range(5) for j in range(10)]
    rows += [(1000 + j, base[0].upper()) for j in range(5)] + [(2000 + j, prose(999 + j, 70)) for j in range(10)]
    df = spark.createDataFrame([doc(*r) for r in rows], DOC_SCHEMA)
    check(df, rows)


def test_chain_through_blocks(spark, monkeypatch):
    """Links that no hub has: neighbours of a chain of edits, in blocks of two."""
    monkeypatch.setattr(m, "BLOCK", 2)
    monkeypatch.setattr(m, "STAR", 2)
    text, rows = prose(5, 120).split(), []
    for j in range(16):
        rows.append((j, " ".join(text)))
        text[(7 * j) % 120] = f"edit{j}"
    check(spark.createDataFrame([doc(*r) for r in rows], DOC_SCHEMA), rows)


def test_small_table_matches_brute_force(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    check(df, [(r["doc_id"], r["text"]) for r in df.collect()])


def test_edges(edge_docs, edge_rows, no_docs):
    got = m.near_duplicates(edge_docs).collect()
    assert len(got) == len(edge_rows)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add((r["component_id"], r["kept"]))
    assert by[2] == {(1, False)} and by[3] == {(1, False)} and by[8] == {(7, False)}
    assert by[4] == {(4, True)} and by[5] == {(5, True)} and by[None] == {(None, True)}
    kept = m.kept_documents(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
        str(r[0]) for r in edge_rows if r[0] not in (2, 3, 8))
    assert m.near_duplicates(no_docs).collect() == [] and m.kept_documents(no_docs).collect() == []


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 30)] + [(100, 90), (90, 95), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(31)}, 90: 90, 95: 90, 100: 90}


@pytest.mark.parametrize("text", ["a b", "a b c d e f"])
def test_word_counts(text):
    assert len(words(text)) == len(text.split())


def test_rows_that_share_a_doc_id_are_judged_by_their_own_text(spark):
    """(2, A) is a copy of (1, A) and goes; (2, B) and a null id stay."""
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    docs = spark.createDataFrame([doc(1, a), doc(2, a), doc(2, b), doc(None, a), doc(3, c), doc(4, c + " x"), doc(4, None)], DOC_SCHEMA)
    left = sorted((r.doc_id or 0, r.text or "") for r in m.kept_documents(docs).collect())
    assert left == sorted([(1, a), (2, b), (0, a), (3, c), (4, "")])
