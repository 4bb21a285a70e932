import collections
import random
import zlib

import numpy as np
import pytest
from samples import DOC_SCHEMA, SF, doc
from hypothesis import given, settings
from hypothesis import strategies as st
from podlake.llm import packing
from podlake.llm.subwords import byte_bpe


def reference():
    import public_tokenizers as P
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))  # as it is, added tokens and all
    return lambda s: t.encode(s, add_special_tokens=False).ids


ODD = ["", " ", "a", " a", "a ", "a  b", "a\n b", "a \n\n b", "don't I'll we've", "<|endoftext|>", "x y z",
       "é à ü ß 123,456", "日本語 の テキスト", "emoji 🙂🙂 here", "tab\tand\x0bvt\x1cfs", "a" * 5000, "  lead", "trail  ",
       "Ünï cödé ʻokina ɐ", "नमस्ते दुनिया", "1 2  3   4", "\x00 \x1f", "<|endoftext|> hi", "a <|endoftext|><|endoftext|>  b", "x<|endoftext|>y", "é <|endoftext|> 日本", "<|endoftext|"]


def test_ids_are_those_of_the_tokenizer(spark):
    encode, words = reference(), byte_bpe()
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(120).collect()]
    for s in texts + texts[:30]:
        assert np.frombuffer(words.encode(s), "<u4").tolist() == encode(s), s[:50]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_ids_of_any_text(s):
    assert np.frombuffer(byte_bpe().encode(s), "<u4").tolist() == test_ids_of_any_text.encode(s)


test_ids_of_any_text.encode = reference()


@pytest.mark.parametrize("n,want", [(1, [(0, 1)]), (8, [(0, 8)]), (9, [(0, 1), (1, 8)]), (16, [(0, 8), (8, 8)]),
                                    (19, [(0, 3), (3, 8), (11, 8)])])
def test_cuts(n, want):
    assert packing.cuts(n, 8) == want


def slow_best_fit(lengths, capacity):
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, f in enumerate(free) if f >= n]
        if fits:
            free[min(fits, key=lambda k: free[k])] -= n
        else:
            free.append(capacity - n)
    return len(free)


def test_plan_equals_best_fit_on_single_pieces():
    for seed in range(60):
        r = random.Random(seed)
        cap = r.choice([8, 32, 100])
        lengths = [r.randint(1, cap) if r.random() < .7 else r.choice([1, cap, cap // 2]) for _ in range(r.randint(1, 300))]
        slots = packing.plan(collections.Counter(lengths), cap)
        used, ranks = collections.defaultdict(list), collections.defaultdict(list)
        for length, a, b, first, offset in slots:
            ranks[length] += range(a, b)
            for k in range(b - a):
                used[first + k].append((offset, length))
        assert {n: sorted(x) for n, x in ranks.items()} == {n: list(range(c)) for n, c in collections.Counter(lengths).items()}
        for spans in used.values():
            at = 0
            for offset, length in sorted(spans):
                assert offset == at
                at += length
            assert at <= cap
        assert len(used) == slow_best_fit(lengths, cap)


def check(rows, docs, capacity=1024):
    encode = reference()
    want = sorted(str((i, encode(t or "") + [2])) for i, t in docs)
    parts = collections.defaultdict(list)
    seqs = collections.defaultdict(list)
    for r in rows:
        parts[(r["doc_id"], r["ids_crc32"] if r["piece"] == 0 else None)].append(r)
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in seqs.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    pieces = collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    expect = collections.Counter()
    for i, t in docs:
        ids = encode(t or "") + [2]
        for k, (s, n) in enumerate(packing.cuts(len(ids), capacity)):
            expect[(i, k, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes()))] += 1
    assert pieces == expect
    return want


def test_documents_round_trip(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 20)
    df = spark.read.parquet(f"{SF}/documents.parquet")
    check(packing.pack_documents(df).collect(), [(r["doc_id"], r["text"]) for r in df.collect()])


def test_edges(edge_docs, edge_rows, no_docs):
    check(packing.pack_documents(edge_docs).collect(), [(r[0], r[1]) for r in edge_rows])
    assert packing.pack_documents(no_docs).collect() == []


def test_many_equal_lengths(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 10)
    rows = [(i, "same words here") for i in range(200)]
    got = packing.pack_documents(spark.createDataFrame([doc(*r) for r in rows], DOC_SCHEMA)).collect()
    check(got, rows)
    assert len({r["sequence_id"] for r in got}) == 1


def test_ids_on_request(spark):
    got = packing.token_pieces(spark.createDataFrame([doc(1, "a b c")], DOC_SCHEMA), capacity=2, with_ids=True).collect()
    assert [x for r in got for x in r["ids"]] == reference()("a b c") + [2]
