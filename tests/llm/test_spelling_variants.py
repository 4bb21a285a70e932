import re
import zlib
from collections import Counter

import pytest
from podlake.llm import spelling_variants as V
from samples import DOC_SCHEMA, SF, doc

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def fold(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def plain_words(rows, least=6, count=5):
    found = Counter()
    for i, text in rows:
        for run in map(fold, RUN.findall(text or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= least:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= count}


def plain_near(words):
    """Neighbours by asking for every possible word."""
    letters = sorted({c for w in words for c in w})
    out = {}
    for w in words:
        near = {w[:k] + w[k + 1:] for k in range(len(w))}
        near |= {w[:k] + c + w[k + 1:] for k in range(len(w)) for c in letters}
        near |= {w[:k] + c + w[k:] for k in range(len(w) + 1) for c in letters}
        out[w] = sorted((near & set(words)) - {w})
    return out


def plain_variants(words, ratio=5):
    near, forms = plain_near(words), {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        forms[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = {}
    for w in words:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] = (forms[w], root, words[w], len(near[w]), words[forms[w]] if forms[w] is not None else None)
    return out


def told(df):
    rows = [(r.word, (r.form, r.root, r.n, r.n_near, r.form_n)) for r in df.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def frame(spark, words):
    return spark.createDataFrame(sorted(words.items()), "word string, n long")


@pytest.mark.parametrize("letters,lengths", [("ab", (1, 7)), ("aé🙂", (1, 4)), ("abcd", (3, 6))])
def test_all_short_words_against_brute_force(spark, letters, lengths):
    import itertools
    import random
    r = random.Random(len(letters))
    every = ["".join(w) for n in range(lengths[0], lengths[1] + 1) for w in itertools.product(letters, repeat=n)]
    words = {w: r.choice([1, 2, 3, 10, 60, 60, 400]) for w in r.sample(every, len(every) * 2 // 3)}
    assert told(V.variants(frame(spark, words))) == plain_variants(words)


def test_long_words_and_the_seam_between_both_ways(spark):
    """Words around and beyond ``depth``: edits at every place of one, at lengths on both sides."""
    import random
    r = random.Random(5)
    words = {}
    for base in ("abcabcabcabcabc", "x" * 9, "x" * 10, "x" * 11, "x" * 12, "q" * 60 + "r" * 60, "".join(r.choice("ab") for _ in range(30))):
        words[base] = 1000
        for k in range(len(base)):
            words.setdefault(base[:k] + base[k + 1:], r.randrange(1, 9))
            words.setdefault(base[:k] + "y" + base[k + 1:], r.randrange(1, 9))
            words.setdefault(base[:k] + "y" + base[k:], r.randrange(1, 9))
    for depth in (10, 24):
        assert told(V.variants(frame(spark, words), depth=depth)) == plain_variants(words)


def test_chains_of_forms(spark):
    """Each word is the form of the next: the root is the last, ties go to the smaller word."""
    words, w, n = {}, "mmmmmmmm", 1
    for k in range(8):
        words[w] = n
        w, n = w[:k] + "z" + w[k + 1:], n * 5
    words |= {"bbbbbba": 100, "bbbbbbc": 100, "bbbbbbb": 20, "alone_": 3}
    got = told(V.variants(frame(spark, words)))
    assert got == plain_variants(words)
    assert got["mmmmmmmm"][1] == "zzzzzzzm" and got["bbbbbbb"][0] == "bbbbbba" and got["alone_"] == (None, "alone_", 3, 0, None)


def test_hot_nodes_are_salted(spark, monkeypatch):
    words = {f"prefix{a}{b}suffix": 1 + (a == "k") * 50 for a in "abcdefghijk" for b in "abcdefg"}
    monkeypatch.setattr(V, "SALT_WORDS", 3)
    assert told(V.variants(frame(spark, words))) == plain_variants(words)


def test_words_of_edge_rows(spark, edge_docs, edge_rows, no_docs):
    got = {r.word: r.n for r in V.frequent_words(edge_docs, count=1).collect()}
    assert got == plain_words([(r[0], r[1]) for r in edge_rows], count=1)
    assert V.frequent_words(no_docs).collect() == [] and told(V.variants(V.frequent_words(no_docs))) == {}
    rows = [doc(i, "ÉCOLE écoles ÉCOLES Straße naïveté× x÷abcdefg " * 3, None, None) for i in range(4)] + [doc(None, "naïveté" * 2), doc(9, None)]
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    want = plain_words([(r[0], r[1]) for r in rows])
    assert {r.word: r.n for r in V.frequent_words(df).collect()} == want
    assert told(V.variants(V.frequent_words(df))) == plain_variants(want)


def test_the_thinning_takes_one_code_point(spark):
    """Every run whose CRC-32 199 divides, in texts made to hold some."""
    runs = [w for w in (f"{a}{b}{c}abcdé" for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefghij")]
    rows = [doc(i, " ".join(runs)) for i in (7, -3)]
    got = {r.word: r.n for r in V.frequent_words(spark.createDataFrame(rows, DOC_SCHEMA), count=1).collect()}
    want = plain_words([(r[0], r[1]) for r in rows], count=1)
    assert got == want and any(len(w) == 7 for w in want)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    words = plain_words([(r.doc_id, r.text) for r in docs])
    assert len(words) > 100
    assert told(V.op12_spelling_variants(spark, SF)) == plain_variants(words)
