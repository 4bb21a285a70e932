import re

import numpy as np
import pytest
from samples import DOC_SCHEMA, SF, doc, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from podlake.llm import pii_tagger as p

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    out = []
    for k, (name, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (name == "ip" and any(int(x) > 255 for x in m[0].split("."))
                    or name == "card" and not (12 <= len(digits) <= 19 and p.luhn(digits))
                    or name == "phone" and not 9 <= len(digits) <= 15):
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="aB0149.@-+ ()%é\n", max_size=40))
def test_base_spans_are_those_of_the_patterns(text):
    assert p.base_spans(text) == plain(text)


@pytest.mark.parametrize("text", ["a@b.c@d.e", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.02.3.4", "4111 1111-1111 1111",
                                  "+1 (415) 555-0100", "x" * 30000 + "@", "9" * 30000, "a" * 20000 + "@b.co"])
def test_base_spans_of_odd_texts(text):
    assert p.base_spans(text) == plain(text)


def test_gradients_agree_with_differences():
    r = np.random.default_rng(1)
    s, trans, gold = r.normal(size=(5, p.TAGS, 2)), r.normal(size=(p.TAGS, p.TAGS)), r.integers(0, p.TAGS, (5, 2))
    _, ds, dt = p._crf_gradient(s, trans, gold)
    for at in ((0, 1, 0), (3, 2, 1), (4, 0, 0)):
        t = s.copy()
        t[at] += 1e-5
        assert abs((p._crf_gradient(t, trans, gold)[0] - p._crf_gradient(s, trans, gold)[0]) / 1e-5 / 2 - ds[at]) < 1e-3
    t = trans.copy()
    t[1, 2] += 1e-5
    assert abs((p._crf_gradient(s, t, gold)[0] - p._crf_gradient(s, trans, gold)[0]) / 1e-5 / 2 - dt[1, 2]) < 1e-3


def test_best_path_is_the_best():
    import itertools
    r = np.random.default_rng(2)
    s, trans = r.normal(size=(4, p.TAGS, 3)).astype("f4"), p.calm(r.normal(size=(p.TAGS, p.TAGS))).astype("f4")
    paths = list(itertools.product(range(p.TAGS), repeat=4))
    value = lambda path, j: sum(s[t, k, j] for t, k in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:]))
    for j, column in enumerate(p.best_path(s, trans).T):
        assert tuple(column) == max(paths, key=lambda x: value(x, j))
    s[:, 0] += 9  # none is best everywhere: then none throughout is the best path
    assert (p.best_path(s, trans) == 0).all()


def test_scores_agree_with_the_training_pass():
    net = p.fresh(3)
    x = np.random.default_rng(3).integers(0, p.N_CLASSES, (20, 4))
    f, _ = p._lstm_pass(net.table[0], net.u[0], x)
    b, _ = p._lstm_pass(net.table[1], net.u[1], x[::-1])
    want = (f @ net.out[0] + b[::-1] @ net.out[1] + net.bias).transpose(0, 2, 1)
    assert np.allclose(p.scores(net, x), want, atol=1e-4)


@pytest.fixture(scope="module")
def net(spark):
    import random
    r = random.Random(0)
    made = []
    for i in range(420):
        kind = i % 5
        value = ["", f"{r.choice('abc')}n.{r.randrange(99)}@mail{r.randrange(9)}.example.com",
                 ".".join(str(r.randrange(1, 255)) for _ in range(4)),
                 "4" + "".join(str(r.randrange(10)) for _ in range(15)),
                 f"+1 ({r.randrange(100, 999)}) 555-{r.randrange(1000, 9999)}"][kind]
        a, b = prose(i, 4).translate({c: None for c in range(48, 58)}), prose(i + 999, 5).translate({c: None for c in range(48, 58)})
        made.append((f"{a} {value} {b}"[:p.TRAIN_LENGTH],
                     [(len(a) + 1, kind - 1, min(p.TRAIN_LENGTH, len(a) + 1 + len(value)))] if kind else []))
    return p.train(made[:360], epochs=12), made[360:]


def test_held_out_accuracy(net):
    model, rest = net
    hit = total = false = 0
    for text, spans in rest:
        tags = p.tagged(model, [text])[0]
        for s, k, e in spans:
            total += 1
            hit += (tags[s:e] == k + 1).mean() > 0.6
        if not spans:
            false += tags.any()
    assert hit >= 0.8 * total and false <= 4


def test_windows_are_reconciled(net):
    """A span is found whole wherever a window seam falls."""
    model, _ = net
    words = prose(4, 300).translate({c: None for c in range(48, 58)})
    for at in range(p.WINDOW - p.OVERLAP - 24, p.WINDOW + 8, 4):
        cut = words.rfind(" ", 0, at)
        text = words[:cut] + " +1 (415) 555-0100 " + words[cut + 1:1200]
        tags = p.tagged(model, [text])[0]
        assert (tags[cut + 1:cut + 18] == 4).mean() > 0.6, at


def test_added_spans():
    text = "call (415) 555-0100 44 now, 4111.1111.1111.1111 and 1234.5678.9012.3456"
    tags = np.zeros(len(text), np.int8)
    tags[4:23], tags[27:48], tags[52:72] = 4, 3, 3
    assert p.added_spans(text, tags, []) == [(5, 3, 22), (28, 2, 47)]
    assert p.added_spans(text, tags, [(6, 3, 9)]) == [(28, 2, 47)]


def test_edges(edge_docs, edge_rows, no_docs):
    got = p.personal_data(edge_docs).collect()
    assert len(got) == len(edge_rows)
    assert sorted(r["base"] for r in got) == sorted(p.joined(p.base_spans(r[1] or "")) for r in edge_rows)
    assert p.personal_data(no_docs).collect() == []


def test_query(spark):
    got = {r["doc_id"]: r for r in p.op4_pii_tagger(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    for d in docs:
        base = plain(d["text"])
        r = got[d["doc_id"]]
        assert [r[f"n_{k}"] for k in p.KINDS] == [sum(b[1] == k for b in base) for k in range(4)]
        assert set(p.joined(base).split(",")) <= set(r["spans"].split(",")) or not base


def test_tables_without_spans(spark):
    df = spark.createDataFrame([doc(1, "nothing here"), doc(2, None)], DOC_SCHEMA)
    assert [(r["base"], r["spans"]) for r in p.personal_data(df).collect()] == [("", "")] * 2
