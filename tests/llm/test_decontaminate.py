import random

import pytest
from samples import DOC_SCHEMA, doc, prose
from podlake.llm import decontaminate as d

ITEM = "item_id long, text string, key string"


def distance(item, text):
    """Fewest edits between item and any passage of text (plain Sellers)."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def noisy(text, edits, seed):
    r, s = random.Random(seed), list(text)
    for _ in range(edits):
        k, op = r.randrange(len(s)), r.randrange(3)
        if op == 0:
            s[k] = r.choice("abcxyz")
        elif op == 1:
            s.insert(k, r.choice("abcxyz"))
        else:
            del s[k]
    return "".join(s)


def test_matches_brute_force(spark):
    r = random.Random(3)
    items = [(i, prose(i, 6 + i), "x") for i in range(6)]
    rows = []
    for i in range(60):
        item = items[i % 6][1]
        edits = r.randrange(0, int(0.2 * len(item)))
        rows.append((i, prose(500 + i, 12) + " " + noisy(item, edits, i) + " " + prose(900 + i, 12)))
    want = {(i, j): distance(d.folded(t), d.folded(x)) for i, x in rows for j, t, _ in items}
    want = {k: v for k, v in want.items() if v <= d.edit_budget(len(items[k[1]][1]))}
    docs = spark.createDataFrame([doc(*x) for x in rows], DOC_SCHEMA)
    got = d.leaks(docs, spark.createDataFrame(items, ITEM)).collect()
    assert {(x["doc_id"], x["item_id"]): x["edits"] for x in got} == want
    texts = dict(rows)
    for x in got:
        passage = d.folded(texts[x["doc_id"]][x["start"]:x["end"]])
        assert distance(passage, d.folded(items[x["item_id"]][1])) <= x["edits"]
    clean = d.clean_documents(docs, spark.createDataFrame(items, ITEM)).collect()
    assert sorted(x["doc_id"] for x in clean) == sorted(set(texts) - {k for k, _ in want})


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(d, "BLOCK_CHARS", 150)
    items = [(i, prose(i, 10), "x") for i in range(20)]
    docs = spark.createDataFrame([doc(i, prose(77 + i, 20) + "\n" + items[i][1].upper()) for i in range(20)], DOC_SCHEMA)
    got = d.leaks(docs, spark.createDataFrame(items, ITEM)).collect()
    assert sorted((x["doc_id"], x["item_id"], x["edits"]) for x in got) == [(i, i, 0) for i in range(20)]
    assert d.clean_documents(docs, spark.createDataFrame(items, ITEM)).count() == 0


def test_repeats_positions_and_case(spark):
    item = prose(1, 8)
    docs = spark.createDataFrame([doc(1, f"é🙂 {item}\n{item.upper()}"), doc(1, item)], DOC_SCHEMA)
    got = d.leaks(docs, spark.createDataFrame([(7, item, "x"), (7, item, "x"), (None, item, "y")], ITEM)).collect()
    spans = sorted((x["start"], x["end"]) for x in got if x["item_id"] == 7)
    n = len(item)
    assert spans == sorted([(3, 3 + n), (4 + n, 4 + 2 * n), (0, n)] * 2)
    assert sum(x["item_id"] is None for x in got) == 3


def test_passages_cut_by_the_text_ends(spark):
    items = [(i, prose(i, 14 + i), "x") for i in range(4)]
    rows = [(100 * i + c, items[i][1][c:] if c % 2 else items[i][1][:len(items[i][1]) - c])
            for i in range(4) for c in range(0, 24, 1)]
    rows += [(1000 + i, items[i][1][3:-3]) for i in range(4)]
    want = {(i, j): distance(d.folded(t), d.folded(x)) for i, x in rows for j, t, _ in items}
    want = {k: v for k, v in want.items() if v <= d.edit_budget(len(items[k[1]][1]))}
    docs = spark.createDataFrame([doc(*x) for x in rows], DOC_SCHEMA)
    got = d.leaks(docs, spark.createDataFrame(items, ITEM)).collect()
    assert {(x["doc_id"], x["item_id"]): x["edits"] for x in got} == want


def test_edges(spark, edge_docs, no_docs, edge_rows):
    items = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "one two three", "x"), (4, edge_rows[0][1][:200], "x")], ITEM)
    got = d.leaks(edge_docs, items).collect()
    assert sorted(x["doc_id"] for x in got) == [1, 2, 2, 3] and {x["item_id"] for x in got} == {4}
    clean = d.clean_documents(edge_docs, items)
    assert clean.columns == edge_docs.columns and clean.count() == len(edge_rows) - 4
    assert d.leaks(no_docs, items).collect() == [] and d.clean_documents(no_docs, items).collect() == []
    none = spark.createDataFrame([], ITEM)
    assert d.leaks(edge_docs, none).collect() == [] and d.clean_documents(edge_docs, none).count() == len(edge_rows)


@pytest.mark.parametrize("region,width,want", [("xxabcdyy", 4, 0), ("xxabdyy", 4, 1), ("zzzz", 2, 4), ("abcd", 0, 0)])
def test_banded_alignment(region, width, want):
    assert d.aligned("abcd", region, width)[0] == want


def worst(item, edits):
    """Edits spread so that they spoil as many q-grams as they can."""
    s = list(item)
    for k in range(1, edits + 1):
        s[k * len(item) // (edits + 1)] = "#"
    return "".join(s)


def test_every_length_with_the_worst_edits():
    """Items of 1 to 60 characters: found with edits up to the budget wherever they fall, and not beyond it."""
    r = random.Random(11)
    for m in range(1, 61):
        item = "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(m - 2)) + "qz" if m > 2 else "qz"[:m]
        item = "x" + item[1:]
        assert len(item) == m
        budget = int(0.1 * m) if m >= 24 else 0
        block = d.Items([0], [item])
        for edits in range(budget + 2):
            for spoilt in {worst(item, edits), noisy_places(item, edits, m)}:
                text = "... " + spoilt + " ..."
                found = block.leaks([text, "nothing here", ""])
                want = distance(item, text) <= budget
                assert bool(found) == want, (m, edits, spoilt)
                assert all(i == 0 for i, *_ in found)


def noisy_places(item, edits, seed):
    s, r = list(item), random.Random(seed)
    for k in r.sample(range(len(s)), min(edits, len(s))):
        s[k] = "#"
    return "".join(s)


def test_thirty_characters_with_three_edits():
    """Edits at places 7, 15, 23 leave no eight characters in a row."""
    for m in range(24, 40):
        item = "".join(random.Random(m).choice("abcdefghij") for _ in range(m))
        s = list(item)
        for k in (7, 15, 23)[:int(0.1 * m)]:
            s[k] = "#"
        assert d.Items([5], [item]).leaks(["ab " + "".join(s) + " cd"])


def test_short_items_are_sought_as_whole_words(spark):
    items = spark.createDataFrame([(1, "the cat", "x"), (2, "a", "x"), (3, "", "x"), (4, prose(3, 9), "x")], ITEM)
    docs = spark.createDataFrame([doc(1, "See THE\tCAT."), doc(2, "the cats"), doc(3, "bathe cat"), doc(4, "banana"), doc(5, "a b"),
                                  doc(6, prose(3, 9)), doc(7, None)], DOC_SCHEMA)
    got = sorted((x["doc_id"], x["item_id"], x["start"], x["end"], x["edits"]) for x in d.leaks(docs, items, shortest=1).collect())
    assert got == [(1, 1, 4, 11, 0), (5, 2, 0, 1, 0), (6, 4, 0, len(prose(3, 9)), 0)]
    assert sorted(x["doc_id"] for x in d.clean_documents(docs, items, shortest=1).collect()) == [2, 3, 4, 7]
    assert sorted(x["doc_id"] for x in d.clean_documents(docs, items).collect()) == [1, 2, 3, 4, 5, 7]


def test_steps_of_very_many_short_rows():
    """More rows than a step's 16 bits for the row."""
    import pyarrow as pa
    item = prose(8, 6)
    texts = ["x"] * 70_000 + [item] + ["y"] * 70_000
    block, found = d.Items([0], [item]), []
    for lo, part in d._texts(pa.array(texts)):
        assert len(part) < 1 << 16
        found += [lo + r for r, *_ in block.leaks(part)]
    assert found == [70_000]
