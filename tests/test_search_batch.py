"""One-shot searches and per-batch postings: counted per document, in bounded tasks."""

from podlake.operators import search

ROWS = [(1, "late water late"), (2, "Water gates"), (2, "gates water"), (3, None), (None, "late"), (4, "x y z late"), (4, "late")]
QUESTIONS = [(1, "late waters"), (2, "gate"), (3, "none known")]


def test_search_batch_is_dealt_by_pairs(spark, monkeypatch):
    """The same scores as an index's; more pairs of query and document make more tasks, not larger ones."""
    docs = spark.createDataFrame(ROWS, "id long, text string")
    q = spark.createDataFrame(QUESTIONS, "query_id int, text string")
    index = search.build_index(docs.where("id IN (1, 3)"), "id", "text", stemmed=True)
    got = search.search_batch(docs.where("id IN (1, 3)"), "id", "text", q, k=3, stemmed=True)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, search.search(index, q, k=3).collect()))
    monkeypatch.setattr(search, "PAIRS", 1)
    many = search.search_batch(docs, "id", "text", q, k=9, stemmed=True)
    # seven rows, asked three times: a task per pair, and one
    assert ", 22)" in many._jdf.queryExecution().executedPlan().toString()
    assert {(r.query_id, r.id) for r in many.collect()} == {(1, 1), (1, 2), (1, 4), (1, None), (2, 2)}


def test_batch_postings_are_counted_in_their_row(spark):
    """Without repeated ids no word is shuffled; with them the counts are as before."""
    docs = spark.createDataFrame(ROWS, "id long, text string")
    once = search.postings_and_lengths(docs.where("id IN (1, 3)"), "id", "text")
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, once.select("term", "id", "dl", "tf").collect()), key=key) == sorted(
        [("late", 1, 3, 2), ("water", 1, 3, 1), (None, 1, 3, None), (None, 3, 0, None)], key=key)
    both = search.postings_and_lengths(docs.where("id = 2"), "id", "text")
    assert sorted(map(tuple, both.select("term", "id", "dl", "tf").collect()), key=key) == sorted(
        [("water", 2, 2, 2), ("gates", 2, 2, 2), (None, 2, 2, None), (None, 2, 2, None)], key=key)


def test_asked_words_are_found_in_their_row(spark, monkeypatch):
    """No word is shuffled, and a document is one row; with too many asked words the same counts and scores come of a join."""
    docs = spark.createDataFrame(ROWS, "id long, text string").repartition(2)
    q = spark.createDataFrame(QUESTIONS, "query_id int, text string")
    asked = search.query_terms(q, stemmed=True).select("term").distinct()
    rows = search.asked_words(docs, "id", "text", asked, True)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and rows.count() == len(ROWS)
    assert {(r.id, r.dl, tuple((w.term, w.tf) for w in r.words)) for r in rows.collect() if r.id in (1, 3)} == {
        (1, 3, (("lat", 2), ("water", 1))), (3, 0, ())}
    key = lambda d: sorted(map(str, d.collect()))
    unique = docs.where("id IN (1, 3)")
    want = [key(search.search_batch(d, "id", "text", q, k=9, stemmed=True)) for d in (docs, unique)]
    monkeypatch.setattr(search, "IN_ROW", 0)
    assert [key(search.search_batch(d, "id", "text", q, k=9, stemmed=True)) for d in (docs, unique)] == want


def test_asks_are_pairs_of_query_and_id(spark):
    """A column of queries says the same as a table of pairs, also where ids repeat: an id may what any of its rows may."""
    rows = [(i, text, a) for (i, text), a in zip(ROWS, ([1], [2], [], [1, 2], [1], None, [1]), strict=True)]
    docs = spark.createDataFrame(rows, "id long, text string, may array<int>")
    q = spark.createDataFrame(QUESTIONS, "query_id int, text string")
    for part in (docs, docs.where("id IN (1, 3, 4)"), docs.where("id IN (1, 3)")):
        pairs = part.selectExpr("id", "explode(may) AS query_id")
        want = search.search_batch(part, "id", "text", q, k=9, stemmed=True, allowed=pairs).collect()
        got = search.search_batch(part, "id", "text", q, k=9, stemmed=True, asks="may").collect()
        assert sorted(map(str, got)) == sorted(map(str, want)) and got
