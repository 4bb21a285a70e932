"""Hand-made rows for the semantics to keep and properties."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from settings import SF_SMALL
from podlake.functions import columns as C
from podlake.operators import documents as doc
from podlake.operators import kpis, review, search
from podlake.plans import semantic
from podlake.plans.logistics_model import logistics_model
from podlake.sources import fixtures as fx


def one(df):
    return df.collect()[0]


def test_pct_half_up_and_null_on_zero(spark):
    df = spark.createDataFrame([(1, 8), (1, 16), (1, 2000), (0, 0), (2, 3)], "a int, b int")
    got = [r[0] for r in df.select(C.pct(F.col("a"), F.col("b"), 1)).collect()]
    # 12.5 -> 12.5; 6.25 -> 6.3 (half up); 0.05 -> 0.1; 0/0 -> NULL; 66.666 -> 66.7
    assert got == [12.5, 6.3, 0.1, None, 66.7]


def test_flag_rules_pipeline_vs_app(spark):
    """T14/T15: prefix yes/true (pipeline) vs exact set with '1' (app); no trim vs trim."""
    df = spark.createDataFrame([("Yes, signed",), ("TRUE",), ("1",), ("no",), (None,), (" ",)],
                               "v string")
    r = df.select(C.yes_no_prefix("v").alias("p"), C.yes_no_exact("v").alias("e"),
                  C.non_empty("v").alias("n")).collect()
    assert [x.p for x in r] == [True, True, False, False, False, False]
    assert [x.e for x in r] == [False, True, True, False, False, False]
    assert [x.n for x in r] == [True, True, True, True, False, True]  # ' ' counts (no trim)


def test_try_number_and_date(spark):
    df = spark.createDataFrame([("12.7",), ("many",), ("7",), (None,)], "v string")
    assert [r[0] for r in df.select(C.try_int("v")).collect()] == [13, None, 7, None]
    d = spark.createDataFrame([("2024-02-03",), ("not stated",)], "v string")
    assert [str(r[0]) for r in d.select(C.try_date("v")).collect()] == ["2024-02-03", "None"]


def test_concat_null_and_sum_null_as_zero(spark):
    """STR1: '||' is NULL if any part is; T17: SUM(CASE WHEN NOT x) counts NULL as 0."""
    df = spark.createDataFrame([("a", True), (None, None), ("c", False)], "s string, b boolean")
    assert [r[0] for r in df.select(F.concat(F.lit("x"), "s")).collect()] == ["xa", None, "xc"]
    assert one(df.agg(C.flag_count(~F.col("b"))))[0] == 1


def test_pick_default_and_status_defaulted(spark):
    df = spark.createDataFrame([("Refused",), ("Lost",), (None,)], "delivery_status string")
    df = df.withColumns({"signature_present": F.lit("yes"), "partial_delivery": F.lit(None),
                         "exception_notes": F.lit(None), "damage_description": F.lit("x")})
    r = review.prefill(df).collect()
    assert [x.form_status for x in r] == ["Refused", "Delivered - Clean", "Delivered - Clean"]
    assert [x.status_defaulted for x in r] == [False, True, True]
    assert r[0].form_signature == "Yes" and r[0].form_partial == "No"
    assert r[0].form_exception_notes == ""


def test_modified_fields_trim_and_faithful_none(spark):
    """RV3 / T12: trimmed compare; faithful mode treats NULL as 'None'."""
    df = spark.createDataFrame([(" a ", "a", None, ""), ("a", "b", "x", "x")],
                               "ai_f string, final_f string, ai_g string, final_g string")
    r = df.select(review.modified_fields(["f", "g"]).alias("m"),
                  review.modified_fields(["f", "g"], faithful=True).alias("t")).collect()
    assert [x.m for x in r] == ["", "f"]
    assert [x.t for x in r] == ["g", "f"]


def test_audit_payload_keeps_nulls(spark):
    df = spark.createDataFrame([(1, "doc_1.txt", "APPROVED", "en", "EN", None, "")],
                               "doc_id long, file_name string, review_status string, "
                               "ai_lang string, final_lang string, ai_notes string, final_notes string")
    r = one(review.audit_rows(df, ["lang", "notes"], "doc_id", "file_name", "me",
                              "2024-01-02 03:04:05"))
    assert r.raw_ai_output == '{"lang":"en","notes":null}'
    assert r.review_id.startswith("REV-20240102030405-")
    assert r.fields_modified == "lang"


def test_render_extract_round_trip(spark, t_small):
    """DOC6 -> DOC3 -> DOC4 gives back the fact fields (0 mismatches)."""
    pods = fx.pod_fact(t_small)
    typed = doc.to_pod_fact(doc.extract_fields(
        doc.render_pod_text(pods.select(*doc.POD_TEXT_INPUTS), fx.dim_carriers(t_small)), "raw_text"))
    fields = ["shipment_id", "order_id", "delivery_date", "signed_by", "pod_status",
              "exception_notes", "damage_description", "partial_delivery", "packages_expected"]
    q = doc.extraction_quality(typed, pods, "pod_id", fields)
    bad = q.where(F.col("matches") != F.col("rows")).collect()
    assert bad == []


def test_packages_many_is_null_and_signature_rule(spark):
    text = "PROOF OF DELIVERY\nPackages: many received\nSignature: Yes, signed\nPartial: No"
    df = spark.createDataFrame([(text, "f.pdf")], "raw_text string, file_name string")
    r = one(doc.to_pod_fact(doc.extract_fields(df, "raw_text")))
    assert r.packages_received is None and r.signature_present is True
    assert r.partial_delivery is False and r.pod_id is None and r.exception_flag is False


def test_parse_empty_is_error_row(spark):
    df = spark.createDataFrame([(1, None), (2, "   "), (3, "<p>a &amp; b</p><p>c</p>")],
                               "id int, html string")
    r = doc.flatten_parsed(doc.parse_documents(df, "html")).orderBy("id").collect()
    assert r[0].error_info == "Empty document" and r[0].raw_text is None
    assert r[1].error_info == "Empty document"
    assert r[2].raw_text == "a & b\nc" and r[2].page_count == 1 and r[2].error_info is None


def test_text_chunks_keep_everything(spark):
    df = spark.createDataFrame([(1, "abcdefghijkl"), (2, "y"), (3, None), (4, ""), (5, "abcde")], "id int, t string")
    rows = doc.text_chunks(df, "t", n=5).orderBy("id", "chunk_no").collect()
    assert [(r.id, r.chunk_no, r.t) for r in rows] == [(1, 0, "abcde"), (1, 1, "fghij"), (1, 2, "kl"), (2, 0, "y"),
                                                       (3, 0, None), (4, 0, ""), (5, 0, "abcde")]
    assert [(r.t_chars, r.t_chunks) for r in rows if r.chunk_no == 0] == [(12, 3), (1, 1), (None, 1), (0, 1), (5, 1)]


def test_typed_pods_keep_long_texts(spark):
    df = spark.createDataFrame([("POD Reference: P\n" + "x" * 20_000, "f")], "raw_text string, file_name string")
    r = one(doc.to_pod_fact(doc.extract_fields(df, "raw_text")))
    assert len(r.pod_text_content) == 20_017


def test_long_keys_stay_distinct(spark):
    df = spark.createDataFrame([(1,), (1234567,), (123456, ), (123456789,), (12345678,)], "k long")
    ids = [r[0] for r in df.select(C.padded_id("CAR", "k", 6)).collect()]
    assert ids == ["CAR000001", "CAR1234567", "CAR123456", "CAR123456789", "CAR12345678"]


def test_html_keeps_title_and_decodes_all_references(spark):
    from podlake.functions.text import html_to_text
    html = ("<html><head><title>Invoice 42</title><style>p{}</style></head><body><p>a &mdash; b &#8217;c&#x2014; "
            "&amp;lt; &lt;x&gt; &nosuch; &#0; &eacute; &#38;amp; R&D &nbsp;end</p></body></html>")
    df = spark.createDataFrame([(html,), (None,)], "h string")
    rows = [r[0] for r in df.select(html_to_text(F.col("h"))).collect()]
    assert rows == ["Invoice 42\na — b ’c— &lt; <x> &nosuch; \ufffd é &amp; R&D end", None]


def test_stem_joins_word_forms(spark):
    from podlake.functions.text import stem
    words = ["deliveries", "delivery", "delivered", "deliver", "damaged", "damage", "packages", "package", "address",
             "missing", "is", "x1s", "shipping"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = dict(zip(words, [r[0] for r in df.select(stem(F.col("w"))).collect()]))
    assert got["deliveries"] == got["delivery"] and got["delivered"] == got["deliver"]
    assert got["damaged"] == got["damage"] and got["packages"] == got["package"]
    assert got["address"] == "address" and got["is"] == "is" and got["x1s"] == "x1s"


def test_smoke_question_finds_damaged_pods(spark):
    from podlake.catalog import QUERIES
    hits = [r for r in QUERIES["bm25_filtered"](spark, "/root/testdata/sf0.01").collect() if r.query_id == 1]
    assert len(hits) == 5 and all(r.customer_name or r.carrier_name for r in hits)


def test_lookup_filters_reach_the_scan(spark, t_small):
    key = "SHP00000001-1304-36-7-34-1996-02-04"
    df = fx.pod_fact(t_small, ["pod_id"], where=fx.line_of(key))
    plan = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "EqualTo(l_orderkey,1)" in plan and "EqualTo(l_partkey,1304)" in plan
    assert fx.pod_fact(t_small, ["pod_id"], where=fx.line_of("no such id")).count() == 0


def test_vectors_meet_in_blocks(spark, monkeypatch):
    import random
    r = random.Random(1)
    rows = [(i, [r.random() for _ in range(4)]) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    q = df.select(F.col("id").alias("q"), F.col("v").alias("qv"))
    one_block = sorted(map(tuple, search.cosine_top_k(df, "id", "v", q, "q", "qv", k=3).collect()))
    monkeypatch.setattr(search, "VECTOR_BLOCK", 7)
    assert sorted(map(tuple, search.cosine_top_k(df, "id", "v", q, "q", "qv", k=3).collect())) == one_block
    assert len(one_block) == 120 and search.cosine_top_k(df, "id", "v", q.limit(0), "q", "qv").count() == 0


def test_stored_index_takes_batches(spark):
    from podlake.session import scratch_path
    path = scratch_path(spark, "two-batches")
    docs = spark.createDataFrame([(i, f"word{i % 3} damaged box") for i in range(12)], "id long, t string")
    for part in (docs.where("id < 5"), docs.where("id >= 5")):
        search.write_index(part, "id", "t", path, stemmed=True)
    q = spark.createDataFrame([(1, "word1 damages")], "query_id int, text string")
    stored = search.search(search.load_index(spark, path, stemmed=True), q, k=6)
    plain = search.search(search.build_index(docs, "id", "t", stemmed=True), q, k=6)
    cols = ["query_id", "rank", "id", "score"]
    assert sorted(stored.select(*cols).collect()) == sorted(plain.select(*cols).collect()) and stored.count() == 6


def test_cluster_without_shared_folder_is_refused(spark, monkeypatch):
    from podlake import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Sc:
        master = "spark://host:7077"
        _jsc = spark.sparkContext._jsc

    class Session:
        conf, sparkContext = Conf(), Sc()

    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isEmpty():
        with pytest.raises(RuntimeError):
            session.shared_dir(Session())


def test_corpus_text_never_null_and_one_row_per_pod(spark, t_small):
    corpus = search.build_corpus(fx.pod_fact(t_small), fx.dim_customers(t_small),
                                 fx.dim_carriers(t_small))
    assert corpus.where(F.col("search_text").isNull()).count() == 0
    assert corpus.count() == fx.pod_fact(t_small, ["pod_id"]).count()
    unknown = corpus.where(F.col("carrier_name").isNull()).select("search_text").limit(1).collect()
    for r in unknown:
        assert "Carrier: Unknown\n" in r[0]


def test_group_sums_equal_global(spark, t_small):
    pods = fx.pod_fact(t_small)
    g = kpis.exceptions_by_carrier(pods, fx.dim_carriers(t_small))
    tot = one(g.agg(F.sum("total_pods"), F.sum("exceptions")))
    s = one(kpis.pod_summary(pods))
    assert tot[0] == s.total_pods and tot[1] == s.with_exceptions


def test_drill_across_equals_separate_queries(spark, t_small):
    from podlake.plans import questions as vq
    da = {r.carrier_name: r for r in vq.drill_across_carrier(t_small).collect()}
    m = logistics_model()
    sep = semantic.metric_query(m, t_small, ["TOTAL_CLAIMS"], ["carrier_name"]).collect()
    for r in sep:
        assert da[r.carrier_name].total_claims == r.total_claims


def test_model_validation_rejects_bad_specs():
    m = logistics_model()
    m.tables["CLAIMS"].primary_key = []
    with pytest.raises(semantic.ModelError):
        m.validate()
    m = logistics_model()
    m.tables["CARRIERS"].dimensions.append("carrier_name")
    with pytest.raises(semantic.ModelError):
        m.validate()
    m = logistics_model()
    m.relationships[0].right_column = "customer_name"
    with pytest.raises(semantic.ModelError):
        m.validate()
    m = logistics_model()
    with pytest.raises(semantic.ModelError):
        m.validate({"SHIPMENTS": ["shipment_id"]})


def test_metric_query_prunes_joins(spark, t_small):
    """SM2 joins only the dimensions asked for; global KPIs read lineitem only."""
    m = logistics_model()
    files = semantic.metric_query(m, t_small, ["TOTAL_PODS"]).inputFiles()
    assert [f.rsplit("/", 1)[-1] for f in files] == ["lineitem.parquet"]
    by_cust = semantic.metric_query(m, t_small, ["TOTAL_PODS"], ["customer_name"]).inputFiles()
    assert {f.rsplit("/", 1)[-1] for f in by_cust} >= {"lineitem.parquet", "orders.parquet",
                                                       "customer.parquet"}


def test_bm25_prefers_matching_doc(spark):
    docs = spark.createDataFrame([(1, "red truck damaged box"), (2, "blue van"), (3, "red car")],
                                 "id int, text string")
    idx = search.build_index(docs, "id", "text")
    q = spark.createDataFrame([(1, "damaged red box")], "query_id int, text string")
    hits = search.search(idx, q, k=2).orderBy("rank").collect()
    assert [h.id for h in hits] == [1, 3]


def test_written_index_gives_same_hits(spark, t_small):
    from podlake.session import scratch_path
    docs = t_small.documents.select("doc_id", "text")
    q = t_small.benchmark.select(F.col("item_id").alias("query_id"), "text")
    lazy = search.search(search.build_index(docs, "doc_id", "text"), q, k=5)
    path = scratch_path(spark, "test-index")
    search.write_index(docs, "doc_id", "text", path)
    stored = search.search(search.load_index(spark, path), q, k=5)
    key = ["query_id", "rank", "id", "score"]
    assert sorted(lazy.select(*key).collect()) == sorted(stored.select(*key).collect())


def test_cosine_top_k_exact(spark):
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])],
                                   "id int, v array<float>")
    q = spark.createDataFrame([(7, [1.0, 0.1])], "qid int, qv array<double>")
    hits = search.cosine_top_k(corpus, "id", "v", q, "qid", "qv", k=2).orderBy("rank").collect()
    assert [h.id for h in hits] == [1, 3]


def test_rrf_fuses(spark):
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "query_id int, id int, rank int")
    b = spark.createDataFrame([(1, 11, 1), (1, 12, 2)], "query_id int, id int, rank int")
    top = search.rrf([a, b], k=1).collect()
    assert top[0].id == 11


def test_money_sum_exact(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,)], "x double")
    assert one(df.agg(C.money_sum("x")))[0] == 0.6
    assert Decimal("0.6") == Decimal(str(one(df.agg(C.money_sum("x")))[0]))


def test_small_fixture_keys_unique(spark, t_small):
    from podlake.operators import quality
    kv = quality.key_violations({"pod_fact": (fx.pod_fact(t_small, ["pod_id"]), "pod_id"),
                                 "dim_carriers": (fx.dim_carriers(t_small), "carrier_id")})
    assert all(r.dup_keys == 0 and r.null_keys == 0 for r in kv.collect())


def test_sf_path_constant():
    assert SF_SMALL.endswith("sf0.001")


def _expressions(df, name: str) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count(f"{name}(")


@pytest.mark.parametrize("mode, steps", [("LAYOUT", 9), ("OCR", 6)])
def test_a_page_is_parsed_once(spark, mode, steps):
    """Every rewriting step of a text stands in the plan once, however many columns read it."""
    df = spark.createDataFrame([(1, "<p>a &amp; b</p>"), (2, " "), (3, "<br>"), (4, None)], "id int, html string")
    parsed = doc.flatten_parsed(doc.parse_documents(df, "html", mode), mode)
    assert _expressions(doc.route_errors(parsed), "regexp_replace") == steps
    rows = [(r["raw_text"], r["error_info"]) for r in parsed.orderBy("id").collect()]
    assert rows == [("a & b", None), (None, "Empty document"), (None, "No text content"), (None, "Empty document")]


def _texts(spark):
    clean = "PROOF OF DELIVERY\nPOD Reference: P1\nStatus: Delivered - Clean\nSignature: yes\nCarrier: a \"b\" é"
    return spark.createDataFrame([("f1", clean), ("f2", "POD Reference: P2\nStatus: Refused"), ("f3", None)], "file_name string, raw_text string")


def test_review_extracts_each_field_once(spark):
    """A filter on the decision does not repeat the patterns of the fields."""
    ex = doc.extract_fields(_texts(spark), "raw_text")
    facts = review.approved_pods(review.pod_decisions(ex, doc.EXTRACTION_KEYS, "me"), doc.EXTRACTION_KEYS)
    assert _expressions(facts, "regexp_extract") == len(doc.EXTRACTION_KEYS)
    assert [(r["pod_id"], r["pod_status"]) for r in facts.collect()] == [("P1", "Delivered - Clean")]


def test_variant_payloads_equal_parsed_json(spark):
    """A payload made as VARIANT holds what its JSON text would, nulls and quotes included."""
    d = review.pod_decisions(doc.extract_fields(_texts(spark), "raw_text"), doc.EXTRACTION_KEYS, "me")
    def log(v):
        rows = review.to_variant(review.audit_rows(d, doc.EXTRACTION_KEYS, "ai_pod_reference", "file_name", "me", "2024-01-01 00:00:00", variant=v),
                                 ["raw_ai_output", "final_output"])
        return [tuple(r) for r in rows.withColumns({c: F.to_json(c) for c in ("raw_ai_output", "final_output")}).orderBy("file_name").collect()]
    assert log(True) == log(False)
