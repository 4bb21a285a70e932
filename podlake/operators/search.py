"""Search: corpus, inverted index, BM25 and vector top-k, fusion.

Index build (SE3): tokens are exploded per row and ``groupBy(term, id)`` gives
term frequencies; document frequencies are a ``groupBy(term)`` over the postings.
Both aggregate partially per task, so a term that every document holds is counted
map-side. A stored index keeps its postings by (term bucket, salt): a bucket's
files hold its terms in order, and the salt spreads a hot term over several files
and tasks. Batches are appended; N, df and mean length are sums at query time.

Query (SE4): query terms join the term statistics and the postings on (bucket,
term) as tables; whichever side is small is broadcast by Spark after measuring
it. Filters (SE7) cut the postings before scores are summed; corpus statistics
stay global. The per-query top k is a ``row_number`` window that Spark plans as a
partial and a final limit, so only k rows per query and task are shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import counted, sorted_words, stem, tokens
from .documents import pod_text

K1 = 1.2
B = 0.75
RRF_K = 60
SCORE_DIGITS = 6
BUCKETS = 64
#: Files that a bucket of a stored index is spread over.
SALTS = 4
#: Pairs of a query and a document that one task scores.
PAIRS = 1_000_000
#: Asked words up to which a batch of questions is looked up in the documents' rows.
IN_ROW = 20_000
#: Query vectors that meet a corpus row together.
VECTOR_BLOCK = 256


# --- SE1 / SE2 --------------------------------------------------------------------

#: The lines of SEARCH_TEXT after the document's own text, as
#: (label, column, text where it is NULL, condition of the line).
SEARCH_TEXT = [
    ("Customer: ", "customer_name", "Unknown", None),
    ("Carrier: ", "carrier_name", "Unknown", None),
    ("Status: ", "pod_status", "Unknown", None),
    ("City: ", "delivery_city", "Unknown", None),
    ("EXCEPTION: ", "exception_notes", "No details", "exception_flag"),
    ("DAMAGE: ", "damage_description", "No details", "damage_reported"),
    ("WARNING: ", None, "Missing signature", "NOT signature_present"),
]


def build_corpus(pod: DataFrame, customers: DataFrame, carriers: DataFrame) -> DataFrame:
    """SE1: denormalised POD rows (JN3) plus SEARCH_TEXT. Never NULL (T18)."""
    j = (pod.join(customers.select("customer_id", "customer_name", "customer_segment"),
                  "customer_id", "left")
         .join(carriers.select("carrier_id", "carrier_name", "carrier_type"), "carrier_id", "left"))
    c = F.col
    text = pod_text(c("carrier_name")) if "pod_text_content" not in pod.columns \
        else c("pod_text_content")
    j = j.withColumn("pod_text_content", text)

    parts = [F.coalesce(c("pod_text_content"), F.lit("")), F.lit("\n\n")]
    for label, value, fallback, flag in SEARCH_TEXT:
        body = F.coalesce(c(value), F.lit(fallback)) if value else F.lit(fallback)
        entry = F.concat(F.lit(label), body, F.lit("\n"))
        parts.append(F.when(F.expr(flag), entry).otherwise(F.lit("")) if flag else entry)
    search_text = F.concat(*parts)
    return j.select(
        "pod_id", "shipment_id", "order_id", "customer_name", "customer_segment", "carrier_name",
        "carrier_type", "delivery_date", "delivery_city", "delivery_state", "pod_status",
        "signed_by", "exception_flag", "exception_notes", "damage_reported", "damage_description",
        "signature_present", "partial_delivery", "packages_received", "packages_expected",
        "pod_text_content", search_text.alias("search_text"))


#: The attributes a search result carries.
SOURCE_ATTRIBUTES = ["pod_id", "shipment_id", "order_id", "customer_name", "carrier_name",
                     "delivery_date", "delivery_city", "pod_status", "exception_flag",
                     "exception_notes", "damage_reported", "signature_present"]


def search_source(corpus: DataFrame) -> DataFrame:
    """SE2: SEARCH_TEXT + 12 attributes, dates and booleans as strings (CST1)."""
    cast = {"delivery_date", "exception_flag", "damage_reported", "signature_present"}
    return corpus.select(
        "search_text",
        *[F.col(a).cast("string").alias(a) if a in cast else F.col(a) for a in SOURCE_ATTRIBUTES])


# --- SE3 --------------------------------------------------------------------------

@dataclass
class TextIndex:
    postings: DataFrame      # term, id, tf, dl (and bucket, if stored)
    terms: DataFrame         # term, df
    docs: DataFrame          # id, dl
    stemmed: bool = False


def token_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, toks, dl)"""
    return (docs.select(F.col(id_col).alias("id"), tokens(F.col(text_col)).alias("toks"))
            .withColumn("dl", F.size("toks")))


def term_frequencies(tok: DataFrame, stemmed: bool = False, only: DataFrame | None = None) -> DataFrame:
    """Postings (term, id, dl, tf) of a token table; ``only`` (term) keeps those
    of given terms, before they are counted."""
    rows = tok.select("id", "dl", F.explode("toks").alias("term"))
    if stemmed:
        rows = rows.withColumn("term", stem(F.col("term")))
    if only is not None:
        rows = rows.join(only, "term", "left_semi")
    return rows.groupBy("term", "id", "dl").agg(F.count(F.lit(1)).alias("tf"))


def document_frequencies(postings: DataFrame) -> DataFrame:
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def postings_and_lengths(docs: DataFrame, id_col: str, text_col: str, stemmed: bool = False) -> DataFrame:
    """Postings (term, id, dl, tf) and, with a NULL term, one length row per
    document; ``split_postings`` separates them. Words are counted in their document's
    row; only where ids repeat are those of one id and length added up over a shuffle."""
    tok = token_table(docs, id_col, text_col)
    if docs.count() == docs.select(F.xxhash64(id_col)).distinct().count():
        return own_counts(tok, stemmed, F.lit(None).cast("string"))
    lengths = tok.select(F.lit(None).cast("string").alias("term"), "id", "dl",
                         F.lit(None).cast("long").alias("tf"))
    return term_frequencies(tok, stemmed).unionByName(lengths)


def own_counts(tok: DataFrame, stemmed: bool, rest: Column) -> DataFrame:
    """(term, id, dl, tf) of each row of a token table by itself, and one more row per
    document with the term ``rest``."""
    last = F.array(F.struct(rest.alias("term"), F.lit(None).cast("long").alias("tf")))
    terms = F.inline(F.concat(counted(sorted_words(F.col("toks"), stemmed)), last))
    return tok.select("id", "dl", terms).select("term", "id", "dl", "tf")


def split_postings(both: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(postings, docs) of a ``postings_and_lengths`` table."""
    return (both.where(F.col("term").isNotNull()),
            both.where(F.col("term").isNull()).select("id", "dl"))


def build_index(docs: DataFrame, id_col: str, text_col: str, stemmed: bool = False) -> TextIndex:
    """SE3: postings, document frequencies and lengths, as a plan."""
    tok = token_table(docs, id_col, text_col)
    postings = term_frequencies(tok, stemmed)
    return TextIndex(postings, document_frequencies(postings), tok.select("id", "dl"), stemmed)


def bucket(term: str = "term") -> Column:
    return F.pmod(F.hash(term), F.lit(BUCKETS))


def write_index(docs: DataFrame, id_col: str, text_col: str, path: str, stemmed: bool = False) -> None:
    """SE3 stored: append the postings and lengths of ``docs`` to the index at
    ``path``. Files are per bucket and salt, in order of terms, so row groups can
    be skipped by term; a hot term's postings are in ``SALTS`` files."""
    tok = token_table(docs, id_col, text_col)
    tok.select("id", "dl").write.mode("append").parquet(f"{path}/docs")
    postings = term_frequencies(tok, stemmed).withColumn("bucket", bucket())
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS))
    (postings.repartition(F.col("bucket"), salt).sortWithinPartitions("bucket", "term")
     .write.mode("append").partitionBy("bucket").parquet(f"{path}/postings"))


def load_index(spark: SparkSession, path: str, stemmed: bool = False) -> TextIndex:
    postings = spark.read.parquet(f"{path}/postings")
    return TextIndex(postings, document_frequencies(postings), spark.read.parquet(f"{path}/docs"), stemmed)


def materialize_index(docs: DataFrame, id_col: str, text_col: str, name: str = "index",
                      stemmed: bool = False) -> TextIndex:
    """Write an index to a fresh place in the shared folder and open it."""
    from ..session import scratch_path
    path = scratch_path(docs.sparkSession, name)
    write_index(docs, id_col, text_col, path, stemmed)
    return load_index(docs.sparkSession, path, stemmed)


# --- SE4 / SE7 ----------------------------------------------------------------------

def query_terms(queries: DataFrame, qid: str = "query_id", text: str = "text",
                stemmed: bool = False) -> DataFrame:
    """Distinct terms per query (a term repeated in the query counts once)."""
    rows = queries.select(F.col(qid).alias("query_id"), F.explode(tokens(F.col(text))).alias("term"))
    if stemmed:
        rows = rows.withColumn("term", stem(F.col("term")))
    return rows.distinct()


def bm25_scores(index: TextIndex, queries: DataFrame, qid: str = "query_id", text: str = "text",
                k1: float = K1, b: float = B, allowed: DataFrame | None = None) -> DataFrame:
    """(query_id, id, score) for every document sharing a term with the query and,
    where ``allowed`` -- (id) or (query_id, id) -- is given, in it."""
    # Scalar subqueries: evaluated once inside the same plan, no driver round trip.
    n_col = index.docs.select(F.count(F.lit(1)).cast("double")).scalar()
    avgdl_col = index.docs.select(F.avg("dl")).scalar()
    weighted = (query_terms(queries, qid, text, index.stemmed).join(index.terms, "term")
                .withColumn("idf", idf_of(n_col)).drop("df"))
    keys = ["term"]
    if "bucket" in index.postings.columns:
        weighted, keys = weighted.withColumn("bucket", bucket()), ["bucket", "term"]
    return summed_scores(weighted.join(index.postings, keys), avgdl_col, allowed, k1, b)


def idf_of(n: Column) -> Column:
    return F.log(F.lit(1.0) + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))


def summed_scores(hits: DataFrame, mean: Column, allowed: DataFrame | None, k1: float = K1, b: float = B) -> DataFrame:
    """(query_id, id, score) of weighted postings (query_id, id, dl, tf, idf), cut to ``allowed``."""
    if allowed is not None:
        same = ["query_id", "id"] if "query_id" in allowed.columns else ["id"]
        hits = hits.join(allowed.select(*same), same, "left_semi")
    norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * F.col("dl") / mean)
    part = F.col("idf") * F.col("tf") * (k1 + 1) / (F.col("tf") + norm)
    return hits.groupBy("query_id", "id").agg(F.sum(part).alias("score"))


def top_k(scored: DataFrame, k: int, score: str = "score", group: str = "query_id",
          id_col: str = "id") -> DataFrame:
    """Per-group top-k with deterministic ties (score rounded, then id)."""
    s = scored.withColumn(score, F.round(F.col(score), SCORE_DIGITS))
    w = Window.partitionBy(group).orderBy(F.desc(score), F.asc(id_col))
    return s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(index: TextIndex, queries: DataFrame, k: int = 5, qid: str = "query_id",
           text: str = "text", allowed: DataFrame | None = None) -> DataFrame:
    """SE4 (+SE7): BM25 top-k per query, among ``allowed`` where given."""
    return top_k(bm25_scores(index, queries, qid, text, allowed=allowed), k)


def asked_words(docs: DataFrame, id_col: str, text_col: str, asked: DataFrame, stemmed: bool, *more: str) -> DataFrame:
    """(id, dl, words, *more): each document with those of its words that are ``asked`` (term, distinct), words as
    (term, tf). Up to ``IN_ROW`` asked words are looked up in the document's row, without a join; with more of them a
    document's words are rows of their own, each with a single use, beside one without a word."""
    rows = docs.select(F.col(id_col).alias("id"), tokens(F.col(text_col)).alias("toks"), *more).withColumn("dl", F.size("toks"))
    if asked.count() <= IN_ROW:
        terms = [r.term for r in asked.collect()]
        words = F.transform("toks", lambda w: stem(w)) if stemmed else F.col("toks")
        return rows.select("id", "dl", counted(F.sort_array(F.filter(words, lambda w: w.isin(terms)))).alias("words"), *more)
    words = rows.select("id", "dl", F.explode(F.concat("toks", F.array(F.lit("")))).alias("term"), *more)
    if stemmed:
        words = words.withColumn("term", stem(F.col("term")))
    terms = asked.unionByName(asked.sparkSession.range(1).select(F.lit("").alias("term")))
    one = F.array(F.struct("term", F.lit(1).cast("long").alias("tf")))
    return words.join(terms, "term").select("id", "dl", F.filter(one, lambda w: w["term"] != "").alias("words"), *more)


def search_batch(docs: DataFrame, id_col: str, text_col: str, queries: DataFrame, k: int = 5,
                 qid: str = "query_id", text: str = "text", stemmed: bool = False,
                 allowed: DataFrame | None = None, asks: str | None = None) -> DataFrame:
    """SE3 + SE4 (+SE7) for a one-shot batch of queries, without an index. One pass
    tokenizes the corpus and writes a row per document with the words that the queries ask for; no word is
    shuffled by itself. For the scores these rows are dealt by document, so that a task holds about
    ``PAIRS`` pairs of a query and a document, whatever the corpus, and a document's words meet there.
    Instead of ``allowed``, ``asks`` may name a column of ``docs``: the array of the queries that a row's id
    is allowed for, taken in the same pass."""
    from ..sources.io import materialize
    spark = docs.sparkSession
    wanted = materialize(query_terms(queries, qid, text, stemmed), spark, "asked")
    more = [asks] if asks else []
    found = materialize(asked_words(docs, id_col, text_col, wanted.select("term").distinct(), stemmed, *more), spark, "postings")
    rows = found.count()
    once = rows == found.select(F.xxhash64("id")).distinct().count()
    pairs = rows * queries.select(qid).distinct().count()
    dealt = found.repartition(max(spark.sparkContext.defaultParallelism, 1 + pairs // PAIRS), "id")
    each = lambda d: d.select("id", "dl", *more, F.inline("words"))
    if once:
        postings, terms, lengths = each(dealt), document_frequencies(each(found)), found.select("id", "dl")
    else:  # what rows of one id and length hold is added up; an id is allowed what any of its rows is
        postings = each(dealt).groupBy("term", "id", "dl").agg(F.sum("tf").alias("tf"))
        terms, lengths = document_frequencies(postings), found.select("id", "dl").distinct()
        if asks:
            allowed = found.select("id", F.explode(asks).alias("query_id"))
    # written, so that their size is known: a few weights go to the postings, not these to them
    n, mean = lengths.agg(F.count(F.lit(1)).cast("double"), F.avg("dl")).first()
    weights = materialize(wanted.join(terms, "term").select("query_id", "term", idf_of(F.lit(n)).alias("idf")), spark, "asked-weights")
    hits = postings.join(weights, "term")
    if asks and once:
        hits = hits.where(F.array_contains(asks, F.col("query_id")))
    return top_k(summed_scores(hits, F.lit(mean), allowed), k)


# --- SE5 / SE6 --------------------------------------------------------------------

def cosine_top_k(corpus: DataFrame, id_col: str, vec_col: str, queries: DataFrame,
                 qid: str, qvec: str, k: int = 5) -> DataFrame:
    """SE5: (query_id, id, score, rank) by cosine similarity, exact.

    The stated query set is dealt into blocks of about ``VECTOR_BLOCK`` vectors,
    one row each; every corpus row meets every block once (an equi-join on the
    block number), scores its vectors with native functions, and only the top k
    per query and task are shuffled. Both sides stay tables, whatever their size."""
    blocks = max(1, -(-queries.count() // VECTOR_BLOCK))
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
    doubles = lambda c: F.transform(F.col(c), lambda x: x.cast("double"))
    q = queries.select(F.col(qid).alias("query_id"), doubles(qvec).alias("q"))
    q = (q.withColumns({"qn": norm(F.col("q")), "block": F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")})
         .groupBy("block").agg(F.collect_list(F.struct("query_id", "q", "qn")).alias("qs")))
    base = (corpus.select(F.col(id_col).alias("id"), doubles(vec_col).alias("v")).withColumn("vn", norm(F.col("v")))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    s = base.join(q, "block").select("id", "v", "vn", F.explode("qs").alias("qq")).select(
        F.col("qq.query_id").alias("query_id"), "id",
        (F.aggregate(F.zip_with("qq.q", "v", lambda a, c: a * c), F.lit(0.0), lambda acc, x: acc + x)
         / F.nullif(F.col("qq.qn") * F.col("vn"), F.lit(0.0))).alias("score"))
    return top_k(s, k)


def centroids(df: DataFrame, key: str, vec_col: str, dim: int | None = None) -> DataFrame:
    """Mean vector per key: one partial + final aggregation with one ``avg`` per
    dimension (no explode, no collect_list of whole groups)."""
    if dim is None:
        dim = df.select(F.max(F.size(vec_col))).first()[0] or 0
    g = df.groupBy(key).agg(*[F.avg(F.col(vec_col).getItem(i).cast("double")).alias(f"__c{i}")
                              for i in range(dim)])
    return g.select(F.col(key).alias("query_id"),
                    F.array(*[F.col(f"__c{i}") for i in range(dim)]).alias("qvec"))


def rrf(rankings: list[DataFrame], k: int = 5, c: int = RRF_K) -> DataFrame:
    """SE6: reciprocal rank fusion of several (query_id, id, rank) rankings."""
    u = reduce(DataFrame.unionByName, [r.select("query_id", "id", "rank") for r in rankings])
    fused = u.groupBy("query_id", "id").agg(
        F.sum(F.lit(1.0) / (F.lit(c) + F.col("rank"))).alias("score"))
    return top_k(fused, k)


def index_health(index_ids: DataFrame, source_ids: DataFrame, id_col: str) -> DataFrame:
    """SE10: indexed vs source rows; ACTIVE when every source row is indexed.

    One full outer join on the id (both sides shuffled once), one aggregate."""
    src = source_ids.select(F.col(id_col).alias("id"), F.lit(True).alias("in_src"))
    idx = index_ids.select(F.col(id_col).alias("id")).distinct().withColumn("in_idx", F.lit(True))
    j = src.join(idx, "id", "full_outer")
    out = j.agg(F.count_if(F.col("in_src")).alias("source_rows"),
                F.count_if(F.col("in_idx")).alias("indexed_rows"),
                F.count_if(F.col("in_src") & F.col("in_idx").isNull()).alias("missing_rows"))
    return out.withColumn("state", F.when((F.col("missing_rows") == 0)
                                          & (F.col("indexed_rows") == F.col("source_rows")),
                                          "ACTIVE").otherwise("STALE"))
