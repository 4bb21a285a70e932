r"""Spelling variants (operator 12): a frontier of trie states, joined level by level.

Two words are near if one inserted, deleted or replaced code point makes one of the
other. All words are in a trie that is a table of edges: (node, next
code point, child), a node named by its prefix. A frontier row (word, position,
node, edits) says that the word up to ``position`` has been read and led to ``node``
with so many edits. One join of the frontier with the edges of a level takes every
row a level down: it reads its next code point, or, with no edit so far, takes
another edge instead (a replaced code point) or leaves one of its own out (a
deleted one). A row that ends with one edit where a word ends has found a neighbour.

Three things keep the frontier small, and lose nothing:

* Links are symmetric, so they are sought from the longer word, or of two of
  the same length from the one with the smaller code point at the place.
* An edit is made at the first place where the two differ. Let a word of length l
  differ at place p; then either p >= l // 2, or from behind the words agree in l // 2
  code points at least. So there is a trie of the words and one of the mirrored
  words, and edits begin at place l // 2: a word enters the frontier at its own
  prefix of that length, where the trie has few branches.
* An edge knows which code points follow its child, so that a row whose next code
  point isn't there is not made.

Words longer than ``DEPTH`` do not add levels: pairs whose longer word is one are
found by joining words with the hash of each word less one code point, and checked.
Groups of that join hold only words that differ at one place, or one insertion
from one word, so their size is bounded by the alphabet and the length.

Scale: each level reads one folder of the edge table and writes its frontier to
the shared folder. Edges of a level are repeated under as many salts as the most
crowded node of that level asks for (a node per ``SALT_WORDS`` words), and the
words of a node are dealt over them. All counts are aggregates with partial sums.

Defined results: null or empty text has no words; repeated rows count each; an
empty table gives no rows; of near words with the same count the smallest in
code-point order is the form; columns beyond doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import ascii_lower, stored

#: Levels of the trie; longer words go by hashes.
DEPTH = 24
#: Words that one salt of a node takes.
SALT_WORDS = 10_000


def word_runs(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, run): maximal runs of Latin letters of at least ``least`` code points,
    A-Z lower-cased."""
    runs = F.regexp_extract_all(ascii_lower(F.coalesce("text", F.lit(""))), F.lit(rf"[a-zÀ-ÿ]{{{least},}}"), F.lit(0))
    return docs.select("doc_id", F.explode(runs).alias("run"))


def thinned(run: Column, doc_id: Column, one_in: int) -> Column:
    """The run, or, if ``one_in`` divides the CRC-32 h of ``<doc_id>:<run>``, the run less
    its code point h % length."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.char_length(run)).cast("int")
    return F.when(F.pmod(h, F.lit(one_in)) == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))) \
        .otherwise(run)


def frequent_words(docs: DataFrame, least: int = 6, count: int = 5, one_in: int = 199) -> DataFrame:
    """(word, n) of all words of at least ``least`` code points and ``count`` occurrences."""
    words = word_runs(docs, least).select(thinned(F.col("run"), F.col("doc_id"), one_in).alias("word"))
    return (words.where(F.char_length("word") >= least).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= count))


def _at(text: str, place: Column) -> Column:
    """The code point at a place from 0; empty beyond the end."""
    return F.substring(F.col(text), place + 1, F.lit(1))


def entry() -> Column:
    """The level at which a word enters the frontier. Whoever may find it enters there
    or below, so no edge above is needed for it."""
    length = F.char_length("word")
    return F.when(length > 2, F.floor(length / 2).cast("int")).otherwise(0)


def edge_table(both: DataFrame) -> DataFrame:
    """(depth, dir, node, c, ends, follow, below) of the tries of
    ``both`` (dir, word, n); ``ends`` is the count of the word that the child is, ``follow``
    the code points below the child."""
    rows = both.select("dir", "word", "n", F.explode(F.sequence(entry(), F.char_length("word") - 1)).alias("depth"))
    last = F.col("depth") == F.char_length("word") - 1
    rows = rows.select("dir", "depth", F.substring("word", F.lit(1), F.col("depth")).alias("node"), _at("word", F.col("depth")).alias("c"),
                       F.when(last, F.col("n")).alias("ends"), F.nullif(_at("word", F.col("depth") + 1), F.lit("")).alias("next"))
    return rows.groupBy("depth", "dir", "node", "c").agg(
        F.max("ends").alias("ends"), F.array_join(F.array_sort(F.collect_set("next")), "").alias("follow"),
        F.count(F.lit(1)).alias("below"))


def _step(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """The frontier a level down: (dir, word, n, pos, node, edits, found, form_n)."""
    length, pos, c = F.char_length("word"), F.col("pos"), F.col("c")
    own, after, fresh = _at("word", pos), _at("word", pos + 1), F.col("edits") == 0

    def open_at(place: Column) -> Column:
        """With one edit: the rest of the word can still be read below the child."""
        return F.when(place >= length, F.col("ends").isNotNull()).otherwise(F.contains(F.col("follow"), _at("word", place)))

    def row(place: Column, edits: Column) -> Column:
        return F.struct(place.alias("pos"), edits.alias("edits"))

    moves = F.array(
        F.when((c == own) & (fresh | open_at(pos + 1)), row(pos + 1, F.col("edits"))),
        F.when(fresh & (pos < length) & (c > own) & open_at(pos + 1), row(pos + 1, F.lit(1))),
        F.when(fresh & (pos + 1 < length) & (c != own) & (c == after) & open_at(pos + 2), row(pos + 2, F.lit(1))))
    moved = (frontier.join(edges, ["dir", "node", "salt"])
             .select("dir", "word", "n", F.concat("node", "c").alias("node"), "ends",
                     F.explode(F.filter(moves, lambda m: m.isNotNull())).alias("m"))
             .select("dir", "word", "n", "node", "ends", "m.pos", "m.edits"))
    # read to the end with one edit, or all but the last code point without any
    found = F.when(F.col("edits") == 1, pos == length).otherwise((pos == length - 1) & F.col("ends").isNotNull())
    return moved.select("dir", "word", "n", "node", "pos", "edits", found.alias("found"), F.col("ends").alias("other_n"))


def trie_links(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n) of near words of at most ``DEPTH`` code points, each
    pair once or more, in one order."""
    spark = words.sparkSession
    both = words.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("dir"), "word", "n")
    both = stored(both.withColumn("word", F.when(F.col("dir") == 1, F.reverse("word")).otherwise(F.col("word"))), "variants-words")
    path = scratch_path(spark, "variants-edges")
    edge_table(both).write.partitionBy("depth").parquet(path)
    edges = spark.read.schema("dir int, node string, c string, ends long, follow string, below long, depth int").parquet(path)
    crowd = {r["depth"]: r["below"] for r in edges.groupBy("depth", "dir", "node").agg(F.sum("below").alias("below"))
             .groupBy("depth").agg(F.max("below").alias("below")).collect()}  # a row per level
    carried, links = None, []
    for depth in sorted(crowd):
        salts = 1 + crowd[depth] // SALT_WORDS
        frontier = both.where(entry() == depth).select("dir", "word", "n", F.substring("word", 1, depth).alias("node"),
                                                     F.lit(depth).alias("pos"), F.lit(0).alias("edits"))
        if carried is not None:
            live = carried.where(F.col("pos") < F.char_length("word"))
            frontier = frontier.unionByName(live.select(*frontier.columns))
        level = edges.where(F.col("depth") == depth).drop("depth", "below") \
            .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        frontier = frontier.withColumn("salt", F.pmod(F.xxhash64("word"), F.lit(salts)).cast("int"))
        carried = stored(_step(frontier, level), f"variants-frontier-{depth}")
        links.append(carried.where("found"))
    schema = "word string, n long, other string, other_n long"
    out = spark.createDataFrame([], schema)
    turn = lambda c: F.when(F.col("dir") == 1, F.reverse(c)).otherwise(F.col(c))
    for t in links:
        out = out.unionByName(t.select(turn("word").alias("word"), "n", turn("node").alias("other"), "other_n"))
    return out


def hash_links(words: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The same for pairs whose longer word has more than ``depth`` code points."""
    length = F.char_length("word")
    long = words.where(length > depth)
    less = long.select("word", "n", F.explode(F.sequence(F.lit(0), length - 1)).alias("at")).select(
        "word", "n", "at", F.xxhash64(F.concat(F.substring("word", F.lit(1), F.col("at")),
                                               F.substring("word", F.col("at") + 2, length))).alias("h"))
    whole = words.where(length >= depth).select(F.col("word").alias("other"), F.col("n").alias("other_n"), F.xxhash64("word").alias("h"))
    deleted = less.join(whole, "h").select("word", "n", "other", "other_n")
    same = less.select(F.col("word").alias("other"), F.col("n").alias("other_n"), "at", "h")
    replaced = less.join(same, ["at", "h"]).where(F.col("word") < F.col("other")).select("word", "n", "other", "other_n")
    return deleted.unionByName(replaced).where(F.levenshtein("word", "other", 1) == 1)


def near_words(words: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(word, n, other, other_n): every two near words of ``words`` (word, n), in both orders, once."""
    links = trie_links(words.where(F.char_length("word").between(1, depth))).unionByName(hash_links(words, depth))
    back = links.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return links.unionByName(back).distinct()


def follow_forms(forms: DataFrame) -> DataFrame:
    """(word, root) for every row of ``forms`` (word, form): the end of its chain of
    forms. Each round doubles the steps taken."""
    reached = stored(forms.select("word", F.col("form").alias("root")), "variants-roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("far"))
        jumped = stored(reached.join(onward, "root", "left").select("word", F.coalesce("far", "root").alias("root"),
                                                                    F.col("far").isNotNull().alias("moved")), "variants-roots")
        if jumped.where("moved").isEmpty():
            return jumped.select("word", "root")
        reached = jumped.select("word", "root")


def variants(words: DataFrame, ratio: int = 5, depth: int = DEPTH) -> DataFrame:
    """The operator: (word, n, n_near, form, form_n, root) of every row of ``words`` (word,
    n), words distinct. The form is the near word of largest count, if that is at
    least ``ratio`` times the word's."""
    words = stored(words.select("word", "n"), "variants-counts")
    best = near_words(words, depth).groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other"))).alias("best"))
    takes = -F.col("best.less") >= ratio * F.col("n")
    told = stored(best.select("word", "n_near", F.when(takes, F.col("best.other")).alias("form"),
                              F.when(takes, -F.col("best.less")).alias("form_n")), "variants-forms")
    roots = follow_forms(told.where("form IS NOT NULL"))
    return (words.join(told, "word", "left").join(roots, "word", "left")
            .select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form", "form_n",
                    F.coalesce("root", "word").alias("root")))


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return variants(frequent_words(docs)).select("word", "form", "root", "n", "n_near", "form_n")
