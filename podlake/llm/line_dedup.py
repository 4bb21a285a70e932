"""Line dedup (operator 5): drop lines that an earlier document already holds.

Line hashes are range-partitioned and sorted by (hash, document, position); the
first occurrence of each hash is streamed out of that order, and every document
gets a compressed bitmap of the lines it keeps. Text never takes part in the
line shuffles: only 128-bit hashes, document ids and positions do.

A hash is split into ``SALTS`` salted runs by document, so a line found in a
third of all documents is spread over that many range partitions; each run
yields one local first occurrence, and the global first is the smallest of at
most ``SALTS`` of them; it goes back to the lines of each salted run.

Defined results: a null or empty text is one empty line; a null doc_id sorts
after all others; rows that share doc_id and text share a bitmap; rows that
share a doc_id are one document when occurrences are compared. An empty table
gives an empty table. Other columns pass through; inner names start with
``__ld_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACES, ascii_lower, fingerprint, stored

MIN_LENGTH = 10
SALTS = 16


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def line_hashes(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """One row (h1, h2, salt, doc_id, fp, pos) per line whose key is long enough."""
    lines = docs.select("doc_id", fingerprint(F.col("text")).alias("fp"),
                        F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    keyed = lines.select("doc_id", "fp", "pos", line_key(F.col("line")).alias("key"))
    return (keyed.where(F.char_length("key") >= min_length)
            .select(F.xxhash64("key").alias("h1"),
                    F.xxhash64(F.lit("second"), "key").alias("h2"),
                    F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"),
                    "doc_id", "fp", "pos"))


def dropped_lines(hashes: DataFrame) -> DataFrame:
    """(doc_id, fp, pos) of every line whose key a smaller document also holds."""
    run = (W.partitionBy("h1", "h2", "salt")
           .orderBy(F.col("doc_id").asc_nulls_last(), "fp", "pos"))
    ranged = hashes.repartitionByRange("h1", "h2", "salt")
    heads = ranged.withColumn("nth", F.row_number().over(run)).where("nth = 1")
    owners = heads.select("h1", "h2", "salt",
                          F.min("doc_id").over(W.partitionBy("h1", "h2")).alias("owner"))
    return (hashes.join(owners, ["h1", "h2", "salt"])
            .where(~F.col("doc_id").eqNullSafe(F.col("owner")))
            .select("doc_id", "fp", "pos"))


def keep_bitmaps(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """The operator: one row per document that loses lines: doc_id, fp (text
    fingerprint), n_dropped, keep = map from word to bits. Bit b of word w says
    whether line 64 * w + b stays; words without a dropped line are left out."""
    hashes = stored(line_hashes(docs, min_length), "line-hashes")
    bit = F.expr("shiftleft(1L, pos % 64)")
    words = (dropped_lines(hashes).groupBy("doc_id", "fp", F.expr("pos div 64").alias("word"))
             .agg(F.bit_or(bit).alias("gone")))
    return (words.groupBy("doc_id", "fp")
            .agg(F.sum(F.bit_count("gone")).alias("n_dropped"),
                 F.map_from_entries(F.sort_array(F.collect_list(
                     F.struct("word", F.bitwise_not("gone").alias("bits"))))).alias("keep")))


def kept_text(text: Column, keep: Column) -> Column:
    """Text of the lines that the bitmap keeps, joined by line feeds."""
    def stays(_, i):
        word = F.try_element_at(keep, F.floor(i / 64))
        return F.coalesce(F.getbit(word, (i % 64).cast("int")) == 1, F.lit(True))

    return (F.when(keep.isNull(), F.coalesce(text, F.lit("")))
            .otherwise(F.array_join(F.filter(lines_of(text), stays), "\n")))


def dedup_lines(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """All rows and columns of ``docs``, plus __ld_n_dropped (long) and
    __ld_kept (the text left after the bitmap is applied)."""
    maps = keep_bitmaps(docs, min_length).select(
        F.col("doc_id").alias("__ld_id"), F.col("fp").alias("__ld_fp2"),
        F.col("n_dropped").alias("__ld_n"), F.col("keep").alias("__ld_keep"))
    left = docs.withColumn("__ld_fp", fingerprint(F.col("text")))
    on = left["doc_id"].eqNullSafe(maps["__ld_id"]) & (left["__ld_fp"] == maps["__ld_fp2"])
    return (left.join(maps.hint("shuffle_hash"), on, "left")
            .withColumn("__ld_kept", kept_text(F.col("text"), F.col("__ld_keep")))
            .withColumn("__ld_n_dropped", F.coalesce("__ld_n", F.lit(0)).cast("long"))
            .drop("__ld_id", "__ld_fp", "__ld_fp2", "__ld_n", "__ld_keep"))


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return (dedup_lines(docs)
            .select("doc_id", F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"),
                    F.col("__ld_n_dropped").alias("n_dropped"),
                    F.sha2("__ld_kept", 256).alias("kept_sha256")))


SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(s, 1) AS pos, unnest(s) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents) d
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), firsts AS (
  SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key
), marked AS (
  SELECT k.doc_id, k.pos, k.line, f.owner IS NOT NULL AND f.owner <> k.doc_id AS gone
  FROM keyed k LEFT JOIN firsts f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
