"""A corpus pipeline: raw documents to packed training sequences.

``STAGES`` lists the stages in order; each takes (spark, docs, sf_dir) and gives
a DataFrame that is written as Parquet and read again as the next one's docs.
All but the last return the columns of ``documents``. SQL can't express the
whole (robust estimates, MinHash, alignment, subword ids), so ``ORACLE_SQL`` is
None and the tests compare ``run`` with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podlake.llm import decontaminate, line_dedup, minhash_dedup, packing, quality_rules
from podlake.llm.common import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.kept_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text without lines that a smaller document holds;
    n_chars is the length of what is left."""
    kept = line_dedup.dedup_lines(docs)
    new = {"text": F.when(F.col("__ld_n_dropped") > 0, F.col("__ld_kept")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("__ld_n_dropped") > 0, F.char_length("__ld_kept").cast("long")) \
            .otherwise(F.col("n_chars"))
    return kept.withColumns(new).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: a Jaccard similarity of 0.8 or more."""
    return minhash_dedup.kept_documents(docs, similarity=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item leaks into."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in a training sequence."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("MinHash near-dedup", near_copies),
    ("benchmark decontamination", benchmark),
    ("best-fit packing", sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
