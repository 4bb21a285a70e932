"""Question routing (RT1): analytics vs search vs both, by keyword scores.

The reference's orchestrator picks a tool per question from its instructions:
KPI/metric questions go to the metric model, questions about specific
documents, exceptions or damage go to search, comparisons use both. Here the
rule is a batch column expression over a table of questions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keywords of each tool, from the routing instructions.
ANALYTICS_WORDS = ["rate", "rates", "total", "count", "how many", "average", "trend", "percent",
                   "percentage", "kpi", "metric", "metrics", "top", "monthly", "volume", "cost",
                   "compare", "by carrier", "by customer"]
SEARCH_WORDS = ["find", "show", "document", "documents", "pod", "proof", "damage", "damaged",
                "exception", "exceptions", "signature", "signed", "missing", "receiver", "notes",
                "search"]


def keyword_pattern(word: str, jvm: bool = False) -> str:
    """Case-insensitive whole-word pattern with ASCII boundaries (no \\b, whose
    meaning differs between Java regex and RE2). ``jvm`` spells the boundary
    class as [^\\p{Alnum}] -- ASCII-only in Java and much faster there."""
    body = " +".join(word.split())
    sep = r"[^\p{Alnum}]" if jvm else "[^A-Za-z0-9]"
    return rf"(?i)(^|{sep}){body}({sep}|$)"


def _score(text: str, words: list[str]):
    hits = [F.when(F.col(text).rlike(keyword_pattern(w, jvm=True)), 1).otherwise(0) for w in words]
    return reduce(lambda a, b: a + b, hits)


def route_questions(df: DataFrame, text: str = "text") -> DataFrame:
    a = _score(text, ANALYTICS_WORDS)
    s = _score(text, SEARCH_WORDS)
    return (df.withColumn("analytics_score", a.cast("int"))
            .withColumn("search_score", s.cast("int"))
            .withColumn("route", F.when((F.col("analytics_score") > 0) & (F.col("search_score") > 0),
                                        "both")
                        .when(F.col("analytics_score") > 0, "analytics")
                        .when(F.col("search_score") > 0, "search").otherwise("none")))
