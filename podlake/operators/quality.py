"""Data-quality jobs: declared keys (SRC10), orphans of relationships (JN10),
domain checks against the model's sample values (SM6)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_violations(named: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """SRC10: per table, how many key values repeat and how many keys are NULL.

    One ``groupBy(key)`` per table (partial aggregation first, so a key that
    repeats a billion times is counted map-side), then a global count.
    """
    parts = []
    for name, (df, key) in named.items():
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        parts.append(per_key.agg(
            F.count_if(F.col(key).isNotNull() & (F.col("n") > 1)).alias("dup_keys"),
            F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).cast("long")
            .alias("null_keys"),
        ).select(F.lit(name).alias("tbl"), F.lit(key).alias("key_col"), "dup_keys", "null_keys"))
    return reduce(DataFrame.unionByName, parts)


def line_key_violations(lines: DataFrame, raw_key: list[str], tables: dict[str, tuple[str, Column]]) -> DataFrame:
    """SRC10 for facts whose keys print the same raw columns: ``tables`` maps a
    table to (its key, which lines it holds). One scan and one shuffle, by the raw
    columns, serve them all; a key with a NULL column is a NULL key."""
    per_key = lines.groupBy(*raw_key).agg(*[F.count_if(held).alias(f"n_{t}") for t, (_, held) in tables.items()])
    null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in raw_key])
    totals = per_key.agg(*[F.count_if(~null & (F.col(f"n_{t}") > 1)).alias(f"dup_{t}") for t in tables],
                         *[F.coalesce(F.sum(F.when(null, F.col(f"n_{t}"))), F.lit(0)).cast("long").alias(f"null_{t}")
                           for t in tables])
    rows = F.array(*[F.struct(F.lit(t).alias("tbl"), F.lit(key).alias("key_col"), F.col(f"dup_{t}").alias("dup_keys"),
                              F.col(f"null_{t}").alias("null_keys")) for t, (key, _) in tables.items()])
    return totals.select(F.explode(rows).alias("r")).select("r.*")


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """JN10: fact rows whose key has no match in the dimension (left anti join).
    NULL keys never match and are returned too."""
    return fact.join(dim.select(key), key, "left_anti")


def orphan_counts(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """JN10 report: orphan rows per key value. The anti join keeps only misses,
    the count is partially aggregated before the shuffle."""
    return (orphans(fact.select(key), dim, key).groupBy(key)
            .agg(F.count(F.lit(1)).alias("orphan_rows")))


def domain_check(checks: list[tuple[str, str, DataFrame, list[str]]]) -> DataFrame:
    """SM6: values present in the data but missing from the declared sample values.

    ``checks`` = (table, column, df, sample_values). The distinct values are
    found with a partial+final aggregation; the short sample list is an
    ``isin`` filter, not a join.
    """
    parts = []
    for table, column, df, samples in checks:
        v = F.col(column)
        parts.append(
            df.where(v.isNotNull() & ~v.isin(*samples)).groupBy(v.alias("value"))
            .agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                    "value", "rows"))
    return reduce(DataFrame.unionByName, parts)
