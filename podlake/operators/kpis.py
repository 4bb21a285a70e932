"""Dashboard KPIs, top-k reports and table counts (AG1-AG5, AG17, TK1-TK3, SET1).

All aggregations are plain ``groupBy/agg``: Catalyst plans a partial
aggregation before the shuffle, so a hot group (the NULL carrier, one status
holding a third of the rows) is pre-reduced on every map task and never lands
in one reducer as raw rows. Per-dimension KPIs aggregate the fact by its
foreign key before the dimension join (eager aggregation), so the join sees one
row per key instead of one per fact row. Dimension joins are left equi joins
without hints; AQE broadcasts the dimension only after measuring it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import flag_count, month, pct

CLEAN = "Delivered - Clean"


def pod_summary(pod: DataFrame) -> DataFrame:
    """AG1: one row even on empty input (global aggregate)."""
    return pod.agg(
        F.count(F.lit(1)).alias("total_pods"),
        F.sum(F.when(F.col("exception_flag"), 1).otherwise(0)).cast("long").alias("with_exceptions"),
        F.sum(F.when(~F.col("signature_present"), 1).otherwise(0)).cast("long").alias("missing_sigs"),
        F.sum(F.when(F.col("damage_reported"), 1).otherwise(0)).cast("long").alias("with_damage"),
        F.sum(F.when(F.col("partial_delivery"), 1).otherwise(0)).cast("long").alias("partial_dels"),
        pct(F.sum(F.when(F.col("pod_status") == CLEAN, 1).otherwise(0)), F.count(F.lit(1)), 1)
        .alias("clean_pct"),
    )


def exceptions_by_carrier(pod: DataFrame, carriers: DataFrame, scope_date: str | None = None) -> DataFrame:
    """AG2 (JN1 + group): NULL carrier group kept, sorted by pct desc. ``scope_date``
    adds the first and last such date of each group (SM7)."""
    # Eager aggregation: one row per carrier_id reaches the join (see
    # plans.semantic._eager); the result equals join-then-aggregate.
    ends = [("first", F.min), ("last", F.max)] if scope_date else []
    pre = pod.groupBy("carrier_id").agg(F.count(F.lit(1)).alias("n"), flag_count(F.col("exception_flag")).alias("e"),
                                        *[fn(scope_date).alias(word) for word, fn in ends])
    j = pre.join(carriers.select("carrier_id", "carrier_name"), "carrier_id", "left")
    n, e = F.sum("n"), F.sum("e")
    return (j.groupBy("carrier_name")
            .agg(n.alias("total_pods"), e.alias("exceptions"),
                 pct(e, n, 1).alias("exception_pct"), *[fn(word).alias(f"{word}_{scope_date}") for word, fn in ends])
            .orderBy(F.desc_nulls_first("exception_pct"), F.asc_nulls_last("carrier_name")))


def exceptions_by_customer(pod: DataFrame, customers: DataFrame) -> DataFrame:
    """AG3 (JN2 + two-key group)."""
    pre = pod.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), flag_count(F.col("exception_flag")).alias("e"),
        flag_count(F.col("damage_reported")).alias("d"),
        flag_count(~F.col("signature_present")).alias("m"))
    j = pre.join(customers.select("customer_id", "customer_name", "customer_segment"),
                 "customer_id", "left")
    return (j.groupBy("customer_name", "customer_segment")
            .agg(F.sum("n").alias("total_pods"), F.sum("e").alias("exceptions"),
                 F.sum("d").alias("damages"), F.sum("m").alias("missing_sigs"))
            .orderBy(F.desc("exceptions"), F.asc_nulls_last("customer_name")))


def pod_status_dist(pod: DataFrame) -> DataFrame:
    """AG4."""
    return (pod.groupBy("pod_status").agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy(F.desc("cnt"), "pod_status"))


def monthly_trend(pod: DataFrame) -> DataFrame:
    """AG5: NULL month kept and sorted last (T7)."""
    return (pod.groupBy(month("delivery_date").alias("month"))
            .agg(F.count(F.lit(1)).alias("total_pods"),
                 flag_count(F.col("exception_flag")).alias("exceptions"),
                 flag_count(F.col("damage_reported")).alias("damages"))
            .orderBy(F.asc_nulls_last("month")))


def recent_exceptions(pod: DataFrame, customers: DataFrame, carriers: DataFrame,
                      n: int = 50) -> DataFrame:
    """TK2: flagged PODs newest first, LIMIT n. The filter is pushed to the scan
    and the limit runs as TakeOrderedAndProject (per-task top-n, then merge).
    The primary key is the last sort key so ties are deterministic (T5, T7)."""
    p = pod.where(F.col("exception_flag")).select(
        "pod_id", "shipment_id", "delivery_date", "pod_status", "customer_id", "carrier_id",
        "exception_notes", "damage_description", "signature_present")
    # Cut to the top n before the dimension joins: the joins are many-to-one
    # left joins, so they neither add nor remove rows and cannot change the order.
    top = p.orderBy(F.desc_nulls_first("delivery_date"), F.asc("pod_id")).limit(n)
    j = (top.join(customers.select("customer_id", "customer_name"), "customer_id", "left")
         .join(carriers.select("carrier_id", "carrier_name"), "carrier_id", "left"))
    return (j.select("pod_id", "shipment_id", "delivery_date", "pod_status", "customer_name",
                     "carrier_name", "exception_notes", "damage_description", "signature_present")
            .orderBy(F.desc_nulls_first("delivery_date"), F.asc("pod_id")))


def row_counts(named: dict[str, DataFrame]) -> DataFrame:
    """SET1 / SRC11: UNION ALL of one (tbl, cnt) row per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("tbl"), "cnt")
             for name, df in named.items()]
    return reduce(DataFrame.unionByName, parts)


def top_by(df: DataFrame, key: str, metric_col, metric_name: str, n: int) -> DataFrame:
    """TK3 building block: aggregate then ORDER BY metric DESC, key LIMIT n."""
    return (df.groupBy(key).agg(metric_col.alias(metric_name))
            .orderBy(F.desc_nulls_last(metric_name), F.asc_nulls_last(key)).limit(n))


def review_kpis(log: DataFrame) -> DataFrame:
    """AG17 over the whole log (T13): totals per status, auto-accept %, and
    approved rows that carried corrections."""
    st = F.col("review_status")
    total = F.count(F.lit(1))
    approved = F.count_if(st == "APPROVED")
    return log.agg(
        total.alias("total_reviews"),
        approved.alias("approved"),
        F.count_if(st == "REJECTED").alias("rejected"),
        F.count_if(st == "FLAGGED").alias("flagged"),
        pct(approved, total, 1).alias("auto_accept_pct"),
        F.count_if((st == "APPROVED") & F.col("fields_modified").isNotNull()
                   & (F.col("fields_modified") != "")).alias("approved_with_corrections"),
    )


def review_queue(log: DataFrame, status: str = "All", n: int = 100) -> DataFrame:
    """TK1 / FLT2: optional status filter ("All" = none), newest first, LIMIT n."""
    if status != "All":
        log = log.where(F.col("review_status") == status)
    return (log.select("review_id", "pod_id", "file_name", "review_status", "reviewer",
                       "review_timestamp", "ai_confidence", "fields_modified", "review_notes")
            .orderBy(F.desc_nulls_first("review_timestamp"), F.asc("review_id")).limit(n))
