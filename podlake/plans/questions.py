"""Named business questions, each bound to a metric query.

No text-to-SQL: a question is a name bound to a compiled metric query over the
model. Parameters (a customer name, a city, a shipment id) are arguments.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import pct
from ..operators.quality import domain_check as _domain_check
from ..sources import fixtures as fx
from .logistics_model import SAMPLE_VALUES, logistics_model
from .semantic import drill_across, metric_query

M = logistics_model()


def vq_on_time(t) -> DataFrame:
    """VQ1 with SM7 scope: the rate together with numerator, denominator, dates."""
    return metric_query(
        M, t, ["ON_TIME_DELIVERY_RATE"], where_columns=["is_on_time", "ship_date"],
        extra_aggs={"on_time_shipments": F.count_if(F.col("is_on_time")),
                    "scope_rows": F.count(F.lit(1)),
                    "first_ship_date": F.min("ship_date"),
                    "last_ship_date": F.max("ship_date")})


def vq_on_time_by_carrier(t) -> DataFrame:
    """VQ2, each rate with its numerator, rows and dates (SM7)."""
    return metric_query(M, t, ["ON_TIME_DELIVERY_RATE", "TOTAL_SHIPMENTS"], ["carrier_name"], scope=True,
                        order=[F.desc_nulls_first("on_time_delivery_rate"),
                               F.asc_nulls_last("carrier_name")])


def vq_exception_by_customer(t) -> DataFrame:
    """VQ3, with the same scope."""
    return metric_query(M, t, ["EXCEPTION_RATE", "TOTAL_PODS"], ["customer_name"], scope=True,
                        order=[F.desc_nulls_first("exception_rate"),
                               F.asc_nulls_last("customer_name")])


def vq_missing_signatures(t) -> DataFrame:
    return metric_query(M, t, ["MISSING_SIGNATURE_COUNT", "TOTAL_PODS"])


def vq_claims_by_type(t) -> DataFrame:
    return metric_query(M, t, ["TOTAL_CLAIMS", "TOTAL_CLAIM_AMOUNT"], ["claim_type"],
                        order=[F.desc("total_claims"), "claim_type"])


def vq_claims_by_carrier_type(t) -> DataFrame:
    return metric_query(M, t, ["TOTAL_CLAIMS", "TOTAL_CLAIM_AMOUNT"],
                        ["carrier_name", "claim_type"],
                        order=[F.asc_nulls_last("carrier_name"), "claim_type"])


def vq_monthly_shipments(t) -> DataFrame:
    """VQ7 / SM3: time grain month of SHIP_DATE."""
    return metric_query(M, t, ["TOTAL_SHIPMENTS", "TOTAL_FREIGHT_COST"],
                        ["ship_date:month as month"], order=[F.asc_nulls_last("month")])


def vq_top_carriers_freight(t, n: int = 5) -> DataFrame:
    """VQ8 / TK3: named carriers only, ties broken by name."""
    return metric_query(M, t, ["TOTAL_FREIGHT_COST"], ["carrier_name"],
                        where=F.col("carrier_name").isNotNull(),
                        order=[F.desc("total_freight_cost"), F.asc("carrier_name")], limit=n)


def vq_claim_resolution(t) -> DataFrame:
    """VQ9: share of claims in status 'Resolved' (2 decimals) with its scope."""
    resolved = F.count_if(F.col("claim_status") == "Resolved")
    return metric_query(M, t, ["TOTAL_CLAIMS"], where_columns=["claim_status", "claim_date"],
                        extra_aggs={"resolved_claims": resolved,
                                    "resolution_rate": pct(resolved, F.count(F.lit(1)), 2),
                                    "first_claim_date": F.min("claim_date"),
                                    "last_claim_date": F.max("claim_date")})


def vq_damaged_for_customer(t, customer_name: str) -> DataFrame:
    """VQ10: damaged PODs of one customer. The customer's key picks its orders and
    these pick their lines, so no join carries other customers' rows."""
    cust = fx.dim_customers(t).where(F.col("customer_name") == customer_name) \
        .select("customer_id", "customer_name")
    pods = fx.pod_fact(t, ["pod_id", "shipment_id", "customer_id", "delivery_date",
                           "damage_reported", "damage_description"],
                       lineitem=fx.lines_of_customer(t, customer_name)).where(F.col("damage_reported"))
    return (pods.join(cust, "customer_id")
            .select("pod_id", "shipment_id", "customer_name", "delivery_date", "damage_description")
            .orderBy(F.desc_nulls_first("delivery_date"), "pod_id"))


def vq_missing_sig_city(t, city: str) -> DataFrame:
    """VQ11: PODs without signature delivered in one city."""
    pods = fx.pod_fact(t, ["pod_id", "shipment_id", "delivery_city", "delivery_date",
                           "signature_present", "signed_by"])
    return (pods.where(~F.col("signature_present") & (F.col("delivery_city") == city))
            .select("pod_id", "shipment_id", "delivery_city", "delivery_date", "signed_by")
            .orderBy(F.desc_nulls_first("delivery_date"), "pod_id"))


def vq_pod_for_shipment(t, shipment_id: str) -> DataFrame:
    """VQ12 / SE9: point lookup. The id names six raw columns of one line, which
    filter the scan; the joins then carry that row only."""
    from ..operators.search import build_corpus
    pods = fx.pod_fact(t, where=fx.line_of(shipment_id))
    corpus = build_corpus(pods, fx.dim_customers(t), fx.dim_carriers(t))
    return (corpus.where(F.col("shipment_id") == shipment_id)
            .select("pod_id", "shipment_id", "order_id", "customer_name", "carrier_name",
                    "delivery_date", "pod_status", "signed_by"))


def vq_on_time_by_dates(t) -> DataFrame:
    """VQ13: on time by dates (actual <= expected) among delivered shipments (T4)."""
    s = fx.fact_shipments(t, ["actual_delivery_date", "expected_delivery_date"]) \
        .where(F.col("actual_delivery_date").isNotNull())
    ok = F.count_if(F.col("actual_delivery_date") <= F.col("expected_delivery_date"))
    return s.agg(F.count(F.lit(1)).alias("delivered"), ok.alias("on_time_by_dates"),
                 pct(ok, F.count(F.lit(1)), 2).alias("on_time_by_dates_pct"))


def drill_across_carrier(t) -> DataFrame:
    """SM4: shipments, PODs and claims metrics side by side per carrier name."""
    dims = ["carrier_name"]
    parts = [
        metric_query(M, t, ["TOTAL_SHIPMENTS", "TOTAL_FREIGHT_COST"], dims),
        metric_query(M, t, ["TOTAL_PODS", "EXCEPTION_RATE"], dims),
        metric_query(M, t, ["TOTAL_CLAIMS", "TOTAL_CLAIM_AMOUNT"], dims),
    ]
    return drill_across(parts, dims).orderBy(F.asc_nulls_last("carrier_name"))


def domain_check(t) -> DataFrame:
    """SM6: data values outside the model's declared sample values."""
    checks = []
    for (table, column), samples in SAMPLE_VALUES.items():
        lt = M.tables[table]
        df = lt.source(t, columns=[column]) if lt.prunable else lt.source(t).select(column)
        checks.append((table, column, df, samples))
    return _domain_check(checks)


def vq_orders_by_segment(t) -> DataFrame:
    """Orders and their value per customer segment and status (ORDERS -> CUSTOMERS)."""
    return metric_query(M, t, ["TOTAL_ORDERS", "TOTAL_ORDER_VALUE"], ["customer_segment", "order_status"])


def vq_shipments_by_segment(t) -> DataFrame:
    """SHIPMENTS -> CUSTOMERS."""
    return metric_query(M, t, ["TOTAL_SHIPMENTS", "ON_TIME_DELIVERY_RATE"], ["customer_segment"])


def vq_claims_by_segment(t) -> DataFrame:
    """CLAIMS -> CUSTOMERS."""
    return metric_query(M, t, ["TOTAL_CLAIMS", "TOTAL_CLAIM_AMOUNT"], ["customer_segment"])


def vq_damage_rate_by_carrier_type(t) -> DataFrame:
    """DAMAGE_RATE per carrier type, with the PODs it is a share of."""
    return metric_query(M, t, ["DAMAGE_RATE", "TOTAL_PODS"], ["carrier_type"], scope=True)


def vq_shipments_by_grain(t) -> DataFrame:
    """SM3: every other time grain of SHIP_DATE (day, week, quarter, year)."""
    parts = [metric_query(M, t, ["TOTAL_SHIPMENTS"], [f"ship_date:{g} as period"])
             .select(F.lit(g).alias("grain"), "period", "total_shipments") for g in ("day", "week", "quarter", "year")]
    return reduce(DataFrame.unionByName, parts)


def orphan_report(t) -> DataFrame:
    """JN10: per declared relation the fact rows without a matching dimension row;
    NULL keys are counted apart."""
    parts = []
    for r in M.relationships:
        left, right = M.tables[r.left], M.tables[r.right]
        source = left.source(t, columns=[r.left_column]) if left.prunable else left.source(t).select(r.left_column)
        keys = source.groupBy(F.col(r.left_column).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        dim = right.source(t).select(F.col(r.right_column).alias("k")).withColumn("known", F.lit(True))
        j = keys.join(dim, "k", "left")
        parts.append(j.agg(
            F.coalesce(F.sum(F.when(F.col("k").isNotNull() & F.col("known").isNull(), F.col("n"))), F.lit(0))
            .cast("long").alias("orphan_rows"),
            F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).cast("long").alias("null_rows"))
            .select(F.lit(r.name).alias("relation"), "orphan_rows", "null_rows"))
    return reduce(DataFrame.unionByName, parts)
