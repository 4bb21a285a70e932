"""The logistics metric model: 6 logical tables, 11 metrics, 7 relationships."""

from __future__ import annotations

from ..sources import fixtures as fx
from .semantic import LogicalTable, Metric, Model, Relationship

def percent(num: str, den: str) -> str:
    """A share in percent with two decimals; NULL when the denominator is 0."""
    return f"round(100.0 * ({num}) / nullif({den}, 0), 2)"


def count_of(c: str) -> Metric:
    return Metric(f"COUNT({c})", "long", {"n": f"COUNT({c})"}, "SUM({n})")


def sum_of(c: str) -> Metric:
    return Metric(f"SUM({c})", "double", {"s": f"SUM({c})"}, "SUM({s})")


def flag_sum(cond: str) -> Metric:
    return Metric(f"count_if({cond})", "long", {"n": f"count_if({cond})"}, "SUM({n})")


def rate_of(flag: str) -> Metric:
    parts = {"num": f"count_if({flag})", "den": "count(*)"}
    return Metric(percent(parts["num"], parts["den"]), "double", parts, percent("sum({num})", "sum({den})"), flag)


# The sample values declared in the reference model, per column.
SAMPLE_VALUES = {
    ("SHIPMENTS", "origin_city"): ["Mumbai", "Chennai", "Delhi", "Bangalore", "Pune"],
    ("SHIPMENTS", "destination_city"): ["Mumbai", "Chennai", "Delhi", "Hyderabad", "Kolkata"],
    ("SHIPMENTS", "status"): ["Delivered", "In Transit", "Out for Delivery", "Exception", "Returned"],
    ("ORDERS", "order_status"): ["Fulfilled", "Processing", "Cancelled", "Returned"],
    ("POD_DOCUMENTS", "pod_status"): ["Delivered - Clean", "Delivered - With Exceptions",
                                      "Partial Delivery", "Refused"],
    ("CLAIMS", "claim_type"): ["Damage", "Loss", "Shortage", "Late Delivery"],
    ("CLAIMS", "claim_status"): ["Resolved", "Under Review", "Pending Documentation", "Rejected"],
    ("CUSTOMERS", "customer_segment"): ["Enterprise", "Mid-Market", "SMB"],
}


def _samples(table: str) -> dict[str, list[str]]:
    return {c: v for (t, c), v in SAMPLE_VALUES.items() if t == table}


def logistics_model() -> Model:
    tables = {
        "SHIPMENTS": LogicalTable(
            "SHIPMENTS", fx.fact_shipments, ["shipment_id"],
            ["shipment_id", "order_id", "customer_id", "carrier_id", "origin_city", "destination_city", "status",
             "is_on_time", "ship_date", "expected_delivery_date", "actual_delivery_date"],
            ["weight_kg", "num_packages", "freight_cost"],
            {"TOTAL_SHIPMENTS": count_of("shipment_id"),
             "TOTAL_FREIGHT_COST": sum_of("freight_cost"),
             "ON_TIME_DELIVERY_RATE": rate_of("is_on_time")},
            _samples("SHIPMENTS"), scope_date="ship_date"),
        "ORDERS": LogicalTable(
            "ORDERS", fx.fact_orders, ["order_id"],
            ["order_id", "customer_id", "order_status", "payment_method", "order_date"],
            ["order_value", "num_items"],
            {"TOTAL_ORDERS": count_of("order_id"),
             "TOTAL_ORDER_VALUE": sum_of("order_value")},
            _samples("ORDERS"), prunable=False),
        "POD_DOCUMENTS": LogicalTable(
            "POD_DOCUMENTS", fx.pod_fact, ["pod_id"],
            ["pod_id", "shipment_id", "customer_id", "carrier_id", "signed_by", "delivery_city",
             "pod_status", "exception_flag", "exception_notes", "signature_present",
             "damage_reported", "partial_delivery", "delivery_date"],
            ["packages_received", "packages_expected"],
            {"TOTAL_PODS": count_of("pod_id"),
             "EXCEPTION_RATE": rate_of("exception_flag"),
             "MISSING_SIGNATURE_COUNT": flag_sum("NOT signature_present"),
             "DAMAGE_RATE": rate_of("damage_reported")},
            _samples("POD_DOCUMENTS"), scope_date="delivery_date"),
        "CLAIMS": LogicalTable(
            "CLAIMS", fx.fact_claims, ["claim_id"],
            ["claim_id", "shipment_id", "customer_id", "carrier_id", "claim_type", "claim_status",
             "claim_date", "resolution_date"],
            ["claim_amount", "resolution_amount"],
            {"TOTAL_CLAIMS": count_of("claim_id"),
             "TOTAL_CLAIM_AMOUNT": sum_of("claim_amount")},
            _samples("CLAIMS"), scope_date="claim_date"),
        "CUSTOMERS": LogicalTable(
            "CUSTOMERS", fx.dim_customers, ["customer_id"],
            ["customer_id", "customer_name", "customer_segment", "city", "state"], [], {},
            _samples("CUSTOMERS"), prunable=False),
        "CARRIERS": LogicalTable(
            "CARRIERS", fx.dim_carriers, ["carrier_id"],
            ["carrier_id", "carrier_name", "carrier_type", "service_region"], ["on_time_rating"],
            {}, {}, prunable=False),
    }
    rel = [
        Relationship("SHIPMENTS_TO_CUSTOMERS", "SHIPMENTS", "CUSTOMERS", "customer_id", "customer_id"),
        Relationship("SHIPMENTS_TO_CARRIERS", "SHIPMENTS", "CARRIERS", "carrier_id", "carrier_id"),
        Relationship("ORDERS_TO_CUSTOMERS", "ORDERS", "CUSTOMERS", "customer_id", "customer_id"),
        Relationship("POD_TO_CUSTOMERS", "POD_DOCUMENTS", "CUSTOMERS", "customer_id", "customer_id"),
        Relationship("POD_TO_CARRIERS", "POD_DOCUMENTS", "CARRIERS", "carrier_id", "carrier_id"),
        Relationship("CLAIMS_TO_CUSTOMERS", "CLAIMS", "CUSTOMERS", "customer_id", "customer_id"),
        Relationship("CLAIMS_TO_CARRIERS", "CLAIMS", "CARRIERS", "carrier_id", "carrier_id"),
    ]
    return Model(tables, rel).validate()
