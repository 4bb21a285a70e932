"""Fixed table schemas (FIXTURES.md part A), one StructType per table."""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DateType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType, TimestampNTZType,
                               VariantType)


def _s(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, D, F64, I, L, B, TS = (StringType(), DateType(), DoubleType(), IntegerType(), LongType(),
                          BooleanType(), TimestampNTZType())

DIM_CARRIERS = _s(("carrier_id", S), ("carrier_name", S), ("carrier_type", S),
                  ("service_region", S), ("on_time_rating", F64), ("active_flag", B))
DIM_CUSTOMERS = _s(("customer_id", S), ("customer_name", S), ("customer_segment", S),
                   ("city", S), ("state", S), ("country", S), ("contact_email", S),
                   ("created_at", TS))
FACT_SHIPMENTS = _s(("shipment_id", S), ("order_id", S), ("customer_id", S), ("carrier_id", S),
                    ("origin_city", S), ("destination_city", S), ("ship_date", D),
                    ("expected_delivery_date", D), ("actual_delivery_date", D), ("status", S),
                    ("weight_kg", F64), ("num_packages", I), ("freight_cost", F64),
                    ("is_on_time", B), ("created_at", TS))
FACT_ORDERS = _s(("order_id", S), ("customer_id", S), ("order_date", D), ("order_value", F64),
                 ("order_status", S), ("payment_method", S), ("num_items", I), ("created_at", TS))
POD_FACT = _s(("pod_id", S), ("shipment_id", S), ("order_id", S), ("customer_id", S),
              ("carrier_id", S), ("delivery_date", D), ("signed_by", S), ("receiver_name", S),
              ("delivery_address", S), ("delivery_city", S), ("delivery_state", S),
              ("pod_status", S), ("exception_flag", B), ("exception_notes", S),
              ("signature_present", B), ("damage_reported", B), ("damage_description", S),
              ("partial_delivery", B), ("packages_received", I), ("packages_expected", I),
              ("pod_file_name", S), ("pod_text_content", S), ("extraction_confidence", F64),
              ("processed_at", TS))
FACT_CLAIMS = _s(("claim_id", S), ("shipment_id", S), ("pod_id", S), ("customer_id", S),
                 ("carrier_id", S), ("claim_date", D), ("claim_type", S), ("claim_amount", F64),
                 ("claim_status", S), ("resolution_date", D), ("resolution_amount", F64),
                 ("description", S), ("created_at", TS))
POD_FILES = _s(("file_name", S), ("file_relative_path", S), ("file_type", S), ("file_size", L),
               ("load_ts", TS), ("processed", B))
POD_EXTRACTED = _s(("file_name", S), ("file_relative_path", S), ("raw_text", S),
                   ("page_count", I), ("extraction_mode", S), ("extracted_at", TS),
                   ("error_info", S))
POD_REVIEW_LOG = _s(("review_id", S), ("pod_id", S), ("file_name", S), ("review_status", S),
                    ("reviewer", S), ("review_timestamp", TS), ("ai_confidence", F64),
                    ("fields_modified", S), ("review_notes", S), ("raw_ai_output", VariantType()),
                    ("final_output", VariantType()))

ALL = {"dim_carriers": DIM_CARRIERS, "dim_customers": DIM_CUSTOMERS,
       "fact_shipments": FACT_SHIPMENTS, "fact_orders": FACT_ORDERS, "pod_fact": POD_FACT,
       "fact_claims": FACT_CLAIMS, "pod_files": POD_FILES, "pod_extracted": POD_EXTRACTED,
       "pod_review_log": POD_REVIEW_LOG}
