"""DuckDB oracle: the FIXTURES.md views as SQL text (independent of the Spark code).

These strings are the documented definitions of the test views; the oracle
queries are written over them and run by DuckDB on the same Parquet tables.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}


def pad(key: str, width: int) -> str:
    """A number with leading zeros up to ``width`` digits; longer ones stay whole."""
    text = f"CAST({key} AS STRING)"
    return f"(repeat('0', greatest(0, {width} - length({text}))::BIGINT) || {text})"

VIEWS["dim_carriers"] = f"""
SELECT 'CAR' || {pad('s_suppkey', 6)} AS carrier_id, s_name AS carrier_name,
  CASE s_suppkey % 4 WHEN 0 THEN 'Express' WHEN 1 THEN 'Standard' WHEN 2 THEN 'Economy' ELSE 'Freight' END AS carrier_type,
  r_name AS service_region, CAST(80 + s_suppkey % 20 AS DOUBLE) / 100 AS on_time_rating, s_suppkey % 10 <> 9 AS active_flag
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
WHERE s_suppkey % 25 <> 24
"""

VIEWS["dim_customers"] = f"""
SELECT 'CUST' || {pad('c_custkey', 8)} AS customer_id, c_name AS customer_name,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Enterprise' WHEN 'MACHINERY' THEN 'Enterprise' WHEN 'AUTOMOBILE' THEN 'Mid-Market' ELSE 'SMB' END AS customer_segment,
  n_name AS city, r_name AS state
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
"""

VIEWS["fact_orders"] = f"""
SELECT 'ORD' || {pad('o_orderkey', 8)} AS order_id, 'CUST' || {pad('o_custkey', 8)} AS customer_id,
  CAST(o_orderdate AS DATE) AS order_date, CAST(o_totalprice AS DECIMAL(18,2)) AS order_value,
  CASE WHEN o_orderstatus = 'F' THEN 'Fulfilled' WHEN o_orderstatus = 'O' THEN 'Processing' WHEN o_orderkey % 2 = 0 THEN 'Cancelled' ELSE 'Returned' END AS order_status,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Credit Card' WHEN o_orderpriority = '3-MEDIUM' THEN 'UPI' WHEN o_orderpriority = '5-LOW' THEN 'COD' ELSE 'Net Banking' END AS payment_method, CAST(1 + o_orderkey % 20 AS INTEGER) AS num_items
FROM orders
"""

VIEWS["line_keyed"] = f"""
SELECT l.*, o.o_custkey, CAST(o.o_orderdate AS DATE) AS o_date, n.n_name AS dest_city, r.r_name AS dest_state,
  {pad('l_orderkey', 8)} || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(CAST(l_quantity AS INT) AS STRING) || '-' || CAST(CAST(l_shipdate AS DATE) AS STRING) AS k
FROM lineitem l LEFT JOIN orders o ON l_orderkey = o_orderkey
LEFT JOIN customer c ON o_custkey = c_custkey LEFT JOIN nation n ON c_nationkey = n_nationkey LEFT JOIN region r ON n_regionkey = r_regionkey
"""

VIEWS["fact_shipments"] = f"""
SELECT 'SHP' || k AS shipment_id, 'ORD' || {pad('l_orderkey', 8)} AS order_id,
  'CUST' || {pad('o_custkey', 8)} AS customer_id, 'CAR' || {pad('l_suppkey', 6)} AS carrier_id,
  'City ' || CAST(l_suppkey % 25 AS STRING) AS origin_city, dest_city AS destination_city, o_date AS ship_date, CAST(o_date + INTERVAL 1000 DAY AS DATE) AS expected_delivery_date,
  CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS actual_delivery_date,
  CASE WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN 'Returned' WHEN l_linestatus = 'F' THEN 'Delivered' WHEN l_returnflag = 'R' THEN 'Exception' ELSE 'In Transit' END AS status,
  l_quantity AS weight_kg, l_linenumber AS num_packages, CAST(l_extendedprice AS DECIMAL(18,2)) AS freight_cost,
  l_discount < 0.085 AS is_on_time
FROM line_keyed
"""

VIEWS["pod_fact"] = f"""
SELECT 'POD' || k AS pod_id, 'SHP' || k AS shipment_id, 'ORD' || {pad('l_orderkey', 8)} AS order_id,
  CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE 'CUST' || {pad('o_custkey', 8)} END AS customer_id,
  'CAR' || {pad('l_suppkey', 6)} AS carrier_id,
  CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS delivery_date,
  'Signer ' || CAST(l_partkey % 10 AS STRING) AS signed_by, 'Receiver ' || CAST(l_partkey % 7 AS STRING) AS receiver_name,
  'Dock ' || CAST(l_linenumber AS STRING) || ', Gate ' || CAST(l_suppkey % 9 AS STRING) AS delivery_address, dest_city AS delivery_city, dest_state AS delivery_state,
  CASE WHEN l_returnflag = 'N' OR (l_returnflag = 'A' AND l_linenumber <= 5) THEN 'Delivered - Clean' WHEN l_returnflag = 'A' THEN 'Partial Delivery'
       WHEN l_linenumber <= 5 THEN 'Delivered - With Exceptions' WHEN l_linenumber = 6 THEN 'Refused' ELSE 'Undeliverable' END AS pod_status,
  l_returnflag = 'R' AS exception_flag,
  CASE WHEN l_returnflag = 'R' AND l_partkey % 3 <> 0 THEN 'Water damage observed on ' || CAST(l_linenumber AS STRING) || ' cartons' END AS exception_notes,
  l_tax < 0.075 AS signature_present, l_discount > 0.085 AS damage_reported,
  CASE WHEN l_discount > 0.085 AND l_partkey % 2 = 0 THEN 'Crushed box' END AS damage_description,
  l_linenumber = 7 AS partial_delivery, CAST(l_quantity AS INT) AS packages_received,
  CAST(l_quantity AS INT) + CASE WHEN l_linenumber = 7 THEN 2 ELSE 0 END AS packages_expected,
  'POD_' || k || '.pdf' AS pod_file_name
FROM line_keyed WHERE l_linestatus = 'F'
"""

VIEWS["fact_claims"] = f"""
SELECT 'CLM' || k AS claim_id, 'SHP' || k AS shipment_id, 'POD' || k AS pod_id, 'CUST' || {pad('o_custkey', 8)} AS customer_id,
  'CAR' || {pad('l_suppkey', 6)} AS carrier_id, CAST(l_shipdate AS DATE) AS claim_date,
  CASE l_linenumber WHEN 1 THEN 'Damage' WHEN 2 THEN 'Loss' WHEN 3 THEN 'Shortage' WHEN 4 THEN 'Late Delivery' WHEN 5 THEN 'Wrong Delivery' ELSE 'Missing Signature' END AS claim_type,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS claim_amount,
  CASE WHEN l_suppkey % 10 < 4 THEN 'Resolved' WHEN l_suppkey % 10 < 7 THEN 'Under Review' WHEN l_suppkey % 10 < 9 THEN 'Pending Documentation' ELSE 'Rejected' END AS claim_status,
  CASE WHEN l_suppkey % 10 < 4 THEN CAST(CAST(l_shipdate AS DATE) + INTERVAL 14 DAY AS DATE) END AS resolution_date,
  CASE WHEN l_suppkey % 10 < 4 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS resolution_amount
FROM line_keyed WHERE l_linestatus = 'F' AND l_returnflag = 'R' AND l_partkey % 5 = 0
"""

VIEWS["pod_extracted"] = f"""
SELECT pod_file_name AS file_name, pod_file_name AS file_relative_path,
  'PROOF OF DELIVERY' || CHR(10) || '---' || CHR(10) || 'POD Reference: ' || pod_id || CHR(10) || 'Shipment ID: ' || shipment_id || CHR(10) ||
  'Order ID: ' || order_id || CHR(10) || 'Customer ID: ' || COALESCE(customer_id, '') || CHR(10) || 'Carrier: ' || COALESCE(c.carrier_name, p.carrier_id) || CHR(10) ||
  'Delivery Date: ' || COALESCE(CAST(delivery_date AS STRING), 'not stated') || CHR(10) || 'Signed By: ' || signed_by || CHR(10) || 'Receiver: ' || receiver_name || CHR(10) || 'Address: ' || delivery_address || CHR(10) ||
  'City: ' || COALESCE(delivery_city, '') || CHR(10) || 'State: ' || COALESCE(delivery_state, '') || CHR(10) || 'Status: ' || pod_status || CHR(10) ||
  'Exceptions: ' || COALESCE(exception_notes, '') || CHR(10) ||
  'Signature: ' || CASE WHEN signature_present AND packages_received % 3 = 0 THEN 'TRUE' WHEN signature_present AND packages_received % 3 = 1 THEN 'Yes, signed' WHEN signature_present THEN 'yes' ELSE 'No' END || CHR(10) ||
  'Damage: ' || COALESCE(damage_description, '') || CHR(10) || 'Partial: ' || CASE WHEN partial_delivery THEN 'Yes' ELSE 'No' END || CHR(10) ||
  'Packages: ' || CASE WHEN packages_received = 13 THEN 'many' ELSE CAST(packages_received AS STRING) END || ' received' || CHR(10) ||
  'Expected: ' || CAST(packages_expected AS STRING) AS raw_text,
  1 + packages_received % 3 AS page_count, 'LAYOUT' AS extraction_mode, CAST(NULL AS STRING) AS error_info
FROM pod_fact p LEFT JOIN dim_carriers c ON p.carrier_id = c.carrier_id
"""

VIEWS["review_decisions"] = f"""
SELECT d.doc_id, 'doc_' || CAST(d.doc_id AS STRING) || '.txt' AS file_name,
  CASE WHEN l.toxic = 1 THEN 'REJECTED' WHEN l.quality = 1 THEN 'APPROVED' ELSE 'FLAGGED' END AS review_status,
  d.lang AS ai_lang, CASE WHEN l.quality = 1 AND d.doc_id % 4 = 0 THEN UPPER(d.lang) ELSE d.lang END AS final_lang,
  d.source AS ai_source, CASE WHEN d.doc_id % 10 = 0 THEN ' ' || d.source || ' ' ELSE d.source END AS final_source,
  CASE WHEN d.doc_id % 6 = 0 THEN NULL ELSE 'n/a' END AS ai_notes, CASE WHEN d.doc_id % 6 = 0 THEN '' ELSE 'n/a' END AS final_notes
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""


ORDER = list(VIEWS)


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with a WITH clause holding every view it (transitively) uses."""
    defs = dict(VIEWS)
    order = list(ORDER)
    for k, v in (extra or {}).items():
        defs[k] = v
        order.append(k)
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in order:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(defs[name])

    visit(body)
    ctes = [f"{n} AS (\n{defs[n].strip()}\n)" for n in order if n in needed]
    if not ctes:
        return body
    return "WITH " + ",\n".join(ctes) + "\n" + body
