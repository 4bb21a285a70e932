"""The logistics star schema derived from the driver tables (FIXTURES.md part B).

Every view is a lazy DataFrame. The fact builders take the list of columns a
query needs and only add the joins those columns require: a global POD KPI
reads three lineitem columns and never touches ``orders`` or ``customer``,
while a per-customer KPI adds the ``orders`` join and a per-city one the
customer -> nation -> region chain. At 100 TB that is the difference between a
single map-side aggregation and two full shuffles of the largest table.

Join order for the geo chain: orders is joined to customer first (shuffle of
orders by custkey), then the result to lineitem by orderkey. Both big joins are
shuffle joins chosen by Catalyst; AQE may turn one into a broadcast join only
after measuring the real size. ``nation`` and ``region`` have 25 and 5 rows at
every scale (fixed by the TPC-H schema), so they are broadcast explicitly.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import padded, padded_id
from .tables import Tables

NL = "\n"


def geo(t: Tables) -> DataFrame:
    """nation LEFT JOIN region -> (n_nationkey, n_name, r_name). 25 rows, fixed."""
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    return (n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left")
            .select("n_nationkey", "n_name", "r_name"))


def dim_carriers(t: Tables) -> DataFrame:
    s = t.supplier.where((F.col("s_suppkey") % 25) != 24)
    g = geo(t)
    k = F.col("s_suppkey")
    return (s.join(F.broadcast(g), s.s_nationkey == g.n_nationkey, "left")
            .select(
                padded_id("CAR", k, 6).alias("carrier_id"),
                F.col("s_name").alias("carrier_name"),
                F.when(k % 4 == 0, "Express").when(k % 4 == 1, "Standard")
                 .when(k % 4 == 2, "Economy").otherwise("Freight").alias("carrier_type"),
                F.col("r_name").alias("service_region"),
                ((F.lit(80) + k % 20).cast("double") / 100).alias("on_time_rating"),
                ((k % 10) != 9).alias("active_flag"),
            ))


def dim_customers(t: Tables) -> DataFrame:
    c = t.customer
    g = geo(t)
    seg = F.col("c_mktsegment")
    return (c.join(F.broadcast(g), c.c_nationkey == g.n_nationkey, "left")
            .select(
                padded_id("CUST", "c_custkey", 8).alias("customer_id"),
                F.col("c_name").alias("customer_name"),
                F.when(seg.isin("BUILDING", "MACHINERY"), "Enterprise")
                 .when(seg == "AUTOMOBILE", "Mid-Market").otherwise("SMB").alias("customer_segment"),
                F.col("n_name").alias("city"),
                F.col("r_name").alias("state"),
            ))


def fact_orders(t: Tables) -> DataFrame:
    o = t.orders
    st, pr, key = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderkey")
    return o.select(
        padded_id("ORD", "o_orderkey", 8).alias("order_id"),
        padded_id("CUST", "o_custkey", 8).alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("order_value"),
        F.when(st == "F", "Fulfilled").when(st == "O", "Processing")
         .when(key % 2 == 0, "Cancelled").otherwise("Returned").alias("order_status"),
        F.when(pr.isin("1-URGENT", "2-HIGH"), "Credit Card").when(pr == "3-MEDIUM", "UPI")
         .when(pr == "5-LOW", "COD").otherwise("Net Banking").alias("payment_method"),
        (F.lit(1) + key % 20).cast("int").alias("num_items"),
    )


# --- line_keyed ------------------------------------------------------------------

def _line_key() -> Column:
    s = lambda c: F.col(c).cast("string")
    return F.concat(
        padded("l_orderkey", 8), F.lit("-"), s("l_partkey"), F.lit("-"),
        s("l_suppkey"), F.lit("-"), s("l_linenumber"), F.lit("-"),
        F.col("l_quantity").cast("int").cast("string"), F.lit("-"),
        F.col("l_shipdate").cast("date").cast("string"))


def line_keyed(t: Tables, need_order: bool = False, need_geo: bool = False,
               where: Column | None = None, lineitem: DataFrame | None = None) -> DataFrame:
    """lineitem (+ o_custkey, o_date) (+ dest_city, dest_state) with the long key ``k``.

    ``where`` is applied to lineitem before any join so the filter reaches the
    Parquet scan and shrinks both shuffles. ``lineitem`` may be a streaming
    DataFrame: the joins are then stream-static left joins.
    """
    li = t.lineitem if lineitem is None else lineitem
    if where is not None:
        li = li.where(where)
    li = li.withColumn("k", _line_key())
    if not (need_order or need_geo):
        return li
    o = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_date"))
    if need_geo:
        g = geo(t)
        c = (t.customer.select("c_custkey", "c_nationkey")
             .join(F.broadcast(g), F.col("c_nationkey") == g.n_nationkey, "left")
             .select("c_custkey", F.col("n_name").alias("dest_city"), F.col("r_name").alias("dest_state")))
        o = o.join(c, o.o_custkey == c.c_custkey, "left").drop("c_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey, "left").drop("o_orderkey")


ORDER_COLS = {"o_custkey", "o_date"}
GEO_COLS = {"dest_city", "dest_state"}


def _build(t: Tables, exprs: dict[str, tuple[Column, set[str]]], columns, where,
           lineitem: DataFrame | None = None) -> DataFrame:
    names = list(exprs) if columns is None else list(columns)
    unknown = [c for c in names if c not in exprs]
    if unknown:
        raise KeyError(f"unknown columns {unknown}")
    deps = set().union(*(exprs[c][1] for c in names)) if names else set()
    base = line_keyed(t, need_order=bool(deps & ORDER_COLS), need_geo=bool(deps & GEO_COLS),
                      where=where, lineitem=lineitem)
    return base.select(*[exprs[c][0].alias(c) for c in names])


def _key(prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.col("k"))


def _order_id() -> Column:
    return padded_id("ORD", "l_orderkey", 8)


def _cust_id() -> Column:
    return padded_id("CUST", "o_custkey", 8)


def _car_id() -> Column:
    return padded_id("CAR", "l_suppkey", 6)


def shipment_exprs() -> dict[str, tuple[Column, set[str]]]:
    ls, rf = F.col("l_linestatus"), F.col("l_returnflag")
    return {
        "shipment_id": (_key("SHP"), set()),
        "order_id": (_order_id(), set()),
        "customer_id": (_cust_id(), {"o_custkey"}),
        "carrier_id": (_car_id(), set()),
        "origin_city": (F.concat(F.lit("City "), (F.col("l_suppkey") % 25).cast("string")), set()),
        "destination_city": (F.col("dest_city"), {"dest_city"}),
        "ship_date": (F.col("o_date"), {"o_date"}),
        "expected_delivery_date": (F.date_add("o_date", 1000), {"o_date"}),
        "actual_delivery_date": (F.when(ls == "F", F.col("l_shipdate").cast("date")), set()),
        "status": (F.when((ls == "F") & (rf == "R"), "Returned").when(ls == "F", "Delivered")
                   .when(rf == "R", "Exception").otherwise("In Transit"), set()),
        "weight_kg": (F.col("l_quantity"), set()),
        "num_packages": (F.col("l_linenumber"), set()),
        "freight_cost": (F.col("l_extendedprice").cast("decimal(18,2)"), set()),
        "is_on_time": (F.col("l_discount") < 0.085, set()),
    }


def fact_shipments(t: Tables, columns=None) -> DataFrame:
    return _build(t, shipment_exprs(), columns, None)


def pod_exprs() -> dict[str, tuple[Column, set[str]]]:
    rf, ln, pk = F.col("l_returnflag"), F.col("l_linenumber"), F.col("l_partkey")
    disc = F.col("l_discount")
    qty = F.col("l_quantity").cast("int")
    return {
        "pod_id": (_key("POD"), set()),
        "shipment_id": (_key("SHP"), set()),
        "order_id": (_order_id(), set()),
        "customer_id": (F.when(pk % 50 == 0, F.lit(None).cast("string")).otherwise(_cust_id()),
                        {"o_custkey"}),
        "carrier_id": (_car_id(), set()),
        "delivery_date": (F.when(pk % 97 == 0, F.lit(None).cast("date"))
                          .otherwise(F.col("l_shipdate").cast("date")), set()),
        "signed_by": (F.concat(F.lit("Signer "), (pk % 10).cast("string")), set()),
        "receiver_name": (F.concat(F.lit("Receiver "), (pk % 7).cast("string")), set()),
        "delivery_address": (F.concat(F.lit("Dock "), ln.cast("string"), F.lit(", Gate "),
                                      (F.col("l_suppkey") % 9).cast("string")), set()),
        "delivery_city": (F.col("dest_city"), {"dest_city"}),
        "delivery_state": (F.col("dest_state"), {"dest_state"}),
        "pod_status": (F.when((rf == "N") | ((rf == "A") & (ln <= 5)), "Delivered - Clean")
                       .when(rf == "A", "Partial Delivery")
                       .when(ln <= 5, "Delivered - With Exceptions")
                       .when(ln == 6, "Refused").otherwise("Undeliverable"), set()),
        "exception_flag": (rf == "R", set()),
        "exception_notes": (F.when((rf == "R") & (pk % 3 != 0),
                                   F.concat(F.lit("Water damage observed on "), ln.cast("string"),
                                            F.lit(" cartons"))), set()),
        "signature_present": (F.col("l_tax") < 0.075, set()),
        "damage_reported": (disc > 0.085, set()),
        "damage_description": (F.when((disc > 0.085) & (pk % 2 == 0), F.lit("Crushed box")), set()),
        "partial_delivery": (ln == 7, set()),
        "packages_received": (qty, set()),
        "packages_expected": (qty + F.when(ln == 7, 2).otherwise(0), set()),
        "pod_file_name": (F.concat(F.lit("POD_"), F.col("k"), F.lit(".pdf")), set()),
    }


POD_COLUMNS = ["pod_id", "shipment_id", "order_id", "customer_id", "carrier_id", "delivery_date",
               "signed_by", "receiver_name", "delivery_address", "delivery_city", "delivery_state",
               "pod_status", "exception_flag", "exception_notes", "signature_present", "damage_reported", "damage_description",
               "partial_delivery", "packages_received", "packages_expected", "pod_file_name"]


def pod_fact(t: Tables, columns=None, lineitem: DataFrame | None = None,
             where: Column | None = None) -> DataFrame:
    """POD_FACT rows: delivered lines only; that filter and ``where`` (on raw
    lineitem columns) are pushed to the scan."""
    delivered = F.col("l_linestatus") == "F"
    return _build(t, pod_exprs(), columns, delivered if where is None else delivered & where, lineitem)


def line_of(key_id: str) -> Column:
    """The raw lineitem columns that a printed id such as a shipment id names, as
    a filter that reaches the scan; no row for a text that is no such id."""
    m = re.fullmatch(r"[A-Z]{3}([0-9]+)-([0-9]+)-([0-9]+)-([0-9]+)-([0-9]+)-([0-9]{4}-[0-9]{2}-[0-9]{2})", key_id)
    if not m:
        return F.lit(False)
    order, part, supplier, line, quantity, day = m.groups()
    return ((F.col("l_orderkey") == int(order)) & (F.col("l_partkey") == int(part))
            & (F.col("l_suppkey") == int(supplier)) & (F.col("l_linenumber") == int(line))
            & (F.col("l_quantity") >= int(quantity)) & (F.col("l_quantity") < int(quantity) + 1)
            & (F.col("l_shipdate").cast("date") == F.lit(day).cast("date")))


def lines_of_customer(t: Tables, customer_name: str) -> DataFrame:
    """Lineitem rows of one customer: customer, then its orders, then their lines."""
    mine = t.customer.where(F.col("c_name") == customer_name).select("c_custkey")
    orders = t.orders.join(mine, t.orders["o_custkey"] == mine["c_custkey"], "left_semi").select("o_orderkey")
    return t.lineitem.join(orders, t.lineitem["l_orderkey"] == orders["o_orderkey"], "left_semi")


def claim_exprs() -> dict[str, tuple[Column, set[str]]]:
    ln, sk = F.col("l_linenumber"), F.col("l_suppkey")
    ship = F.col("l_shipdate").cast("date")
    resolved = (sk % 10) < 4
    return {
        "claim_id": (_key("CLM"), set()),
        "shipment_id": (_key("SHP"), set()),
        "pod_id": (_key("POD"), set()),
        "customer_id": (_cust_id(), {"o_custkey"}),
        "carrier_id": (_car_id(), set()),
        "claim_date": (ship, set()),
        "claim_type": (F.when(ln == 1, "Damage").when(ln == 2, "Loss").when(ln == 3, "Shortage")
                       .when(ln == 4, "Late Delivery").when(ln == 5, "Wrong Delivery")
                       .otherwise("Missing Signature"), set()),
        "claim_amount": (F.col("l_extendedprice").cast("decimal(18,2)"), set()),
        "claim_status": (F.when(resolved, "Resolved").when((sk % 10) < 7, "Under Review")
                         .when((sk % 10) < 9, "Pending Documentation").otherwise("Rejected"), set()),
        "resolution_date": (F.when(resolved, F.date_add(ship, 14)), set()),
        "resolution_amount": (F.when(resolved, F.col("l_extendedprice").cast("decimal(18,2)")), set()),
    }


def fact_claims(t: Tables, columns=None) -> DataFrame:
    cond = ((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "R")
            & (F.col("l_partkey") % 5 == 0))
    return _build(t, claim_exprs(), columns, cond)


def review_decisions(t: Tables) -> DataFrame:
    """Human decisions over documents: labels say approve / reject / flag."""
    d = t.documents.select("doc_id", "lang", "source")
    lab = t.labels.select("doc_id", "quality", "toxic")
    j = d.join(lab, "doc_id")
    did = F.col("doc_id")
    return j.select(
        did,
        F.concat(F.lit("doc_"), did.cast("string"), F.lit(".txt")).alias("file_name"),
        F.when(F.col("toxic") == 1, "REJECTED").when(F.col("quality") == 1, "APPROVED")
         .otherwise("FLAGGED").alias("review_status"),
        F.col("lang").alias("ai_lang"),
        F.when((F.col("quality") == 1) & (did % 4 == 0), F.upper("lang")).otherwise(F.col("lang"))
         .alias("final_lang"),
        F.col("source").alias("ai_source"),
        F.when(did % 10 == 0, F.concat(F.lit(" "), F.col("source"), F.lit(" ")))
         .otherwise(F.col("source")).alias("final_source"),
        F.when(did % 6 == 0, F.lit(None).cast("string")).otherwise(F.lit("n/a")).alias("ai_notes"),
        F.when(did % 6 == 0, F.lit("")).otherwise(F.lit("n/a")).alias("final_notes"),
    )
