"""Document processing: parse, flatten, extract, type, clip, report.

The hosted parser and extractor of the reference are re-aimed as native column
expressions: HTML/text -> plain text through a regex chain (DOC1), labelled
fields through one ``regexp_extract`` per field inside a single projection
(DOC3). Every step is a narrow transformation: no shuffle, one stage, and the
work is spread over however many Parquet splits the input has. Hooks for a
binary-format parser or a model-based extractor are Arrow-batched
``mapInPandas`` functions supplied by the caller (off by default).
"""

from __future__ import annotations

from decimal import Decimal
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import non_empty, pct, try_date, try_int, yes_no_prefix
from ..functions.text import (extract_label, label_pattern, label_pattern_jvm, page_count,
                              spaced_text, without_tags)

MAX_FACT_TEXT = 16000
CONFIDENCE = Decimal("0.85")

# The 18 extraction keys of the pipeline, in order.
EXTRACTION_KEYS = [
    "pod_reference", "shipment_id", "order_id", "customer_id", "carrier_name", "delivery_date",
    "signed_by", "receiver_name", "delivery_address", "delivery_city", "delivery_state",
    "delivery_status", "exception_notes", "signature_present", "damage_description",
    "partial_delivery", "packages_received", "packages_expected",
]

# The printed label of each field on a POD document.
POD_LABELS = {
    "pod_reference": "POD Reference", "shipment_id": "Shipment ID", "order_id": "Order ID",
    "customer_id": "Customer ID", "carrier_name": "Carrier", "delivery_date": "Delivery Date",
    "signed_by": "Signed By", "receiver_name": "Receiver", "delivery_address": "Address",
    "delivery_city": "City", "delivery_state": "State", "delivery_status": "Status",
    "exception_notes": "Exceptions", "signature_present": "Signature",
    "damage_description": "Damage", "partial_delivery": "Partial",
    "packages_received": "Packages", "packages_expected": "Expected",
}


def label_spec() -> dict[str, tuple[str, str]]:
    """Field -> (label, value regex with group 1). 'Packages: 13 received' keeps
    the first word."""
    spec = {k: (POD_LABELS[k], r"(.*)") for k in EXTRACTION_KEYS}
    spec["packages_received"] = ("Packages", r"(\S*).*")
    return spec


def default_spec() -> dict[str, str]:
    """Field -> portable regex (group 1 = value), the spec in its RE2/Java form."""
    return {k: label_pattern(lab, val) for k, (lab, val) in label_spec().items()}


# --- DOC1 / DOC2 ------------------------------------------------------------------

def parse_documents(df: DataFrame, content: str, mode: str = "LAYOUT") -> DataFrame:
    """DOC1: add ``parsed`` = {content, metadata{pageCount}, errorInformation}.

    Empty or NULL input becomes an error row, never a failed job. The text is made in
    columns of its own, half by half: an expression that is read in several places would
    be evaluated in each of them.
    """
    raw, text = F.col(content), F.col("__text")
    df = df.withColumn("__bare", without_tags(raw, mode)).withColumn("__text", spaced_text(F.col("__bare"), mode))
    empty_in = raw.isNull() | (F.trim(raw) == "")
    err = (F.when(empty_in, F.lit("Empty document"))
           .when(text == "", F.lit("No text content")))
    return df.withColumn("parsed", F.struct(
        F.when(err.isNull(), text).alias("content"),
        F.struct(F.when(err.isNull(), page_count(raw)).alias("pageCount")).alias("metadata"),
        err.alias("errorInformation"))).drop("__bare", "__text")


def flatten_parsed(df: DataFrame, mode: str = "LAYOUT") -> DataFrame:
    """DOC2: payload -> raw_text, page_count, extraction_mode, error_info."""
    return (df.withColumn("raw_text", F.col("parsed.content"))
            .withColumn("page_count", F.col("parsed.metadata.pageCount"))
            .withColumn("extraction_mode", F.lit(mode))
            .withColumn("error_info", F.col("parsed.errorInformation"))
            .drop("parsed"))


def parse_with(df: DataFrame, parser: Callable, schema) -> DataFrame:
    """Hook for binary formats: ``parser(iterator of pandas frames)`` via mapInPandas."""
    return df.mapInPandas(parser, schema)


def route_errors(df: DataFrame, on_error: str = "quarantine") -> DataFrame:
    """DOC5: 'keep' passes error rows on (the reference's task 2, T9); 'drop'
    removes them; 'quarantine' keeps all rows and tags each with its route so a
    job can write the two sides to two sinks."""
    if on_error == "keep":
        return df
    if on_error == "drop":
        return df.where(F.col("error_info").isNull())
    if on_error == "quarantine":
        return df.withColumn("route", F.when(F.col("error_info").isNull(), "ok")
                             .otherwise("quarantine"))
    raise ValueError(on_error)


def parse_report(extracted: DataFrame) -> DataFrame:
    """DOC10: documents, pages, characters and errors per extraction mode."""
    return (extracted.groupBy("extraction_mode")
            .agg(F.count(F.lit(1)).alias("documents"),
                 F.coalesce(F.sum("page_count"), F.lit(0)).cast("long").alias("pages"),
                 F.coalesce(F.sum(F.length("raw_text")), F.lit(0)).cast("long").alias("characters"),
                 F.count_if(F.col("error_info").isNotNull()).alias("errors")))


# --- DOC3 / DOC4 ------------------------------------------------------------------

def extract_fields(df: DataFrame, text: str, spec: dict[str, str] | None = None,
                   prefix: str = "") -> DataFrame:
    """DOC3: one nullable string column per field, all in one projection.

    ``spec`` maps field -> regex (group 1 = value). Without one, the labelled
    POD fields are read with the newline-anchored Java form of the label
    patterns over ``"\n" + text`` (same matches as ``default_spec``)."""
    if spec is None:
        t = F.concat(F.lit("\n"), F.col(text))
        cols = [extract_label(t, label_pattern_jvm(lab, val)).alias(prefix + k)
                for k, (lab, val) in label_spec().items()]
    else:
        t = F.col(text)
        cols = [extract_label(t, p).alias(prefix + k) for k, p in spec.items()]
    return df.select("*", *cols)


def to_pod_fact(df: DataFrame, text: str = "raw_text", file_name: str = "file_name") -> DataFrame:
    """DOC4: the 18 strings -> typed POD_FACT columns (pipeline rules). The text
    is kept whole; ``text_chunks`` cuts it for sinks with a length limit."""
    c = F.col
    return df.select(
        c("pod_reference").alias("pod_id"), c("shipment_id"), c("order_id"), c("customer_id"),
        c("carrier_name").alias("carrier_id"),  # the pipeline stores the name here (T6)
        try_date("delivery_date").alias("delivery_date"),
        c("signed_by"), c("receiver_name"), c("delivery_address"), c("delivery_city"),
        c("delivery_state"), c("delivery_status").alias("pod_status"),
        non_empty("exception_notes").alias("exception_flag"), c("exception_notes"),
        yes_no_prefix("signature_present").alias("signature_present"),
        non_empty("damage_description").alias("damage_reported"), c("damage_description"),
        yes_no_prefix("partial_delivery").alias("partial_delivery"),
        try_int("packages_received").alias("packages_received"),
        try_int("packages_expected").alias("packages_expected"),
        c(file_name).alias("pod_file_name"),
        c(text).alias("pod_text_content"),
        F.lit(CONFIDENCE).cast("double").alias("extraction_confidence"),
    )


def text_chunks(df: DataFrame, col: str, n: int = MAX_FACT_TEXT) -> DataFrame:
    """DOC9 (T8): a text as ordered chunks of at most ``n`` characters, for a sink
    that holds no longer ones. Nothing is cut off: the chunks of a row, in order,
    are its text. Adds {col}_chars (of the whole), {col}_chunks and chunk_no
    (from 0); a NULL or empty text is one chunk."""
    length = F.coalesce(F.length(col), F.lit(0))
    chunks = F.greatest(F.lit(1), F.ceil(length / n)).cast("int")
    return (df.withColumns({f"{col}_chars": F.length(col).cast("long"), f"{col}_chunks": chunks})
            .withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.col(f"{col}_chunks") - 1)))
            .withColumn(col, F.col(col).substr(F.col("chunk_no") * n + 1, F.lit(n))))


# --- DOC6 -------------------------------------------------------------------------

def pod_text(carrier_name: Column | None = None) -> Column:
    """DOC6: the labelled POD text printed from fact columns (inverse of DOC3)."""
    c = F.col
    car = F.coalesce(carrier_name, c("carrier_id")) if carrier_name is not None else c("carrier_id")
    rec = c("packages_received")
    sig = (F.when(c("signature_present") & (rec % 3 == 0), "TRUE")
           .when(c("signature_present") & (rec % 3 == 1), "Yes, signed")
           .when(c("signature_present"), "yes").otherwise("No"))
    lines = [
        F.lit("PROOF OF DELIVERY"), F.lit("---"),
        F.concat(F.lit("POD Reference: "), c("pod_id")),
        F.concat(F.lit("Shipment ID: "), c("shipment_id")),
        F.concat(F.lit("Order ID: "), c("order_id")),
        F.concat(F.lit("Customer ID: "), F.coalesce(c("customer_id"), F.lit(""))),
        F.concat(F.lit("Carrier: "), car),
        F.concat(F.lit("Delivery Date: "),
                 F.coalesce(c("delivery_date").cast("string"), F.lit("not stated"))),
        F.concat(F.lit("Signed By: "), c("signed_by")),
        F.concat(F.lit("Receiver: "), c("receiver_name")),
        F.concat(F.lit("Address: "), c("delivery_address")),
        F.concat(F.lit("City: "), F.coalesce(c("delivery_city"), F.lit(""))),
        F.concat(F.lit("State: "), F.coalesce(c("delivery_state"), F.lit(""))),
        F.concat(F.lit("Status: "), c("pod_status")),
        F.concat(F.lit("Exceptions: "), F.coalesce(c("exception_notes"), F.lit(""))),
        F.concat(F.lit("Signature: "), sig),
        F.concat(F.lit("Damage: "), F.coalesce(c("damage_description"), F.lit(""))),
        F.concat(F.lit("Partial: "), F.when(c("partial_delivery"), "Yes").otherwise("No")),
        F.concat(F.lit("Packages: "), F.when(rec == 13, "many").otherwise(rec.cast("string")),
                 F.lit(" received")),
        F.concat(F.lit("Expected: "), c("packages_expected").cast("string")),
    ]
    # concat (not concat_ws): a NULL line makes the whole text NULL, as in SQL '||'.
    out = lines[0]
    for ln in lines[1:]:
        out = F.concat(out, F.lit("\n"), ln)
    return out


POD_TEXT_INPUTS = ["pod_id", "shipment_id", "order_id", "customer_id", "carrier_id",
                   "delivery_date", "signed_by", "receiver_name", "delivery_address", "delivery_city",
                   "delivery_state", "pod_status", "exception_notes", "signature_present", "damage_description",
                   "partial_delivery", "packages_received", "packages_expected", "pod_file_name"]


def render_pod_text(pod: DataFrame, carriers: DataFrame) -> DataFrame:
    """DOC6 as a table: POD_EXTRACTED-shaped rows printed from POD_FACT."""
    j = pod.join(carriers.select("carrier_id", "carrier_name"), "carrier_id", "left")
    return j.select(
        F.col("pod_file_name").alias("file_name"),
        F.col("pod_file_name").alias("file_relative_path"),
        pod_text(F.col("carrier_name")).alias("raw_text"),
        (F.lit(1) + F.col("packages_received") % 3).cast("int").alias("page_count"),
        F.lit("LAYOUT").alias("extraction_mode"),
        F.lit(None).cast("string").alias("error_info"))


# --- DOC7 / DOC8 ------------------------------------------------------------------

def resolve_carrier(pods: DataFrame, carriers: DataFrame, raw: str = "carrier_id") -> DataFrame:
    """DOC7: repair T6. Match the extracted carrier text as an id first, else as
    a normalised name. Names that belong to more than one carrier are not used
    (no fan-out); such rows stay unresolved."""
    by_id = carriers.select(F.col("carrier_id").alias("__id"))
    by_name = (carriers.select(F.lower(F.trim("carrier_name")).alias("__norm"), "carrier_id")
               .groupBy("__norm").agg(F.min("carrier_id").alias("__name_id"),
                                      F.count(F.lit(1)).alias("__n"))
               .where(F.col("__n") == 1).drop("__n"))
    p = pods.withColumn("__norm", F.lower(F.trim(F.col(raw))))
    j = (p.join(by_id, p[raw] == by_id["__id"], "left")
         .join(by_name, "__norm", "left"))
    return (j.withColumn("resolved_carrier_id", F.coalesce("__id", "__name_id"))
            .withColumn("carrier_match", F.when(F.col("__id").isNotNull(), "id")
                        .when(F.col("__name_id").isNotNull(), "name").otherwise("none"))
            .drop("__id", "__name_id", "__norm"))


def extraction_quality(extracted: DataFrame, truth: DataFrame, key: str,
                       fields: list[str]) -> DataFrame:
    """DOC8: per field rows, matches, accuracy % and null rate of the extraction.

    One join on the key and one global aggregate with two counters per field; the
    single row of totals is then turned into one row per field.
    """
    e = extracted.select(key, *[F.col(f).cast("string").alias(f"e__{f}") for f in fields if f != key],
                         *([F.col(key).alias(f"e__{key}")] if key in fields else []))
    t = truth.select(key, *[F.col(f).cast("string").alias(f"t__{f}") for f in fields if f != key],
                     *([F.col(key).alias(f"t__{key}")] if key in fields else []))
    totals = t.join(e, key, "left").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(f"e__{f}").eqNullSafe(F.col(f"t__{f}"))).alias(f"m__{f}") for f in fields],
        *[F.count_if(F.col(f"e__{f}").isNull()).alias(f"n__{f}") for f in fields])
    per_field = F.array(*[F.struct(F.lit(f).alias("field"), F.col("rows"), F.col(f"m__{f}").alias("matches"),
                                   F.col(f"n__{f}").alias("nulls")) for f in fields])
    rows = totals.select(F.explode(per_field).alias("r")).select("r.*")
    return rows.select("field", "rows", "matches", pct(F.col("matches"), F.col("rows"), 2).alias("accuracy_pct"),
                       pct(F.col("nulls"), F.col("rows"), 2).alias("null_pct"))
