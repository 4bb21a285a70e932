"""Human review workflow as table operations.

A review batch is a DataFrame of (AI output, reviewer decision) rows. Every
step is a projection or filter over it -- no joins, no shuffles -- so a batch of
any size is processed in one stage.
"""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import pick, yes_no_exact

# The delivery status options of the review form, in order.
STATUS_OPTIONS = ["Delivered - Clean", "Delivered - With Exceptions", "Partial Delivery",
                  "Refused", "Undeliverable"]
CONFIDENCE = Decimal("0.85")


def prefill(ai: DataFrame) -> DataFrame:
    """RV1: AI fields -> review-form defaults (T14, T16)."""
    st = F.col("delivery_status")
    return ai.withColumns({
        "status_defaulted": ~F.coalesce(st.isin(*STATUS_OPTIONS), F.lit(False)),
        "form_status": pick(STATUS_OPTIONS, STATUS_OPTIONS[0], st),
        "form_signature": F.when(yes_no_exact("signature_present"), "Yes").otherwise("No"),
        "form_partial": F.when(yes_no_exact("partial_delivery"), "Yes").otherwise("No"),
        "form_exception_notes": F.coalesce(F.col("exception_notes"), F.lit("")),
        "form_damage_description": F.coalesce(F.col("damage_description"), F.lit("")),
    })


def decide(df: DataFrame, action: str = "action") -> DataFrame:
    """RV2: approve/reject/other -> APPROVED/REJECTED/FLAGGED; blank reviewer refused."""
    a = F.lower(F.col(action))
    return (df.where(F.trim(F.coalesce(F.col("reviewer"), F.lit(""))) != "")
            .withColumn("review_status", F.when(a == "approve", "APPROVED")
                        .when(a == "reject", "REJECTED").otherwise("FLAGGED")))


def _norm(c: Column, faithful: bool) -> Column:
    # faithful=True compares Python str() of values: NULL prints as 'None' (T12).
    return F.trim(F.coalesce(c, F.lit("None" if faithful else "")))


def modified_fields(fields: list[str], ai_prefix: str = "ai_", final_prefix: str = "final_",
                    faithful: bool = False) -> Column:
    """RV3: names of fields whose trimmed text differs, in field order, ', '-joined."""
    return F.concat_ws(", ", *[
        F.when(_norm(F.col(final_prefix + f), False) != _norm(F.col(ai_prefix + f), faithful),
               F.lit(f)) for f in fields])


def payload(fields: list[str], prefix: str, variant: bool = False) -> Column:
    """JSN3: the field bag as a JSON object text, NULLs kept as null; or as a VARIANT
    object at once, without printing and parsing that text."""
    bag = F.struct(*[F.col(prefix + f).alias(f) for f in fields])
    return F.to_variant_object(bag) if variant else F.to_json(bag, {"ignoreNullFields": "false"})


def audit_rows(df: DataFrame, fields: list[str], id_col: str, file_col: str,
               reviewer: str, reviewed_at: datetime | str, notes: str = "",
               faithful: bool = False, variant: bool = False) -> DataFrame:
    """RV4: POD_REVIEW_LOG rows, payloads as JSON text or VARIANT. One timestamp per batch (the table default of
    an INSERT); the id adds the whole digest of the file name,
    so that ids of different files differ at any size (T11)."""
    if isinstance(reviewed_at, datetime):
        reviewed_at = reviewed_at.strftime("%Y-%m-%d %H:%M:%S")
    ts = F.lit(reviewed_at).cast("timestamp_ntz")
    rid = F.concat(F.lit("REV-"), F.date_format(ts, "yyyyMMddHHmmss"), F.lit("-"),
                   F.md5(F.col(file_col)))
    return df.select(
        rid.alias("review_id"), F.col(id_col).cast("string").alias("pod_id"),
        F.col(file_col).alias("file_name"), "review_status", F.lit(reviewer).alias("reviewer"),
        ts.alias("review_timestamp"), F.lit(CONFIDENCE).cast("double").alias("ai_confidence"),
        modified_fields(fields, faithful=faithful).alias("fields_modified"),
        F.lit(notes).alias("review_notes"),
        payload(fields, "ai_", variant).alias("raw_ai_output"),
        payload(fields, "final_", variant).alias("final_output"))


def approved_to_fact(df: DataFrame, fields: list[str], id_col: str, file_col: str,
                     notes_field: str = "notes") -> DataFrame:
    """RV5: only APPROVED rows become fact rows; the notes flag is taken from the
    trimmed text (T15), values are stored as entered."""
    a = df.where(F.col("review_status") == "APPROVED")
    return a.select(
        F.col(id_col), F.col(file_col).alias("file_name"),
        *[F.col("final_" + f).alias(f) for f in fields],
        (F.trim(F.coalesce(F.col("final_" + notes_field), F.lit(""))) != "").alias("has_notes"),
        F.lit(CONFIDENCE).cast("double").alias("extraction_confidence"))


def to_variant(df: DataFrame, cols: list[str]) -> DataFrame:
    """SNK4: JSON payload text -> VARIANT columns for storage; what is VARIANT stays."""
    types = dict(df.dtypes)
    return df.withColumns({c: F.try_parse_json(F.col(c)) for c in cols if types[c] != "variant"})


def append_log(log: DataFrame, path: str) -> None:
    """SNK4: audit rows appended to the log table, payloads as VARIANT."""
    to_variant(log, ["raw_ai_output", "final_output"]).write.mode("append").parquet(path)


def pod_decisions(extracted: DataFrame, fields: list[str], reviewer: str) -> DataFrame:
    """RV1 + RV2 for extracted PODs: the form's defaults are the final values, and
    the batch rule approves clean or excepted deliveries with a signature, rejects
    undeliverable ones and leaves the rest flagged. ``inline`` makes each row's
    fields once: without it, Spark moves a later filter on the status below the
    extraction and evaluates the fields' patterns again for it."""
    rows = extracted.select("file_name", "raw_text", F.inline(F.array(F.struct(*fields))))
    form = {"delivery_status": "form_status", "signature_present": "form_signature",
            "partial_delivery": "form_partial", "exception_notes": "form_exception_notes",
            "damage_description": "form_damage_description"}
    p = prefill(rows).withColumn("reviewer", F.lit(reviewer))
    p = p.withColumn("action", F.when(F.col("form_status") == "Undeliverable", "reject")
                     .when((F.col("form_signature") == "Yes") & F.col("form_status").startswith("Delivered"), "approve")
                     .otherwise("flag"))
    return decide(p).select(
        "file_name", "raw_text", "review_status", *[F.col(f).alias(f"ai_{f}") for f in fields],
        *[F.col(form.get(f, f)).alias(f"final_{f}") for f in fields])


def approved_pods(decisions: DataFrame, fields: list[str]) -> DataFrame:
    """RV5: approved reviews as typed POD_FACT rows, from the final values."""
    from .documents import to_pod_fact
    final = decisions.where(F.col("review_status") == "APPROVED").select(
        "file_name", "raw_text", *[F.col(f"final_{f}").alias(f) for f in fields])
    return to_pod_fact(final)
