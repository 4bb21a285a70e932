"""Column helpers: native expressions only, no per-row Python."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def padded(c: str | Column, width: int) -> Column:
    """A number with leading zeros up to ``width`` digits; longer ones stay whole
    (LPAD alone would cut them and merge distinct keys)."""
    text = col(c).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def padded_id(prefix: str, c: str | Column, width: int) -> Column:
    """A printed id such as 'CAR000042'."""
    return F.concat(F.lit(prefix), padded(c, width))


def flag_count(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END): NULL counts as 0 (T17)."""
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def pct(num: Column, den: Column, digits: int = 1) -> Column:
    """ROUND(100.0 * num / NULLIF(den, 0), digits) in exact decimal, HALF_UP,
    returned as DOUBLE. NULL when the denominator is 0 (CND3, MTH3)."""
    hundred = F.lit(Decimal("100.0"))
    return F.round(hundred * num / F.nullif(den, F.lit(0)), digits).cast("double")


def money_sum(c: str | Column) -> Column:
    """Exact money total (T10): sum as DECIMAL(18,2), report DOUBLE."""
    return F.sum(col(c).cast("decimal(18,2)")).cast("double")


def yes_no_prefix(c: str | Column) -> Column:
    """DOC4b: TRUE when the text starts with 'yes' or 'true' (any case); NULL -> FALSE."""
    x = col(c)
    return F.coalesce(x.ilike("yes%") | x.ilike("true%"), F.lit(False))


def yes_no_exact(c: str | Column) -> Column:
    """RV1 / PRD3: lower(text) in ('yes', 'true', '1'); NULL -> FALSE."""
    return F.coalesce(F.lower(col(c)).isin("yes", "true", "1"), F.lit(False))


def non_empty(c: str | Column) -> Column:
    """DOC4a: non-NULL and not '' (no trim); NULL -> FALSE."""
    x = col(c)
    return F.coalesce(x != F.lit(""), F.lit(False))


def try_int(c: str | Column) -> Column:
    """CST3 TRY_TO_NUMBER: integral result, rounds '12.7' to 13, NULL if unparsable."""
    return col(c).try_cast("decimal(38,0)").cast("int")


def try_date(c: str | Column) -> Column:
    """CST2 TRY_TO_DATE: NULL when unparsable."""
    return col(c).try_cast("date")


def pick(options: list[str], default: str, c: str | Column) -> Column:
    """PRD4: keep the value when it is one of the options, else the default."""
    x = col(c)
    return F.when(x.isin(*options), x).otherwise(F.lit(default))


def month(c: str | Column) -> Column:
    """DATE_TRUNC('month', d)::DATE."""
    return F.trunc(col(c), "month")
