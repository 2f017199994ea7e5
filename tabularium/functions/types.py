"""Casts with declared rules: null on what does not parse, never an error."""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import Column


def iso_date(col: Column, *, null_sentinel: bool = False) -> Column:
    """YYYYMMDD text as YYYY-MM-DD text; null, blank and '0' are null.

    ``null_sentinel``: also '00000000', which otherwise gives '0000-00-00' as published products have it.
    """
    nothing = col.isNull() | col.isin("", "0")
    if null_sentinel:
        nothing = nothing | (col == "00000000")
    return F.when(~nothing, F.concat(F.substring(col, 1, 4), F.lit("-"), F.substring(col, 5, 2), F.lit("-"), F.substring(col, 7, 2)))


def compact_date(col: Column) -> Column:
    """YYYYMMDD text as a date; anything else, also impossible days, null."""
    return F.when(col.rlike("^[0-9]{8}$"), F.try_to_timestamp(col, F.lit("yyyyMMdd")).cast("date"))


def comma_double(col: Column) -> Column:
    return F.replace(col, F.lit(","), F.lit(".")).try_cast("double")


def comma_decimal(col: Column) -> Column:
    return F.replace(col, F.lit(","), F.lit(".")).try_cast("decimal(18,2)")


def lenient_int(col: Column) -> Column:
    """Integers, and decimals rounded to one."""
    return F.round(col.try_cast("double")).try_cast("int")


def yes_no(col: Column) -> Column:
    return F.when(col == "S", True).when(col == "N", False)


def coded(col: Column, labels: dict[str, str], default: str = "") -> Column:
    out = None
    for code, label in labels.items():
        out = F.when(col == code, label) if out is None else out.when(col == code, label)
    return out.otherwise(default)


def asc(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def desc(name: str) -> Column:
    return F.col(name).desc_nulls_last()


# Coercions of nested documents: zero, empty or unspecified instead of null.
def doc_int(col: Column) -> Column:
    return F.coalesce(F.trim(col.cast("string")).try_cast("long"), F.lit(0).cast("long"))


def doc_str(col: Column) -> Column:
    return F.coalesce(F.trim(col), F.lit(""))


def doc_date(col: Column) -> Column:
    digits = F.trim(F.replace(col, F.lit("-"), F.lit("")))
    return F.when(digits.rlike("^[0-9]{8}$"), digits.try_cast("long")).otherwise(F.lit(0).cast("long"))


def doc_bool(col: Column) -> Column:
    return F.coalesce(col, F.lit(False))


def doc_masked_id(col: Column) -> Column:
    """The six digits of a masked personal id; else the first run of six digits; else 0."""
    digits = F.regexp_replace(F.coalesce(col, F.lit("")), "[^0-9]", "")
    six = F.when(F.length(digits) == 6, digits).otherwise(F.regexp_extract(F.coalesce(col, F.lit("")), "[0-9]{6}", 0))
    return F.coalesce(six.try_cast("long"), F.lit(0).cast("long"))


def doc_enum(col: Column, allowed: tuple[int, ...]) -> Column:
    value = doc_int(col)
    return F.when(value.isin(*allowed), value).otherwise(F.lit(0).cast("long"))
