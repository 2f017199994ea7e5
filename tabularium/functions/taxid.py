"""Tax ids: digits, check digits, formatted form, document path."""

from __future__ import annotations

import re

import pyspark.sql.functions as F
from pyspark.sql import Column

# Weights of the two check digits, mod 11.
WEIGHTS_1 = (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
WEIGHTS_2 = (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)


def strip_id(col: Column) -> Column:
    return F.regexp_replace(col, "[^0-9]", "")


def check_digit(digits: Column, weights: tuple[int, ...]) -> Column:
    total = F.lit(0)
    for i, w in enumerate(weights):
        total = total + F.substring(digits, i + 1, 1).try_cast("int") * w
    rest = total % 11
    return F.when(rest < 2, 0).otherwise(11 - rest)


def valid_id(col: Column) -> Column:
    """14 digits, not all equal, both check digits right; null and anything else is false."""
    digits = strip_id(col)
    first = check_digit(digits, WEIGHTS_1)
    second = check_digit(digits, WEIGHTS_2)
    ends = F.substring(digits, 13, 2) == F.concat(first.cast("string"), second.cast("string"))
    return F.coalesce((F.length(digits) == 14) & ~digits.rlike("^(.)\\1{13}$") & ends, F.lit(False))


def formatted_id(col: Column) -> Column:
    digits = strip_id(col)
    parts = [F.substring(digits, 1, 2), F.lit("."), F.substring(digits, 3, 3), F.lit("."), F.substring(digits, 6, 3), F.lit("/"), F.substring(digits, 9, 4), F.lit("-"), F.substring(digits, 13, 2)]
    return F.when(F.length(digits) == 14, F.concat(*parts)).otherwise(col)


def document_path(root: Column) -> Column:
    """Eight digits as XX/XXX/XXX.pb."""
    padded = F.lpad(root, 8, "0")
    return F.concat(F.substring(padded, 1, 2), F.lit("/"), F.substring(padded, 3, 3), F.lit("/"), F.substring(padded, 6, 3), F.lit(".pb"))


def clean_id(text: str) -> str:
    return re.sub("[^0-9]", "", text)
