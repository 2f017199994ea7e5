"""Text normalisation as column expressions that stay in generated code."""

from __future__ import annotations

import sys
import unicodedata

import pyspark.sql.functions as F
from pyspark.sql import Column


def _accent_table() -> tuple[str, str]:
    """Every letter that is a base letter with marks, and its base; then the marks themselves, which go."""
    source, target, marks = [], [], []
    for code in range(0x80, sys.maxunicode + 1):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF or code >= 0x20000:
            continue
        char = chr(code)
        if unicodedata.category(char) == "Mn":
            marks.append(char)
            continue
        bare = "".join(c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn")
        if len(bare) == 1 and bare != char and code < 0x2000:
            source.append(char)
            target.append(bare)
    return "".join(source + [m for m in marks if ord(m) < 0x2100]), "".join(target)


ACCENTED, BARE = _accent_table()


def strip_accents(col: Column) -> Column:
    return F.translate(col, ACCENTED, BARE)


def upper_plain(col: Column) -> Column:
    """Upper case without accents, one letter for one: sharp s becomes capital sharp s, not SS."""
    return F.upper(F.translate(strip_accents(col), "ß", "ẞ"))


def collapse_spaces(col: Column) -> Column:
    return F.regexp_replace(col, r"\s+", " ")


def blank(col: Column) -> Column:
    return col.isNull() | (F.trim(col) == "")


def filled(col: Column) -> Column:
    return col.isNotNull() & (col != "")


# Street prefixes and what they stand for.
STREET_PREFIXES = {
    "R": "RUA",
    "AV": "AVENIDA",
    "TV": "TRAVESSA",
    "AL": "ALAMEDA",
    "PCA": "PRACA",
    "PC": "PRACA",
    "EST": "ESTRADA",
    "ROD": "RODOVIA",
    "VL": "VILA",
    "LG": "LARGO",
}
_PREFIX = r"^([A-Z]+)\.?\s+"


def expand_prefix(col: Column, prefixes: dict[str, str] = STREET_PREFIXES) -> Column:
    """The first word, if it is a known abbreviation (a dot may follow), in full; otherwise ``col`` as it is."""
    known = F.create_map(*[F.lit(x) for pair in prefixes.items() for x in pair])
    full = F.try_element_at(known, F.regexp_extract(col, _PREFIX, 1))
    return F.coalesce(F.concat(full, F.lit(" "), F.regexp_replace(col, _PREFIX, "")), col)


def street(col: Column) -> Column:
    return expand_prefix(upper_plain(F.trim(collapse_spaces(col))))


def search_needle(text: str) -> str:
    """User input for a contains-search: wildcards and backslashes go, accents and case are normalised like the columns."""
    kept = "".join(c for c in text if c not in "%_\\").strip()
    bare = "".join(c for c in unicodedata.normalize("NFD", kept) if unicodedata.category(c) != "Mn")
    return bare.replace("ß", "ẞ").upper()
