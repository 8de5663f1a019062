"""Text helpers: accents, statuses, yes/no flags, names, identifiers."""

from __future__ import annotations

import re
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accent_map() -> tuple[str, str]:
    """Every letter that decomposes to an ASCII letter and marks, and that letter."""
    accented, plain = [], []
    for letter in filter(unicodedata.decomposition, map(chr, range(0x00C0, sys.maxunicode + 1))):
        parts = unicodedata.normalize("NFD", letter)
        if len(parts) > 1 and parts[0].isascii() and all(map(unicodedata.combining, parts[1:])):
            accented.append(letter)
            plain.append(parts[0])
    return "".join(accented), "".join(plain)


_ACCENTED, _PLAIN = _accent_map()


def fold_accents(col: Column) -> Column:
    """Letters without their accents, composed or as combining marks."""
    return F.regexp_replace(F.translate(col, _ACCENTED, _PLAIN), r"\p{M}+", "")


def normalize_status(col: Column) -> Column:
    """Accent-free, upper case, trimmed; null becomes ''."""
    return F.coalesce(F.trim(F.upper(fold_accents(col.cast("string")))), F.lit(""))


def is_yes(col: Column) -> Column:
    return normalize_status(col) == "SIM"


def begins_with(col: Column, letter: str) -> Column:
    """Flag text such as 'Sim'/'Não' judged by its first letter; null is false."""
    return F.coalesce(F.upper(F.trim(col.cast("string"))).startswith(letter), F.lit(False))


def is_one(col: Column) -> Column:
    """0/1 flags that may arrive as number or text."""
    return F.coalesce(F.trim(col.cast("string")).isin("1", "1.0"), F.lit(False))


def capitalize(col: Column) -> Column:
    """First letter upper, the rest lower."""
    return F.concat(F.upper(F.left(col, F.lit(1))), F.lower(F.substring(col, 2, 2147483647)))


def text_or_empty(col: Column) -> Column:
    return F.coalesce(F.trim(col.cast("string")), F.lit(""))


def clean_identifier(col: Column) -> Column:
    """Identifier text without the '.0' a float reader leaves behind."""
    return F.regexp_replace(text_or_empty(col), r"^(-?\d+)\.0$", "$1")


def clean_tax_id(col: Column) -> Column:
    """Tax id: up to eleven digits are zero-padded, anything else is kept."""
    text = clean_identifier(col)
    return F.when(text.rlike(r"^\d{1,11}$"), F.lpad(text, 11, "0")).otherwise(text)


def normalize_name(name: str) -> str:
    """Column name: accent-free ASCII, runs of other characters become '_'."""
    ascii_name = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()
    return re.sub(r"[^0-9a-zA-Z]+", "_", ascii_name).strip("_").lower()


def match_name(name: str, drop: str = " _.") -> str:
    """Comparison form of a column name: no accents, case, nor ``drop`` characters."""
    decomposed = unicodedata.normalize("NFD", name)
    kept = (c for c in decomposed if not unicodedata.combining(c) and c not in drop)
    return "".join(kept).lower()
