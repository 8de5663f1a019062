"""Masks for personal data. Columns in, columns out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digits(col: Column) -> Column:
    return F.regexp_replace(col.cast("string"), r"\D", "")


def mask_tax_id(col: Column) -> Column:
    digits = _digits(col)
    tail = F.when(F.length(digits) < 2, "**").otherwise(F.right(digits, F.lit(2)))
    masked = F.concat(F.lit("***.***.***-"), tail)
    return F.when(F.coalesce(col.cast("string"), F.lit("")) == "", "").otherwise(masked)


def mask_phone(col: Column) -> Column:
    digits = _digits(col)
    masked = F.concat(
        F.left(digits, F.lit(2)), F.lit(" "), F.substring(digits, 3, 1), F.lit("****-**"), F.right(digits, F.lit(2))
    )
    return (
        F.when(F.coalesce(col.cast("string"), F.lit("")) == "", "")
        .when(F.length(digits) < 4, "****")
        .otherwise(masked)
    )


def mask_email(col: Column) -> Column:
    domain = F.regexp_extract(col, r"(?s)^[^@]*@(.*)$", 1)
    return F.when(F.instr(F.coalesce(col, F.lit("")), "@") == 0, "").otherwise(
        F.concat(F.when(col.startswith("@"), "").otherwise(F.left(col, F.lit(1))), F.lit("***@"), domain)
    )


# Personal data inside free text: formatted tax ids, phones and addresses.
TAX_ID_IN_TEXT = r"\b\d{3}\.\d{3}\.\d{3}-(\d{2})\b"
EMAIL_IN_TEXT = r"\b([A-Za-z0-9])[A-Za-z0-9._%+-]*@([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"
PHONE_IN_TEXT = r"\+?\(?(\d{2,3})\)?[ .-]?(\d)\d{2,4}[ .-]\d{2}(\d{2})\b"


def mask_text(col: Column) -> Column:
    """The same three masks applied wherever the pattern occurs in a text."""
    masked = F.regexp_replace(col, EMAIL_IN_TEXT, "$1***@$2")
    masked = F.regexp_replace(masked, TAX_ID_IN_TEXT, "***.***.***-$1")
    return F.regexp_replace(masked, PHONE_IN_TEXT, "$1 $2****-**$3")
