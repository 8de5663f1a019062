"""Money: the receipt compositions, coupons, and text amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lastro.schemas import MONEY

#: Amounts read from text may be of any length; only what is no number fails.
READ = "decimal(38,4)"


def zero_amount() -> Column:
    return F.lit(0).cast(MONEY)


_BLANKS = "[\\s\\u00a0]"


def full_amount() -> Column:
    """Everything received: charges included, every discount taken off."""
    charges = sum(F.col(c) for c in ("taxa_boleto", "multa", "juros_atraso", "correcao_atraso"))
    return base_amount() + charges - F.col("desconto_custa")


def base_amount() -> Column:
    """Received without late charges and slip fee. A null part nulls the row."""
    added = sum(F.col(c) for c in ("juros_parcela", "correcao", "acrescimo"))
    taken = sum(F.col(c) for c in ("desconto", "desconto_imposto", "desconto_condicional"))
    return F.col("principal") + added - taken


def coupons(amount: Column, per_coupon: int = 100) -> Column:
    """Whole blocks of ``per_coupon``; reversals (negative totals) give none."""
    return F.when(amount > 0, F.floor(amount / per_coupon)).otherwise(0).cast("long")


def _numeric(text: Column) -> Column:
    return F.coalesce(text.try_cast(READ), zero_amount().cast(READ))


def _ingest_text(col: Column) -> Column:
    """One pass drops currency marks, dots and outer blanks; the comma turns into the point."""
    noise = "R\\$" + _BLANKS + "*|\\.|^" + _BLANKS + "+|" + _BLANKS + "+$"
    return F.translate(F.regexp_replace(col, noise, ""), ",", ".")


def parse_ingest(col: Column, is_text: bool = True) -> Column:
    """Snapshot amounts: every dot is a thousands mark, the comma is decimal."""
    return _numeric(_ingest_text(col)) if is_text else F.coalesce(col.cast(MONEY), zero_amount())


def ingest_failed(col: Column) -> Column:
    """True where ``parse_ingest`` turned a non-blank text into zero."""
    text = _ingest_text(col)
    return F.coalesce((text != "") & text.try_cast(READ).isNull(), F.lit(False))


def _decimal_comma(text: Column) -> Column:
    dots_gone = F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(text.contains(","), dots_gone).otherwise(text)


def _bare(col: Column) -> Column:
    return F.trim(F.regexp_replace(col, "R\\$|\u00a0", ""))


def parse_export(col: Column) -> Column:
    """Export amounts: dots are thousands marks only when a comma is present."""
    return _numeric(_decimal_comma(_bare(col)))


def signed_text(col: Column) -> Column:
    """Plain number text of an accounting amount: '(1.234,50)' gives '-1234.50'."""
    text = _bare(col)
    negative = text.startswith("-") | (text.startswith("(") & text.endswith(")"))
    digits = F.trim(F.regexp_replace(F.regexp_replace(text, r"^[()]+|[()]+$", ""), "^-+", ""))
    thousands = digits.rlike(r"^\d{1,3}(\.\d{3})+$") & ~digits.contains(",")
    plain = F.when(thousands, F.replace(digits, F.lit("."), F.lit(""))).otherwise(_decimal_comma(digits))
    return F.when(negative, F.concat(F.lit("-"), plain)).otherwise(plain)


def parse_signed(col: Column) -> Column:
    blank = _bare(col).isin("", "-")
    return F.when(blank, zero_amount()).otherwise(_numeric(signed_text(col)))


def signed_failed(col: Column) -> Column:
    """True where ``parse_signed`` had to fall back to zero."""
    readable = signed_text(col).try_cast(READ).isNotNull()
    return col.isNotNull() & ~_bare(col).isin("", "-") & ~readable


def parse_digits(col: Column) -> Column:
    """Keep digits, comma and minus only."""
    return _numeric(F.replace(F.regexp_replace(col, "[^0-9,\\-]", ""), F.lit(","), F.lit(".")))


def to_double(col: Column) -> Column:
    """Output edge: decimals leave the library as doubles."""
    return col.cast("double")


def money_text(col: Column) -> Column:
    """'R$ 1.234,56', the form dirty sources carry."""
    plain = F.format_number(F.abs(col), 2)
    swapped = F.translate(plain, ",.", ".,")
    return F.concat(F.when(col < 0, "-").otherwise(""), F.lit("R$ "), swapped)
