"""Dates written as text, and month arithmetic."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_day_first(col: Column) -> Column:
    """'dd/MM/yyyy', 'yyyyMMdd' or ISO text to a date; anything else is null."""
    text = F.trim(col.cast("string"))
    return F.coalesce(
        F.when(text.rlike(r"^\d{8}$"), F.try_to_date(text, "yyyyMMdd")),
        F.when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}"), F.try_to_date(F.substring_index(text, " ", 1), "d/M/yyyy")),
        F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_date(F.left(text, F.lit(10)), "yyyy-MM-dd")),
    )


def day_text(col: Column) -> Column:
    return F.date_format(col, "dd/MM/yyyy")


def competence(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def month_window(reference: Column) -> tuple[Column, Column]:
    """'MM_yyyy' to its first day and the first day of the next month."""
    first = F.try_to_date(F.concat(F.lit("01_"), reference), "dd_MM_yyyy")
    return first, F.add_months(first, 1)


def month_bounds(reference: str) -> tuple[date, date]:
    month, year = (int(part) for part in reference.split("_"))
    following = date(year + month // 12, month % 12 + 1, 1)
    return date(year, month, 1), following
