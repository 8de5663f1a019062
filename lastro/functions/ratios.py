"""Ratios, half-even rounding, and totals next to the rows they are totals of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, 0 where the whole is 0 or absent."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    return ratio(100 * part.cast("double"), whole)


def totals(df: DataFrame, **aggregates: Column) -> dict[str, Column]:
    """Global aggregates as scalar columns, usable in a select over any frame.

    One subquery of one row; no window over the whole frame and no cross join.
    """
    named = F.struct(*(column.alias(name) for name, column in aggregates.items()))
    row = df.agg(named.alias("totals")).scalar()
    return {name: row.getField(name) for name in aggregates}


def rounded(value: Column, places: int = 0) -> Column:
    return F.bround(value, places)
