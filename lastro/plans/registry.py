"""A section of named queries, each with the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]


def output(df: DataFrame) -> DataFrame:
    """Decimals leave as doubles; every other column is passed through."""
    return df.select(
        *(
            F.col(f"`{field.name}`").cast("double").alias(field.name)
            if isinstance(field.dataType, T.DecimalType)
            else F.col(f"`{field.name}`")
            for field in df.schema.fields
        )
    )


class Section:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracle: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def add(function: Query) -> Query:
            self.queries[name] = lambda spark, sf_dir: output(function(spark, sf_dir))
            if sql is not None:
                self.oracle[name] = sql
            return function

        return add
