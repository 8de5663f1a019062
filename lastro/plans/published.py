"""Months and photos as they are published: written once for a state of the inputs, read by every report.

The reports compare what was published; they don't rule on the ledgers again. What a
session has published is found again as long as the input files are the same ones and the
published files are there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lastro.sources import storage

_PLACES: dict[tuple, str] = {}


def published(spark: SparkSession, sf: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The published table ``name``; published now if it is not yet."""
    state = (spark.sparkContext.applicationId, sf, name, storage.fingerprint(spark, sf))
    path = _PLACES.get(state)
    if path is None or not storage.names(spark, path):
        path = storage.run_folder(spark, f"publicado-{name}")
        build().write.parquet(path)
        _PLACES[state] = path
    return spark.read.parquet(path)
