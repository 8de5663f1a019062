"""Dated photos kept as validity intervals: a row is stored once for all successive photos that hold it.

A photo is compared with the rows that are open. Rows it no longer holds are closed on its
day, new ones are opened, equal ones are not touched, so the archive grows with the changes
and not with the photos. A row is told by two hashes of all its columns, nulls told apart;
rows that repeat are one with a count. Any archived day reads back as it was.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lastro.sources import storage
from lastro.sources.buckets import BucketTable

_OWN = ["_a", "_b", "_copias", "_desde", "_ate"]
_SAME = ["_a", "_b", "_copias"]


def _hash(columns: Sequence[str], seed: int) -> Column:
    parts = [part for name in columns for part in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]
    return F.xxhash64(F.lit(seed), *parts)


class PhotoArchive:
    """Photos of one table below a folder; ``key`` deals the rows to buckets and need not be unique."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], buckets: int = 64) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.table = BucketTable(spark, f"{self.path}/linhas", [*key, "_a", "_b", "_copias", "_desde"], key, buckets)

    def days(self) -> list[date]:
        """Archived days, oldest first."""
        names = storage.names(self.spark, f"{self.path}/dias")
        return sorted(date.fromisoformat(name[:-4]) for name in names if name.endswith(".txt"))

    def add(self, photo: DataFrame, day: date) -> None:
        """Archive the photo of a day after all archived ones. A day that is in already stays as it is."""
        days = self.days()
        if day in days:
            return
        if days and day < days[-1]:
            raise ValueError(f"{day} comes before the archived {days[-1]}")
        if clash := {*_OWN} & set(photo.columns):
            raise ValueError(f"columns of the archive in the photo: {sorted(clash)}")
        names = photo.columns
        told = photo.withColumns({"_a": _hash(names, 1), "_b": _hash(names, 2)})
        first = [F.first(f"`{name}`").alias(name) for name in names]
        rows = told.groupBy("_a", "_b").agg(*first, F.count(F.lit(1)).alias("_copias"))
        fresh = rows.withColumns({"_desde": F.lit(day), "_ate": F.lit(None).cast("date")}).select(*names, *_OWN)
        if self.table.manifest().schema is not None:
            held = self.table.read().where(F.col("_ate").isNull()).select(*names, *_OWN)
            closed = held.join(fresh.select(*_SAME), _SAME, "left_anti").select(*names, *_OWN).withColumn("_ate", F.lit(day))
            fresh = fresh.join(held.select(*_SAME), _SAME, "left_anti").select(*names, *_OWN).unionByName(closed)
        self.table.write(fresh, day.toordinal())
        storage.write_new(self.spark, f"{self.path}/dias/{day.isoformat()}.txt", "")

    def read(self, day: date) -> DataFrame:
        """The photo of an archived day, repeats included."""
        if day not in self.days():
            raise ValueError(f"no photo of {day}")
        rows = self.table.read()
        names = [name for name in rows.columns if name not in _OWN]
        valid = rows.where((F.col("_desde") <= F.lit(day)) & (F.col("_ate").isNull() | (F.col("_ate") > F.lit(day))))
        each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copias")))
        return valid.select(*(F.col(f"`{name}`") for name in names), each.alias("_copia")).drop("_copia")

    def history(self) -> DataFrame:
        """Every stored row with the days from which and up to which it held, the second not included."""
        return self.table.read().withColumnsRenamed({"_desde": "desde", "_ate": "ate"}).drop("_a", "_b", "_copias")
