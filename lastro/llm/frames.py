"""Frames: reading tables, free column names, cut lineage, and pass-through of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lastro.sources.storage import checkpoint, run_folder  # noqa: F401  (reliable, in the session's shared folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The rows as a table in the session's shared folder: cuts the lineage as a checkpoint does, and is compressed."""
    path = run_folder(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or with underscores in front until no column has that name in any case."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def ref(name: str) -> Column:
    """The column with exactly this name, whatever characters it has."""
    return F.col(f"`{name.replace('`', '``')}`")


def parallelism(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def identity(key: str, text: str) -> Column:
    """Key and hash of the text: what one document is, also where keys are null or repeat."""
    return F.struct(ref(key).alias("key"), F.xxhash64(ref(text)).alias("version"))


def first_of_each(df: DataFrame, by: str) -> DataFrame:
    """One row per value of a column. Free after a sort-merge join on that column."""
    number = free_name(df, "number")
    ordered = Window.partitionBy(ref(by)).orderBy(ref(by))
    return df.withColumn(number, F.row_number().over(ordered)).where(ref(number) == 1).drop(number)
