"""Which sales moved between two executions, by digests compared from the top down.

A row's digest is a pair of 64-bit hashes of all its columns, nulls told apart. Digests of
rows add up, in any order, to that of a sale; sales to a development, developments to a
company. An execution is published once with its three levels. Two executions are compared
by company first; only of companies that differ the developments are read, and only of
developments that differ the sales, each from its own folder. Equal branches are never opened.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lastro.schemas import SALE_KEY
from lastro.sources import storage

COMPANY, DEVELOPMENT = SALE_KEY[:1], SALE_KEY[:2]
_SUMS = ["linhas", "soma_a", "soma_b"]
# What happened to a sale.
ENTERED, LEFT, CHANGED = "ENTROU", "SAIU", "MUDOU"


def _hash(columns: Sequence[str], seed: int) -> Column:
    """A 64-bit hash; the marks keep apart rows in which a null changes places with a value."""
    parts = [part for name in columns for part in (F.col(name), F.col(name).isNull())]
    return F.xxhash64(F.lit(seed), *parts).cast("decimal(20,0)")


def by_sale(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``linhas, soma_a, soma_b`` per sale: rows, and the exact sums of both hashes of the columns (all but the key)."""
    columns = list(columns or [name for name in df.columns if name not in SALE_KEY])
    rows = df.select(*SALE_KEY, _hash(columns, 1).alias("a"), _hash(columns, 2).alias("b"))
    return rows.groupBy(*SALE_KEY).agg(F.count(F.lit(1)).alias("linhas"), F.sum("a").alias("soma_a"), F.sum("b").alias("soma_b"))


def rolled_up(digests: DataFrame, key: Sequence[str]) -> DataFrame:
    """Digests of a higher level. The keys below belong to it, so equal rows under other keys differ."""
    below = [name for name in SALE_KEY if name in digests.columns and name not in key]
    told = digests.select(*key, "linhas", _hash([*below, *_SUMS], 1).alias("a"), _hash([*below, *_SUMS], 2).alias("b"))
    return told.groupBy(*key).agg(F.sum("linhas").alias("linhas"), F.sum("a").alias("soma_a"), F.sum("b").alias("soma_b"))


def publish(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """The three levels of an execution below ``path``, which holds none yet.

    Folders are named after company and development; the keys stay columns too, as null and
    empty ones share a folder.
    """
    spark, sales = df.sparkSession, by_sale(df, columns)
    storage.write_new(spark, f"{path}/esquema.json", sales.schema.json())
    foldered = sales.withColumns({f"_{name}": F.col(name) for name in DEVELOPMENT}).repartition(*DEVELOPMENT)
    foldered.write.partitionBy(*(f"_{name}" for name in DEVELOPMENT)).parquet(f"{path}/vendas")
    developments = rolled_up(spark.read.schema(sales.schema).parquet(f"{path}/vendas"), DEVELOPMENT)
    developments.withColumn("_empresa", F.col("empresa")).repartition("empresa").write.partitionBy("_empresa").parquet(f"{path}/obras")
    rolled_up(spark.read.schema(developments.schema).parquet(f"{path}/obras"), COMPANY).write.parquet(f"{path}/empresas")


def _differ(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys whose digests are not equal, with what is on each side. Null keys are keys."""
    both = before.select(*key, *_SUMS, F.lit(1).alias("_lado")).unionByName(after.select(*key, *_SUMS, F.lit(2).alias("_lado")))

    def of(side: int) -> Column:
        return F.max(F.when(F.col("_lado") == side, F.struct(*_SUMS)))

    return both.groupBy(*key).agg(of(1).alias("antes"), of(2).alias("depois")).where(~F.col("antes").eqNullSafe(F.col("depois")))


def _branches(spark: SparkSession, path: str, level: str, folders: list[str], schema) -> DataFrame:
    """The rows of some folders of a level; those that this execution has."""
    root = f"{path}/{level}"
    held = [folder for folder in (f"{root}/{name}" for name in folders) if storage.names(spark, folder)]
    return spark.read.schema(schema).parquet(*held) if held else spark.createDataFrame([], schema)


def _folders(spark: SparkSession, keys: DataFrame, names: Sequence[str]) -> list[str]:
    """Folders of the keys, as Spark names them; as many as companies or developments that differ."""
    util = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    rows = keys.select(*(F.col(name).cast("string") for name in names)).distinct().collect()
    return sorted({"/".join(util.getPartitionPathString(f"_{name}", row[name]) for name in names) for row in rows})


def moved_sales(spark: SparkSession, before: str, after: str) -> DataFrame:
    """``empresa, obra, num_venda, movimento``: the sales that differ between two published executions.

    What the driver holds is the list of companies, then of developments, that differ.
    """
    sides = (before, after)
    companies = _differ(*(spark.read.parquet(f"{path}/empresas") for path in sides), COMPANY)
    own = _folders(spark, companies, COMPANY)
    kind = StructType.fromJson(json.loads(storage.read_text(spark, f"{before}/esquema.json")))
    above = StructType([field for field in kind if field.name != "num_venda"])
    developments = _differ(*(_branches(spark, path, "obras", own, above) for path in sides), DEVELOPMENT)
    own = _folders(spark, developments, DEVELOPMENT)
    sales = _differ(*(_branches(spark, path, "vendas", own, kind) for path in sides), SALE_KEY)
    movement = F.when(F.col("antes").isNull(), ENTERED).when(F.col("depois").isNull(), LEFT).otherwise(CHANGED)
    return sales.select(*SALE_KEY, movement.alias("movimento"))
