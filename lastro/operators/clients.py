"""Exact client counts over any slice, from bitmaps instead of from rows.

Clients get dense numbers once. A cube holds, per value of its dimensions and per block of
numbers, one bitmap of the clients seen there. A count over any slice or coarser grouping ors
bitmaps: no client is counted twice, however many cells it is in, and no contract row is
read again. Cubes of several days or months can be put together if they share the numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lastro.sources.storage import run_folder


def numbered(df: DataFrame, client: str, known: DataFrame | None = None) -> DataFrame:
    """``client, numero``: distinct clients numbered without gaps; null is no client.

    Numbers of ``known`` stay, new clients follow them. Clients are ranked inside ranges, and
    the ranges' sizes, one row each, are added up.
    """
    clients = df.select(client).where(F.col(client).isNotNull()).distinct()
    first = 0
    if known is not None:
        clients = clients.join(known, client, "left_anti")
        first = known.count()
    spark = df.sparkSession
    ranged = clients.repartitionByRange(client).withColumn("_faixa", F.spark_partition_id())
    # Written down: ranges are drawn from a sample and may fall otherwise when worked out again.
    path = run_folder(spark, "faixas")
    ranged.write.parquet(path)
    ranged = spark.read.parquet(path)
    sizes = ranged.groupBy("_faixa").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_faixa").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_faixa", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_antes"))
    rank = F.row_number().over(Window.partitionBy("_faixa").orderBy(client))
    fresh = ranged.withColumn("_posto", rank).join(offsets, "_faixa").select(client, (F.col("_antes") + F.col("_posto") - 1 + first).alias("numero"))
    return fresh if known is None else known.select(client, "numero").unionByName(fresh)


def cube(df: DataFrame, numbers: DataFrame, client: str, dimensions: Sequence[str]) -> DataFrame:
    """``dimensions, bloco, mapa``: the clients of every cell, in bitmaps of a fixed number of bits."""
    told = df.select(client, *dimensions).join(numbers, client)
    block = F.bitmap_bucket_number("numero").alias("bloco")
    return told.groupBy(*dimensions, block).agg(F.bitmap_construct_agg(F.bitmap_bit_position("numero")).alias("mapa"))


def clients_by(cells: DataFrame, dimensions: Sequence[str], where: Column | None = None) -> DataFrame:
    """``dimensions, clientes``: distinct clients per value of some of the dimensions, over a slice; none of them gives the total."""
    kept = cells if where is None else cells.where(where)
    blocks = kept.groupBy(*dimensions, "bloco").agg(F.bitmap_or_agg("mapa").alias("mapa"))
    return blocks.groupBy(*dimensions).agg(F.coalesce(F.sum(F.bitmap_count("mapa")), F.lit(0)).alias("clientes"))
