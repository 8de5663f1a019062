"""Receipts as a stream: daily sums, coupons per contract, late postings.

Every micro-batch writes its own folder, named by its batch id, so a replayed
batch replaces what it wrote and readers see each result once. Where rows replace
earlier rows of their key, they go to a table of hash buckets: a batch writes the buckets
it touches, and a batch that is in already is passed over. State that must survive
(daily sums) is Spark's own checkpointed state; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lastro.functions.money import coupons
from lastro.sources.buckets import BucketTable

BATCH = "lote"
#: Runs a bucket of a sink may have before they are merged.
MOST_RUNS = 8


def read_stream(
    spark: SparkSession, folder: str, schema: StructType, name_filter: str | None = None, files_per_batch: int = 1000
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.parquet(folder)


def batch_folder(path: str) -> Callable[[DataFrame, int], None]:
    """Sink: one folder per batch, overwritten when the batch is replayed."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return write


def upsert_buckets(path: str, key: list[str], most: int = MOST_RUNS) -> Callable[[DataFrame, int], None]:
    """Sink: the batch's rows replace those of the same key; null keys are a key.

    A batch adds a run to the buckets of its keys. Buckets with more than ``most`` runs are
    merged, and what no longer counts is removed; a reader of the version before still finds its files.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table = BucketTable(batch.sparkSession, path, key)
        if table.write(batch, batch_id):
            table.compact(most)
            table.clean()

    return write


def run_available(
    df: DataFrame, path: str, checkpoint: str, mode: str, key: list[str] | None = None
) -> StreamingQuery:
    """Process what is there, then stop. The same call resumes from the checkpoint.

    With ``key`` the sink keeps one current row per key, else all rows of all batches. A sink
    belongs to one checkpoint: batches it has already are passed over.
    """
    query = (
        df.writeStream.outputMode(mode)
        .foreachBatch(upsert_buckets(path, key) if key else batch_folder(path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def current(spark: SparkSession, path: str, key: list[str]) -> DataFrame:
    """The current rows of an upserting sink."""
    return BucketTable(spark, path, key).read()


def event_day(ts: str) -> Column:
    """The day a time was written with, whatever the session's zone."""
    return F.col(ts).cast("timestamp_ntz").cast("date")


def daily_sums(stream: DataFrame, ts: str, value: str) -> DataFrame:
    """Count and money per event day, however late a receipt is posted.

    No watermark: postings come up to weeks late and must count. The state is one
    row per day, so it stays small without closing days.
    """
    return stream.groupBy(event_day(ts).alias("dia")).agg(F.count(F.lit(1)).alias("recebimentos"), F.sum(value).alias("valor"))


def contract_totals(stream: DataFrame, contract: str, value: str) -> DataFrame:
    """Running total per contract. Reversals lower it, so coupons are read off the
    total by ``contract_coupons`` and never added up."""
    return stream.groupBy(contract).agg(F.sum(value).alias("valor"))


def contract_coupons(spark: SparkSession, path: str, contract: str) -> DataFrame:
    return current(spark, path, [contract]).withColumn("cupons", coupons(F.col("valor")))


def route_late(stream: DataFrame, ts: str, cutoff: date) -> DataFrame:
    """Receipts of a closed period are marked for the correction table, not dropped."""
    late = event_day(ts) < F.lit(cutoff)
    return stream.withColumn("destino", F.when(late, "correcao").otherwise("corrente"))
