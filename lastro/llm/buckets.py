"""Links inside buckets, without forming all pairs and without holding a bucket whole."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Items of one group -> links between its items (positions) that span what is connected.
Forest = Callable[[pa.RecordBatch], list[tuple[int, int]]]
LINKS = "a long, b long"


def _crowded(limit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``bucket, id`` -> distinct ids of buckets with two or more, numbered in blocks."""
    last_bucket = last_id = None  # the last distinct row seen; its number, and whether it is out already
    number, told = 0, False
    for batch in batches:
        bucket = batch.column("bucket").to_numpy(zero_copy_only=False)
        ident = batch.column("id").to_numpy(zero_copy_only=False)
        if last_bucket is not None:  # put the pending row in front
            bucket, ident = np.append(last_bucket, bucket), np.append(last_id, ident)
        fresh = np.ones(len(bucket), dtype=bool)
        fresh[1:] = (bucket[1:] != bucket[:-1]) | (ident[1:] != ident[:-1])
        bucket, ident = bucket[fresh], ident[fresh]
        if not len(bucket):
            continue
        starts = np.ones(len(bucket), dtype=bool)
        starts[1:] = bucket[1:] != bucket[:-1]
        first = np.maximum.accumulate(np.where(starts, np.arange(len(bucket)), 0))
        numbers = np.arange(len(bucket)) - first
        numbers[first == 0] += number if last_bucket is not None else 0
        more = np.zeros(len(bucket), dtype=bool)
        more[:-1] = ~starts[1:]
        out = ~starts | more
        if last_bucket is not None:  # out already if it had a predecessor
            out[0] = more[0] and not told
        # The last row waits for a successor, unless its predecessor has made it certain.
        last_bucket, last_id, number = bucket[-1], ident[-1], int(numbers[-1])
        told = bool(out[-1]) or (len(bucket) == 1 and told)
        if out.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[out]), pa.array(ident[out]), pa.array((numbers[out] // limit).astype(np.int64))],
                names=["bucket", "id", "block"],
            )


def crowded(rows: DataFrame, limit: int) -> DataFrame:
    """``bucket, id, block``: the distinct ids of every bucket that has two or more.

    One shuffle and one sorted pass that holds no bucket. Blocks of ``limit`` ids part a
    bucket of any size. The output keeps the order by bucket and block within partitions.
    """
    return (
        rows.select("bucket", "id")
        .repartition("bucket")
        .sortWithinPartitions("bucket", "id")
        .mapInArrow(partial(_crowded, limit), "bucket long, id long, block long")
    )


def _linked(forest: Forest, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with the same ``bucket, block`` are one group."""

    def links(group: pa.RecordBatch) -> pa.RecordBatch:
        ids = group.column("id").to_numpy(zero_copy_only=False)
        found = np.array(forest(group), dtype=np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(ids[found[:, 0]]), pa.array(ids[found[:, 1]])], names=["a", "b"])

    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        bucket = batch.column("bucket").to_numpy(zero_copy_only=False)
        block = batch.column("block").to_numpy(zero_copy_only=False)
        if not len(bucket):
            continue
        cuts = np.flatnonzero((bucket[1:] != bucket[:-1]) | (block[1:] != block[:-1])) + 1
        edges = [0, *cuts.tolist(), len(bucket)]
        for start, stop in zip(edges, edges[1:], strict=False):
            now = (bucket[start], block[start])
            if held and now != key:
                yield links(_joined(held))
                held = []
            key = now
            held.append(batch.slice(start, stop - start))
    if held:
        yield links(_joined(held))


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def linked(groups: DataFrame, forest: Forest) -> DataFrame:
    """``a, b`` links of groups that stand together: ``bucket, block, id`` and what ``forest`` reads."""
    return groups.mapInArrow(partial(_linked, forest), LINKS)


def across_blocks(members: DataFrame, forest: Forest) -> DataFrame:
    """Links between the blocks of buckets that fill more than one: every two blocks meet once.

    ``members`` has ``bucket, block, id`` and what ``forest`` reads; it holds blocked buckets
    only. Each id is copied once per other block of its bucket, never paired with each id.
    """
    counts = members.groupBy("bucket").agg((F.max("block") + 1).alias("blocks"))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda n: n != F.col("block"))
    pair = F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")
    met = (
        members.join(counts, "bucket")
        .withColumn("other", F.explode(others))
        .withColumn("block", pair)
        .drop("blocks", "other")
    )
    return linked(met.repartition("bucket", "block").sortWithinPartitions("bucket", "block", "id"), forest)
