"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position gets a nonzero vector of ``radius + 1`` bits. Each nonzero vector v of
that length is a table; its mask has the positions whose vector has an odd product with v.
The vectors of ``radius`` differing positions span at most ``radius`` dimensions, so some v
is orthogonal to all of them: its mask touches none of the positions, and both fingerprints
fall into one bucket of that table. No pair within the radius is ever missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro.llm.buckets import across_blocks, crowded, linked
from lastro.llm.components import components
from lastro.llm.frames import checkpoint, first_of_each, free_name, identity, ref

BITS, SHINGLE, RADIUS, SEED = 64, 4, 4, 42
#: Fingerprints compared together; larger buckets meet block by block.
BLOCK = 2048
#: Shingles summed at a time.
RUN = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit i is 1 if set in over half the shingles' hashes. Signed, as Spark keeps it."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, the six ASCII spaces only
    if not words:
        return 0
    spaced = b" ".join(words)
    starts, at = [], 0
    for word in words:
        starts.append(at)
        at += len(word) + 1
    count = max(1, len(words) - shingle + 1)
    ends = [start - 1 for start in starts[shingle:]] + [len(spaced)]
    sums = np.zeros(BITS, dtype=np.int64)
    for low in range(0, count, RUN):
        places = zip(starts[low : min(low + RUN, count)], ends[low : low + RUN], strict=False)
        hashes = np.array([xxhash.xxh64_intdigest(spaced[a:b], SEED) for a, b in places], dtype=">u8")
        sums += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * sums > count).tobytes(), "big", signed=True)


def _fingerprints(shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(text.as_py(), shingle) for text in batch.column(0)]
        names = batch.schema.names[1:]
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(prints, pa.int64())], names=[*names, "fp"])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``key, version, fp`` of every row; version hashes the text, null is the empty text."""
    rows = df.select(ref(text).alias("t"), ref(key).alias("key"), F.xxhash64(ref(text)).alias("version"))
    return rows.mapInArrow(partial(_fingerprints, shingle), rows.drop("t").schema.add("fp", "long"))


def masks(radius: int, bits: int = BITS) -> list[int]:
    """One mask per nonzero vector of ``radius + 1`` bits, as signed integers."""
    vectors = [1 + position % ((1 << radius + 1) - 1) for position in range(bits)]
    out = []
    for table in range(1, 1 << radius + 1):
        mask = sum(1 << i for i, vector in enumerate(vectors) if (vector & table).bit_count() % 2)
        out.append(mask - (1 << bits) if mask >> bits - 1 else mask)
    return out


def _near(radius: int, group: pa.RecordBatch) -> list[tuple[int, int]]:
    """A spanning forest of the links within the radius, by breadth-first search."""
    prints = group.column("id").to_numpy(zero_copy_only=False).view(np.uint64)
    unseen = np.ones(len(prints), dtype=bool)
    links: list[tuple[int, int]] = []
    for seed in range(len(prints)):
        if not unseen[seed]:
            continue
        unseen[seed], queue = False, [seed]
        while queue:
            node = queue.pop()
            found = np.flatnonzero(unseen & (np.bitwise_count(prints ^ prints[node]) <= radius))
            unseen[found] = False
            links += [(node, other) for other in found.tolist()]
            queue += found.tolist()
    return links


def links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``a, b``: links that connect all distinct ``fp`` within the radius, directly or by others.

    Equal fingerprints are one row before the tables, so a group of copies weighs one row a
    table. A bucket is compared in blocks; only spanning links leave a task, at most one
    per fingerprint and block, never all pairs.
    """
    tables = [
        F.xxhash64(F.lit(number), F.col("fp").bitwiseAND(F.lit(mask).cast("long")))
        for number, mask in enumerate(masks(radius))
    ]
    rows = prints.select("fp").distinct().select(F.col("fp").alias("id"), F.explode(F.array(*tables)).alias("bucket"))
    members = checkpoint(crowded(rows, block))
    near = partial(_near, radius)
    # A checkpoint keeps partitions and order, so the groups still stand together.
    found = linked(members, near)
    large = members.where("block > 0").select("bucket").distinct()
    if large.isEmpty():
        return found
    return found.unionAll(across_blocks(members.join(large, "bucket", "left_semi"), near))


def groups(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fp, root, first``: one fingerprint of the component, and its smallest key that is not null."""
    lowest = prints.groupBy("fp").agg(F.min("key").alias("low"))
    roots = components(links(prints, radius))
    named = lowest.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    firsts = named.groupBy("root").agg(F.min("low").alias("first"))
    return named.join(firsts, "root").select("fp", "root", "first")


def hex16(print_: Column) -> Column:
    return F.lower(F.lpad(F.hex(print_), 16, "0"))


def cluster(df: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """``key, fingerprint, component_id`` of every row.

    A null or empty text has fingerprint zero and links like any other. Repeated rows stay,
    with the same component. The component is its smallest key; null keys are left out of
    that choice, and a component of null keys only is null. Other columns are ignored.
    """
    prints = checkpoint(fingerprints(df, key, text))
    return prints.join(groups(prints, radius), "fp").select(
        F.col("key").alias(key), hex16(F.col("fp")).alias("fingerprint"), F.col("first").alias("component_id")
    )


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """The rows of one document per component, with all columns.

    The document with the smallest key stays, then the smallest hash of its text; a null
    key only where its component has no other. Of rows that repeat key and text one stays.
    """
    prints = checkpoint(fingerprints(df, key, text))
    named = prints.join(groups(prints, radius), "fp")
    rank = F.struct(F.col("key").isNull().alias("unknown"), "key", "version")
    best = named.groupBy("root").agg(F.min(rank).alias("best"))
    chosen = free_name(df, "chosen")
    winners = best.select(F.struct("best.key", "best.version").alias(chosen))
    rows = df.withColumn(chosen, identity(key, text)).join(winners, chosen)
    return first_of_each(rows, chosen).select(*(ref(c) for c in df.columns))
