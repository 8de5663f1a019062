"""Count-min sketches of 64-bit hashes: one per task, merged by segments, of fixed size."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

SEGMENT = 1 << 16
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Shape:
    """``depth`` rows of ``2 ** bits`` cells. A cell counts 0, 1 or 2, where 2 is two or more.

    Merged, only "two or more" is kept: depth * 2**bits / 8 bytes, whatever the corpus.
    A narrow sketch calls more hashes repeated; it never calls a repeated one single.
    """

    bits: int = 25
    depth: int = 3

    def cells(self, hashes: np.ndarray, row: int) -> np.ndarray:
        return (hashes * np.uint64(_FACTORS[row])) >> np.uint64(64 - self.bits)

    @property
    def bytes(self) -> int:
        return self.depth * (1 << self.bits) // 8


class Repeated:
    """The merged sketch: which hashes may occur twice or more."""

    def __init__(self, shape: Shape, planes: list[np.ndarray]) -> None:
        self.shape, self.planes = shape, planes

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), dtype=bool)
        for row, plane in enumerate(self.planes):
            cell = self.shape.cells(hashes, row)
            out &= (plane[cell >> np.uint64(3)] >> (np.uint64(7) - (cell & np.uint64(7))).astype(np.uint8)) & 1 == 1
        return out


def _count(
    shape: Shape, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((shape.depth, 1 << shape.bits), dtype=np.uint8)
    for batch in batches:
        for part in hashes(batch):
            for row in range(shape.depth):
                cells, times = np.unique(shape.cells(part, row), return_counts=True)
                counts[row, cells] = np.minimum(counts[row, cells] + np.minimum(times, 2), 2)
    pack = zstandard.ZstdCompressor(level=1)
    size = min(SEGMENT, 1 << shape.bits)
    for row in range(shape.depth):
        found: list[tuple[int, bytes, bytes]] = []
        for segment, cells in enumerate(counts[row].reshape(-1, size)):
            if cells.any():
                once, twice = np.packbits(cells >= 1).tobytes(), np.packbits(cells >= 2).tobytes()
                found.append((segment, pack.compress(once), pack.compress(twice)))
        if found:
            segments, once, twice = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row] * len(found), pa.int64()), pa.array(segments, pa.int64()),
                 pa.array(once, pa.binary()), pa.array(twice, pa.binary())],
                names=["row", "segment", "once", "twice"],
            )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by row and segment: the bits that are set twice, or once in two parts."""
    unpack = zstandard.ZstdDecompressor()
    key, once, twice = None, None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([twice.tobytes()], pa.binary())],
            names=["row", "segment", "twice"],
        )

    for batch in batches:
        for row, segment, first, second in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            a = np.frombuffer(unpack.decompress(first), dtype=np.uint8)
            b = np.frombuffer(unpack.decompress(second), dtype=np.uint8)
            if (row, segment) != key:
                if key is not None:
                    yield out()
                key, once, twice = (row, segment), a, b
            else:
                once, twice = once | a, twice | b | (once & a)
    if key is not None:
        yield out()


def repeated(
    df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], shape: Shape = Shape()
) -> Repeated:
    """Sketch what ``hashes`` finds in the rows, each time it occurs.

    A task's sketch holds depth * 2**bits bytes and leaves it as compressed segments of
    cells; tasks are at most as many as shuffle partitions, so what is merged is bounded
    too. What reaches the driver is the merged bit planes, ``shape.bytes`` at most.
    """
    spark = df.sparkSession
    parts = df.coalesce(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(
        partial(_count, shape, hashes), "row long, segment long, once binary, twice binary"
    )
    merged = (
        parts.repartition("row", "segment")
        .sortWithinPartitions("row", "segment")
        .mapInArrow(_merge, "row long, segment long, twice binary")
    )
    size = min(SEGMENT, 1 << shape.bits) // 8
    planes = [np.zeros(max(1, (1 << shape.bits) // 8), dtype=np.uint8) for _ in range(shape.depth)]
    for row, segment, twice in merged.collect():  # shape.bytes at most
        planes[row][segment * size : segment * size + len(twice)] = np.frombuffer(twice, dtype=np.uint8)
    return Repeated(shape, planes)
