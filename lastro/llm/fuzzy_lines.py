"""Fuzzy line dedup: MinHash signatures, banding, exact Jaccard, and one line per component.

A line is compared in lower case with single spaces. Its shingles are runs of ``SHINGLE``
characters; a shorter line is one shingle. Signatures come from one hash per shingle and
``bands * rows`` cheap variations of it, for all lines of a piece at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lastro.llm.buckets import LINKS, across_blocks, crowded
from lastro.llm.components import components
from lastro.llm.frames import checkpoint, identity, ref
from lastro.llm.sketch import Shape, repeated


@dataclass(frozen=True)
class Banding:
    """Two lines of similarity s share a bucket with probability 1 - (1 - s**rows)**bands:
    0.985 at 0.8, 0.998 at 0.85 and 0.99996 at 0.9 for the default."""

    shingle: int = 8
    bands: int = 8
    rows: int = 4
    similarity: float = 0.8


#: Lines compared with each other at a time; larger buckets meet block by block.
BLOCK = 256
#: Characters whose hashes are worked on together; they stay in the processor's cache.
CHARS = 1 << 16
_BASE = np.uint64(0x9E3779B97F4A7C15)


def normal(line: str) -> str:
    """Lower case, single spaces, none at the ends. Empty for a line without visible characters."""
    return " ".join(line.lower().split())


def normal_lines(text: str | None) -> list[str]:
    """``normal`` of each line; the text is put into lower case as a whole."""
    return [" ".join(line.split()) for line in (text or "").lower().split("\n")]


def line_id(line: str) -> int:
    """64-bit hash of a normal line, signed."""
    value = xxhash.xxh3_64_intdigest(line.encode())
    return value - (1 << 64) if value >> 63 else value


def _rolled(lines: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the lines, one after the other, and each line's number of them (at least one)."""
    padded = [line.ljust(size, "\0") for line in lines]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter(map(len, padded), dtype=np.int64, count=len(padded))
    ends = np.cumsum(lengths)
    hashes = codes.astype(np.uint64)
    count = len(hashes) - size + 1
    rolled = hashes[:count].copy()
    for offset in range(1, size):
        rolled *= _BASE
        rolled += hashes[offset : offset + count]
    rolled ^= rolled >> np.uint64(32)
    rolled *= np.uint64(0xD6E8FEB86659FD93)
    rolled ^= rolled >> np.uint64(32)
    whole = np.ones(count, dtype=bool)  # without shingles that would run into the next line
    for offset in range(1, size):
        inside = ends - offset
        whole[inside[inside < count]] = False
    return rolled[whole], lengths - size + 1


def _signatures(lines: list[str], shape: Banding) -> np.ndarray:
    """``bands`` bucket hashes of each line."""
    count = shape.bands * shape.rows
    random = np.random.default_rng(20)  # the same variations on every executor
    factors = random.integers(0, 1 << 32, count, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    masks = random.integers(0, 1 << 32, count, dtype=np.uint64).astype(np.uint32)
    out = np.zeros((len(lines), shape.bands), dtype=np.uint64)
    low = 0
    while low < len(lines):
        high, held = low, 0
        while high < len(lines) and (high == low or held + len(lines[high]) <= CHARS):
            held += max(shape.shingle, len(lines[high]))
            high += 1
        rolled, counts = _rolled(lines[low:high], shape.shingle)
        short = rolled.astype(np.uint32)
        starts = np.cumsum(counts) - counts
        keys = np.zeros((shape.bands, high - low), dtype=np.uint64)
        varied = np.empty_like(short)
        for number in range(count):
            np.bitwise_xor(short, masks[number], out=varied)
            np.multiply(varied, factors[number], out=varied)
            band = number // shape.rows
            keys[band] = keys[band] * _BASE + np.minimum.reduceat(varied, starts) + np.uint64(number)
        keys ^= keys >> np.uint64(29)
        keys *= np.uint64(0xC2B2AE3D27D4EB4F)
        out[low:high] = keys.T
        low = high
    return out.view(np.int64)


_LINES = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))]
)


def _lines(shape: Banding, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every visible line of every row; its buckets where the line first occurs in the batch."""
    for batch in batches:
        owner, number, ids, first = [], [], [], []
        distinct: dict[int, str] = {}
        for index, text in enumerate(batch.column(0).to_pylist()):
            for n, plain in enumerate(normal_lines(text)):
                if plain:
                    ident = line_id(plain)
                    first.append(ident not in distinct)
                    if first[-1]:
                        distinct[ident] = plain
                    owner.append(index)
                    number.append(n)
                    ids.append(ident)
        keys = _signatures(list(distinct.values()), shape)
        fresh = np.array(first, dtype=bool)
        place = np.cumsum(fresh) - 1
        offsets = np.concatenate([[0], np.cumsum(np.where(fresh, shape.bands, 0))]).astype(np.int32)
        values = keys[place[fresh]].ravel() if len(fresh) else np.zeros(0, dtype=np.int64)
        bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=pa.array(~fresh))
        taken = pa.array(owner, pa.int64())
        rest = [column.take(taken) for column in batch.columns[1:]]
        yield pa.RecordBatch.from_arrays(
            [*rest, pa.array(ids, pa.int64()), pa.array(number, pa.int64()), bands],
            names=[*batch.schema.names[1:], "id", "n", "bands"],
        )


def occurrences(df: DataFrame, key: str, text: str, shape: Banding = Banding()) -> DataFrame:
    """``key, version, id, n, bands`` of every line with a visible character."""
    rows = df.select(ref(text).alias("t"), ref(key).alias("key"), F.xxhash64(ref(text)).alias("version"))
    return rows.mapInArrow(partial(_lines, shape), T.StructType([*rows.drop("t").schema.fields, *_LINES.fields]))


def _ids(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """Each id twice, so that the sketch remembers it."""
    ids = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
    yield np.concatenate([ids, ids])


def _wanted(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct normal lines of each batch whose id may be wanted."""
    for batch in batches:
        lines: dict[int, str] = {}
        for text in batch.column(0).to_pylist():
            for plain in normal_lines(text):
                if plain:
                    lines.setdefault(line_id(plain), plain)
        ids = np.fromiter(lines, dtype=np.int64, count=len(lines))
        maybe = shared.value(ids.view(np.uint64))
        texts = [line for line, yes in zip(lines.values(), maybe.tolist(), strict=True) if yes]
        yield pa.RecordBatch.from_arrays([pa.array(ids[maybe]), pa.array(texts, pa.string())], names=["id", "line"])


def shingles(line: str, size: int) -> set[str]:
    return {line[i : i + size] for i in range(max(1, len(line) - size + 1))}


def similar(a: set[str], b: set[str], similarity: float) -> bool:
    small, large = sorted((len(a), len(b)))
    if small < similarity * large:
        return False
    both = len(a & b)
    return both >= similarity * (small + large - both)


#: Lines from which on a group is compared by counting. Both ways find the same components.
MANY = 16
#: Characters of groups whose shingles are hashed together; they stay in the processor's cache.
PIECE = 1 << 16


def _few(sets: list[set], similarity: float) -> list[tuple[int, int]]:
    links: list[tuple[int, int]] = []
    unseen = list(range(len(sets)))
    while unseen:
        queue = [unseen.pop(0)]
        while queue and unseen:
            node, rest = queue.pop(), []
            for other in unseen:
                if similar(sets[node], sets[other], similarity):
                    links.append((node, other))
                    queue.append(other)
                else:
                    rest.append(other)
            unseen = rest
    return links


def _many(hashed: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """A line meets all others at once, by counting which of its shingles they have.

    Memory grows with the group's shingles, not with its pairs.
    """
    counts = np.fromiter(map(len, hashed), dtype=np.int64, count=len(hashed))
    owner, hashes = np.repeat(np.arange(len(hashed)), counts), np.concatenate(hashed)
    hashes = hashes[np.lexsort((hashes, owner))]  # the owners stay as they were
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    distinct, codes = np.unique(hashes[fresh], return_inverse=True)
    sizes = np.bincount(owner[fresh], minlength=len(hashed))
    starts = np.cumsum(sizes) - sizes
    has = np.zeros(len(distinct), dtype=np.int16)
    unseen = np.ones(len(hashed), dtype=bool)
    links: list[tuple[int, int]] = []
    for seed in range(len(hashed)):
        if not unseen[seed]:
            continue
        unseen[seed], queue = False, [seed]
        while queue and unseen.any():
            node = queue.pop()
            own = codes[starts[node] : starts[node] + sizes[node]]
            has[own] = 1
            both = np.add.reduceat(has[codes], starts, dtype=np.int64)
            has[own] = 0
            found = np.flatnonzero(unseen & (both >= similarity * (sizes + sizes[node] - both)))
            unseen[found] = False
            links += [(node, other) for other in found.tolist()]
            queue += found.tolist()
    return links


def _hashed(lines: list[str], size: int) -> list[np.ndarray]:
    """Each line's shingles as 64-bit hashes, repeats included."""
    hashes, counts = _rolled(lines, size)
    return np.split(hashes, np.cumsum(counts)[:-1])


def _spanning(hashed: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Spanning links of exact Jaccard similarity, by breadth-first search over lines not yet reached."""
    if len(hashed) >= MANY:
        return _many(hashed, similarity)
    return _few([set(own.tolist()) for own in hashed], similarity)


def _alike(shape: Banding, group: pa.RecordBatch) -> list[tuple[int, int]]:
    return _spanning(_hashed(group.column("line").to_pylist(), shape.shingle), shape.similarity)


class _Reached:
    """Which lines the links of this task connect already. Grows with the links found, not with the pairs."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, node: int) -> int:
        path = []
        while (above := self.up.get(node, node)) != node:
            path.append(node)
            node = above
        for below in path:
            self.up[below] = node
        return node

    def one(self, nodes: list[int]) -> bool:
        first = self.root(nodes[0])
        return all(self.root(node) == first for node in nodes[1:])

    def join(self, a: int, b: int) -> None:
        self.up[self.root(a)] = self.root(b)


def _linked_lines(shape: Banding, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with the same ``bucket, block`` are one group; groups that are connected already are passed over."""
    reached = _Reached()

    def links(groups: list[tuple[list[int], list[str]]]) -> Iterator[pa.RecordBatch]:
        groups = [(ids, lines) for ids, lines in groups if len(ids) > 1 and not reached.one(ids)]
        if not groups:
            return
        hashed = _hashed([line for _, lines in groups for line in lines], shape.shingle)
        found, at = [], 0
        for ids, _ in groups:
            own, at = hashed[at : at + len(ids)], at + len(ids)
            if not reached.one(ids):
                for a, b in _spanning(own, shape.similarity):
                    reached.join(ids[a], ids[b])
                    found.append((ids[a], ids[b]))
        if found:
            yield _pairs(found)

    key, ids, lines = None, [], []  # the last group, which may go on
    waiting: list[tuple[list[int], list[str]]] = []
    held = 0
    for batch in batches:
        bucket = batch.column("bucket").to_numpy(zero_copy_only=False)
        block = batch.column("block").to_numpy(zero_copy_only=False)
        if not len(bucket):
            continue
        all_ids, all_lines = batch.column("id").to_pylist(), batch.column("line").to_pylist()
        edges = [0, *(np.flatnonzero((bucket[1:] != bucket[:-1]) | (block[1:] != block[:-1])) + 1).tolist(), len(bucket)]
        for start, stop in zip(edges, edges[1:], strict=False):
            now = (bucket[start], block[start])
            if now != key:
                waiting.append((ids, lines))
                held += sum(map(len, lines))
                key, ids, lines = now, [], []
                if held > PIECE:
                    yield from links(waiting)
                    waiting, held = [], 0
            ids = ids + all_ids[start:stop]
            lines = lines + all_lines[start:stop]
    yield from links([*waiting, (ids, lines)])


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _of_groups(groups: DataFrame, shape: Banding) -> DataFrame:
    """``a, b`` of rows that are sorted by ``bucket, block``."""
    return groups.mapInArrow(partial(_linked_lines, shape), LINKS)


def links(
    df: DataFrame, lines: DataFrame, text: str, shape: Banding = Banding(), block: int = BLOCK,
    sketch: Shape = Shape(bits=25, depth=1),
) -> DataFrame:
    """``a, b``: spanning links between distinct lines that share a bucket and are similar.

    Only lines that share a bucket with another are fetched as text, in a second pass that
    a bit plane of fixed size thins out before the join by id.
    """
    spread = lines.where("bands is not null").select("id", F.explode("bands").alias("bucket"))
    members = checkpoint(crowded(spread, block))
    # Similar lines share most of their buckets: of buckets with the same ids one is enough.
    sets = members.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"),
        F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"),
    )
    members = checkpoint(members.join(sets.groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")), "bucket", "left_semi"))
    wanted = members.select("id").distinct()
    shared = df.sparkSession.sparkContext.broadcast(repeated(wanted, _ids, sketch))
    found = df.select(ref(text).alias("t")).mapInArrow(partial(_wanted, shared), "id long, line string")
    texts = checkpoint(found.join(wanted, "id", "left_semi").groupBy("id").agg(F.min("line").alias("line")))
    told = members.join(texts, "id")
    out = _of_groups(told.repartition("bucket", "block").sortWithinPartitions("bucket", "block", "id"), shape)
    large = members.where("block > 0").select("bucket").distinct()
    if large.isEmpty():
        return out
    return out.unionAll(across_blocks(told.join(large, "bucket", "left_semi"), partial(_alike, shape)))


def repeated_lines(df: DataFrame, key: str = "doc_id", text: str = "text", shape: Banding = Banding()) -> DataFrame:
    """``key, version, n, line_class, first`` of every line that is equal or similar to another.

    ``line_class`` names the component; ``first`` marks its one line that stays: that of
    the smallest key (null before all), then the smallest place, then the smallest hash
    of the text.
    """
    lines = checkpoint(occurrences(df, key, text, shape))
    roots = checkpoint(components(links(df, lines, text, shape)))
    place = F.struct("key", "n", "version")
    each = lines.groupBy("id").agg(F.min(place).alias("low"), F.count(F.lit(1)).alias("times"))
    named = each.join(roots, F.col("id") == F.col("node"), "left")
    shared = named.where("times > 1 or root is not null").select("id", "low", F.coalesce("root", "id").alias("root"))
    best = shared.groupBy("root").agg(F.min("low").alias("best"))
    chosen = shared.join(best, "root").select("id", "root", "best")
    return lines.join(chosen, "id").select(
        "key", "version", "n", F.col("root").alias("line_class"), (place == F.col("best")).alias("first")
    )


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, removed = [], []
        for text, gone in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if gone:
                drop = set(gone)
                text = "\n".join(line for n, line in enumerate(text.split("\n")) if n not in drop)
            texts.append(text)
            removed.append(len(gone or ()))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[2:], pa.array(texts, pa.string()), pa.array(removed, pa.int64())],
            names=[*batch.schema.names[2:], "kept", "removed"],
        )


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text", shape: Banding = Banding()) -> DataFrame:
    """The rows, their text without lines whose component has an earlier line; all columns stay.

    Every row stays, also one that loses all its lines. Lines without a visible character
    are not compared and stay. A null text stays null. Rows that repeat a key and a text
    are one document and end alike; a null key is smaller than any other.
    """
    names = [f"c{i}" for i in range(len(df.columns))]
    gone = (
        repeated_lines(df, key, text, shape)
        .where(~F.col("first"))
        .groupBy(F.struct("key", "version").alias("id"))
        .agg(F.collect_set("n").alias("gone"))
    )
    rows = df.select(
        ref(text).alias("t"), identity(key, text).alias("id"), *(ref(c).alias(n) for c, n in zip(df.columns, names, strict=True))
    )
    joined = rows.join(gone, "id", "left").select("t", "gone", *names)
    schema = T.StructType([*joined.select(*names).schema.fields, T.StructField("kept", T.StringType()), T.StructField("removed", T.LongType())])
    rebuilt = joined.mapInArrow(_rebuild, schema)
    return rebuilt.select(
        *(F.col("kept").alias(c) if c == text else F.col(n).alias(c) for c, n in zip(df.columns, names, strict=True))
    )


def report(df: DataFrame, key: str = "doc_id", text: str = "text", shape: Banding = Banding()) -> DataFrame:
    """``key, n_lines, n_removed, kept_sha256, removed`` per distinct document: places of the lines that go."""
    rows = df.select(ref(key).alias("key"), ref(text).alias("t"), identity(key, text).alias("id"))
    lost = (
        repeated_lines(df, key, text, shape)
        .groupBy(F.struct("key", "version").alias("id"))
        .agg(F.sort_array(F.collect_set(F.when(~F.col("first"), F.col("n")))).alias("removed"))
    )
    all_lines = F.split(F.coalesce("t", F.lit("")), "\n", -1)
    gone = F.coalesce("removed", F.array().cast("array<bigint>"))
    left = F.array_join(F.filter(all_lines, lambda _, n: ~F.array_contains(gone, n.cast("long"))), "\n")
    kept = F.when(F.size(gone) == 0, F.coalesce("t", F.lit(""))).otherwise(left)  # most documents lose nothing
    return rows.join(lost, "id", "left").select(
        F.col("key").alias(key),
        F.size(all_lines).cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_removed"),
        F.sha2(kept, 256).alias("kept_sha256"),
        F.array_join(gone, ",").alias("removed"),
    )
