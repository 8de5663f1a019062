"""Hard negatives from lists that the anchors of a cluster share.

Anchors are clustered by direction. For a cluster with centroid c and widest angle b, no
member u has a product with a candidate i above |u| |i| cos(max(0, angle(i, c) - b)). The
candidates are sorted by that bound once per cluster, and every member walks the list until
the bound of what is left can't reach what it has found: then its result is certified.

A cluster's list is cut into shards of bounded size, and a large cluster into parts, so
that no task holds a list or a cluster whole: rows of a shard stream by in the order Spark
sorted them, past the anchors of one part. The head of each list, the candidates with the
largest bounds, is walked first. What it gives bounds the rest from below, so anchors that it
certifies leave, and others stop sooner in the shards of the tail. Positives (same label)
and negatives (other label, products inside a band of each positive) are two walks over
lists of the same kind. Products are exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lastro.llm.frames import checkpoint, ref


@dataclass(frozen=True)
class Mining:
    """Positives per anchor, negatives per positive, and the band (in percent of the positive's product).

    ``clusters`` are fitted on at most ``sample`` anchors. ``members`` and ``shard`` bound the
    anchors and candidates that meet at a time; ``head`` is the share of a list walked first.
    """

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    clusters: int = 8
    sample: int = 4096
    members: int = 16_384
    shard: int = 16_384
    head: float = 0.1


#: Stands for no id: after all others, and null again in the result.
NO_ID = (1 << 63) - 1
_PACKED = "row long, id long, label long, anchor boolean, norm double, v binary, item int"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes, two, four or eight a component, with their norm. Products must fit a long."""
    for batch in batches:
        norms, packed, items, fits = [], [], [], []
        for v in batch.column("v").to_pylist():
            values = np.array(v, dtype=np.int64)
            norm = float(np.sqrt((values.astype(np.float64) ** 2).sum()))
            top = int(np.abs(values.astype(np.float64)).max(initial=0))
            item = 2 if top < 1 << 15 else 4 if top < 1 << 31 else 8
            norms.append(norm)
            packed.append(values.astype(f"<i{item}").tobytes())
            items.append(item)
            fits.append(norm < 3.0e9)
        rows = pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in ("row", "id", "label", "anchor")), pa.array(norms, pa.float64()),
             pa.array(packed, pa.binary()), pa.array(items, pa.int32())],
            names=["row", "id", "label", "anchor", "norm", "v", "item"],
        )
        yield rows.filter(pa.array(fits, pa.bool_()))


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    """Whole numbers as float64; shorter vectors end in zeros."""
    items = batch.column("item").to_numpy(zero_copy_only=False)
    parts = batch.column("v").to_pylist()
    if len(items) and (items == items[0]).all() and all(len(part) == dim * items[0] for part in parts):
        return np.frombuffer(b"".join(parts), dtype=f"<i{items[0]}").reshape(len(parts), dim).astype(np.float64)
    out = np.zeros((len(parts), dim))
    for number, (part, item) in enumerate(zip(parts, items.tolist(), strict=True)):
        values = np.frombuffer(part, dtype=f"<i{item}")
        out[number, : len(values)] = values
    return out


def _angles(vectors: np.ndarray, norms: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    cosines = (vectors @ centroids.T) / np.where(norms > 0, norms, 1)[:, None]
    return np.arccos(np.clip(cosines, -1, 1))


def _centroids(vectors: np.ndarray, norms: np.ndarray, count: int) -> np.ndarray:
    """Unit centroids of directions, by Lloyd's rounds from a fixed start."""
    units = vectors / np.where(norms > 0, norms, 1)[:, None]
    random = np.random.default_rng(13)
    centroids = units[random.permutation(len(units))[:count]]
    for _ in range(10):
        nearest = (units @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, units)
        lengths = np.linalg.norm(sums, axis=1)
        centroids = np.where(lengths[:, None] > 0, sums / np.where(lengths > 0, lengths, 1)[:, None], centroids)
    return centroids


def _assign(centroids: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors with their cluster and the angle to its centroid (0 for a zero vector: all its products are 0)."""
    for batch in batches:
        norms = batch.column("norm").to_numpy(zero_copy_only=False)
        angles = _angles(_matrix(batch, centroids.shape[1]), norms, centroids)
        cluster = angles.argmin(axis=1)
        own = np.where(norms > 0, angles[np.arange(len(cluster)), cluster] if len(cluster) else 0.0, 0.0)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(cluster, pa.int32()), pa.array(own, pa.float64())],
            names=[*batch.schema.names, "cluster", "angle"],
        )


def _bound(centroids: np.ndarray, widest: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a ``cluster``: the largest product a member of length 1 can have. Angles carry a small slack."""
    for batch in batches:
        norms = batch.column("norm").to_numpy(zero_copy_only=False)
        cluster = batch.column("cluster").to_numpy(zero_copy_only=False)
        vectors = _matrix(batch, centroids.shape[1])
        cosines = np.einsum("ij,ij->i", vectors, centroids[cluster]) / np.where(norms > 0, norms, 1)
        apart = np.arccos(np.clip(cosines, -1, 1)) - widest[cluster] - 1e-6
        bound = norms * np.cos(np.clip(apart, 0, np.pi)) + 1e-9 * norms
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bound, pa.float64())], names=[*batch.schema.names, "bound"])


_KEY = ["key", "cluster", "part", "shard"]
_NEVER = np.iinfo(np.int64).max


class _Walk:
    """The members of one part, and the shard of the list that streams by."""

    def __init__(self, dim: int, keep: int, same: bool):
        self.dim, self.keep, self.same = dim, keep, same
        self.anchors: list[pa.RecordBatch] = []
        self.pending: list[pa.RecordBatch] = []
        self.held, self.size, self.ready = 0, 128, False

    def feed(self, rows: pa.RecordBatch) -> None:
        side = rows.column("side").to_numpy(zero_copy_only=False)
        first = int(np.searchsorted(side, 1))
        if first:
            self.anchors.append(rows.slice(0, first))
        if first < len(side) and self.anchors:  # a list that no anchor walks is passed over
            self.pending.append(rows.slice(first))
            self.held += len(side) - first
            if self.held >= self.size:
                self.flush()

    def _start(self) -> None:
        table = pa.Table.from_batches(self.anchors).combine_chunks().to_batches()[0]
        self.rows = table.column("row").to_numpy(zero_copy_only=False)
        self.labels = table.column("label").to_numpy(zero_copy_only=False)
        self.norms = table.column("norm").to_numpy(zero_copy_only=False)
        self.vectors = _matrix(table, self.dim)
        lows, highs, floors = (table.column(name).to_pylist() for name in ("low", "high", "floor"))
        bands = max(map(len, lows), default=0)
        shape = (len(self.rows), bands)
        self.low, self.high = np.full(shape, _NEVER, dtype=np.int64), np.full(shape, -_NEVER, dtype=np.int64)
        self.floor = np.full(shape, _NEVER, dtype=np.int64)
        for number in range(len(self.rows)):
            count = len(lows[number])
            self.low[number, :count], self.high[number, :count] = lows[number], highs[number]
            self.floor[number, :count] = floors[number]
        self.scores = np.full((*shape, self.keep), -_NEVER, dtype=np.int64)
        self.ids = np.full((*shape, self.keep), NO_ID, dtype=np.int64)
        self.filled = np.zeros((*shape, self.keep), dtype=bool)
        self.open = np.arange(len(self.rows))
        self.size = max(256, (1 << 22) // max(1, len(self.rows)))
        self.ready = True

    def _needed(self) -> np.ndarray:
        """What a product must reach to count: the band, what is kept already, here or in the head."""
        return np.maximum(np.maximum(self.low, self.floor), self.scores[:, :, -1])

    def flush(self) -> None:
        if not self.ready:
            self._start()
        rows = pa.Table.from_batches(self.pending).combine_chunks().to_batches()
        self.pending, self.held = [], 0
        if not len(self.open) or not rows:
            return
        batch = rows[0]
        top = float(batch.column("bound").to_numpy(zero_copy_only=False)[0])
        # Certified: nothing from here on reaches what is needed. Whole numbers, so half a unit is slack enough.
        reach = top * self.norms[self.open] + 0.5
        self.open = self.open[(reach[:, None] >= self._needed()[self.open]).any(axis=1)]
        if not len(self.open):
            return
        vectors, norms = _matrix(batch, self.dim), batch.column("norm").to_numpy(zero_copy_only=False)
        mine = self.vectors[self.open]
        if self.norms[self.open].max() * norms.max() < 2.0**52:  # every sum on the way is exact
            products = (mine @ vectors.T).astype(np.int64)
        else:
            products = mine.astype(np.int64) @ vectors.astype(np.int64).T
        labels = batch.column("label").to_numpy(zero_copy_only=False)
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        if self.same:
            others = batch.column("row").to_numpy(zero_copy_only=False)
            fits = (self.labels[self.open][:, None] == labels) & (self.rows[self.open][:, None] != others)
        else:
            fits = self.labels[self.open][:, None] != labels
        needed = self._needed()[self.open]
        for band in range(self.low.shape[1]):
            inside = fits & (products >= needed[:, band, None]) & (products <= self.high[self.open, band, None])
            member, place = np.nonzero(inside)
            if len(member):
                self._merge(self.open[member], band, products[member, place], ids[place])

    def _merge(self, member: np.ndarray, band: int, scores: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(member)
        old = self.filled[touched, band]
        member = np.concatenate([np.repeat(touched, self.keep).reshape(old.shape)[old], member])
        scores = np.concatenate([self.scores[touched, band][old], scores])
        ids = np.concatenate([self.ids[touched, band][old], ids])
        order = np.lexsort((ids, -scores, member))
        member, scores, ids = member[order], scores[order], ids[order]
        starts = np.flatnonzero(np.r_[True, member[1:] != member[:-1]])
        rank = np.arange(len(member)) - np.repeat(starts, np.diff(np.r_[starts, len(member)]))
        best = rank < self.keep
        member, scores, ids, rank = member[best], scores[best], ids[best], rank[best]
        self.scores[member, band, rank], self.ids[member, band, rank] = scores, ids
        self.filled[member, band, rank] = True

    def found(self) -> Iterator[pa.RecordBatch]:
        if self.pending:
            self.flush()
        if self.ready and self.filled.any():
            member, band, rank = np.nonzero(self.filled)
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.rows[member]), pa.array(band.astype(np.int32)), pa.array(self.scores[member, band, rank]),
                 pa.array(self.ids[member, band, rank])],
                names=["row", "band", "score", "id"],
            )


def _walk(dim: int, keep: int, same: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of groups, anchors before candidates in the order of their bounds -> the best of each group."""
    walk, now = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(name).to_numpy(zero_copy_only=False) for name in _KEY]
        cuts = np.flatnonzero(np.logical_or.reduce([key[1:] != key[:-1] for key in keys])) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for start, stop in zip(edges, edges[1:], strict=False):
            key = tuple(int(key[start]) for key in keys)
            if key != now:
                if walk:
                    yield from walk.found()
                walk, now = _Walk(dim, keep, same), key
            walk.feed(batch.slice(start, stop - start))
    if walk:
        yield from walk.found()


def _best(found: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("row", "band").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def _lists(anchors: DataFrame, candidates: DataFrame, using: Mining, same: bool, dim: int, keep: int, index: tuple, shards: int) -> DataFrame:
    """``row, band, score, id, rank``: the best candidates of each band of each anchor.

    ``anchors`` have ``low, high, floor`` per band. Lists are per cluster and part, and per
    label where only the own label counts.
    """
    centroids, widest = index
    key = F.col("label") if same else F.lit(0).cast("long")
    anchors = anchors.withColumn("key", key)
    groups = anchors.select("key", "cluster", "part").distinct()
    packed = ["row", "id", "label", "norm", "v", "item"]
    if same:
        pairs = candidates.select(*packed, key.alias("key")).join(groups, "key")
    else:  # clusters and their parts: as many as blocks of anchors
        blocks = [F.struct(F.lit(row["cluster"]).alias("cluster"), F.lit(row["part"]).alias("part")) for row in groups.collect()]
        each = F.explode(F.array(*blocks)).alias("block")
        pairs = candidates.select(*packed, key.alias("key"), each).select(*packed, "key", "block.*")
    schema = "row long, id long, label long, norm double, v binary, item int, key long, cluster int, part int"
    bounded = pairs.select(*packed, "key", "cluster", "part").mapInArrow(partial(_bound, centroids, widest), f"{schema}, bound double")
    cuts = bounded.groupBy("cluster").agg(F.percentile_approx("bound", 1 - using.head, 1000).alias("cut"))
    cuts = {row["cluster"]: row["cut"] for row in cuts.collect()}  # one number per cluster
    cut = F.element_at(F.create_map(*(F.lit(part) for pair in cuts.items() for part in pair)), F.col("cluster")) if cuts else F.lit(0.0)
    empty = F.array().cast("array<long>")

    def walked(members: DataFrame, rows: DataFrame) -> DataFrame:
        left = members.select(
            *packed, "key", "cluster", "part", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
            F.lit(0).alias("side"), F.lit(0.0).alias("bound"), "low", "high", "floor",
        )
        right = rows.select(
            *packed, "key", "cluster", "part", F.pmod("row", F.lit(shards)).cast("int").alias("shard"), F.lit(1).alias("side"), "bound",
            empty.alias("low"), empty.alias("high"), empty.alias("floor"),
        )
        lists = left.unionAll(right).repartition(*_KEY).sortWithinPartitions(*_KEY, "side", F.desc("bound"), "id")
        return lists.mapInArrow(partial(_walk, dim, keep, same), "row long, band int, score long, id long")

    head = checkpoint(_best(walked(anchors, bounded.where(F.col("bound") >= cut)), keep))
    # The worst of a full band is what the tail has to reach.
    full = head.where(F.col("rank") == keep).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("band", "score"))).alias("got"))
    known = anchors.join(full, "row", "left").withColumn(
        "floor", F.transform("floor", lambda least, band: F.coalesce(F.element_at("got", band), least))
    )
    reach = cut * F.col("norm") + 0.5
    needed = F.zip_with("floor", "low", lambda floor, low: F.greatest(floor, low))
    open_ones = known.where(F.exists(needed, lambda least: reach >= least)).drop("got")
    tail = walked(open_ones, bounded.where(F.col("bound") < cut))
    return checkpoint(_best(head.drop("rank").unionAll(tail), keep))


def _scaled(number: str, percent: int, up: bool) -> Column:
    """``number * percent / 100`` rounded up or down, in whole numbers."""
    whole = F.expr(f"cast({number} as decimal(20,0)) * {percent}")
    return (F.ceil(whole / 100) if up else F.floor(whole / 100)).cast("long")


def mine(
    df: DataFrame, anchor: Column, key: str = "vec_id", vector: str = "vector", label: str = "label", using: Mining = Mining()
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vector`` is an array of whole numbers. Rows without a vector or label, or with a null
    component, take no part, nor do those so long (3e9) that a product may not fit a long.
    Shorter vectors end in zeros, an empty one is the zero vector. Rows that repeat key,
    vector and label are one. Rows without key are candidates like others, after equal ones.
    Other columns are ignored. Without anchors, or any table of rows, the result is empty.
    """
    spark = df.sparkSession
    rows = df.select(
        ref(key).cast("long").alias("id"), ref(label).cast("long").alias("label"), ref(vector).cast("array<long>").alias("v"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    ).where("label is not null and v is not null and not exists(v, x -> x is null)")
    named = rows.withColumn("row", F.xxhash64("id", "label", "v")).groupBy("row").agg(
        *(F.first(name).alias(name) for name in ("id", "label", "v", "anchor"))
    )
    named = named.select("row", F.coalesce("id", F.lit(NO_ID)).alias("id"), "label", "anchor", "v")
    packed = checkpoint(named.mapInArrow(_pack, _PACKED))
    total, dim = packed.agg(F.count(F.lit(1)), F.max(F.length("v") / F.col("item"))).first()
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    sample = packed.where("anchor").orderBy(F.xxhash64("row"), "row").limit(using.sample).toArrow()
    if not sample.num_rows:
        return spark.createDataFrame([], out)
    dim, batch = max(1, int(dim)), sample.combine_chunks().to_batches()[0]
    norms = batch.column("norm").to_numpy(zero_copy_only=False)
    centroids = _centroids(_matrix(batch, dim), norms, using.clusters)
    anchors = packed.where("anchor").mapInArrow(partial(_assign, centroids), f"{_PACKED}, cluster int, angle double")
    anchors = checkpoint(anchors)
    told = anchors.groupBy("cluster").agg(F.max("angle").alias("widest"), F.count(F.lit(1)).alias("n")).collect()
    widest, parts = np.zeros(len(centroids)), [1] * len(centroids)
    for row in told:  # one row per cluster
        widest[row["cluster"]], parts[row["cluster"]] = row["widest"], -(-row["n"] // using.members)
    part = F.pmod("row", F.get(F.array(*map(F.lit, parts)), "cluster")).cast("int")
    anchors = anchors.drop("angle", "anchor").withColumn("part", part)
    shards, index = max(1, -(-total // using.shard)), (centroids, widest)

    def bands(low: Column, high: Column) -> dict[str, Column]:
        return {"low": low, "high": high, "floor": F.transform(low, lambda _: F.lit(-NO_ID).cast("long"))}

    whole = F.array(F.lit(-NO_ID).cast("long")), F.array(F.lit(NO_ID).cast("long"))
    positives = _lists(anchors.withColumns(bands(*whole)), packed, using, True, dim, using.positives, index, shards)
    positives = positives.select(
        "row", F.col("id").alias("positive"), "score", (F.col("rank") - 1).alias("band"),
        _scaled("score", using.low, True).alias("least"), _scaled("score", using.high, False).alias("most"),
    )
    per_anchor = positives.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("band", "least", "most"))).alias("bands"))
    asked = anchors.join(per_anchor, "row").withColumns(
        bands(F.transform("bands", lambda b: b["least"]), F.transform("bands", lambda b: b["most"]))
    )
    found = _lists(asked.drop("bands"), packed, using, False, dim, using.negatives, index, shards)
    joined = found.join(positives, ["row", "band"]).join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
    shown = lambda name: F.when(F.col(name) != NO_ID, F.col(name))
    return joined.select(
        "anchor_id", shown("positive").alias("positive_id"), "rank", shown("id").alias("negative_id"),
        positives["score"].alias("positive_score"), found["score"].alias("negative_score"),
    )


def report(embeddings: DataFrame, using: Mining = Mining()) -> DataFrame:
    """Hard negatives of every fiftieth vector; components in 256ths, every seventh label moved on by one."""
    key, vector, label = ref("vec_id"), ref("embedding"), ref("label")
    moved = F.when(key % 7 == 0, (label + 1) % 10).otherwise(label)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.when(finite, F.transform(vector, lambda x: F.floor(x.cast("double") * 256)))
    rows = embeddings.select(key.alias("vec_id"), moved.alias("label"), whole.alias("vector"))
    return mine(rows, F.col("vec_id") % 50 == 0, using=using)
