"""Repeated word windows, found by a count-min prefilter and grouped exactly.

A window's anchor is the smallest-hashed run of ``gram`` words in it, the leftmost of
equals: a function of the window's words, so equal windows have equal anchors at equal
places, and neighbouring windows mostly share one. The sketch counts anchors, once per
place. A window's count is at most its anchor's, so the estimate is never too low, and a
run of windows costs the sketch one update. The second pass groups only windows whose
anchor is estimated repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lastro.llm.frames import checkpoint, identity, ref
from lastro.llm.sketch import Repeated, Shape, repeated
from lastro.llm.words import WordHash, pieces, window_hashes, word_hashes

WINDOW, GRAM = 20, 8
#: Rows of one anchor above which its windows are grouped each by itself.
HEAVY = 100_000


class _Anchored:
    """The windows of some texts: place, hash, anchor's place and hash, and text, per window."""

    def __init__(self, texts: list[bytes], known: WordHash, size: int, gram: int) -> None:
        hashes, counts = word_hashes(texts, known)
        self.starts = np.concatenate([[0], np.cumsum(counts)])
        empty = np.zeros(0, dtype=np.int64)
        self.place = self.anchor_place = self.text = empty
        self.hash = self.anchor = empty.astype(np.uint64)
        windows = window_hashes(hashes, size)
        if not len(windows):
            return
        text = np.repeat(np.arange(len(texts)), counts)
        grams = window_hashes(hashes, gram)
        inside = np.lib.stride_tricks.sliding_window_view(grams, size - gram + 1)
        place = np.flatnonzero(text[: len(windows)] == text[size - 1 :])
        self.anchor_place = place + inside.argmin(axis=1)[place]
        self.place, self.hash, self.text = place, windows[place], text[place]
        self.anchor = grams[self.anchor_place]


def _anchors(size: int, gram: int, batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    known = WordHash()
    for _, texts in pieces(batch.column(0).to_pylist()):
        found = _Anchored(texts, known, size, gram)
        first = np.ones(len(found.anchor_place), dtype=bool)  # places never fall from window to window
        first[1:] = found.anchor_place[1:] != found.anchor_place[:-1]
        yield found.anchor[first]


_FOUND = ("anchor", "key", "version", "start", "stop", "windows")


def _candidates(size: int, gram: int, shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of windows to group (with an anchor), and word ranges found repeated here (without)."""
    maybe: Repeated = shared.value
    for batch in batches:
        known = WordHash()
        keys, versions = batch.column("key").to_pylist(), batch.column("version").to_pylist()
        texts = batch.column("t").to_pylist()
        order = sorted(range(len(keys)), key=lambda i: (keys[i] is not None, keys[i], versions[i]))
        key_type = batch.schema.field("key").type
        for first, part in pieces([texts[i] for i in order]):
            rows: list[tuple] = []
            at = [order[first + i] for i in range(len(part))]
            same = [i > 0 and keys[at[i]] == keys[at[i - 1]] for i in range(len(part))]
            rank = np.cumsum(~np.array(same, dtype=bool)) if part else np.zeros(0, dtype=np.int64)
            found = _Anchored(part, known, size, gram)
            take = np.flatnonzero(maybe(found.anchor))
            place, text, anchor, window = found.place[take], found.text[take], found.anchor[take], found.hash[take]
            start = place - found.starts[text]
            # Exact grouping here by (anchor, window); the first has the smallest key and start.
            sort = np.lexsort((start, rank[text], window, anchor))
            head = np.ones(len(sort), dtype=bool)
            head[1:] = (anchor[sort][1:] != anchor[sort][:-1]) | (window[sort][1:] != window[sort][:-1])
            lead = sort[np.maximum.accumulate(np.where(head, np.arange(len(sort)), 0))] if len(sort) else sort
            later = np.zeros(len(sort), dtype=bool)
            later[sort] = (rank[text][sort] != rank[text][lead]) | (start[sort] != start[lead])
            # Runs of neighbours with the same anchor place and the same fate.
            cut = np.ones(len(take), dtype=bool)
            spot = found.anchor_place[take]
            cut[1:] = (
                (place[1:] != place[:-1] + 1) | (text[1:] != text[:-1]) | (later[1:] != later[:-1])
                | (~later[1:] & (spot[1:] != spot[:-1]))
            )
            edges = [*np.flatnonzero(cut).tolist(), len(take)]
            signed, anchors = window.view(np.int64), anchor.view(np.int64).tolist()
            starts, owners, fates = start.tolist(), text.tolist(), later.tolist()
            for low, high in zip(edges, edges[1:], strict=False):
                owner = at[owners[low]]
                if fates[low]:
                    stop = starts[high - 1] + size
                    rows.append((None, keys[owner], versions[owner], starts[low], stop, None))
                else:
                    rows.append((anchors[low], keys[owner], versions[owner], starts[low], None, signed[low:high]))
            if rows:
                yield _batch(rows, key_type)


def _batch(rows: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
    types = (pa.int64(), key_type, pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)], names=list(_FOUND)
    )


def _repeats(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by slot, anchor, key and start: word ranges of windows seen before."""
    present, seen = None, {}
    for batch in batches:
        rows: list[tuple] = []
        columns = (batch.column(name).to_pylist() for name in ("slot", *_FOUND))
        for slot, anchor, key, version, start, stop, windows in zip(*columns, strict=True):
            if windows is None:
                rows.append((key, version, start, stop))
                continue
            if (slot, anchor) != present:
                present, seen = (slot, anchor), {}
            low = None
            for offset, window in enumerate(windows):
                here = (key, start + offset)
                if seen.setdefault(window, here) != here:
                    low = offset if low is None else low
                elif low is not None:
                    rows.append((key, version, start + low, start + offset - 1 + size))
                    low = None
            if low is not None:
                rows.append((key, version, start + low, start + len(windows) - 1 + size))
        if rows:
            kinds = (batch.schema.field("key").type, pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)],
                names=["key", "version", "start", "stop"],
            )


def repeated_ranges(
    df: DataFrame, key: str = "doc_id", text: str = "text", size: int = WINDOW, gram: int = GRAM,
    shape: Shape = Shape(), heavy: int = HEAVY,
) -> DataFrame:
    """``key, version, start, stop``: word ranges covered by windows that also start earlier.

    A window is in one range at least; ranges of one document may overlap. Before the
    shuffle a task settles the repeats it sees itself, so a passage in a third of all rows
    is one row per few megabytes of text. Anchors with over ``heavy`` rows are parted
    into their windows, each grouped for itself.
    """
    spark = df.sparkSession
    rows = df.select(ref(text).alias("t"), ref(key).alias("key"), F.xxhash64(ref(text)).alias("version"))
    sketch = spark.sparkContext.broadcast(repeated(rows.select("t"), partial(_anchors, size, gram), shape))
    types = dict(
        zip(_FOUND, (T.LongType(), rows.schema["key"].dataType, *[T.LongType()] * 3, T.ArrayType(T.LongType())),
            strict=True)
    )
    schema = T.StructType([T.StructField(name, kind) for name, kind in types.items()])
    found = checkpoint(rows.mapInArrow(partial(_candidates, size, gram, sketch), schema))
    counts = found.where("anchor is not null").groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    many = counts.where(F.col("n") > heavy).select(F.col("anchor").alias("hot"))
    slot = F.coalesce("anchor", F.xxhash64("key", "version", "start"))
    marked = found.join(many, F.col("anchor") == F.col("hot"), "left")
    whole = marked.where("hot is null").select(slot.alias("slot"), *_FOUND)
    parted = (
        marked.where("hot is not null")
        .select(*_FOUND, F.posexplode("windows").alias("offset", "window"))
        .select(
            F.xxhash64("anchor", "window").alias("slot"), "anchor", "key", "version",
            (F.col("start") + F.col("offset")).alias("start"), "stop", F.array("window").alias("windows"),
        )
    )
    if many.isEmpty():
        each = found.select(slot.alias("slot"), *_FOUND)
    else:
        each = whole.unionByName(parted)
    sorted_ = each.repartition("slot").sortWithinPartitions("slot", "anchor", "key", "start")
    out = T.StructType([T.StructField("key", types["key"]), *(T.StructField(c, T.LongType()) for c in ("version", "start", "stop"))])
    return sorted_.mapInArrow(partial(_repeats, size), out)


def _remove(texts_too: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, removed, digests, kept_texts = [], [], [], []
        for text, ranges in zip(batch.column("t").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
            words = (text or "").encode().split()
            counts.append(len(words))
            if ranges:
                keep = np.ones(len(words), dtype=bool)
                for span in ranges:
                    keep[span["start"] : span["stop"]] = False
                words = [words[i] for i in np.flatnonzero(keep).tolist()]
            removed.append(counts[-1] - len(words))
            joined = b" ".join(words)
            digests.append(hashlib.sha256(joined).hexdigest())
            kept_texts.append(joined.decode() if texts_too else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(digests, pa.string()), pa.array(kept_texts, pa.string())],
            names=["key", "n_words", "n_removed", "kept_sha256", "kept"],
        )


def remove(
    df: DataFrame, key: str = "doc_id", text: str = "text", size: int = WINDOW, gram: int = GRAM,
    shape: Shape = Shape(), heavy: int = HEAVY, texts: bool = True,
) -> DataFrame:
    """``key, n_words, n_removed, kept_sha256, kept`` of every row.

    Words covered by a window of ``size`` words that starts earlier, under a smaller key or
    at a smaller place under the same key, are removed; ``kept`` has the rest, joined by a
    space (null without ``texts``). Windows are judged on the input. Null keys come before
    all others. Rows that repeat a key and a text are one document: none is earlier. Rows
    that share a key but not the text are one document in several versions: a window goes
    if it starts at a smaller place in any. A null text has no words. Other columns are
    ignored. Words and windows are told apart by 64-bit hashes of the window and of its anchor.
    """
    ranges = repeated_ranges(df, key, text, size, gram, shape, heavy)
    spans = ranges.groupBy(F.struct("key", "version").alias("id")).agg(
        F.collect_set(F.struct("start", "stop")).alias("ranges")
    )
    rows = df.select(ref(key).alias("key"), ref(text).alias("t"), identity(key, text).alias("id"))
    joined = rows.join(spans, "id", "left").select("key", "t", "ranges")
    out = joined.select("key").schema.add("n_words", "long").add("n_removed", "long")
    return joined.mapInArrow(partial(_remove, texts), out.add("kept_sha256", "string").add("kept", "string")).select(
        F.col("key").alias(key), "n_words", "n_removed", "kept_sha256", "kept"
    )
