"""Hard negatives against brute force: small shards and parts, ties, and products beyond 53 bits."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lastro.llm.negatives import Mining, mine


def brute(rows, positives=5, negatives=3):
    ids = [r[0] for r in rows]
    labels = [r[2] for r in rows]
    out = []
    for a, (anchor, v, label) in enumerate(rows):
        if anchor % 5:
            continue
        scores = [sum(x * y for x, y in zip(v, w, strict=True)) for _, w, _ in rows]
        order = sorted(range(len(rows)), key=lambda i: (-scores[i], ids[i]))
        for p in [i for i in order if i != a and labels[i] == label][:positives]:
            fit = [i for i in order if labels[i] != label and 50 * scores[p] <= 100 * scores[i] <= 95 * scores[p]]
            out += [(anchor, ids[p], rank, ids[i], scores[p], scores[i]) for rank, i in enumerate(fit[:negatives], 1)]
    return sorted(out)


def vectors(seed, count, dim, scale, copies):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    rows = [centres[i % 6] + rng.normal(size=dim) * 0.4 for i in range(count - copies)]
    rows += [rows[0]] * copies  # one vector of a third of all rows
    labels = rng.integers(0, 3, count)
    return [(i, [int(x) for x in np.floor(v * scale)], int(labels[i])) for i, v in enumerate(rows)]


@pytest.mark.parametrize(
    "rows, using",
    [
        (vectors(1, 300, 8, 100, 100), Mining(shard=50, members=7, clusters=3)),
        (vectors(2, 200, 4, 20, 0), Mining(shard=1000, clusters=5, sample=10, head=0.5)),
        (vectors(3, 120, 6, 1 << 28, 10), Mining(shard=64, clusters=2)),  # products beyond 53 bits
        (vectors(4, 40, 3, 3, 20), Mining(clusters=64)),  # more clusters than anchors, many ties
    ],
)
def test_mined_rows_equal_brute_force(spark, rows, using):
    frame = spark.createDataFrame(rows, "vec_id long, vector array<long>, label long")
    found = mine(frame, F.col("vec_id") % 5 == 0, using=using).collect()
    assert sorted(tuple(r) for r in found) == brute(rows)


def test_a_member_stops_when_the_rest_of_the_list_is_certified():
    """The members of one part and three pieces of a sorted list: the second certifies them, the third is not read."""
    from lastro.llm.negatives import _Walk

    def rows(side, number, vectors, bounds):
        packed = [np.array(v, dtype="<i2").tobytes() for v in vectors]
        low, high, floor = ([[value] * (1 - side) for _ in vectors] for value in (-(1 << 62), 1 << 62, -(1 << 62)))
        kinds = [pa.list_(pa.int64())] * 3
        count = len(vectors)
        return pa.RecordBatch.from_arrays(
            [pa.array(range(number, number + count), pa.int64()), pa.array(range(number, number + count), pa.int64()),
             pa.array([1] * count, pa.int64()), pa.array([float(np.linalg.norm(v)) for v in vectors]), pa.array(packed, pa.binary()),
             pa.array([2] * count, pa.int32()), pa.array([side] * count, pa.int32()), pa.array(bounds, pa.float64()),
             *(pa.array(part, kind) for part, kind in zip((low, high, floor), kinds, strict=True))],
            names=["row", "id", "label", "norm", "v", "item", "side", "bound", "low", "high", "floor"],
        )

    walk = _Walk(2, 2, same=True)
    walk.feed(rows(0, 0, [[100, 0], [99, 5]], [0.0, 0.0]))
    walk.feed(rows(1, 10, [[90, 0], [89, 1], [88, 2]], [91.0, 90.0, 89.0]))
    walk.flush()
    assert len(walk.open) == 2
    walk.feed(rows(1, 20, [[3, 80], [2, 80]], [10.0, 9.0]))
    walk.flush()
    assert len(walk.open) == 0
    walk.feed(rows(1, 30, [[2, 1]], [2.0]))
    found = next(walk.found()).to_pydict()
    assert found["id"] == [10, 11, 10, 11] and found["score"] == [9000, 8900, 8910, 8816]
