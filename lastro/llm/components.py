"""Connected components as a distributed union-find (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastro.llm.frames import checkpoint


def _state(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` of every node that has a link; the root is the component's smallest node.

    A round joins each node's larger neighbours to its smallest one, then the smaller ones
    too. Rounds go on until no link changes, which takes about the logarithm of the longest
    path. Each is written to the shared folder, so a lost executor costs one round at most.
    A node with very many neighbours is one row per neighbour and one minimum, which joins
    can split; nothing is gathered. Null ends and links to itself are ignored.
    """
    clean = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")
    pairs = checkpoint(clean.distinct())
    state = _state(pairs)
    while state[0]:
        both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        passed = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = checkpoint(passed.unionAll(lowest.select("u", F.col("m").alias("v"))).distinct())
        before, state = state, _state(pairs)
        if state == before:
            break
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
