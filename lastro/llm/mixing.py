"""Mixing sources to target weights along a time-varying curriculum.

Each source has a share of all words and a schedule, its weight over training time from 0
to 1. The schedule's integral is the source's cumulative demand for words; a document that
begins after c words of its source is trained on when the demand reaches c. Documents of a
source follow each other in the order of a hash, pass after pass; the last pass ends within
a document, so a source gives its target to the word.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lastro.llm.frames import checkpoint, free_name, ref
from lastro.llm.words import WORD

#: Weights go to the sources in the order of their names, again and again.
WEIGHTS = (5, 2, 1)
#: No source gives more than so many times its size.
MOST_PASSES = 3
#: Hex digits of a document's hash that name its slice of the source: 16 ** 3 slices.
SLICE_DIGITS = 3


@dataclass(frozen=True)
class Schedule:
    """Weight over time, linear between knots ``(time, weight)`` from time 0 to time 1."""

    knots: tuple[tuple[float, float], ...] = ((0.0, 1.0), (1.0, 1.0))

    def areas(self) -> list[float]:
        """Demand up to each knot."""
        out = [0.0]
        for (t0, w0), (t1, w1) in zip(self.knots, self.knots[1:], strict=False):
            out.append(out[-1] + (w0 + w1) / 2 * (t1 - t0))
        return out

    def time_of(self, share: Column) -> Column:
        """The time at which ``share`` (0 to 1) of the whole demand has come up."""
        areas = self.areas()
        demand = share * F.lit(areas[-1])
        time = F.lit(self.knots[-1][0])
        pieces = list(zip(self.knots, self.knots[1:], areas, areas[1:], strict=False))
        for (t0, w0), (t1, w1), low, high in reversed(pieces):
            over = demand - F.lit(low)
            slope = (w1 - w0) / (t1 - t0)
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * over, F.lit(0.0)))
            inside = F.when(over <= 0, F.lit(t0)).otherwise(F.lit(t0) + F.lit(2.0) * over / (F.lit(w0) + root))
            time = F.when(demand < F.lit(high), inside).otherwise(time)
        return time


#: Per weight in WEIGHTS: heavy sources fade, middle ones stay, light ones come in late.
SCHEDULES = (
    Schedule(((0.0, 1.5), (1.0, 0.5))),
    Schedule(),
    Schedule(((0.0, 0.25), (0.5, 0.5), (1.0, 2.0))),
)


def sized(df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``key, version, source, size``: words of the whole text, 0 for null."""
    size = F.coalesce(F.regexp_count(ref(text), F.lit(WORD)), F.lit(0)).cast("long")
    return df.select(
        ref(key).alias("key"), F.xxhash64(ref(text)).alias("version"), ref(source).alias("source"), size.alias("size")
    )


def targets(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """``source, place, source_size, target``: one row per source, in the order of names, null last.

    All targets add up to all sizes. A target above ``most`` times its source's size stops
    there and the excess goes to the others by weight, until none is above: with sources by
    rising size per weight, the first that takes its share of what the stopped ones leave
    decides the share of all after it.
    """
    named = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*(F.lit(w).cast("long") for w in weights)), F.col("place") % len(weights))
    rows = named.withColumn("place", place).withColumn("weight", weight).withColumn("most", F.col("source_size") * most)
    fill = Window.orderBy(F.col("most") / F.col("weight"), "place")
    whole = Window.partitionBy()
    ahead = F.coalesce(F.sum("most").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    left = F.sum("source_size").over(whole) - F.col("ahead")
    rows = rows.withColumn("ahead", ahead).withColumn("rest", rest).withColumn("left", left)
    open_ = F.col("most") * F.col("rest") >= F.col("weight") * F.col("left")
    share = F.max(F.when(open_, F.col("left") / F.col("rest"))).over(whole)
    rows = rows.withColumn("open", open_).withColumn("share", share)
    target = F.when(F.col("open"), F.col("weight") * F.col("share")).otherwise(F.col("most").cast("double"))
    return rows.select("source", "place", "source_size", target.alias("target"))


def placed(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES, digits: int = SLICE_DIGITS
) -> DataFrame:
    """The documents with ``place, source_size, target, whole, rest, before``.

    ``before`` is the number of words of the source that come before the document, ``whole``
    the complete passes over the source, ``rest`` the words of the last, incomplete one.
    Sums run within a slice of a source and over the slices' totals; no source is in one task.
    """
    per_source = targets(docs, weights, most)
    known = docs.join(per_source.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    digest = F.md5(F.coalesce(F.col("key").cast("string"), F.lit("")).cast("binary"))
    known = known.withColumn("digest", digest).withColumn("slice", F.substring("digest", 1, digits))
    totals = known.groupBy("place", "slice").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("place").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("place", "slice", F.coalesce(F.sum("words").over(running), F.lit(0)).alias("offset"))
    inner = Window.partitionBy("place", "slice").orderBy("digest", "key", "size", "version")
    within = F.coalesce(F.sum("size").over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rows = known.withColumn("within", within).join(offsets, ["place", "slice"])
    rows = rows.withColumn("before", F.col("offset") + F.col("within")).withColumn("whole", passes.cast("long"))
    rest = F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")
    return rows.withColumn("rest", rest).drop("digest", "slice", "offset", "within")


def _last() -> Column:
    """Words of the document in the incomplete pass."""
    return F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))


def _time(words: Column, schedules: tuple[Schedule, ...]) -> Column:
    share = words / F.col("target")
    out = F.lit(None).cast("double")
    for number, schedule in enumerate(schedules):
        out = F.when(F.col("place") % len(schedules) == number, schedule.time_of(share)).otherwise(out)
    return F.when(F.col("target") > 0, out).otherwise(F.lit(0.0))


def passes(rows: DataFrame, schedules: tuple[Schedule, ...] = SCHEDULES) -> DataFrame:
    """One row per document and pass with words in it: adds ``pass``, ``words`` and ``position``.

    ``position`` is the training time, 0 to 1, at which the document begins in that pass. A
    document without words has one row, in pass 0, so that nothing goes missing.
    """
    each = rows.withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole"))))
    words = F.when(F.col("pass") < F.col("whole"), F.col("size")).otherwise(_last())
    begins = F.col("pass") * F.col("source_size") + F.col("before")
    return (
        each.withColumn("words", words)
        .where((F.col("words") > 0) | ((F.col("size") == 0) & (F.col("pass") == 0)))
        .withColumn("position", _time(begins, schedules))
    )


def mix(
    df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
    weights: tuple[int, ...] = WEIGHTS, schedules: tuple[Schedule, ...] = SCHEDULES,
) -> DataFrame:
    """``key, size, source_size, target, taken, position`` of every row, in training order.

    The passes are laid out along the schedules as ``curriculum`` does, and read back per
    document: ``taken`` adds up the words of its passes, repeats included; ``position`` is
    the first of their places in training, null if nothing of it is taken. Documents never
    taken come last. A null source is a source. Repeated rows are documents of their own;
    those that agree in everything may stand for each other. A null text has size 0 and is
    never taken. Other columns are ignored.
    """
    docs = checkpoint(sized(df, key, source, text).withColumn("row", F.monotonically_increasing_id()))
    rows = checkpoint(placed(docs, weights))
    laid = passes(rows, schedules).where("words > 0").groupBy("row")
    seen = laid.agg(F.sum("words").alias("taken"), F.min("position").alias("position"))
    order = rows.join(seen, "row", "left").orderBy(F.col("position").asc_nulls_last(), "place", "before", "row")
    taken = F.coalesce("taken", F.lit(0).cast("long"))
    return order.select(F.col("key").alias(key), "size", "source_size", "target", taken.alias("taken"), "position")


def curriculum(
    df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
    weights: tuple[int, ...] = WEIGHTS, schedules: tuple[Schedule, ...] = SCHEDULES,
) -> DataFrame:
    """The rows in training order, range-sorted by position: one row per document and pass.

    Adds ``pass``, ``words`` (how many of the document's words the pass takes, from its
    start) and ``position``; with underscores in front where the table has such columns. A
    document the mix does not reach is left out, one without words stays.
    """
    docs = checkpoint(sized(df, key, source, text))
    ident, copy = free_name(df, "ident"), free_name(df, "copy")
    # Rows that repeat key, text and source are told apart by a number within the repeats.
    same = Window.partitionBy("key", "version", "source").orderBy("before")
    rows = passes(placed(docs, weights).withColumn("copy", F.row_number().over(same)), schedules)
    names = {c: free_name(df, c) for c in ("pass", "words", "position", "place", "before")}
    order = rows.select(
        F.struct("key", "version", "source").alias(ident), F.col("copy").alias(copy),
        *(F.col(c).alias(name) for c, name in names.items()),
    )
    whole = F.struct(ref(key).alias("key"), F.xxhash64(ref(text)).alias("version"), ref(source).alias("source"))
    texts = df.withColumn(ident, whole)
    texts = texts.withColumn(copy, F.row_number().over(Window.partitionBy(ref(ident)).orderBy(ref(ident))))
    joined = texts.join(order, [ident, copy])
    added = [names[c] for c in ("pass", "words", "position")]
    return joined.orderBy(*(ref(names[c]) for c in ("position", "place", "before", "pass"))).select(
        *(ref(c) for c in [*df.columns, *added])
    )
