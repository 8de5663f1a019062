"""URL rules by a sort-merge range join.

A host's labels reversed, each followed by a comma, make a key under which a host and
all its subdomains are one interval: ``com,example,`` up to the same with a last
character beyond all others. Rules and urls are sorted together by that key and swept
once; a stack holds the rules whose intervals contain the present key. Intervals of
prefixes nest or are apart, so the stack is never deeper than a host has labels, times
the rules of one host. Each url tests the path prefixes of the rules on the stack.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro.llm.frames import parallelism, ref

RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
DEFAULT = "allow"
#: Boundaries per shuffle partition, and sampled keys per boundary. They set the balance, never the result.
RANGES, SAMPLES = 4, 16
LAST = "\U0010ffff" * 4


def host(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    found = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(found, upper, upper.lower()), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(name: Column) -> Column:
    """``www.example.com`` as ``com,example,www,``; commas in a host are kept apart."""
    labels = F.reverse(F.split(F.replace(name, F.lit(","), F.lit(";")), "\\."))
    return F.concat(F.array_join(labels, ","), F.lit(","))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range, key, kind: rules (kind 0) before the urls (kind 1) they cover."""
    present, stack = None, []  # of (interval's prefix, [(host, path, rule, action), ...])
    for batch in batches:
        keep: list[int] = []
        rules: list[str | None] = []
        actions: list[str | None] = []
        columns = (batch.column(name).to_pylist() for name in ("range", "key", "kind", "host", "path", "action"))
        for index, (part, key, kind, name, tail, action) in enumerate(zip(*columns, strict=True)):
            if part != present:
                present, stack = part, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if kind == 0:
                if not stack or stack[-1][0] != key:
                    stack.append((key, []))
                stack[-1][1].append((len(name) + len(tail), len(name), tail, name + tail, action))
                continue
            best = None
            for _, held in stack:
                for rule in held:
                    if tail.startswith(rule[2]) and (best is None or rule[:2] > best[:2] or (
                        rule[:2] == best[:2] and rule[4] > best[4]
                    )):
                        best = rule
            keep.append(index)
            rules.append(best and best[3])
            actions.append(best and best[4])
        kept = batch.take(pa.array(keep, type=pa.int64()))
        columns = [kept.column("row"), kept.column("host"), kept.column("path")]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(rules, pa.string()), pa.array(actions, pa.string())],
            names=["row", "host", "path", "rule", "action"],
        )


def judge(
    pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = DEFAULT
) -> DataFrame:
    """``key, host, path, rule, verdict`` for every row.

    ``rules`` has ``action, host, path``. A rule fits its host and all subdomains where the
    path starts with the rule's. The longest host and path wins, then the longer host, then
    the action last in the alphabet, so that ``block`` beats ``allow``. Without a rule the
    verdict is ``default`` and the rule null. A null url, or one without ``://``, has an empty
    host and path. Repeated rows and null keys stay; extra columns are ignored.

    Keys are cut into ranges at boundaries taken from a bounded set of keys (one of each of
    ``SAMPLES`` classes of hashes per boundary). Urls of one host spread over ranges by path and
    a hash of the row. A rule goes to every range its interval meets, found by comparing it
    with the boundaries, so that each range can be swept by itself.
    """
    count = max(1, parallelism(pages) * RANGES)
    rows = pages.select(ref(key).alias("row"), host(ref(url)).alias("host"), path(ref(url)).alias("path"))
    salt = F.lpad(F.hex(F.xxhash64("row", "path")), 16, "0")
    # Only the key has a meaning in the sweep; path and salt part the rows of one host.
    urls = rows.select("*", host_key(F.col("host")).alias("key"), salt.alias("salt"))
    # One url of each class of a second hash: as many as there are classes reach the driver, however many tasks read.
    classes = F.pmod(F.xxhash64("row", "path", F.lit(7)), F.lit(count * SAMPLES))
    drawn = urls.groupBy(classes.alias("class")).agg(F.min(F.struct("salt", "key", "path")).alias("s"))
    sampled = drawn.select("s.key", "s.path", "s.salt").collect()
    bounds = sorted(tuple(row) for row in sampled)[SAMPLES::SAMPLES]
    events = urls.select(
        F.lit(1).alias("kind"), "row", "host", "path", F.lit(None).cast("string").alias("action"), "key", "salt"
    )
    starts = rules.select(
        F.lit(0).alias("kind"), F.lit(None).cast(rows.schema["row"].dataType).alias("row"), "host", "path", "action",
        host_key(F.col("host")).alias("key"), F.lit("").alias("salt"),
    )
    placed = events.unionByName(starts).mapInArrow(
        partial(_place, bounds), events.drop("salt").schema.add("range", "long")
    )
    swept = (
        placed.repartition("range")
        .sortWithinPartitions("range", "key", "kind")
        .mapInArrow(_sweep, rows.select("row", "host", "path").schema.add("rule", "string").add("action", "string"))
    )
    return swept.select(
        F.col("row").alias(key), "host", "path", "rule", F.coalesce("action", F.lit(default)).alias("verdict")
    )


def _place(bounds: list[tuple[str, str, str]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A url once, at the number of boundaries at or below it; a rule at every range it meets."""
    for batch in batches:
        rows: list[int] = []
        ranges: list[int] = []
        columns = (batch.column(name).to_pylist() for name in ("kind", "key", "path", "salt"))
        for index, (kind, key, tail, salt) in enumerate(zip(*columns, strict=True)):
            if kind:
                at = [bisect.bisect_right(bounds, (key, tail, salt))]
            else:
                last = bisect.bisect_right(bounds, (key + LAST, "", ""))
                at = range(bisect.bisect_right(bounds, (key, "", "")), last + 1)
            rows += [index] * len(at)
            ranges += at
        out = batch.drop_columns("salt").take(pa.array(rows, type=pa.int64()))
        yield out.append_column("range", pa.array(ranges, type=pa.int64()))


def literal_rules(spark, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "action string, host string, path string")
