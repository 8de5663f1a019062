"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and
one bit per failed rule; policies are versioned sets of bits, so a new policy or
an ablation reads the ledger's integers and never the texts again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lastro.llm.frames import free_name, ref
from lastro.llm.words import SPACES, pieces

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letter_words",
)
SYMBOLS = "#*$%&|<>"
#: A word with one of these bytes counts as having a letter: ASCII letters and all beyond ASCII.
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``fails``, SQL over the measurements, is true. Its bit never changes."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    Rule(4, "short_words", "word_chars < 3 * n_words"),
    Rule(5, "long_words", "word_chars > 10 * n_words"),
    Rule(6, "words_without_letters", "100 * n_letter_words < 70 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """A version of the verdict: a document that fails any of these rules goes."""

    version: str
    rules: tuple[str, ...] = field(default=tuple(rule.name for rule in RULES))

    def mask(self, rules: tuple[Rule, ...] = RULES) -> int:
        bits = {rule.name: rule.bit for rule in rules}
        return sum(1 << bits[name] for name in set(self.rules))


BASE = Policy("base", ("few_words", "repeated_words"))
STANDARD = Policy("standard-1")


def _repeated(words: list[list[bytes]], size: int = 3) -> np.ndarray:
    """Words of each text that stand in a window of ``size`` words found twice or more in it.

    Words are numbered within the piece, so windows are compared exactly.
    """
    counts = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    total = int(counts.sum())
    out = np.zeros(len(words), dtype=np.int64)
    if total < size:
        return out
    numbers: dict[bytes, int] = {}
    ids = np.fromiter(
        (numbers.setdefault(word, len(numbers)) for text in words for word in text), dtype=np.int64, count=total
    )
    text = np.repeat(np.arange(len(words)), counts)
    length = total - size + 1
    key = text[:length]
    for offset in range(size):  # number (window so far, next word) anew: exact, and below total * total
        _, key = np.unique(key * len(numbers) + ids[offset : offset + length], return_inverse=True)
    inside = text[:length] == text[size - 1 :]
    _, found, times = np.unique(key[inside], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(inside)[times[found] > 1]
    covered = np.zeros(total, dtype=bool)
    for offset in range(size):
        covered[starts + offset] = True
    np.add.at(out, text[covered], 1)
    return out


def _measure(texts: list[str | None]) -> list[list[int]]:
    columns: list[list[int]] = [[] for _ in MEASURES]
    for first, piece in pieces(texts):
        words = [data.split() for data in piece]
        repeated = _repeated(words)
        for index, split in enumerate(words):
            text = texts[first + index] or ""
            lines = [line for line in text.split("\n") if line.strip(SPACES)]
            lettered = sum(1 for word in split if word.translate(None, _LETTERS) != word)
            chars = len(text) - sum(map(text.count, SPACES))
            row = (
                len(split), chars, sum(map(text.count, SYMBOLS)), len(lines),
                len(lines) - len(set(lines)), int(repeated[index]), lettered,
            )
            for column, value in zip(columns, row, strict=True):
                column.append(value)
    return columns


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every column of the batch, then one struct of measurements."""
    for batch in batches:
        values = _measure(batch.column(0).to_pylist())
        measured = pa.StructArray.from_arrays(
            [pa.array(column, type=pa.int64()) for column in values], names=list(MEASURES)
        )
        names = [f"c{i}" for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], measured], names=[*names, "m"])


def measure(df: DataFrame, text: str, name: str) -> DataFrame:
    """The rows with a struct column ``name`` of measurements. One pass, no shuffle."""
    carried = df.select(ref(text).alias("t"), *(ref(c).alias(f"c{i}") for i, c in enumerate(df.columns)))
    fields = T.StructType([T.StructField(measure, T.LongType()) for measure in MEASURES])
    schema = carried.drop("t").schema.add("m", fields)
    out = carried.mapInArrow(_measured, schema)
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)), F.col("m").alias(name))


def fail_bits(measures: str, rules: tuple[Rule, ...] = RULES) -> Column:
    """One bit per failed rule, over a struct column of measurements."""
    names = re.compile(rf"\b({'|'.join(MEASURES)})\b")
    struct = f"`{measures.replace('`', '``')}`"
    each = (names.sub(lambda m: f"{struct}.{m[1]}", rule.fails) for rule in rules)
    return F.expr(" | ".join(f"if({sql}, {1 << rule.bit}L, 0L)" for rule, sql in zip(rules, each, strict=True)))


def ledger(
    df: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """One row per document: the key, the measurements and ``fail_bits``.

    A null text has no words. An empty text fails ``few_words`` only. Repeated rows
    are judged alike, each by itself; a null key is kept. Other columns are ignored.
    """
    measured = measure(df.select(ref(key).alias(key), ref(text).alias("text_")), "text_", "m_")
    return measured.select(
        ref(key), *(F.col(f"m_.{name}").alias(name) for name in MEASURES), fail_bits("m_", rules).alias("fail_bits")
    )


def verdict(bits: Column, policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    """True where the policy keeps the document."""
    return bits.bitwiseAND(F.lit(policy.mask(rules))) == 0


def ablation(
    book: DataFrame, policies: tuple[Policy, ...], rules: tuple[Rule, ...] = RULES, bits: str = "fail_bits"
) -> DataFrame:
    """Per policy and rule: documents rejected, failed by the rule, and saved by leaving it out.

    The ledger is first reduced to one count per pattern of bits, at most two to the
    number of rules, by partial aggregation; each figure is a sum over patterns.
    Columns: policy, rule, documents, rejected, failed, only_this_rule.
    """
    patterns = book.groupBy(ref(bits).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    cases = [
        F.struct(
            F.lit(policy.version).alias("policy"), F.lit(rule.name).alias("rule"),
            F.lit(policy.mask(rules)).cast("long").alias("mask"), F.lit(1 << rule.bit).cast("long").alias("bit"),
        )
        for policy in policies for rule in rules if rule.name in policy.rules
    ]
    failed = F.col("b").bitwiseAND(F.col("c.mask"))
    total = lambda where: F.coalesce(F.sum(F.when(where, F.col("n"))), F.lit(0))
    return (
        patterns.select("b", "n", F.explode(F.array(*cases)).alias("c"))
        .groupBy(F.col("c.policy").alias("policy"), F.col("c.rule").alias("rule"))
        .agg(
            F.sum("n").alias("documents"),
            total(failed != 0).alias("rejected"),
            total(F.col("b").bitwiseAND(F.col("c.bit")) != 0).alias("failed"),
            total(failed == F.col("c.bit")).alias("only_this_rule"),
        )
    )


def keep(df: DataFrame, policy: Policy = STANDARD, text: str = "text") -> DataFrame:
    """The rows the policy keeps, with all their columns. A null text has no words, so it goes."""
    name = free_name(df, "measures")
    return measure(df, text, name).where(verdict(fail_bits(name), policy)).select(*(ref(c) for c in df.columns))


def report(df: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """Measurements, failure bits, the base verdict and the policy's, per document."""
    bits = F.col("fail_bits")
    base_failed = ~verdict(bits, BASE)
    return ledger(df).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & verdict(bits, policy)).alias("kept"),
        "n_lines", "n_letter_words", "fail_bits",
    )
