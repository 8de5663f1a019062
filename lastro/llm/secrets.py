"""Secret scans: fixed patterns, and Shannon entropy over candidate strings.

Positions are code points. A span's place follows from the lengths of the texts
between the matches and of the matches before it, so no text is cut into characters.
Candidates are long runs of one character class, without what is known to be harmless and
without what is reported already: such parts are cut out of a run, and each piece that is
long enough is judged on its own. A window slides over a candidate
with its counts per character; a step changes two counts, and the sum of c * log2(c)
by their two terms. Sums are kept in millionths as integers: no rounding drifts.
Only built-in functions are used.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro.llm.frames import ref

ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
#: A run that fails its length holds no shorter start that passes, so the length stands in the pattern.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
VALUE_LENGTH = 6
MILLION = 1_000_000


@dataclass(frozen=True)
class CharacterClass:
    """Candidates of one class: pieces of ``least`` or more characters whose best window
    of ``window`` characters reaches ``bits`` per character, and which match all of ``needs``."""

    kind: str
    characters: str
    alphabet: str
    fold: bool
    bits: float
    needs: tuple[str, ...]
    least: int = 20
    window: int = 20


HEX_CLASS = CharacterClass("entropy_hex", "0-9A-Fa-f", "0123456789abcdef", True, 3.0, ("[0-9]", "[A-Fa-f]"))
BASE64_CLASS = CharacterClass(
    "entropy_base64", "A-Za-z0-9+/_=-",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", False, 3.9, ("[0-9]", "[A-Z]", "[a-z]"),
)
CLASSES = (HEX_CLASS, BASE64_CLASS)
#: What matches any of these is no part of a secret.
ALLOWED = (
    "[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",
    "[Ee][Xx][Aa][Mm][Pp][Ll][Ee]",
    "abcdefghijklmnop|ABCDEFGHIJKLMNOP|0123456789",
)


def spans(text: Column, pattern: str, kind: str, rank: int) -> Column:
    """Leftmost matches as an array of ``start, rank, end, kind, value``."""
    found = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"),
        F.split(text, pattern, -1).alias("before"),
    )
    span = "struct<start:int,rank:int,end:int,kind:string,value:string>"
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("spans"))

    def add(state: Column, item: Column) -> Column:
        start = state["at"] + F.length(item["before"])
        end = start + F.length(item["value"])
        one = F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"),
            item["value"].alias("value"),
        )
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(one)).alias("spans"))

    matched = F.filter(found, lambda item: item["value"].isNotNull())  # the last piece follows the last match
    return F.aggregate(matched, empty, add, lambda state: state["spans"])


def term(count: int) -> int:
    """c * log2(c) in millionths."""
    return round(count * math.log2(count) * MILLION) if count else 0


def least_gain(shape: CharacterClass) -> int:
    """The largest sum of terms at which a window still reaches the bits."""
    return math.floor(shape.window * (math.log2(shape.window) - shape.bits) * MILLION)


def lowest_sum(candidate: Column, shape: CharacterClass) -> Column:
    """Smallest sum of terms of any window, by incremental counts: the highest entropy."""
    terms = F.array(*(F.lit(term(count)).cast("long") for count in range(shape.window + 2)))
    folded = F.lower(candidate) if shape.fold else candidate
    codes = F.transform(F.split(folded, ""), lambda c: F.instr(F.lit(shape.alphabet), c))  # 1-based, 0 for none
    steps = F.transform(
        codes,
        lambda code, i: F.struct(
            code.alias("new"), F.coalesce(F.get(codes, i - shape.window), F.lit(0)).alias("old"), i.alias("i")
        ),
    )
    start = F.struct(
        F.array_repeat(F.lit(0), len(shape.alphabet) + 1).alias("counts"),
        F.lit(0).cast("long").alias("sum"), F.lit(None).cast("long").alias("least"),
    )

    def slide(state: Column, step: Column) -> Column:
        one, none = F.lit(1), F.lit(0)
        counts = F.transform(
            state["counts"],
            lambda n, code: n
            + F.when((code == step["new"]) & (step["new"] > 0), one).otherwise(none)
            - F.when((code == step["old"]) & (step["old"] > 0), one).otherwise(none),
        )
        new, old = F.get(state["counts"], step["new"]), F.get(state["counts"], step["old"])
        gain = F.get(terms, new + 1) - F.get(terms, new)
        loss = F.when(step["old"] > 0, F.get(terms, old) - F.get(terms, old - 1)).otherwise(F.lit(0))
        total = state["sum"] + F.when(step["new"] == step["old"], F.lit(0)).otherwise(gain - loss)
        full = F.when(step["i"] >= shape.window - 1, total)
        return F.struct(
            counts.alias("counts"), total.cast("long").alias("sum"), F.least(state["least"], full).alias("least")
        )

    return F.aggregate(steps, start, slide, lambda state: state["least"])


_PIECE = "array<struct<start:int,value:string>>"


def _without(run: Column, taken: Column, least: int) -> Column:
    """Pieces of a run outside the taken spans, as ``start, value``."""
    over = F.array_sort(F.filter(taken, lambda span: (span["start"] < run["end"]) & (run["start"] < span["end"])))
    empty = F.struct(run["start"].alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("free"))

    def cut(state: Column, span: Column) -> Column:
        piece = F.struct(state["at"].alias("start"), span["start"].alias("end"))
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), F.concat(state["free"], F.array(piece)).alias("free"))

    free = F.aggregate(over, empty, cut, lambda state: F.concat(state["free"], F.array(F.struct(state["at"].alias("start"), run["end"].alias("end")))))
    long_enough = F.filter(free, lambda piece: piece["end"] - piece["start"] >= least)
    return F.transform(
        long_enough,
        lambda piece: F.struct(
            piece["start"].alias("start"),
            F.substring(run["value"], piece["start"] - run["start"] + 1, piece["end"] - piece["start"]).alias("value"),
        ),
    )


def _between(piece: Column, pattern: str) -> Column:
    """Pieces of a piece between the matches of a pattern, as ``start, value``."""
    parts = F.arrays_zip(
        F.split(piece["value"], pattern, -1).alias("value"),
        F.regexp_extract_all(piece["value"], F.lit(pattern), F.lit(0)).alias("after"),
    )
    empty = F.struct(piece["start"].alias("at"), F.array().cast(_PIECE).alias("out"))

    def add(state: Column, part: Column) -> Column:
        one = F.struct(state["at"].alias("start"), part["value"].alias("value"))
        at = state["at"] + F.length(part["value"]) + F.coalesce(F.length(part["after"]), F.lit(0))
        return F.struct(at.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    return F.aggregate(parts, empty, add, lambda state: state["out"])


def entropy_spans(text: Column, taken: Column, shape: CharacterClass, rank: int, allowed: tuple[str, ...] = ALLOWED) -> Column:
    runs = spans(text, f"[{shape.characters}]{{{shape.least},}}", shape.kind, rank)
    pieces = F.flatten(F.transform(runs, lambda run: _without(run, taken, shape.least)))
    if allowed:
        harmless = "|".join(f"(?:{pattern})" for pattern in allowed)
        pieces = F.flatten(F.transform(pieces, lambda piece: _between(piece, harmless)))
    candidates = F.transform(
        F.filter(pieces, lambda piece: F.length(piece["value"]) >= shape.least),
        lambda piece: F.struct(
            piece["start"].alias("start"), F.lit(rank).alias("rank"),
            (piece["start"] + F.length(piece["value"])).alias("end"), F.lit(shape.kind).alias("kind"), piece["value"].alias("value"),
        ),
    )

    def plausible(candidate: Column) -> Column:
        holds = F.lit(True)
        for need in shape.needs:
            holds = holds & candidate["value"].rlike(need)
        return holds

    candidates = F.filter(candidates, plausible)
    return F.filter(candidates, lambda c: lowest_sum(c["value"], shape) <= least_gain(shape))


def scan(
    df: DataFrame, key: str = "doc_id", text: str = "text", classes: tuple[CharacterClass, ...] = CLASSES,
    allowed: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """One row per row: the key, the base spans and the added ones, each sorted by start and kind.

    A null text is empty and has no spans. Repeated rows and null keys stay. Other columns
    are ignored. What a base span covers, or a span of a class before, is cut out of a
    candidate: it is reported already.
    """
    rows = df.select(ref(key).alias(key), F.coalesce(ref(text), F.lit("")).alias("t"))
    value_end = F.filter(
        spans(F.col("t"), ASSIGN, "assign", 0),
        lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= VALUE_LENGTH,
    )
    base = rows.select(
        "*", value_end.alias("assign"), spans(F.col("t"), ACCESS, "access", 1).alias("access"),
        spans(F.col("t"), HEX, "hex", 2).alias("hex"),
    )
    names = ["assign", "access", "hex"]
    for number, shape in enumerate(classes):
        base = base.withColumn("taken", F.concat(*names))
        base = base.withColumn(shape.kind, entropy_spans(F.col("t"), F.col("taken"), shape, 3 + number, allowed))
        names.append(shape.kind)
    ordered = lambda *parts: F.array_sort(F.concat(*parts))
    return base.select(
        ref(key), "assign", "access", "hex",
        ordered("assign", "access", "hex").alias("base"), ordered(*names).alias("all"),
    )


def spelled(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(df: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The rows with ``mark`` in place of base matches. A null text stays null."""
    value = f"(?:{ACCESS}|{HEX})"
    cleaned = F.regexp_replace(ref(text), ASSIGN, F.concat(F.lit("$1="), F.lit(mark)))
    cleaned = F.regexp_replace(cleaned, value, mark)
    return df.select(*(cleaned.alias(c) if c == text else ref(c) for c in df.columns))


def report(df: DataFrame) -> DataFrame:
    """Counts and positions per document."""
    return scan(df).select(
        "doc_id",
        F.size("assign").cast("long").alias("n_assign"),
        F.size("access").cast("long").alias("n_access"),
        F.size("hex").cast("long").alias("n_hex"),
        F.sha2(spelled(F.col("base")), 256).alias("base_sha256"),
        spelled(F.col("all")).alias("spans"),
        (F.size("all") - F.size("base")).cast("long").alias("n_added"),
    )
