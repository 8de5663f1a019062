"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context
and only that reply trainable. Turns after the last reply, or a conversation without
one, give one example without a target, so that no turn is lost.

Template of a turn: ``<s>[role] text </s>``. ``&``, ``<`` and ``[`` inside a role or a
text become ``&amp;``, ``&lt;`` and ``&lsqb;``, so the marks never occur there, and
reading back in the opposite order restores every text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro.llm.frames import ref

OPEN, AFTER_ROLE, CLOSE = "<s>[", "] ", " </s>"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"), ("]", "&rsqb;"))


def escape(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def turn_text(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), escape(role), F.lit(AFTER_ROLE), escape(text), F.lit(CLOSE))


def examples(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    target_role: str = "assistant",
) -> DataFrame:
    """``conv, example, text, loss_start, loss_length, last`` per example.

    ``text`` is the whole formatted prefix with its target at the end; the loss covers
    ``loss_length`` code points from ``loss_start`` (0-based), the escaped reply without
    marks; without a target both are null. ``last`` marks the example that holds every turn.

    Turns sort by turn, role and text, nulls first; repeated rows stay as often as they
    occur. A null role or text is empty. Rows of the null conversation are one. The output
    holds each prefix in full and so grows with the square of a conversation's turns, as
    the method demands; each example is a row of its own.
    """
    item = F.struct(
        ref(turn).alias("turn"), F.coalesce(ref(role), F.lit("")).alias("role"),
        F.coalesce(ref(text), F.lit("")).alias("text"),
    )
    talks = df.select(ref(conv).alias("conv"), item.alias("item")).groupBy("conv")
    turns = talks.agg(F.sort_array(F.collect_list("item")).alias("turns"))
    marked = turns.select(
        "conv",
        F.transform("turns", lambda t: turn_text(t["role"], t["text"])).alias("formatted"),
        F.transform("turns", lambda t: F.length(escape(t["text"]))).alias("lengths"),
        F.transform("turns", lambda t: t["role"] == target_role).alias("targets"),
    )
    size = F.size("formatted")
    ends = F.filter(
        F.sequence(F.lit(1), size), lambda n: F.get("targets", n - 1) | (n == F.size("formatted"))
    )
    each = marked.select("*", F.posexplode(ends).alias("example", "end"))
    prefix = F.array_join(F.slice("formatted", F.lit(1), F.col("end")), "")
    trained = F.get("targets", F.col("end") - 1)
    length = F.when(trained, F.get("lengths", F.col("end") - 1)).cast("long")
    return each.select(
        F.col("conv").alias(conv), "example", prefix.alias("text"), length.alias("loss_length"),
        (F.col("end") == size).alias("last"),
    ).select(
        conv, "example", "text",
        (F.length("text") - len(CLOSE) - F.col("loss_length")).cast("long").alias("loss_start"), "loss_length", "last",
    )


def read_back(text: Column) -> Column:
    """Array of ``role, text`` structs of a formatted text."""
    parts = F.split(F.regexp_replace(text, r" </s>\z", ""), " </s><s>\\[")
    parts = F.transform(parts, lambda p: F.regexp_replace(p, r"\A<s>\[", ""))
    mark = F.lit(AFTER_ROLE)
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape(F.substring_index(p, AFTER_ROLE, 1)).alias("role"),
            unescape(F.substr(p, F.instr(p, mark) + len(AFTER_ROLE))).alias("text"),
        ),
    )


def digest(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What the examples hold, read back from their texts and masks, per conversation."""
    target = unescape(F.substr("text", (F.col("loss_start") + 1).cast("int"), F.col("loss_length").cast("int")))
    each = formatted.select(
        ref(conv).alias("conv"),
        F.length("text").cast("long").alias("chars"),
        F.when(F.col("loss_length").isNotNull(), F.struct("example", target.alias("loss"))).alias("loss"),
        F.when(F.col("last"), F.col("text")).alias("whole"),
    )
    one = each.groupBy("conv").agg(
        F.sum("chars").alias("formatted_chars"),
        F.array_join(F.transform(F.sort_array(F.collect_list("loss")), lambda x: x["loss"]), "").alias("loss"),
        F.max("whole").alias("whole"),
    )
    spelled = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return one.withColumn("turns", read_back(F.col("whole"))).select(
        F.col("conv").alias(conv),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(spelled, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
