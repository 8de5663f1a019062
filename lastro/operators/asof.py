"""What was in force on a day: as-of joins, and the owner of a receipt along its cessions.

Both sides are laid over each other, sorted by day, and each row takes the last value
before it. A key with very many rows is not sorted as one: its days are parted into slices
of fixed length that are sorted on their own. What a slice begins with is carried to it from
the last value of the slices before, which is one row per key and slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lastro.operators import contracts as C
from lastro.params import Portfolio
from lastro.schemas import SALE_KEY
from lastro.sources.storage import checkpoint

#: Days of a slice.
SLICE = 31


def asof(
    rows: DataFrame, events: DataFrame, key: Sequence[str], day: str, since: str, values: Sequence[str], slice_days: int = SLICE
) -> DataFrame:
    """``rows`` with ``since`` and ``values`` of the last event of their key on or before their day.

    Events of one key have different days. A row before the first event, without a day or
    with a null in its key gets nulls; every row stays. ``since`` and ``values`` are not among
    the columns of ``rows``.
    """
    if clash := {since, *values} & set(rows.columns):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    part = lambda column: F.floor(F.datediff(column, F.lit("1970-01-01").cast("date")) / slice_days)
    known = events.where(F.col(since).isNotNull() & ~sum_null(key)).select(*key, F.struct(since, *values).alias("_valor"))
    nothing = F.lit(None).cast(known.schema["_valor"].dataType)
    left = rows.select(*key, F.col(day).alias("_dia"), F.struct(*rows.columns).alias("_linha"), nothing.alias("_valor"))
    right = known.select(
        *key, F.col(f"_valor.{since}").alias("_dia"), F.lit(None).cast(left.schema["_linha"].dataType).alias("_linha"), "_valor"
    )
    both = left.unionByName(right).withColumn("_fatia", part(F.col("_dia")))
    # The last event of every slice that has rows or events, then the last one before each slice.
    ends = both.groupBy(*key, "_fatia").agg(F.max("_valor").alias("_fim"))
    before = Window.partitionBy(*key).orderBy("_fatia").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*key, "_fatia", F.last("_fim", ignorenulls=True).over(before).alias("_antes")).where("_antes is not null")
    # On a day the event comes first.
    inside = Window.partitionBy(*key, "_fatia").orderBy("_dia", F.col("_linha").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    placed = both.withColumn("_ate", F.last("_valor", ignorenulls=True).over(inside)).where("_linha is not null")
    joined = placed.join(carried, [*key, "_fatia"], "left")
    found = F.when(F.col("_dia").isNotNull(), F.coalesce("_ate", "_antes"))
    return joined.select("_linha.*", found.alias("_em")).select("*", "_em.*").drop("_em")


def sum_null(key: Sequence[str]):
    """True where any part of a key is null."""
    out = F.lit(False)
    for name in key:
        out = out | F.col(name).isNull()
    return out


def owners(sales: DataFrame, history: DataFrame, portfolio: Portfolio) -> DataFrame:
    """``SALE_KEY, desde, venda_vigente, cliente_vigente``: of every sale, who holds it from which day on.

    A sale holds itself from its own day on (at the earliest possible day, as receipts may
    come before it); from a cession on its new sale does, from that one's cession on the
    next, and so on. A cession that comes before the one that leads to it counts from that
    one's day. Of cessions on one day the last along the chain stays. Rounds follow chains
    step by step; a chain that comes back to a sale it has passed ends there.
    """
    step = C.cession_latest(history, portfolio).where("venda_nova is not null and data_cedida is not null")
    links = checkpoint(
        step.select("empresa", "obra", F.col("num_venda").alias("venda_vigente"), F.col("venda_nova").alias("_nova"), F.col("data_cedida").alias("_dia"))
    )
    first = F.lit("0001-01-01").cast("date")
    start = sales.select(*SALE_KEY, first.alias("desde"), F.col("num_venda").alias("venda_vigente"), F.lit(0).alias("_passo")).distinct()
    reached = checkpoint(start)
    found = reached
    while True:
        onward = reached.join(links, ["empresa", "obra", "venda_vigente"]).select(
            *SALE_KEY, F.greatest("desde", "_dia").alias("desde"), F.col("_nova").alias("venda_vigente"), (F.col("_passo") + 1).alias("_passo")
        )
        passed = found.select(*SALE_KEY, "venda_vigente")
        reached = checkpoint(onward.join(passed, [*SALE_KEY, "venda_vigente"], "left_anti"))
        if reached.isEmpty():
            break
        found = checkpoint(found.unionByName(reached))
    latest = found.groupBy(*SALE_KEY, "desde").agg(F.max_by("venda_vigente", "_passo").alias("venda_vigente"))
    # The smallest client where a sale has rows of several.
    client = sales.groupBy(*SALE_KEY).agg(F.min("cliente").alias("cliente_vigente")).withColumnRenamed("num_venda", "venda_vigente")
    return latest.join(client, ["empresa", "obra", "venda_vigente"], "left").select(*SALE_KEY, "desde", "venda_vigente", "cliente_vigente")


def receipt_owners(receipts: DataFrame, sales: DataFrame, history: DataFrame, portfolio: Portfolio, slice_days: int = SLICE) -> DataFrame:
    """Receipts of the portfolio with the sale and the client in force on their payment day."""
    rows = C.in_universe(receipts, portfolio)
    return asof(rows, owners(sales, history, portfolio), SALE_KEY, "pago_em", "desde", ["venda_vigente", "cliente_vigente"], slice_days)
