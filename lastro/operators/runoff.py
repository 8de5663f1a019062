"""Receipts that are still to be posted, from how late those of earlier days came in.

Payments of a day are posted on that day and on the days after it. The triangle holds the
money of each payment day by its lag. How much a day grows from one lag to the next is
learnt from all days old enough to tell; the product of the steps still ahead of a young day
gives what to expect of it. A day of which less than half is expected of what the same
weekday brought in the four weeks before is short. Everything past the first aggregation
has a row per day and lag.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastro.functions.money import base_amount
from lastro.operators.contracts import in_universe
from lastro.params import Portfolio

WEEKS = 4


def triangle(receipts: DataFrame, portfolio: Portfolio, first: date, as_of: date, most: int) -> DataFrame:
    """``dia, atraso, qtd, valor``: non-fee receipts paid from ``first`` on and posted by ``as_of``.

    Posted before their payment day they have no lag; lags beyond ``most`` days are ``most``.
    """
    paid, posted = F.col("pago_em"), F.col("cadastrado_em")
    known = in_universe(receipts, portfolio).where(
        (paid >= F.lit(first)) & (paid <= F.lit(as_of)) & (posted <= F.lit(as_of)) & (F.col("tipo") != portfolio.fee_type)
    )
    lag = F.least(F.greatest(F.datediff(posted, paid), F.lit(0)), F.lit(most))
    return known.groupBy(paid.alias("dia"), lag.alias("atraso")).agg(F.count(F.lit(1)).alias("qtd"), F.sum(base_amount()).alias("valor"))


def grown(cells: DataFrame, as_of: date, most: int) -> DataFrame:
    """``dia, atraso, acumulado``: money of a day up to each lag it is old enough to have."""
    old = F.least(F.datediff(F.lit(as_of), "dia"), F.lit(most))
    days = cells.select("dia").distinct().withColumn("atraso", F.explode(F.sequence(F.lit(0), old)))
    own = cells.select("dia", F.col("atraso").alias("_atraso"), "valor")
    both = days.join(own, "dia").where(F.col("_atraso") <= F.col("atraso"))
    sums = both.groupBy("dia", "atraso").agg(F.sum("valor").alias("acumulado"))
    # A day whose first money comes with a lag has none before it.
    return days.join(sums, ["dia", "atraso"], "left").withColumn("acumulado", F.coalesce("acumulado", F.lit(0).cast(sums.schema["acumulado"].dataType)))


def factors(sums: DataFrame, most: int) -> DataFrame:
    """``atraso, fator``: growth into each lag from 1 on, over all days that have it; 1 where there was nothing to grow from."""
    before = sums.select("dia", (F.col("atraso") + 1).alias("atraso"), F.col("acumulado").alias("_antes"))
    step = sums.join(before, ["dia", "atraso"]).groupBy("atraso").agg(F.sum("acumulado").alias("agora"), F.sum("_antes").alias("antes"))
    lags = sums.sparkSession.range(1, most + 1).select(F.col("id").cast("int").alias("atraso"))
    factor = F.when(F.col("antes") > 0, F.col("agora").cast("double") / F.col("antes").cast("double")).otherwise(1.0)
    return lags.join(step, "atraso", "left").select("atraso", factor.alias("fator"))


def still_to_come(receipts: DataFrame, portfolio: Portfolio, first: date, as_of: date, most: int) -> DataFrame:
    """``dia, idade, observado, fator, esperado, a_entrar, dia_curto`` of every day with money."""
    sums = grown(triangle(receipts, portfolio, first, as_of, most), as_of, most)
    steps = factors(sums, most)
    ahead = steps.agg(F.array_sort(F.collect_list(F.struct((-F.col("atraso")).alias("ordem"), "fator"))).alias("_passos"))
    age = F.datediff(F.lit(as_of), "dia")
    now = sums.groupBy("dia").agg(F.max_by("acumulado", "atraso").cast("double").alias("observado"))
    # One row of ``most`` numbers beside each day, from the largest lag down.
    told = now.withColumn("idade", age).withColumn("_passos", ahead.scalar())
    growth = F.aggregate(F.filter("_passos", lambda step: -step["ordem"] > F.col("idade")), F.lit(1.0), lambda a, step: a * step["fator"])
    told = told.select("dia", F.col("idade").cast("long").alias("idade"), "observado", growth.alias("fator"))
    told = told.withColumn("esperado", F.col("observado") * F.col("fator"))
    judged = told
    for week in range(1, WEEKS + 1):
        judged = judged.join(told.select(F.date_add("dia", 7 * week).alias("dia"), F.col("esperado").alias(f"_s{week}")), "dia", "left")
    weeks = [F.col(f"_s{week}") for week in range(1, WEEKS + 1)]
    total = sum((F.coalesce(week, F.lit(0.0)) for week in weeks[1:]), F.coalesce(weeks[0], F.lit(0.0)))
    seen = sum(F.when(week.isNotNull(), 1).otherwise(0) for week in weeks)
    short = (seen > 0) & (F.col("esperado") * 2 < total / F.nullif(seen, F.lit(0)))
    return judged.select(
        "dia", "idade", "observado", "fator", "esperado", (F.col("esperado") - F.col("observado")).alias("a_entrar"),
        F.coalesce(short, F.lit(False)).alias("dia_curto"),
    )
