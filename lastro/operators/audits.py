"""Audits of transfers, technical receipts and late postings.

A cession and a receipt meet on the sale key. Both sides are counted and summed
per key and day first; the join sees those rows, and totals over all cession and
receipt pairs come back as products of the counts and sums.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lastro.functions.money import base_amount, full_amount, zero_amount
from lastro.operators.contracts import approved_cessions, effective_cancellations, in_universe
from lastro.params import STATUS_SETTLED, CloseWindow, LiveWindow, Portfolio
from lastro.schemas import SALE_KEY

# Labels of the audit reports.
OLD_SIDE, NEW_SIDE = "Antiga (cedente)", "Nova (cessionario)"
GONE, NOT_FOUND = "SUMIU (nenhuma tabela)", "NAO ENCONTRADA"
OLD_POSITIONS = (
    "1. Antes da cessao (pagamento real do cedente)",
    "2. NO DIA da cessao (suspeita tecnico)",
    "3. DEPOIS da cessao (venda ja cancelada - suspeita tecnico)",
)
NEW_POSITIONS = (
    "1. ANTES da cessao (venda nem existia - tecnico)",
    "2. NO DIA da cessao (suspeita tecnico/entrada)",
    "3. Depois da cessao (pagamento real do cessionario)",
)


def portfolio_cessions(history: DataFrame, portfolio: Portfolio) -> DataFrame:
    return approved_cessions(history, portfolio).where(~F.col("empresa").isin(*portfolio.excluded_companies))


def campaign_cessions(history: DataFrame, portfolio: Portfolio, start: date) -> DataFrame:
    return portfolio_cessions(history, portfolio).where(F.col("data_mnt") >= F.lit(start))


def volumetry(history: DataFrame, portfolio: Portfolio, start: date) -> DataFrame:
    return portfolio_cessions(history, portfolio).agg(
        F.count(F.lit(1)).alias("cessoes_aprovadas"),
        F.count_if(F.col("data_mnt") >= F.lit(start)).alias("cessoes_na_campanha"),
        F.min("data_mnt").alias("primeira_cessao"),
        F.max("data_mnt").alias("ultima_cessao"),
    )


def _status_of(sales: DataFrame, number: str, name: str) -> DataFrame:
    return sales.select("empresa", "obra", F.col("num_venda").alias(number), F.col("status").alias(name))


def _where_is(live: str, archived: str, missing: str) -> Column:
    def text(table: str, status: str) -> Column:
        return F.concat(F.lit(f"{table} (status "), F.col(status).cast("string"), F.lit(")"))

    return (
        F.when(F.col(live).isNotNull(), text("Vendas", live))
        .when(F.col(archived).isNotNull(), text("VendasRecebidas", archived))
        .otherwise(missing)
    )


def locate_sides(
    history: DataFrame, live: DataFrame, archived: DataFrame, cancellations: DataFrame, portfolio: Portfolio, start: date
) -> DataFrame:
    """Table and status of both sides of each cession; would the new one be in the base?"""
    out = campaign_cessions(history, portfolio, start)
    for number, side in (("num_venda", "antiga"), ("num_nova", "nova")):
        for sales, source in ((live, "viva"), (archived, "arquivo")):
            out = out.join(_status_of(sales, number, f"{side}_{source}"), ["empresa", "obra", number], "left")
    cancelled = effective_cancellations(cancellations).select(
        "empresa", "obra", F.col("num_venda").alias("num_nova"), F.lit(True).alias("_distratada")
    )
    out = out.join(cancelled.distinct(), ["empresa", "obra", "num_nova"], "left")
    enters = (F.coalesce("nova_viva", "nova_arquivo") == 0) & F.col("_distratada").isNull()
    return out.select(
        "empresa",
        "obra",
        F.col("num_venda").alias("venda_antiga"),
        F.col("num_nova").alias("venda_nova"),
        "num_hist",
        F.col("data_mnt").alias("data_cessao"),
        _where_is("antiga_viva", "antiga_arquivo", GONE).alias("onde_venda_antiga"),
        _where_is("nova_viva", "nova_arquivo", NOT_FOUND).alias("onde_venda_nova"),
        F.when(enters, "Sim").otherwise("NAO").alias("nova_entra_na_base"),
    )


def _by_side(cessions: DataFrame, number: str) -> DataFrame:
    """Cessions counted per sale of one side and day."""
    keyed = cessions.select("empresa", "obra", F.col(number).alias("num_venda"), "data_mnt")
    return keyed.groupBy(*SALE_KEY, "data_mnt").agg(F.count(F.lit(1)).alias("cessoes"))


def _paid_days(receipts: DataFrame, portfolio: Portfolio, window: LiveWindow, *more: str) -> DataFrame:
    """Receipts of the campaign counted and summed per sale, day and further columns."""
    paid = F.col("pago_em")
    rows = in_universe(receipts, portfolio).where((paid >= F.lit(window.start)) & (paid < F.lit(window.end)))
    return (
        rows.withColumn("cheio", full_amount())
        .groupBy(*SALE_KEY, "pago_em", *more)
        .agg(F.count(F.lit(1)).alias("linhas"), F.sum("cheio").alias("cheio"))
    )


def _not_fee(portfolio: Portfolio) -> Column:
    return F.col("tipo") != portfolio.fee_type


def money_by_side(history: DataFrame, receipts: DataFrame, portfolio: Portfolio, window: LiveWindow) -> DataFrame:
    """Campaign money hanging on the old and on the new side of its cessions."""
    cessions = campaign_cessions(history, portfolio, window.start)
    paid = (
        _paid_days(receipts.where(_not_fee(portfolio)), portfolio, window)
        .groupBy(*SALE_KEY)
        .agg(F.sum("cheio").alias("cheio"))
    )
    sides = []
    for number, side in (("num_venda", OLD_SIDE), ("num_nova", NEW_SIDE)):
        counted = _by_side(cessions, number).groupBy(*SALE_KEY).agg(F.sum("cessoes").alias("cessoes"))
        sides.append(counted.join(paid, SALE_KEY).withColumn("lado", F.lit(side)))
    both = sides[0].unionByName(sides[1])
    return both.groupBy("lado").agg(
        F.count(F.lit(1)).alias("qtd_vendas"), F.sum(F.col("cessoes") * F.col("cheio")).alias("valor_recebido_campanha")
    )


def date_semantics(history: DataFrame, live: DataFrame, portfolio: Portfolio) -> DataFrame:
    """Is the cession day filled on the old sale, the new one, both or neither?"""
    out = portfolio_cessions(history, portfolio)
    for number, name in (("num_venda", "antiga"), ("num_nova", "nova")):
        side = live.select("empresa", "obra", F.col("num_venda").alias(number), F.col("data_cessao").alias(name))
        out = out.join(side, ["empresa", "obra", number], "left")
    flags = [
        F.when(F.col(name).isNotNull(), 1).otherwise(0).alias(f"{name}_tem_data_cessao") for name in ("antiga", "nova")
    ]
    return out.groupBy(*flags).agg(F.count(F.lit(1)).alias("qtd"))


def recent_sample(
    history: DataFrame,
    live: DataFrame,
    archived: DataFrame,
    people: DataFrame,
    portfolio: Portfolio,
    start: date,
    rows: int = 20,
) -> DataFrame:
    """The latest cessions with both clients, for a look by eye."""
    latest = campaign_cessions(history, portfolio, start).orderBy(
        F.desc("data_mnt"), "empresa", "obra", "num_venda", "num_hist"
    )
    out = latest.limit(rows)

    def client(sales: DataFrame, number: str, name: str) -> DataFrame:
        return sales.select("empresa", "obra", F.col("num_venda").alias(number), F.col("cliente").alias(name))

    out = (
        out.join(client(live, "num_venda", "_a1"), ["empresa", "obra", "num_venda"], "left")
        .join(client(archived, "num_venda", "_a2"), ["empresa", "obra", "num_venda"], "left")
        .join(client(live, "num_nova", "_novo"), ["empresa", "obra", "num_nova"], "left")
        .withColumn("_antigo", F.coalesce("_a1", "_a2"))
    )
    for number, name in (("_antigo", "cliente_antigo"), ("_novo", "cliente_novo")):
        out = out.join(people.select(F.col("cliente").alias(number), F.col("nome").alias(name)), number, "left")
    # A sale that repeats in a table repeats its cession: cut after the joins too.
    order = (F.desc("data_mnt"), "empresa", "obra", "num_venda", "num_hist", "cliente_antigo", "cliente_novo")
    return (
        out.orderBy(*order)
        .limit(rows)
        .select(
            "empresa",
            "obra",
            F.col("num_venda").alias("venda_antiga"),
            F.col("num_nova").alias("venda_nova"),
            F.col("data_mnt").alias("data_cessao"),
            "cliente_antigo",
            "cliente_novo",
        )
    )


def technical_receipts(
    history: DataFrame, receipts: DataFrame, portfolio: Portfolio, window: LiveWindow, new_side: bool
) -> DataFrame:
    """Receipts before, on and after the cession day, by instalment type."""
    cessions = campaign_cessions(history, portfolio, window.start)
    number, positions = ("num_nova", NEW_POSITIONS) if new_side else ("num_venda", OLD_POSITIONS)
    joined = _by_side(cessions, number).join(_paid_days(receipts, portfolio, window, "tipo"), SALE_KEY)
    position = (
        F.when(F.col("pago_em") < F.col("data_mnt"), positions[0])
        .when(F.col("pago_em") == F.col("data_mnt"), positions[1])
        .otherwise(positions[2])
    )
    per_sale = joined.groupBy(position.alias("posicao"), "tipo", *SALE_KEY).agg(
        F.sum(F.col("cessoes") * F.col("linhas")).alias("linhas"), F.sum(F.col("cessoes") * F.col("cheio")).alias("cheio")
    )
    return per_sale.groupBy("posicao", "tipo").agg(
        F.sum("linhas").alias("qtd_linhas"),
        F.count(F.lit(1)).alias("qtd_vendas"),
        F.sum("cheio").alias("valor_recebido"),
    )


def technical_settled(
    history: DataFrame, archived: DataFrame, receipts: DataFrame, portfolio: Portfolio, window: LiveWindow
) -> DataFrame:
    """Settled new sales: money up to the cession day against money after it."""
    settled = archived.where(F.col("status") == STATUS_SETTLED).select(*SALE_KEY)
    cessions = _by_side(campaign_cessions(history, portfolio, window.start), "num_nova").join(settled, SALE_KEY)
    paid = _paid_days(receipts.where(_not_fee(portfolio)), portfolio, window)
    amount = F.col("cessoes") * F.col("cheio")
    after = F.col("pago_em") > F.col("data_mnt")
    return (
        cessions.join(paid, SALE_KEY)
        .groupBy(*SALE_KEY, F.col("data_mnt").alias("data_cessao"))
        .agg(
            F.sum(F.when(~after, amount).otherwise(zero_amount())).alias("valor_no_dia_ou_antes"),
            F.sum(F.when(after, amount).otherwise(zero_amount())).alias("valor_fora_janela_tecnica"),
        )
    )


# Posting dates --------------------------------------------------------------


def posting_sanity(receipts: DataFrame, portfolio: Portfolio, start: date) -> DataFrame:
    rows = in_universe(receipts, portfolio).where(F.col("pago_em") >= F.lit(start))
    return rows.agg(
        F.count(F.lit(1)).alias("total_linhas"),
        F.count_if(F.col("cadastrado_em") >= F.col("pago_em")).alias("cad_maior_igual_rec"),
        F.count_if(F.col("cadastrado_em") < F.col("pago_em")).alias("cad_menor_que_rec"),
        F.max("cadastrado_em").alias("ultimo_cadastro"),
    )


def _posted_late(receipts: DataFrame, portfolio: Portfolio, first: Column, window: CloseWindow) -> DataFrame:
    paid = F.col("pago_em")
    late = (paid >= first) & (paid < F.lit(window.cutoff)) & (F.col("cadastrado_em") >= F.lit(window.cutoff))
    return in_universe(receipts, portfolio).where(late)


def late_by_day(receipts: DataFrame, portfolio: Portfolio, window: CloseWindow) -> DataFrame:
    """Receipts of the month posted after it, per posting day."""
    rows = _posted_late(receipts, portfolio, F.lit(window.month_start), window).where(_not_fee(portfolio))
    per_sale = (
        rows.withColumn("base", base_amount())
        .groupBy(F.col("cadastrado_em").alias("dia_cadastro"), *SALE_KEY)
        .agg(F.count(F.lit(1)).alias("linhas"), F.sum("base").alias("base"))
    )
    return per_sale.groupBy("dia_cadastro").agg(
        F.sum("linhas").alias("qtd_recebimentos"),
        F.count(F.lit(1)).alias("qtd_vendas"),
        F.sum("base").alias("valor_base_cupom"),
    )


def completeness(receipts: DataFrame, portfolio: Portfolio, window: CloseWindow, days: int = 4) -> DataFrame:
    """Receipts per payment day at the month end; unchanged between two runs = complete."""
    paid = F.col("pago_em")
    rows = in_universe(receipts, portfolio).where(
        (paid >= F.date_sub(F.lit(window.cutoff), days)) & (paid < F.lit(window.cutoff))
    )
    return rows.groupBy(paid.alias("dia_pagamento")).agg(
        F.count(F.lit(1)).alias("qtd_recebimentos"), F.sum("principal").alias("valor_principal")
    )


def late_sample(
    receipts: DataFrame, portfolio: Portfolio, window: CloseWindow, days: int = 2, rows: int = 20
) -> DataFrame:
    """The latest late postings, without personal data."""
    late = _posted_late(receipts, portfolio, F.date_sub(F.lit(window.cutoff), days), window)
    order = F.desc("cadastrado_em"), *SALE_KEY, "num_parcela", "num_parcela_geral", "tipo", "pago_em"
    return (
        late.select(*SALE_KEY, "num_parcela", "num_parcela_geral", "tipo", "pago_em", "cadastrado_em")
        .orderBy(*order)
        .limit(rows)
    )


# Tracing --------------------------------------------------------------------


def inline_keys(spark: SparkSession, keys: Sequence[tuple[int, str, int]]) -> DataFrame:
    """A literal key list of any length; Spark picks the join by its measured size."""
    return spark.createDataFrame(list(keys), "empresa int, obra string, num_venda long")


def key_trace(
    keys: DataFrame, live: DataFrame, archived: DataFrame, history: DataFrame, cancellations: DataFrame
) -> DataFrame:
    """Every row the given sales have in four tables: source, code, number and day."""
    views = (
        ("Vendas", live, "status", F.lit(None), "data_venda"),
        ("VendasRecebidas", archived, "status", F.lit(None), "data_venda"),
        ("VendaHist", history, "tipo_mnt", F.col("num_hist"), "data_mnt"),
        ("VendaDistrato", cancellations, "status_aprov", F.col("num_distrato"), "data_cad"),
    )
    found = [
        df.join(keys, SALE_KEY).select(
            F.lit(source).alias("fonte"),
            *SALE_KEY,
            F.col(code).cast("long").alias("codigo"),
            number.cast("long").alias("numero"),
            F.col(day).alias("dia"),
        )
        for source, df, code, number, day in views
    ]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])
