"""City, regional, legal and export views over the contract frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lastro.functions.money import zero_amount
from lastro.functions.ratios import percent, ratio, rounded, totals
from lastro.operators.kpis import ELIGIBLE, PENDING, is_status, mark, monthly_ruling, unpivot_row
from lastro.schemas import SALE_KEY

GREEN, RED = "acima", "abaixo"
IN_COURT, OUT_OF_COURT = "Na justiça", "Fora da justiça"
COMPONENTS = ("Principal", "Juros de atraso", "Multa")
EXPORT_KEY = ["regional", "cidade", "empresa_codigo", "obra_nome"]


def money_sum(name: str) -> Column:
    return F.coalesce(F.sum(name), zero_amount())


def count_sum(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0))


def slice_by(df: DataFrame, regionals: Sequence[str] = (), cities: Sequence[str] = ()) -> DataFrame:
    """Multi-select filters; an empty selection keeps every named value."""
    for name, chosen in (("regional", regionals), ("cidade", cities)):
        df = df.where(F.col(name).isin(*chosen) if chosen else F.col(name).isNotNull())
    return df


def per_sale(df: DataFrame, *group: str) -> DataFrame:
    """One row per group and sale: marks per status, sums of its amounts."""
    rows = df.where(" and ".join(f"{name} is not null" for name in group)) if group else df
    return rows.groupBy(*group, *SALE_KEY).agg(
        mark(is_status(ELIGIBLE)).alias("elegivel"),
        mark(is_status(PENDING)).alias("pendente"),
        F.sum("cupons_calculados").alias("cupons"),
        F.sum("valor_total_recebido").alias("recebido"),
        F.sum("valor_vencido_antes").alias("vencido"),
    )


def status_pivot(df: DataFrame, *group: str) -> DataFrame:
    """Distinct sales per group under each of the two statuses, with sums."""
    return (
        per_sale(df, *group)
        .groupBy(*group)
        .agg(
            F.sum("elegivel").alias("elegivel"),
            F.sum("pendente").alias("pendente"),
            F.count(F.lit(1)).alias("contratos_distintos"),
            count_sum("cupons").alias("cupons"),
            money_sum("recebido").alias("recebido"),
            money_sum("vencido").alias("vencido"),
        )
    )


def coupons_per_paying_day(df: DataFrame) -> DataFrame:
    daily = df.groupBy("data_recebimento").agg(F.sum("cupons_calculados").alias("cupons"))
    sums = daily.agg(count_sum("cupons").alias("cupons"), F.count("data_recebimento").alias("dias_pagantes"))
    return sums.withColumn("media_cupons_dia", ratio(F.col("cupons"), F.col("dias_pagantes")))


def average_paid(df: DataFrame) -> DataFrame:
    """Money received per paying client."""
    payers = df.where("valor_total_recebido > 0")
    per_client = payers.groupBy("cpf_titular").agg(F.sum("valor_total_recebido").alias("v"))
    sums = per_client.agg(F.sum("v").alias("v"), F.count("cpf_titular").alias("pagantes"))
    return sums.select("pagantes", ratio(F.col("v"), F.col("pagantes")).alias("parcela_media"))


def average_days_late(df: DataFrame) -> DataFrame:
    late = F.when(F.col("dias_atraso") > 0, F.col("dias_atraso"))
    return df.agg(F.coalesce(F.avg(late), F.lit(0.0)).alias("dias_atraso_medio"))


def registration_rate(df: DataFrame) -> DataFrame:
    sales = df.groupBy(*SALE_KEY).agg(mark(F.col("status_cadastro") == "cadastrado").alias("cadastrado"))
    sums = sales.agg(F.count(F.lit(1)).alias("contratos"), count_sum("cadastrado").alias("cadastrados"))
    return sums.withColumn("taxa_cadastro", percent(F.col("cadastrados"), F.col("contratos")))


def city_status_pivot(df: DataFrame) -> DataFrame:
    return status_pivot(df, "cidade").select("cidade", "elegivel", "pendente")


def portfolio_share(df: DataFrame) -> DataFrame:
    """Share of sales with an eligible row, as the headline rounds it."""
    sums = per_sale(df).agg(F.sum("elegivel").alias("e"), F.count(F.lit(1)).alias("n"))
    return sums.select((rounded(percent(F.col("e"), F.col("n")), 1) / 100).alias("media"))


def city_above_below(df: DataFrame) -> DataFrame:
    """On-time share of each city against the portfolio's."""
    average = portfolio_share(df).scalar()
    both = F.greatest(F.col("elegivel") + F.col("pendente"), F.lit(1))
    shares = status_pivot(df, "cidade").select("cidade", (F.col("elegivel") / both).alias("adimplencia"))
    return shares.withColumn("media_geral", average).withColumn(
        "farol", F.when(F.col("adimplencia") >= F.col("media_geral"), GREEN).otherwise(RED)
    )


def regional_capacity(df: DataFrame) -> DataFrame:
    """Coupons and money against what could have come in (received + overdue)."""
    sums = (
        df.where("regional is not null")
        .groupBy("regional")
        .agg(
            money_sum("valor_total_recebido").alias("recebido"),
            money_sum("valor_vencido_antes").alias("vencido"),
            count_sum("cupons_calculados").alias("cupons"),
        )
    )
    one = F.lit(1).cast("decimal(18,4)")
    with_capacity = sums.withColumn("capacidade", F.greatest(F.col("recebido") + F.col("vencido"), one))
    whole = totals(
        with_capacity, cupons=F.sum("cupons"), recebido=F.sum("recebido"), capacidade=F.sum("capacidade")
    )

    def shares(coupons: Column, received: Column, capacity: Column) -> tuple[Column, Column]:
        base = capacity.cast("double")
        return 100 * coupons / (base / 100), 100 * received.cast("double") / base

    own = shares(F.col("cupons"), F.col("recebido"), F.col("capacidade"))
    overall = shares(whole["cupons"], whole["recebido"], whole["capacidade"])
    return with_capacity.select(
        "*",
        own[0].alias("pct_cupons"),
        own[1].alias("pct_recebido"),
        overall[0].alias("pct_cupons_geral"),
        overall[1].alias("pct_recebido_geral"),
    )


def city_summary(df: DataFrame) -> DataFrame:
    cities = status_pivot(df, "cidade").withColumn("contratos", F.col("elegivel") + F.col("pendente"))
    whole = totals(cities, contratos=F.sum("contratos"), cupons=F.sum("cupons"))
    average = portfolio_share(df).scalar()
    both = F.greatest("contratos", F.lit(1))
    share = F.col("elegivel") / both
    return cities.select(
        "cidade",
        F.when(share >= average, GREEN).otherwise(RED).alias("farol"),
        "contratos",
        ratio(F.col("contratos"), whole["contratos"]).alias("representatividade"),
        F.col("elegivel").alias("elegiveis"),
        F.col("pendente").alias("pendentes"),
        share.alias("pct_adimplente"),
        (F.col("pendente") / both).alias("pct_inadimplente"),
        F.col("vencido").alias("saldo_inadimplente"),
        "cupons",
        ratio(F.col("cupons"), whole["cupons"]).alias("pct_cupons"),
        F.col("recebido").alias("valor"),
    )


def clients_by_status(df: DataFrame) -> DataFrame:
    """Distinct clients per status: one row per client first, marks summed after."""
    marks = {
        "elegiveis": is_status(ELIGIBLE),
        "pendentes": is_status(PENDING),
        "aptos_casas": monthly_ruling(df),
    }
    clients = df.where("cpf_titular is not null").groupBy("cpf_titular")
    per_client = clients.agg(*(mark(condition).alias(name) for name, condition in marks.items()))
    return per_client.agg(*(count_sum(name).alias(name) for name in marks))


# Legal ----------------------------------------------------------------------


def in_court() -> Column:
    return F.col("juridico_ativo") | F.col("juridico_passivo")


def legal_split(df: DataFrame) -> DataFrame:
    sales = df.groupBy(*SALE_KEY).agg(
        F.sum("valor_vencido_antes").alias("vencido"),
        F.sum("valor_juros_inadimplencia").alias("juros"),
        F.sum("valor_multa_inadimplencia").alias("multa"),
        F.sum(F.when(in_court(), F.col("valor_vencido_antes"))).alias("na_justica"),
        mark(F.col("juridico_ativo")).alias("ativo"),
        mark(F.col("juridico_passivo")).alias("passivo"),
        mark(in_court()).alias("qualquer"),
    )
    sums = sales.agg(
        money_sum("vencido").alias("saldo"),
        money_sum("juros").alias("juros"),
        money_sum("multa").alias("multa"),
        money_sum("na_justica").alias("valor_na_justica"),
        count_sum("ativo").alias("contratos_juridico_ativo"),
        count_sum("passivo").alias("contratos_juridico_passivo"),
        count_sum("qualquer").alias("contratos_na_justica"),
    )
    collectable = F.greatest(F.col("saldo") - F.col("valor_na_justica"), zero_amount())
    charges = (F.col("juros") + F.col("multa")).cast("double")
    return sums.withColumns({"valor_cobravel": collectable, "pct_multa_juros": percent(charges, F.col("saldo"))})


def overdue_composition(df: DataFrame) -> DataFrame:
    sums = df.agg(
        money_sum("valor_vencido_antes").alias("saldo"),
        money_sum("valor_juros_inadimplencia").alias("juros"),
        money_sum("valor_multa_inadimplencia").alias("multa"),
    )
    principal = F.greatest(F.col("saldo") - F.col("juros") - F.col("multa"), zero_amount())
    wide = sums.select(
        *(
            amount.cast("decimal(38,4)").alias(name)
            for name, amount in (("principal", principal), ("juros", F.col("juros")), ("multa", F.col("multa")))
        )
    )
    return unpivot_row(wide, "componente", "valor", list(zip(COMPONENTS, ("principal", "juros", "multa"), strict=True)))


def legal_vs_collectable(df: DataFrame) -> DataFrame:
    """Pending sales and overdue balance, in and out of court."""
    sales = df.groupBy(in_court().alias("na_justica"), *SALE_KEY).agg(
        mark(is_status(PENDING)).alias("pendente"), F.sum("valor_vencido_antes").alias("vencido")
    )
    group = F.when(F.col("na_justica"), IN_COURT).otherwise(OUT_OF_COURT)
    return sales.groupBy(group.alias("grupo")).agg(
        F.sum("pendente").alias("contratos"), money_sum("vencido").alias("valor")
    )


def legal_by_regional(df: DataFrame) -> DataFrame:
    sales = df.where(in_court() & F.col("regional").isNotNull()).select("regional", *SALE_KEY).distinct()
    return sales.groupBy("regional").agg(F.count(F.lit(1)).alias("contratos"))


# Matrices and rankings ------------------------------------------------------


def development_matrix(df: DataFrame) -> DataFrame:
    shown = status_pivot(df, "obra")
    return shown.select(
        "obra",
        F.col("elegivel").alias("elegiveis"),
        F.col("pendente").alias("pendentes"),
        "cupons",
        F.col("recebido").alias("valor"),
    )


def top_clients(df: DataFrame, n: int = 15) -> DataFrame:
    group = ["nome_cliente", "obra", "cidade", "status_elegibilidade"]
    sums = (
        df.dropna(subset=group)
        .groupBy(*group)
        .agg(count_sum("cupons_calculados").alias("cupons"), money_sum("valor_total_recebido").alias("valor"))
    )
    return sums.orderBy(F.desc("cupons"), *group).limit(n)


def export_matrix(df: DataFrame) -> DataFrame:
    """Leaves of the export: sales, statuses, coupons and money per development."""
    names = df.groupBy(*EXPORT_KEY).agg(F.min("empresa").alias("empresa_nome"))
    leaves = status_pivot(df, *EXPORT_KEY).join(names, EXPORT_KEY)
    return leaves.select(
        *EXPORT_KEY,
        "empresa_nome",
        F.col("contratos_distintos").alias("contratos"),
        F.col("elegivel").alias("elegiveis"),
        F.col("pendente").alias("inadimplentes"),
        "cupons",
        "recebido",
    )


def export_rollup(matrix: DataFrame) -> DataFrame:
    """Subtotals per company, city and regional: sums of leaves, not new counts."""
    measures = ["contratos", "elegiveis", "inadimplentes", "cupons", "recebido"]
    rolled = matrix.rollup("regional", "cidade", "empresa_codigo").agg(
        F.grouping_id().cast("long").alias("_gid"), *(F.sum(name).alias(name) for name in measures)
    )
    level = F.when(F.col("_gid") == 0, "empresa").when(F.col("_gid") == 1, "cidade").when(F.col("_gid") == 3, "regional")
    return rolled.where("_gid < 7").select(
        level.alias("nivel"), "regional", "cidade", "empresa_codigo", *measures
    )


def share_ranking(df: DataFrame, label: str, value: str, n: int) -> DataFrame:
    """Top rows with position, share of the largest, and share of the grand total."""
    named = df.where(F.col(label).isNotNull() & F.col(value).isNotNull())
    whole = totals(named, soma=F.sum(value), maior=F.max(value))
    top = named.select(label, value).orderBy(F.desc(value), label).limit(n)
    position = F.row_number().over(Window.orderBy(F.desc(value), label))
    return top.select(
        position.alias("posicao"),
        label,
        value,
        percent(F.col(value), whole["maior"]).cast("long").alias("pct_do_maior"),
        percent(F.col(value), whole["soma"]).alias("pct_do_total"),
    )


# Lower bound of each band of value / largest value.
PERFORMANCE_BANDS = ((0.8, "topo"), (0.6, "alto"), (0.4, "medio"), (0.2, "atencao"))


def performance_band(df: DataFrame, label: str, value: str) -> DataFrame:
    largest = totals(df, maior=F.max(value))["maior"].cast("double")
    share = F.try_divide(F.col(value).cast("double"), largest)
    band = F.lit("baixo")
    for lower, name in reversed(PERFORMANCE_BANDS):
        band = F.when(share >= lower, name).otherwise(band)
    return df.select(label, value, F.when(largest == 0, "medio").otherwise(band).alias("faixa"))


def target_gap(df: DataFrame, target: float = 70.0) -> DataFrame:
    """On-time percentage against the target, in points, with its traffic light."""
    share = portfolio_share(df).select((F.col("media") * 100).alias("pct"))
    pct = F.bround("pct", 1)
    light = F.when(pct >= target, "meta").when(pct >= target * 0.75, "proximo").otherwise("abaixo")
    return share.select(
        pct.alias("pct_adimplencia"), F.bround(pct - target, 1).alias("delta"), light.alias("situacao")
    )


def portfolio_split(df: DataFrame) -> DataFrame:
    sums = per_sale(df).agg(count_sum("elegivel").alias("e"), F.count(F.lit(1)).alias("n"))
    late = F.col("n") - F.col("e")
    wide = sums.select(F.col("e").alias("adimplentes"), late.alias("inadimplentes"), "n")
    entries = F.array(
        *(
            F.struct(
                F.lit(name).alias("situacao"), F.col(name).alias("contratos"), percent(F.col(name), F.col("n")).alias("pct")
            )
            for name in ("adimplentes", "inadimplentes")
        )
    )
    return wide.select(F.inline(entries))


def distinct_cities(df: DataFrame) -> DataFrame:
    return df.agg(F.countDistinct("cidade").alias("cidades"))


