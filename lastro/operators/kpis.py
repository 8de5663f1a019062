"""Indicators and series over the contract frame (one row per sale and buyer).

A sale may have several buyers, so nearly every count is of distinct sales under
some condition. Those counts are not written as many distinct aggregates, which
would copy each row once per condition: the frame is reduced to one row per sale
carrying sums and 0/1 marks, and the marks are summed.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lastro.functions.money import zero_amount
from lastro.functions.ratios import percent, ratio, rounded
from lastro.params import Campaign, CouponRule
from lastro.schemas import SALE_KEY

# Labels of the published series.
ELIGIBLE, PENDING = "elegivel", "pendente"
REGISTERED, RECOVERED = "cadastrado", "recuperacao"
WEEKDAYS = ("Segunda", "Terça", "Quarta", "Quinta", "Sexta", "Sábado", "Domingo")
ORIGINS = ("Em dia", "Recuperado", "Antecipado")
OVERDUE_BANDS = (
    (0, "Sem atraso informado"),
    (30, "1-30 dias"),
    (60, "31-60 dias"),
    (90, "61-90 dias"),
    (180, "91-180 dias"),
    (None, "180+ dias"),
)
FUNNEL = ("Base total", "Cadastrados", "Elegíveis", "Geraram cupons")
NEW_BUSINESS, KNOWN_BUSINESS, UNKNOWN_BUSINESS = "Nova venda pós-campanha", "Base existente", "Indeterminado"
SALE_DAY_COLUMNS = ("data_venda", "data_contrato", "data_negocio")
DRAW_TYPES = (("Milhão (final)", "cupons_calculados"), ("Casas (mês)", "cupons_casas"))
OLDER_DRAW_TYPES = (
    ("Milhão (final)", "cupons_calculados"),
    ("Casas — sorteio atual", "cupons_casas_sorteio_atual"),
    ("Casas — próximo sorteio", "cupons_casas_proximo_sorteio"),
)
MONTHLY_PRIZE, FINAL_PRIZE = "Casa + Carro", "R$ 1.000.000"
DONE, SOON, FINAL, FUTURE = "Realizado", "Em breve", "Final", "Futuro"


def contract_id() -> Column:
    """Readable id of a sale; counts use the key columns themselves."""
    return F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in SALE_KEY))


def mark(condition: Column) -> Column:
    """1 when any row of the group meets the condition."""
    return F.max(F.when(condition, 1).otherwise(0))


def is_status(value: str) -> Column:
    return F.col("status_elegibilidade") == value


def monthly_ruling(df: DataFrame) -> Column:
    """The monthly ruler, or the single ruler of frames that have only one."""
    name = "status_elegibilidade_casas" if "status_elegibilidade_casas" in df.columns else "status_elegibilidade"
    return F.col(name) == ELIGIBLE


def money_or_zero(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else zero_amount()


def distinct_clients(df: DataFrame, condition: Column | None = None) -> DataFrame:
    rows = df if condition is None else df.where(condition)
    return rows.agg(F.countDistinct("cpf_titular").alias("clientes"))


# Executive indicators -------------------------------------------------------


def per_contract(df: DataFrame) -> DataFrame:
    """One row per sale: sums of its rows, and which statuses occur in them."""
    coupons = F.coalesce(F.col("cupons_calculados"), F.lit(0))
    monthly = F.coalesce(F.col("cupons_casas"), F.lit(0)) if "cupons_casas" in df.columns else F.lit(0)
    recovered = (
        F.col("classificacao_recebimento") == RECOVERED if "classificacao_recebimento" in df.columns else F.lit(False)
    )
    return df.groupBy(*SALE_KEY).agg(
        F.sum("valor_total_recebido").alias("recebido"),
        F.sum("valor_elegivel").alias("elegivel"),
        F.sum(coupons).alias("cupons"),
        F.sum(monthly).alias("cupons_casas"),
        F.sum(F.when(is_status(ELIGIBLE), coupons).otherwise(0)).alias("cupons_elegiveis"),
        F.sum(money_or_zero(df, "valor_recuperado")).alias("recuperado"),
        F.sum(money_or_zero(df, "valor_vencido_antes")).alias("vencido"),
        mark(F.col("status_cadastro") == REGISTERED).alias("cadastrado"),
        mark(is_status(ELIGIBLE)).alias("apto"),
        mark(monthly_ruling(df)).alias("apto_casas"),
        mark(recovered).alias("contrato_recuperado"),
        mark(is_status(ELIGIBLE) & (coupons > 0)).alias("apto_com_cupom"),
    )


def kpis_executive(df: DataFrame) -> DataFrame:
    clients = distinct_clients(df).scalar()
    money, count = zero_amount(), F.lit(0)
    return (
        per_contract(df)
        .agg(
            F.coalesce(F.sum("recebido"), money).alias("valor_total_recebido"),
            F.coalesce(F.sum("elegivel"), money).alias("valor_elegivel"),
            F.coalesce(F.sum("cupons"), count).alias("cupons_calculados"),
            F.count(F.lit(1)).alias("contratos_participantes"),
            F.coalesce(F.sum("cadastrado"), count).alias("contratos_cadastrados"),
            F.coalesce(F.sum("apto"), count).alias("contratos_elegiveis"),
            F.coalesce(F.sum("apto_casas"), count).alias("contratos_aptos_casas"),
            F.coalesce(F.sum("cupons_casas"), count).alias("cupons_casas"),
            F.coalesce(F.sum("cupons_elegiveis"), count).alias("cupons_elegiveis"),
            F.coalesce(F.sum("recuperado"), money).alias("valor_recuperado"),
            F.coalesce(F.sum("contrato_recuperado"), count).alias("contratos_recuperados"),
            F.coalesce(F.sum("vencido"), money).alias("valor_vencido"),
        )
        .withColumn("clientes_participantes", clients)
    )


def kpis_portfolio(df: DataFrame) -> DataFrame:
    total, eligible = F.col("contratos_participantes"), F.col("contratos_elegiveis")
    return kpis_executive(df).withColumns(
        {
            "contratos_inadimplentes": total - eligible,
            "pct_adimplencia": rounded(percent(eligible, total), 1),
            "ticket_medio": ratio(F.col("valor_total_recebido"), total),
            "cupons_por_contrato_apto": rounded(ratio(F.col("cupons_calculados"), eligible), 1),
        }
    )


# Series ---------------------------------------------------------------------


def coupons_by_month(df: DataFrame) -> DataFrame:
    rows = df.where("mes_referencia is not null")
    return rows.groupBy("mes_referencia").agg(F.sum("cupons_calculados").alias("cupons_calculados"))


def running(df: DataFrame, value: str, by: str = "data") -> DataFrame:
    """Running total over an already aggregated calendar series (few rows)."""
    window = Window.orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("acumulado", F.sum(value).over(window))


def receipts_series(df: DataFrame, day: Column) -> DataFrame:
    """Money per ``day`` (a date or its month) with its running total."""
    paid = df.where(F.col("data_recebimento").isNotNull() & (F.col("valor_total_recebido") > 0))
    series = paid.groupBy(day.alias("data")).agg(F.sum("valor_total_recebido").alias("valor_total_recebido"))
    return running(series, "valor_total_recebido")


def receipts_monthly(df: DataFrame) -> DataFrame:
    return receipts_series(df, F.trunc("data_recebimento", "MM"))


def receipts_daily(df: DataFrame) -> DataFrame:
    return receipts_series(df, F.to_date("data_recebimento"))


def unpivot_row(df: DataFrame, label: str, value: str, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """One wide row to (label, value) rows, in the order of ``pairs``."""
    entries = F.array(*(F.struct(F.lit(text).alias(label), F.col(name).alias(value)) for text, name in pairs))
    return df.select(F.inline(entries))


def receipts_by_origin(df: DataFrame) -> DataFrame:
    """On time = received - recovered - advanced, never below zero; zero rows left out."""
    sums = df.agg(
        F.coalesce(F.sum("valor_total_recebido"), zero_amount()).alias("total"),
        F.coalesce(F.sum(money_or_zero(df, "valor_recuperado")), zero_amount()).alias("recuperado"),
        F.coalesce(F.sum(money_or_zero(df, "valor_antecipado")), zero_amount()).alias("antecipado"),
    )
    on_time = F.greatest(F.col("total") - F.col("recuperado") - F.col("antecipado"), zero_amount())
    wide = sums.select(
        *(
            amount.cast("decimal(38,4)").alias(name)
            for name, amount in (
                ("em_dia", on_time),
                ("recuperado", F.col("recuperado")),
                ("antecipado", F.col("antecipado")),
            )
        )
    )
    pairs = list(zip(ORIGINS, ("em_dia", "recuperado", "antecipado"), strict=True))
    return unpivot_row(wide, "origem", "valor", pairs).where("valor > 0")


def overdue_band(days: Column) -> Column:
    """Right-closed bands; -1 and below belong to none."""
    band = F.lit(None).cast("string")
    for upper, name in reversed(OVERDUE_BANDS):
        band = F.lit(name) if upper is None else F.when(days <= upper, name).otherwise(band)
    return F.when(days > -1, band)


def overdue_bands(df: DataFrame) -> DataFrame:
    """Sales with pending rows and no eligible one, by their longest delay."""
    pending = is_status(PENDING)
    contracts = df.groupBy(*SALE_KEY).agg(
        mark(is_status(ELIGIBLE)).alias("apto"),
        mark(pending).alias("pendente"),
        F.max(F.when(pending, F.col("dias_atraso"))).alias("dias"),
        F.sum(F.when(pending, money_or_zero(df, "valor_vencido_antes"))).alias("vencido"),
    )
    late = contracts.where("pendente = 1 and apto = 0").withColumn("faixa", overdue_band(F.col("dias")))
    return (
        late.where("faixa is not null")
        .groupBy("faixa")
        .agg(F.count(F.lit(1)).alias("contratos"), F.coalesce(F.sum("vencido"), zero_amount()).alias("valor"))
    )


def participation_funnel(df: DataFrame) -> DataFrame:
    """Base, registered (only when it tells something new), eligible, with coupons."""
    counts = per_contract(df).agg(
        F.count(F.lit(1)).alias("base"),
        *(
            F.coalesce(F.sum(name), F.lit(0)).alias(name)
            for name in ("cadastrado", "apto", "apto_com_cupom")
        ),
    )
    pairs = list(zip(FUNNEL, ("base", "cadastrado", "apto", "apto_com_cupom"), strict=True))
    shown = counts.withColumn("cadastrado", F.when(F.col("cadastrado") != F.col("apto"), F.col("cadastrado")))
    return unpivot_row(shown, "etapa", "contratos", pairs).where("contratos is not null")


def business_origin(df: DataFrame, campaign_start: date) -> DataFrame:
    """New or known business, by the first sale-day column the frame has."""
    day = next((c for c in SALE_DAY_COLUMNS if c in df.columns), None)
    if day is not None:
        is_new = F.col(day) >= F.lit(campaign_start)
        origin = F.when(is_new, NEW_BUSINESS).otherwise(KNOWN_BUSINESS)
    elif "classificacao_recebimento" in df.columns:
        known = F.col("classificacao_recebimento").isin(RECOVERED, "normal")
        origin = F.when(known, KNOWN_BUSINESS).otherwise(UNKNOWN_BUSINESS)
    else:
        origin = F.lit(UNKNOWN_BUSINESS)
    return df.withColumn("origem_negocio", origin)


def first_sale(df: DataFrame, campaign_start: date) -> DataFrame:
    """Clients whose first sale falls into the campaign, with its day."""
    first = df.where("cpf_titular is not null").groupBy("cpf_titular").agg(F.min("data_venda").alias("dia"))
    return first.where(F.col("dia") >= F.lit(campaign_start))


def last_recovery(df: DataFrame) -> DataFrame:
    """Recovered clients with the day of their last receipt."""
    rows = df.where(
        (F.col("classificacao_recebimento") == RECOVERED)
        & F.col("data_recebimento").isNotNull()
        & F.col("cpf_titular").isNotNull()
    )
    return rows.groupBy("cpf_titular").agg(F.max("data_recebimento").alias("dia"))


def new_clients(df: DataFrame, campaign_start: date) -> DataFrame:
    return first_sale(df, campaign_start).agg(F.count(F.lit(1)).alias("novos_clientes"))


def new_sales_daily(df: DataFrame, campaign_start: date) -> DataFrame:
    """Distinct sale numbers per day; equal numbers of two companies count once."""
    rows = df.where(F.col("data_venda") >= F.lit(campaign_start))
    return rows.groupBy(F.col("data_venda").alias("data")).agg(F.countDistinct("num_venda").alias("vendas"))


def weekday_name(index: Column) -> Column:
    return F.element_at(F.array(*(F.lit(name) for name in WEEKDAYS)), index + 1)


def coupons_weekday_avg(df: DataFrame) -> DataFrame:
    daily = (
        df.where("data_recebimento is not null")
        .groupBy("data_recebimento")
        .agg(F.coalesce(F.sum("cupons_calculados"), F.lit(0)).alias("cupons"))
    )
    by_weekday = daily.groupBy(F.weekday("data_recebimento").alias("d")).agg(F.avg("cupons").alias("cupons"))
    return by_weekday.select(weekday_name(F.col("d")).alias("dia"), rounded(F.col("cupons")).cast("long").alias("cupons"))


def clients_weekday(df: DataFrame, campaign_start: date) -> DataFrame:
    """New and recovered clients per weekday; all seven days appear."""
    tagged = [
        clients.select(F.weekday("dia").alias("d"), F.lit(new).alias("novos"), F.lit(1 - new).alias("recuperados"))
        for clients, new in ((first_sale(df, campaign_start), 1), (last_recovery(df), 0))
    ]
    counts = tagged[0].unionByName(tagged[1]).groupBy("d").agg(
        F.sum("novos").alias("novos"), F.sum("recuperados").alias("recuperados")
    )
    week = df.sparkSession.range(7).select(F.col("id").cast("int").alias("d"))
    return week.join(counts, "d", "left").select(
        weekday_name(F.col("d")).alias("dia"),
        F.coalesce("novos", F.lit(0)).alias("novos"),
        F.coalesce("recuperados", F.lit(0)).alias("recuperados"),
    )


def clients_daily_series(clients: DataFrame) -> DataFrame:
    """Clients per day with a running count, from ``first_sale`` or ``last_recovery``."""
    per_day = clients.groupBy(F.col("dia").alias("data")).agg(F.count(F.lit(1)).alias("quantidade"))
    return running(per_day, "quantidade")


def coupons_by_draw_type(df: DataFrame) -> DataFrame:
    types = DRAW_TYPES if "cupons_casas" in df.columns else OLDER_DRAW_TYPES
    present = [(text, name) for text, name in types if name in df.columns]
    sums = df.agg(
        *(F.coalesce(F.sum(F.col(name).cast("long")), F.lit(0)).alias(name) for _, name in present)
    )
    return unpivot_row(sums, "tipo", "cupons", present)


def top_developments(df: DataFrame, n: int | None = 6) -> DataFrame:
    """Developments by money received, with coupons, paying days and money per day."""
    per_day = (
        df.where("obra is not null")
        .groupBy("obra", "data_recebimento")
        .agg(F.sum("valor_total_recebido").alias("valor"), F.sum("cupons_calculados").alias("cupons"))
    )
    per_development = per_day.groupBy("obra").agg(
        F.coalesce(F.sum("valor"), zero_amount()).alias("valor"),
        F.coalesce(F.sum("cupons"), F.lit(0)).alias("cupons"),
        F.nullif(F.count("data_recebimento"), F.lit(0)).alias("dias_pagantes"),
    )
    daily = F.col("valor").cast("double") / F.col("dias_pagantes")
    ranked = per_development.withColumn("media_diaria", rounded(daily, 2))
    return ranked if n is None else ranked.orderBy(F.desc("valor"), "obra").limit(n)


def top_cities(df: DataFrame, value: str, n: int) -> DataFrame:
    sums = df.where("cidade is not null").groupBy("cidade").agg(F.sum(value).alias(value))
    return sums.orderBy(F.desc_nulls_last(value), "cidade").limit(n)


# Campaign calendar ----------------------------------------------------------


def draw_calendar(receipts: DataFrame, campaign: Campaign, as_of: date) -> DataFrame:
    """Payment month, its draw, and the money received for that draw so far."""
    last_month = campaign.end.replace(day=1)
    months = receipts.sparkSession.range(1).select(
        F.explode(
            F.sequence(F.lit(campaign.start.replace(day=1)), F.lit(last_month), F.expr("interval 1 month"))
        ).alias("mes")
    )
    money = receipts.groupBy(F.trunc("data_recebimento", "MM").alias("mes")).agg(
        F.sum("valor_total_recebido").alias("valor")
    )
    draw_day = F.date_add(F.add_months("mes", 1), campaign.draw_day - 1)
    is_last = F.col("mes") == F.lit(last_month)
    status = (
        F.when(draw_day <= F.lit(as_of), DONE)
        .when(F.col("mes") == F.trunc(F.lit(as_of), "MM"), SOON)
        .when(is_last, FINAL)
        .otherwise(FUTURE)
    )
    return months.join(money, "mes", "left").select(
        F.date_format("mes", "yyyy-MM").alias("pagamento"),
        F.date_format(F.add_months("mes", 1), "yyyy-MM").alias("sorteio"),
        draw_day.alias("data_sorteio"),
        F.when(is_last, FINAL_PRIZE).otherwise(MONTHLY_PRIZE).alias("premio"),
        status.alias("status"),
        is_last.alias("final"),
        F.coalesce("valor", zero_amount()).alias("valor_recebido"),
    )


def campaign_progress(receipts: DataFrame, campaign: Campaign, as_of: date) -> DataFrame:
    """Days elapsed, clamped to the campaign, beside the money received in it."""
    total = (campaign.end - campaign.start).days or 1
    elapsed = max(0, min(total, (as_of - campaign.start).days))
    day = F.col("data_recebimento")
    inside = (day >= F.lit(campaign.start)) & (day <= F.lit(min(as_of, campaign.end)))
    return receipts.agg(
        F.lit(elapsed).alias("dias_decorridos"),
        F.lit(total).alias("dias_totais"),
        F.lit(total - elapsed).alias("dias_restantes"),
        F.lit(round(100 * elapsed / total, 1)).alias("pct"),
        F.coalesce(F.sum(F.when(inside, F.col("valor_total_recebido"))), zero_amount()).alias("valor_recebido"),
    )


def month_slice(df: DataFrame, as_of: date) -> DataFrame:
    return df.where(F.col("mes_referencia") == f"{as_of:%Y-%m}")



def potential(df: DataFrame, rule: CouponRule, limit: int = 0) -> DataFrame:
    """Coupons generated against the limit, or against (received + overdue) / block."""
    sums = df.agg(
        F.coalesce(F.sum("cupons_calculados"), F.lit(0)).alias("cupons_realizados"),
        F.coalesce(F.sum("valor_total_recebido"), zero_amount()).alias("_recebido"),
        F.coalesce(F.sum("valor_vencido_antes"), zero_amount()).alias("_vencido"),
    )
    possible = ((F.col("_recebido") + F.col("_vencido")) / rule.amount_per_coupon).cast("long")
    shown = sums.withColumn("cupons_limite", F.lit(limit).cast("long") if limit else possible)
    share = 100 * F.col("cupons_realizados") / F.greatest("cupons_limite", F.lit(1))
    return shown.select("cupons_realizados", "cupons_limite", share.alias("pct_cupons"))
