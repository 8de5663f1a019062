"""Queries over open instalments and receipts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lastro.operators import contracts as C
from lastro.operators import ledger as L
from lastro.params import INSTALMENT_TYPES
from lastro.plans.contracts import CESSAO
from lastro.plans.oracle_tables import KEY, KEY6, PREFIXES, with_tables
from lastro.plans.registry import Section
from lastro.schemas import SALE_KEY
from lastro.sources import standin as S

section = Section()
P, LIVE = S.PORTFOLIO, S.LIVE

# SQL: valuations repeat an instalment, as a plain left join does.
CONTAS = f"""
contas_calc as (
  select c.*, k.* exclude ({KEY6}) from contas c left join calc k using ({KEY6}) where left(c.obra, 2) in ('65', '67', '68', '69')),
consolidado as (
  select {KEY}, {
    ", ".join(
        f"cast(sum(case when tipo = '{kind}' then 1 else 0 end) as bigint) as qtd_{kind.lower()}"
        for kind in INSTALMENT_TYPES
    )
}, cast(sum(case when tipo <> '1' then val_parcela else 0 end) as double) as valor_a_receber,
    max(case when vencimento < date '1998-08-11' then 1 end) as inadimplente,
    max(case when vencimento < date '1998-07-01' then 1 end) as aberta_antes_campanha,
    date '1998-08-11' - min(case when vencimento < date '1998-08-11' then vencimento end) as dias_atraso,
    cast(sum(case when vencimento < date '1998-08-11' and tipo <> '1' then coalesce(val_principal, 0)
      + coalesce(val_juros, 0) + coalesce(val_correcao, 0) else 0 end) as double) as valor_inadimplente,
    cast(sum(case when vencimento < date '1998-08-11' and tipo <> '1' then coalesce(val_juro_atraso, 0)
      else 0 end) as double) as valor_juros_inadimplencia,
    cast(sum(case when vencimento < date '1998-08-11' and tipo <> '1' then coalesce(val_multa_atraso, 0)
      else 0 end) as double) as valor_multa_inadimplencia
  from contas_calc group by {KEY})"""


def totals_sql(name: str, start: str, end: str, month: str) -> str:
    return f"""
{name}_linhas as (
  select r.* from recebidas r left join cedida c using ({KEY})
  where left(r.obra, 2) in ('65', '67', '68', '69') and tipo <> '1' and pago_em >= date '{start}' and pago_em < date '{end}'
    and (c.data_cedida is null or pago_em < c.data_cedida)),
{name} as (
  select {KEY}, sum(cheio) as valor_recebido, sum(base) as valor_gera_cupom,
    sum(case when pago_em >= date '{month}' then base else 0 end) as valor_cupom_mes,
    sum(case when pago_em >= date '{month}' then cheio else 0 end) as valor_recebido_mes,
    max(case when vencimento < date '{start}' then 1 else 0 end) as pagou_vencida_antes,
    max(case when last_day(pago_em) < last_day(vencimento) then 1 else 0 end) as antecipou,
    sum(case when last_day(pago_em) < last_day(vencimento) then cheio else 0 end) as valor_antecipado,
    max(case when pago_em > vencimento then 1 else 0 end) as recuperou,
    sum(case when pago_em > vencimento then cheio else 0 end) as valor_recuperado,
    max(pago_em) as ultimo_recebimento
  from {name}_linhas group by {KEY})"""


TOTAIS = totals_sql("totais", "1998-07-01", "1999-01-01", "1998-08-01")
MES_ANTERIOR = f"""
mes_anterior as (
  select distinct {KEY}, 1 as mes_anterior_aberto from contas
  where tipo <> '1' and {PREFIXES} and vencimento >= date '1998-07-01' and vencimento < date '1998-08-01')"""


def _receivables(spark, sf):
    open_rows = L.open_by_instalment(S.receivables(spark, sf), P, LIVE.as_of, LIVE.start)
    valuation = L.valuation_by_instalment(S.valuations(spark, sf), P)
    return L.receivables_by_sale(open_rows, valuation, P, LIVE.as_of)


def _overdue(spark, sf):
    open_rows = L.open_by_instalment(S.receivables(spark, sf), P, LIVE.as_of, LIVE.start)
    return L.overdue_by_sale(open_rows, LIVE.as_of)


def _receivable_query(name: str, columns: list[str], marks_only: bool = False) -> None:
    sql = with_tables(f"select {KEY}, {', '.join(columns)} from consolidado", CONTAS)
    source = _overdue if marks_only else _receivables
    section.query(name, sql)(lambda spark, sf: source(spark, sf).select(*SALE_KEY, *columns))


_receivable_query("instalment_type_counts", [f"qtd_{kind.lower()}" for kind in INSTALMENT_TYPES])
_receivable_query("receivable_total", ["valor_a_receber"])
_receivable_query("overdue_flag", ["inadimplente"], marks_only=True)
_receivable_query("overdue_before_campaign", ["aberta_antes_campanha"], marks_only=True)
_receivable_query("days_overdue", ["dias_atraso"], marks_only=True)
_receivable_query("overdue_amount", ["valor_inadimplente"])
_receivable_query("overdue_interest_fine", ["valor_juros_inadimplencia", "valor_multa_inadimplencia"])


@section.query(
    "calc_values_join",
    with_tables(
        f"""select {KEY6}, count(*) as linhas, cast(sum(val_parcela) as double) as valor_parcela,
        cast(sum(val_principal) as double) as valor_principal from contas_calc group by {KEY6}""",
        CONTAS,
    ),
)
def calc_values_join(spark, sf):
    """Joined rows summed per instalment; the row pairs themselves are never formed."""
    open_rows = L.open_by_instalment(S.receivables(spark, sf), P, LIVE.as_of, LIVE.start)
    sums = (
        C.in_universe(S.valuations(spark, sf), P)
        .groupBy(*L.INSTALMENT_KEY)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("val_parcela").alias("v"), F.sum("val_principal").alias("p"))
    )
    joined = open_rows.join(sums, L.INSTALMENT_KEY, "left")
    return joined.select(
        *L.INSTALMENT_KEY,
        (F.col("linhas") * F.coalesce("n", F.lit(1))).alias("linhas"),
        (F.col("linhas") * F.col("v")).alias("valor_parcela"),
        (F.col("linhas") * F.col("p")).alias("valor_principal"),
    )


@section.query(
    "receipt_window_filter",
    with_tables(
        f"""select {KEY6}, pago_em, vencimento, cast(cheio as double) as cheio from recebidas where {PREFIXES} and tipo <> '1'
        and pago_em >= date '1998-07-01' and pago_em < date '1999-01-01'"""
    ),
)
def receipt_window_filter(spark, sf):
    window = L.receipts_in_window(S.receipts(spark, sf), P, LIVE.start, LIVE.end)
    return window.select(*L.INSTALMENT_KEY, "pago_em", "vencimento", L.full_amount().alias("cheio"))


@section.query(
    "receipt_cession_cut",
    with_tables(
        f"select {KEY}, pago_em, cast(sum(cheio) as double) as cheio from totais_linhas group by {KEY}, pago_em", CESSAO, TOTAIS
    ),
)
def receipt_cession_cut(spark, sf):
    daily = L.daily_receipts(L.receipts_in_window(S.receipts(spark, sf), P, LIVE.start, LIVE.end), LIVE.start)
    kept = L.before_cession(daily, C.cession_old_side(S.history(spark, sf), P))
    return kept.select(*SALE_KEY, "pago_em", "cheio")


def _receipt_query(name: str, columns: list[str], money: tuple[str, ...] = ()) -> None:
    shown = ", ".join(f"cast({c} as double) as {c}" if c in money else c for c in columns)

    def run(spark, sf):
        ceded = C.cession_old_side(S.history(spark, sf), P)
        totals = L.campaign_receipts(S.receipts(spark, sf), ceded, P, LIVE.start, LIVE.end, LIVE.month_start)
        return totals.select(*SALE_KEY, *columns)

    section.query(name, with_tables(f"select {KEY}, {shown} from totais", CESSAO, TOTAIS))(run)


_receipt_query("received_total", ["valor_recebido"], ("valor_recebido",))
_receipt_query("coupon_base_total", ["valor_gera_cupom"], ("valor_gera_cupom",))
_receipt_query("coupon_base_month", ["valor_cupom_mes"], ("valor_cupom_mes",))
_receipt_query("received_month", ["valor_recebido_mes"], ("valor_recebido_mes",))
_receipt_query("paid_precampaign_overdue", ["pagou_vencida_antes"])
_receipt_query("anticipated", ["antecipou", "valor_antecipado"], ("valor_antecipado",))
_receipt_query("recovered", ["recuperou", "valor_recuperado"], ("valor_recuperado",))
_receipt_query("last_receipt_date", ["ultimo_recebimento"])


@section.query("prev_month_open", with_tables("select * from mes_anterior", MES_ANTERIOR))
def prev_month_open(spark, sf):
    return L.previous_month_open(S.receivables(spark, sf), P, LIVE.previous_month_start, LIVE.month_start)
