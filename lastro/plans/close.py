"""Queries over the month close: as-of reconstruction and the audit base."""

from __future__ import annotations

from lastro.operators import base as B
from lastro.operators import contracts as C
from lastro.operators import eligibility as R
from lastro.operators import ledger as L
from lastro.params import INSTALMENT_TYPES
from lastro.plans.contracts import (
    CATEGORIA,
    CESSAO,
    DIMENSAO,
    DISTRATO,
    FONE,
    HIST_FLAGS,
    ITEM,
    JURIDICO,
    UNIDADE,
    VENDA,
    VENDA_FONTE,
)
from lastro.plans.ledger import totals_sql
from lastro.plans.oracle_tables import EXCLUDED, KEY, KEY6, PREFIXES, with_tables
from lastro.plans.registry import Section
from lastro.plans.rulings import enriched_sql
from lastro.schemas import SALE_KEY
from lastro.sources import standin as S

section = Section()
P, CLOSE = S.PORTFOLIO, S.CLOSE

PAGAS = f"""
pagas as (select distinct {KEY6} from recebidas where {PREFIXES} and pago_em < date '1998-08-01'),
contas_corte as (
  select c.*, k.* exclude ({KEY6}), p.num_venda as paga, c.vencimento < date '1998-08-01' and p.num_venda is null as vencida
  from contas c left join calc k using ({KEY6}) left join pagas p using ({KEY6})
  where left(c.obra, 2) in ('65', '67', '68', '69')),
consolidado_corte as (
  select {KEY}, {
    ", ".join(
        f"cast(sum(case when tipo = '{kind}' then 1 else 0 end) as bigint) as qtd_{kind.lower()}"
        for kind in INSTALMENT_TYPES
    )
}, cast(sum(case when tipo <> '1' then val_parcela else 0 end) as double) as valor_a_receber,
    max(case when vencida then 1 end) as inadimplente,
    max(case when vencimento < date '1998-07-01' and paga is null then 1 end) as aberta_antes_campanha,
    date '1998-07-31' - min(case when vencida then vencimento end) as dias_atraso,
    cast(sum(case when vencida and tipo <> '1' then coalesce(val_principal, 0) + coalesce(val_juros, 0)
      + coalesce(val_correcao, 0) else 0 end) as double) as valor_inadimplente,
    cast(sum(case when vencida and tipo <> '1' then coalesce(val_juro_atraso, 0) else 0 end) as double)
      as valor_juros_inadimplencia,
    cast(sum(case when vencida and tipo <> '1' then coalesce(val_multa_atraso, 0) else 0 end) as double)
      as valor_multa_inadimplencia
  from contas_corte group by {KEY})"""

DEPOIS = f"""
pagas_depois as (
  select distinct {KEY}, 1 as paga_depois from recebidas
  where {PREFIXES} and vencimento < date '1998-08-01' and pago_em >= date '1998-08-01'),
largada as (
  select distinct {KEY}, 1 as pagou_vencida_antes from recebidas
  where {PREFIXES} and vencimento < date '1998-07-01' and pago_em >= date '1998-07-01')"""

TOTAIS_CORTE = totals_sql("totais_corte", "1998-07-01", "1998-08-01", "1998-07-01")
MES_ANTERIOR_CORTE = f"""
mes_anterior_corte as (
  select distinct {KEY}, 1 as mes_anterior_aberto from contas c
  where tipo <> '1' and {PREFIXES} and vencimento >= date '1998-06-01' and vencimento < date '1998-07-01'
    and not exists (select 1 from pagas p where p.empresa = c.empresa and p.obra = c.obra and p.num_venda = c.num_venda
      and p.num_parcela = c.num_parcela and p.num_parcela_geral = c.num_parcela_geral and p.tipo = c.tipo))"""

NUCLEO_CORTE = f"""
nucleo_corte as (
  select v.*, k.* exclude ({KEY}), t.* exclude ({KEY}, pagou_vencida_antes), c.venda_nova, c.data_cedida, n.venda_origem,
    n.data_cessao, m.mes_anterior_aberto, j.juridico_ativo as jur_ativo, j.juridico_passivo as jur_passivo,
    x.paga_depois, l.pagou_vencida_antes,
    coalesce(coalesce(d.data_aprov, d.data_cad) >= date '1998-08-01', false) as distratada_depois
  from venda v left join consolidado_corte k using ({KEY}) left join totais_corte t using ({KEY})
  left join cedida c using ({KEY}) left join cessao_nova n using ({KEY}) left join mes_anterior_corte m using ({KEY})
  left join pagas_depois x using ({KEY}) left join largada l using ({KEY}) left join distrato d using ({KEY})
  left join juridico j on j.empresa = v.empresa and j.documento = concat('VENDAS ', v.num_venda, '-', v.obra)
  where (v.status = 0 or (v.status = 3 and t.num_venda is not null)
      or (v.status = 1 and c.venda_nova is not null and t.num_venda is not null)
      or (v.status = 1 and distratada_depois and t.num_venda is not null))
    and v.empresa not in {EXCLUDED}
    and not exists (select 1 from distrato_ef e where e.empresa = v.empresa and e.obra = v.obra
      and e.num_venda = v.num_venda and e.dia < date '1998-08-01')),
fechado as (
  select {KEY}, cliente, data_venda, cast(valor_venda as double) as valor_venda, status,
    case when inadimplente = 1 or paga_depois = 1 then 'Inadimplente' else 'Adimplente' end as statuvenda,
    case when aberta_antes_campanha = 1 or pagou_vencida_antes = 1 then 1 else 0 end as inad_junho,
    case when recuperou = 1 then 1 else 0 end as recuperacao,
    cast(coalesce(valor_recuperado, 0) as double) as valor_recuperado,
    case when antecipou = 1 then 'Sim' else 'Não' end as antecipacao,
    cast(coalesce(valor_antecipado, 0) as double) as valor_antecipado,
    coalesce(valor_a_receber, 0) as valor_a_receber, coalesce(valor_inadimplente, 0) as valor_inadimplencia,
    coalesce(valor_juros_inadimplencia, 0) as valor_juros_inadimplencia,
    coalesce(valor_multa_inadimplencia, 0) as valor_multa_inadimplencia,
    cast(coalesce(valor_recebido, 0) as double) as valor_recebido,
    cast(coalesce(valor_gera_cupom, 0) as double) as valor_gera_cupom,
    cast(coalesce(valor_cupom_mes, 0) as double) as valor_cupom_mes_atual,
    ultimo_recebimento as data_ultimo_recebimento,
    cast(case when valor_recebido > 0 then floor(valor_recebido / 100) else 0 end as bigint) as cupons_milhao,
    cast(case when valor_recebido_mes > 0 then floor(valor_recebido_mes / 100) else 0 end as bigint) as cupons_casas,
    case when mes_anterior_aberto = 1 then 'Não' else 'Sim' end as pagou_parcela_mes_anterior, dias_atraso,
    case when distratada_depois or inadimplente = 1 or paga_depois = 1 then 'NÃO APTO' else 'APTO' end
      as status_sorteio,
    case when distratada_depois then 'DISTRATO APÓS O FECHAMENTO'
      when inadimplente = 1 or paga_depois = 1 then 'PARCELA VENCIDA EM ABERTO EM 31/07'
      else 'ADIMPLENTE' end as motivo,
    case when jur_ativo = 1 then 'Sim' else 'Não' end as juridico_ativo,
    case when jur_passivo = 1 then 'Sim' else 'Não' end as juridico_passivo,
    case when venda_origem is not null then 'Sim' else 'Não' end as cessao, venda_origem as venda_origem_cessao, data_cessao,
    case when status = 3 then 'Sim' else 'Não' end as contrato_quitado,
    case when venda_nova is not null then 'Sim' else 'Não' end as contrato_cedido, venda_nova as venda_nova_cessao, data_cedida,
    case when distratada_depois then 1 else 0 end as distrato_apos_fechamento,
    case when distratada_depois then 'NÃO APTO'
      when status = 3 or (status = 1 and venda_nova is not null)
        then case when coalesce(valor_recebido_mes, 0) > 0 then 'APTO' else 'NÃO APTO' end
      when inadimplente = 1 or paga_depois = 1 then 'NÃO APTO' else 'APTO' end as aptidao_casas,
    status_sorteio as aptidao_sorteio,
    qtd_p, qtd_s, qtd_sa, qtd_sn, qtd_e, qtd_er, qtd_am, qtd_fc, qtd_b, qtd_r, qtd_i, qtd_op
  from nucleo_corte)"""

CLOSE_PARTS = (
    VENDA, PAGAS, DEPOIS, CESSAO, TOTAIS_CORTE, MES_ANTERIOR_CORTE, JURIDICO, DISTRATO, NUCLEO_CORTE,
)


def _open_rows(spark, sf):
    rows = L.open_by_instalment(S.receivables(spark, sf), P, CLOSE.cutoff, CLOSE.start)
    return L.drop_paid(rows, L.paid_before(S.receipts(spark, sf), P, CLOSE.cutoff))


@section.query("paid_before_cutoff", with_tables("select * from pagas", PAGAS))
def paid_before_cutoff(spark, sf):
    return L.paid_before(S.receipts(spark, sf), P, CLOSE.cutoff)


@section.query("receivables_asof", with_tables("select * from consolidado_corte", PAGAS))
def receivables_asof(spark, sf):
    valuation = L.valuation_by_instalment(S.valuations(spark, sf), P)
    return L.receivables_by_sale(_open_rows(spark, sf), valuation, P, CLOSE.last_day)


@section.query("paid_after_cutoff", with_tables("select * from pagas_depois", DEPOIS))
def paid_after_cutoff(spark, sf):
    return L.due_before_paid_after(S.receipts(spark, sf), P, CLOSE.cutoff, "paga_depois")


@section.query("overdue_at_launch_retro", with_tables("select * from largada", DEPOIS))
def overdue_at_launch_retro(spark, sf):
    return L.due_before_paid_after(S.receipts(spark, sf), P, CLOSE.start, "pagou_vencida_antes")


_TOTALS = ["valor_recebido", "valor_gera_cupom", "valor_cupom_mes", "valor_recebido_mes", "valor_antecipado", "valor_recuperado"]


@section.query(
    "receipts_closed_window",
    with_tables(
        f"""select {KEY}, {", ".join(f"cast({c} as double) as {c}" for c in _TOTALS)}, antecipou, recuperou, ultimo_recebimento
        from totais_corte""",
        CESSAO,
        TOTAIS_CORTE,
    ),
)
def receipts_closed_window(spark, sf):
    ceded = C.cession_old_side(S.history(spark, sf), P)
    totals = L.campaign_receipts(S.receipts(spark, sf), ceded, P, CLOSE.start, CLOSE.cutoff, CLOSE.month_start)
    return totals.drop("pagou_vencida_antes")


@section.query("prev_month_open_asof", with_tables("select * from mes_anterior_corte", PAGAS, MES_ANTERIOR_CORTE))
def prev_month_open_asof(spark, sf):
    return L.previous_month_open_asof(
        S.receivables(spark, sf), S.receipts(spark, sf), P, CLOSE.previous_month_start, CLOSE.month_start, CLOSE.cutoff
    )


@section.query(
    "cancel_after_close",
    with_tables(
        f"""select {KEY}, case when coalesce(data_aprov, data_cad) >= date '1998-08-01' then 1 else 0 end
        as distrato_apos_fechamento from distrato""",
        DISTRATO,
    ),
)
def cancel_after_close(spark, sf):
    latest = C.cancellation_latest(S.cancellations(spark, sf))
    return latest.select(*SALE_KEY, R.flag(R.cancelled_after(CLOSE.cutoff)).alias("distrato_apos_fechamento"))


def _close_query(name: str, columns: list[str]) -> None:
    wanted = [*SALE_KEY, *columns]
    section.query(name, with_tables(f"select {', '.join(wanted)} from fechado", *CLOSE_PARTS))(
        lambda spark, sf: B.close_core(S.erp(spark, sf), P, CLOSE, wanted)
    )


_close_query("status_reason_retro", ["statuvenda", "status_sorteio", "motivo"])
_close_query("eligibility_retro", ["aptidao_casas", "aptidao_sorteio"])
_close_query("membership_retro", ["status"])


@section.query(
    "cancel_before_cutoff_antijoin",
    with_tables(
        f"""select {KEY}, status from venda v where not exists (select 1 from distrato_ef e
        where e.empresa = v.empresa and e.obra = v.obra and e.num_venda = v.num_venda and e.dia < date '1998-08-01')""",
        VENDA,
        DISTRATO,
    ),
)
def cancel_before_cutoff_antijoin(spark, sf):
    sales = C.all_sales(S.sales_live(spark, sf), S.sales_archived(spark, sf), P)
    kept = C.without_cancelled_before(sales, S.cancellations(spark, sf), CLOSE.cutoff)
    return kept.select(*SALE_KEY, "status")


@section.query("contract_base_close", with_tables(enriched_sql("fechado"), *CLOSE_PARTS, DIMENSAO, ITEM, UNIDADE, FONE))
def contract_base_close(spark, sf):
    return B.contract_base_close(S.erp(spark, sf), P, CLOSE)


FECHAMENTO = f"""
rec_mes as (
  select {KEY}, sum(base) as valor_gera_cupom, sum(cheio) as valor_recebido,
    max(case when pago_em >= date '1998-07-30' then 1 else 0 end) as pgto_fim_mes, max(pago_em) as ultimo_recebimento
  from totais_corte_linhas group by {KEY}),
abertas as (
  select distinct {KEY}, 1 as aberta_no_corte from contas c where {PREFIXES} and vencimento < date '1998-08-01'
    and not exists (select 1 from pagas p where p.empresa = c.empresa and p.obra = c.obra and p.num_venda = c.num_venda
      and p.num_parcela = c.num_parcela and p.num_parcela_geral = c.num_parcela_geral and p.tipo = c.tipo)),
auditoria as (
  select v.empresa as codempresa, v.obra as codobra, v.num_venda as venda, upper(s.nome) as nomecliente, s.cpf,
    cast(coalesce(valor_gera_cupom, 0) as double) as valor_gera_cupom_mes,
    cast(coalesce(valor_recebido, 0) as double) as valor_recebido_mes,
    cast(case when valor_recebido > 0 then floor(valor_recebido / 100) else 0 end as bigint) as cupons_casas_mes,
    ultimo_recebimento as ultimo_recebimento_mes,
    case when aberta_no_corte = 1 or paga_depois = 1 then 'NAO APTO' else 'APTO' end as status_fechamento,
    case when aberta_no_corte = 1 or paga_depois = 1 then 'PARCELA VENCIDA EM ABERTO EM 31/07'
      else 'ADIMPLENTE NO FECHAMENTO' end as motivo,
    case when pgto_fim_mes = 1 then 1 else 0 end as pgto_fim_mes, fonte_venda,
    case status when 0 then 'NORMAL' when 1 then 'CANCELADA' when 2 then 'ALTERADA' when 3 then 'QUITADA'
      when 4 then 'EM ACERTO' else concat('DESCONHECIDO (', status, ')') end as status_venda,
    case when d.num_venda is not null then 'Sim' else 'Nao' end as distrato_aprovado,
    case when d.num_venda is null then '' when teve_cessao = 1 then 'TRANSFERENCIA (CESSAO DE DIREITO)'
      else 'CANCELAMENTO' end as classificacao_distrato,
    case tipo_distrato when 0 then 'NORMAL' when 1 then 'ADMINISTRATIVO' else '' end as tipo_distrato,
    coalesce(categoria_distrato, '') as categoria_distrato, coalesce(motivo_distrato, '') as motivo_distrato,
    data_cad as data_geracao_distrato, data_aprov as data_aprovacao_distrato,
    case when coalesce(data_aprov, data_cad) >= date '1998-08-01' then 1 else 0 end as distrato_apos_fechamento,
    case when teve_cessao = 1 then 'Sim' else 'Nao' end as cessao_hist,
    case when teve_renegociacao = 1 then 'Sim' else 'Nao' end as renegociacao_hist,
    u.data_cedida as data_cessao, case when u.data_aprovacao >= date '1998-08-01' then 1 else 0 end as cessao_apos_fechamento,
    u.venda_nova as venda_nova_cessao, n.venda_origem as venda_origem_cessao
  from venda_fonte v left join pessoas s using (cliente) left join rec_mes using ({KEY}) left join abertas using ({KEY})
  left join pagas_depois using ({KEY}) left join distrato_cat d using ({KEY}) left join hist_flags using ({KEY})
  left join cessao_ultima u using ({KEY}) left join cessao_nova n using ({KEY})
  where v.empresa not in {EXCLUDED})"""

AUDIT_PARTS = (
    VENDA_FONTE, PAGAS, DEPOIS, CESSAO, TOTAIS_CORTE, DISTRATO, CATEGORIA, HIST_FLAGS, FECHAMENTO,
)


@section.query(
    "close_receipts_month",
    with_tables(
        f"""select {KEY}, cast(valor_gera_cupom as double) as valor_gera_cupom, cast(valor_recebido as double) as valor_recebido,
        pgto_fim_mes, ultimo_recebimento from rec_mes""",
        *AUDIT_PARTS,
    ),
)
def close_receipts_month(spark, sf):
    ceded = C.cession_old_side(S.history(spark, sf), P)
    return L.close_receipts(S.receipts(spark, sf), ceded, P, CLOSE.month_start, CLOSE.cutoff)


@section.query("close_open_instalments", with_tables("select * from abertas", *AUDIT_PARTS))
def close_open_instalments(spark, sf):
    return L.open_at_cutoff(S.receivables(spark, sf), S.receipts(spark, sf), P, CLOSE.cutoff)


def _audit_query(name: str, columns: list[str]) -> None:
    wanted = ["codempresa", "codobra", "venda", *columns]
    section.query(name, with_tables(f"select {', '.join(wanted)} from auditoria", *AUDIT_PARTS))(
        lambda spark, sf: B.close_full(S.erp(spark, sf), P, CLOSE).select(*wanted)
    )


_audit_query("close_status", ["status_fechamento", "motivo", "cupons_casas_mes"])
_audit_query("status_labels", ["status_venda", "tipo_distrato"])
_audit_query("cancel_vs_transfer", ["distrato_aprovado", "classificacao_distrato"])
_audit_query("cession_after_close_link", ["data_cessao", "cessao_apos_fechamento", "venda_nova_cessao", "venda_origem_cessao"])


@section.query("close_full", with_tables("select * from auditoria", *AUDIT_PARTS))
def close_full(spark, sf):
    return B.close_full(S.erp(spark, sf), P, CLOSE)
