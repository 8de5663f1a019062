"""Queries over many closes at once."""

from __future__ import annotations

from datetime import date

from lastro.operators import closes as M
from lastro.params import INSTALMENT_TYPES
from lastro.plans.contracts import CESSAO, DISTRATO, JURIDICO, VENDA
from lastro.plans.oracle_tables import EXCLUDED, KEY, KEY6, PREFIXES, with_tables
from lastro.plans.registry import Section
from lastro.sources import standin as S

section = Section()
MONTHS = 12
WINDOWS = M.month_closes(S.CLOSE.start, date(1998, 7, 1), MONTHS)

# SQL: every ledger row meets every cutoff.
CORTES = f"""
cortes as (
  select cast(date '1998-07-01' + to_months(cast(i as integer)) as date) as inicio,
    cast(date '1998-07-01' + to_months(cast(i + 1 as integer)) as date) as corte,
    cast(date '1998-07-01' + to_months(cast(i - 1 as integer)) as date) as anterior
  from range({MONTHS}) t(i)),
entradas as (
  select {KEY}, corte, sum(cheio) as valor_recebido, sum(base) as valor_gera_cupom,
    sum(case when pago_em >= inicio then base else 0 end) as valor_cupom_mes,
    sum(case when pago_em >= inicio then cheio else 0 end) as valor_recebido_mes,
    max(case when last_day(pago_em) < last_day(vencimento) then 1 else 0 end) as antecipou,
    sum(case when last_day(pago_em) < last_day(vencimento) then cheio else 0 end) as valor_antecipado,
    max(case when pago_em > vencimento then 1 else 0 end) as recuperou,
    sum(case when pago_em > vencimento then cheio else 0 end) as valor_recuperado, max(pago_em) as ultimo_recebimento
  from recebidas left join cedida using ({KEY}) join cortes on pago_em < corte
  where {PREFIXES} and tipo <> '1' and pago_em >= date '1998-07-01' and (data_cedida is null or pago_em < data_cedida)
  group by {KEY}, corte),
tardias as (
  select distinct {KEY}, corte, 1 as paga_depois from recebidas join cortes on vencimento < corte and pago_em >= corte
  where {PREFIXES}),
lancadas as (
  select distinct {KEY}, 1 as pagou_vencida_antes from recebidas
  where {PREFIXES} and vencimento < date '1998-07-01' and pago_em >= date '1998-07-01'),
primeiras as (select {KEY6}, min(pago_em) as primeira from recebidas where {PREFIXES} group by {KEY6}),
contas_em as (
  select c.*, k.* exclude ({KEY6}), corte, inicio, anterior, primeira is null or primeira >= corte as aberta,
    vencimento < corte and (primeira is null or primeira >= corte) as vencida
  from contas c left join calc k using ({KEY6}) left join primeiras using ({KEY6}) cross join cortes where {PREFIXES}),
carteira as (
  select {KEY}, corte, {
    ", ".join(
        f"cast(sum(case when tipo = '{kind}' then 1 else 0 end) as bigint) as qtd_{kind.lower()}"
        for kind in INSTALMENT_TYPES
    )
}, sum(case when tipo <> '1' then val_parcela else 0 end) as valor_a_receber,
    max(case when vencida then 1 end) as inadimplente,
    max(case when vencimento < date '1998-07-01' and aberta then 1 end) as aberta_antes_campanha,
    (corte - 1) - min(case when vencida then vencimento end) as dias_atraso,
    max(case when aberta and tipo <> '1' and vencimento >= anterior and vencimento < inicio then 1 end) as mes_anterior_aberto,
    sum(case when vencida and tipo <> '1' then coalesce(val_principal, 0) + coalesce(val_juros, 0)
      + coalesce(val_correcao, 0) else 0 end) as valor_inadimplente,
    sum(case when vencida and tipo <> '1' then coalesce(val_juro_atraso, 0) else 0 end) as valor_juros_inadimplencia,
    sum(case when vencida and tipo <> '1' then coalesce(val_multa_atraso, 0) else 0 end) as valor_multa_inadimplencia
  from contas_em group by {KEY}, corte),
primeiro_distrato as (select {KEY}, min(dia) as distratada from distrato_ef group by {KEY}),
nucleos as (
  select v.*, m.corte, k.* exclude ({KEY}, corte), t.* exclude ({KEY}, corte), t.num_venda is not null as recebeu, c.venda_nova,
    c.data_cedida, n.venda_origem, n.data_cessao, j.juridico_ativo as jur_ativo, j.juridico_passivo as jur_passivo,
    x.paga_depois, l.pagou_vencida_antes, coalesce(coalesce(d.data_aprov, d.data_cad) >= m.corte, false) as distratada_depois
  from venda v cross join cortes m left join carteira k using ({KEY}, corte) left join entradas t using ({KEY}, corte)
  left join cedida c using ({KEY}) left join cessao_nova n using ({KEY}) left join tardias x using ({KEY}, corte)
  left join lancadas l using ({KEY}) left join distrato d using ({KEY}) left join primeiro_distrato e using ({KEY})
  left join juridico j on j.empresa = v.empresa and j.documento = concat('VENDAS ', v.num_venda, '-', v.obra)
  where v.empresa not in {EXCLUDED} and (e.distratada is null or e.distratada >= m.corte)
    and (v.status = 0 or (t.num_venda is not null
      and (v.status = 3 or (v.status = 1 and c.venda_nova is not null) or (v.status = 1 and distratada_depois))))),
fechados as (
  select corte, {KEY}, cliente, data_venda, cast(valor_venda as double) as valor_venda, status,
    case when inadimplente = 1 or paga_depois = 1 then 'Inadimplente' else 'Adimplente' end as statuvenda,
    case when aberta_antes_campanha = 1 or pagou_vencida_antes = 1 then 1 else 0 end as inad_junho,
    case when recuperou = 1 then 1 else 0 end as recuperacao,
    cast(coalesce(valor_recuperado, 0) as double) as valor_recuperado,
    case when antecipou = 1 then 'Sim' else 'Não' end as antecipacao,
    cast(coalesce(valor_antecipado, 0) as double) as valor_antecipado,
    cast(coalesce(valor_a_receber, 0) as double) as valor_a_receber,
    cast(coalesce(valor_inadimplente, 0) as double) as valor_inadimplencia,
    cast(coalesce(valor_juros_inadimplencia, 0) as double) as valor_juros_inadimplencia,
    cast(coalesce(valor_multa_inadimplencia, 0) as double) as valor_multa_inadimplencia,
    cast(coalesce(valor_recebido, 0) as double) as valor_recebido,
    cast(coalesce(valor_gera_cupom, 0) as double) as valor_gera_cupom,
    cast(coalesce(valor_cupom_mes, 0) as double) as valor_cupom_mes_atual, ultimo_recebimento as data_ultimo_recebimento,
    cast(case when valor_recebido > 0 then floor(valor_recebido / 100) else 0 end as bigint) as cupons_milhao,
    cast(case when valor_recebido_mes > 0 then floor(valor_recebido_mes / 100) else 0 end as bigint) as cupons_casas,
    case when mes_anterior_aberto = 1 then 'Não' else 'Sim' end as pagou_parcela_mes_anterior, dias_atraso,
    case when distratada_depois or inadimplente = 1 or paga_depois = 1 then 'NÃO APTO' else 'APTO' end as status_sorteio,
    case when distratada_depois then 'DISTRATO APÓS O FECHAMENTO'
      when inadimplente = 1 or paga_depois = 1 then 'PARCELA VENCIDA EM ABERTO EM ' || strftime(corte - 1, '%d/%m')
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
  from nucleos)"""


@section.query("close_months", with_tables("select * from fechados", VENDA, CESSAO, DISTRATO, JURIDICO, CORTES))
def close_months(spark, sf):
    return M.close_months_core(S.erp(spark, sf), S.PORTFOLIO, WINDOWS)
