"""Queries over the live contract row: rulings, coupons, texts, the whole base."""

from __future__ import annotations

from pyspark.sql import functions as F

from lastro.operators import base as B
from lastro.operators import eligibility as R
from lastro.plans.contracts import CESSAO, DIMENSAO, DISTRATO, FONE, ITEM, JURIDICO, UNIDADE, VENDA
from lastro.plans.ledger import CONTAS, MES_ANTERIOR, TOTAIS
from lastro.plans.oracle_tables import EXCLUDED, KEY, with_tables
from lastro.plans.registry import Section
from lastro.sources import standin as S

section = Section()

NUCLEO = f"""
nucleo as (
  select v.*, k.* exclude ({KEY}), t.* exclude ({KEY}), c.venda_nova, c.data_cedida, n.venda_origem, n.data_cessao,
    m.mes_anterior_aberto, j.juridico_ativo as jur_ativo, j.juridico_passivo as jur_passivo
  from venda v left join consolidado k using ({KEY}) left join totais t using ({KEY}) left join cedida c using ({KEY})
  left join cessao_nova n using ({KEY}) left join mes_anterior m using ({KEY})
  left join juridico j on j.empresa = v.empresa and j.documento = concat('VENDAS ', v.num_venda, '-', v.obra)
  where (v.status = 0 or (v.status = 3 and t.num_venda is not null)
      or (v.status = 1 and c.venda_nova is not null and t.num_venda is not null))
    and v.empresa not in {EXCLUDED}
    and not exists (select 1 from distrato_ef d
      where d.empresa = v.empresa and d.obra = v.obra and d.num_venda = v.num_venda)),
vivo as (
  select {KEY}, cliente, data_venda, cast(valor_venda as double) as valor_venda, status,
    case when inadimplente = 1 then 'Inadimplente' else 'Adimplente' end as statuvenda,
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
    case when inadimplente = 1 then 'NÃO APTO' else 'APTO' end as status_sorteio,
    case when inadimplente = 1 then 'PARCELA VENCIDA NO ENCERRAMENTO DO PERÍODO'
      else 'ADIMPLENTE' end as motivo,
    case when jur_ativo = 1 then 'Sim' else 'Não' end as juridico_ativo,
    case when jur_passivo = 1 then 'Sim' else 'Não' end as juridico_passivo,
    case when venda_origem is not null then 'Sim' else 'Não' end as cessao, venda_origem as venda_origem_cessao, data_cessao,
    case when status = 3 then 'Sim' else 'Não' end as contrato_quitado,
    case when venda_nova is not null then 'Sim' else 'Não' end as contrato_cedido, venda_nova as venda_nova_cessao, data_cedida,
    case when status = 3 or (status = 1 and venda_nova is not null)
        then case when coalesce(valor_recebido_mes, 0) > 0 then 'APTO' else 'NÃO APTO' end
      when inadimplente = 1 then 'NÃO APTO' else 'APTO' end as aptidao_casas,
    case when inadimplente = 1 then 'NÃO APTO' else 'APTO' end as aptidao_sorteio,
    qtd_p, qtd_s, qtd_sa, qtd_sn, qtd_e, qtd_er, qtd_am, qtd_fc, qtd_b, qtd_r, qtd_i, qtd_op
  from nucleo)"""

LIVE_PARTS = (VENDA, CONTAS, CESSAO, TOTAIS, MES_ANTERIOR, JURIDICO, DISTRATO, NUCLEO)


def enriched_sql(source: str, extra: str = "") -> str:
    return f"""
select cidade, regional, v.empresa as codempresa, v.obra as codobra, obra_nome as nomeobra, empresa_nome as nomeempresa,
  produto_nome as produto, v.num_venda as venda, identificador, data_venda as dt_venda, valor_venda as vlrvenda,
  upper(nome) as nomecliente, cpf as cpf_pes, lower(email) as emailcliente, telefone as telefoneformatado,
  tipo_telefone as tipotelefone, v.* exclude ({KEY}, cliente, status, data_venda, valor_venda, dias_atraso,
    qtd_p, qtd_s, qtd_sa, qtd_sn, qtd_e, qtd_er, qtd_am, qtd_fc, qtd_b, qtd_r, qtd_i, qtd_op),
  dias_atraso as diasatraso, qtd_p as qtd_parcelas, qtd_s as qtd_sinal, qtd_sa as qtd_sinal_arras,
  qtd_sn as qtd_sinal_negoci, qtd_e as qtd_entrada, qtd_er as qtd_ent_reativacao, qtd_am as qtd_amortizacao,
  qtd_fc as qtd_financ_cef, qtd_b as qtd_balao, qtd_r as qtd_residuo, qtd_i as qtd_intermediacao,
  qtd_op as qtd_operacao_xpi
from {source} v join dimensao d using (empresa, obra) join item_unidade i using ({KEY})
left join produtos p on p.produto = i.produto_unidade and p.status = 1
left join pessoas s on s.cliente = v.cliente left join melhor_fone f on f.cliente = v.cliente"""


def _live_query(name: str, columns: list[str]) -> None:
    wanted = ["empresa", "obra", "num_venda", *columns]
    section.query(name, with_tables(f"select {', '.join(wanted)} from vivo", *LIVE_PARTS))(
        lambda spark, sf: B.live_core(S.erp(spark, sf), S.PORTFOLIO, S.LIVE, wanted)
    )


_live_query("default_status", ["statuvenda"])
_live_query("overdue_at_launch", ["inad_junho"])
_live_query("recovery_advance_cols", ["recuperacao", "valor_recuperado", "antecipacao", "valor_antecipado"])
_live_query("coupons_final_month", ["cupons_milhao", "cupons_casas"])
_live_query("paid_prev_month", ["pagou_parcela_mes_anterior"])
_live_query("draw_status_reason", ["status_sorteio", "motivo"])
_live_query("legal_flags", ["juridico_ativo", "juridico_passivo"])
_live_query(
    "cession_cols",
    ["cessao", "venda_origem_cessao", "data_cessao", "contrato_quitado", "contrato_cedido", "venda_nova_cessao", "data_cedida"],
)
_live_query("eligible_monthly", ["aptidao_casas"])
_live_query("eligible_final", ["aptidao_sorteio"])

_BASE_SQL = with_tables(enriched_sql("vivo"), *LIVE_PARTS, DIMENSAO, ITEM, UNIDADE, FONE)


@section.query("contract_base_live", _BASE_SQL)
def contract_base_live(spark, sf):
    return B.contract_base_live(S.erp(spark, sf), S.PORTFOLIO, S.LIVE)


@section.query(
    "text_presentation",
    with_tables(
        f"""select codempresa, codobra, venda, regional, nomecliente, emailcliente,
        strftime(dt_venda, '%d/%m/%Y') as dt_venda, strftime(data_ultimo_recebimento, '%d/%m/%Y') as data_ultimo_recebimento,
        strftime(data_cessao, '%d/%m/%Y') as data_cessao, strftime(data_cedida, '%d/%m/%Y') as data_cedida
        from ({enriched_sql("vivo")})""",
        *LIVE_PARTS,
        DIMENSAO,
        ITEM,
        UNIDADE,
        FONE,
    ),
)
def text_presentation(spark, sf):
    shown = R.presentation(B.contract_base_live(S.erp(spark, sf), S.PORTFOLIO, S.LIVE))
    return shown.select(
        "codempresa",
        "codobra",
        "venda",
        F.col("regional"),
        "nomecliente",
        "emailcliente",
        "dt_venda",
        "data_ultimo_recebimento",
        "data_cessao",
        "data_cedida",
    )
