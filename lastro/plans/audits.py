"""Audit queries: cessions, technical receipts, posting dates, key traces."""

from __future__ import annotations

from lastro.operators import audits as A
from lastro.plans.contracts import CESSAO, DISTRATO
from lastro.plans.oracle_tables import EXCLUDED, KEY, PREFIXES, with_tables
from lastro.plans.registry import Section
from lastro.sources import standin as S

section = Section()
P, LIVE, CLOSE = S.PORTFOLIO, S.LIVE, S.CLOSE

CESSOES = f"""
cessoes_base as (select * from cessoes where empresa not in {EXCLUDED}),
cessoes_camp as (select * from cessoes_base where data_mnt >= date '1998-07-01'),
rec_camp as (
  select * from recebidas where {PREFIXES} and pago_em >= date '1998-07-01' and pago_em < date '1999-01-01')"""


@section.query(
    "cession_volumetry",
    with_tables(
        """select count(*) as cessoes_aprovadas, count(*) filter (data_mnt >= date '1998-07-01') as cessoes_na_campanha,
        min(data_mnt) as primeira_cessao, max(data_mnt) as ultima_cessao from cessoes_base""",
        CESSAO,
        CESSOES,
    ),
)
def cession_volumetry(spark, sf):
    return A.volumetry(S.history(spark, sf), P, LIVE.start)


@section.query(
    "cession_locate_sides",
    with_tables(
        """select h.empresa, h.obra, h.num_venda as venda_antiga, h.num_nova as venda_nova, h.num_hist, h.data_mnt as data_cessao,
        case when va.num_venda is not null then concat('Vendas (status ', va.status, ')')
          when ra.num_venda is not null then concat('VendasRecebidas (status ', ra.status, ')')
          else 'SUMIU (nenhuma tabela)' end as onde_venda_antiga,
        case when vn.num_venda is not null then concat('Vendas (status ', vn.status, ')')
          when rn.num_venda is not null then concat('VendasRecebidas (status ', rn.status, ')')
          else 'NAO ENCONTRADA' end as onde_venda_nova,
        case when coalesce(vn.status, rn.status) = 0 and not exists (select 1 from distrato_ef d
          where d.empresa = h.empresa and d.obra = h.obra and d.num_venda = h.num_nova) then 'Sim' else 'NAO' end
          as nova_entra_na_base
        from cessoes_camp h
        left join vendas va on va.empresa = h.empresa and va.obra = h.obra and va.num_venda = h.num_venda
        left join vendas_rec ra on ra.empresa = h.empresa and ra.obra = h.obra and ra.num_venda = h.num_venda
        left join vendas vn on vn.empresa = h.empresa and vn.obra = h.obra and vn.num_venda = h.num_nova
        left join vendas_rec rn on rn.empresa = h.empresa and rn.obra = h.obra and rn.num_venda = h.num_nova""",
        CESSAO,
        CESSOES,
        DISTRATO,
    ),
)
def cession_locate_sides(spark, sf):
    live, archived = S.sales_live(spark, sf), S.sales_archived(spark, sf)
    return A.locate_sides(S.history(spark, sf), live, archived, S.cancellations(spark, sf), P, LIVE.start)


@section.query(
    "cession_money_by_side",
    with_tables(
        f"""select lado, count(distinct concat(empresa, '-', obra, '-', num_venda)) as qtd_vendas,
        cast(sum(cheio) as double) as valor_recebido_campanha from (
          select 'Antiga (cedente)' as lado, h.empresa, h.obra, h.num_venda, cheio from cessoes_camp h
          join rec_camp r using ({KEY}) where r.tipo <> '1'
          union all
          select 'Nova (cessionario)', h.empresa, h.obra, h.num_nova, cheio from cessoes_camp h
          join rec_camp r on r.empresa = h.empresa and r.obra = h.obra and r.num_venda = h.num_nova where r.tipo <> '1')
        group by lado""",
        CESSAO,
        CESSOES,
    ),
)
def cession_money_by_side(spark, sf):
    return A.money_by_side(S.history(spark, sf), S.receipts(spark, sf), P, LIVE)


@section.query(
    "cession_date_semantics",
    with_tables(
        """select case when a.data_cessao is not null then 1 else 0 end as antiga_tem_data_cessao,
        case when n.data_cessao is not null then 1 else 0 end as nova_tem_data_cessao, count(*) as qtd
        from cessoes_base h
        left join vendas a on a.empresa = h.empresa and a.obra = h.obra and a.num_venda = h.num_venda
        left join vendas n on n.empresa = h.empresa and n.obra = h.obra and n.num_venda = h.num_nova group by all""",
        CESSAO,
        CESSOES,
    ),
)
def cession_date_semantics(spark, sf):
    return A.date_semantics(S.history(spark, sf), S.sales_live(spark, sf), P)


@section.query(
    "cession_recent_sample",
    with_tables(
        """select h.empresa, h.obra, h.num_venda as venda_antiga, h.num_nova as venda_nova, h.data_mnt as data_cessao,
        pa.nome as cliente_antigo, pn.nome as cliente_novo
        from cessoes_camp h
        left join vendas va on va.empresa = h.empresa and va.obra = h.obra and va.num_venda = h.num_venda
        left join vendas_rec ra on ra.empresa = h.empresa and ra.obra = h.obra and ra.num_venda = h.num_venda
        left join vendas vn on vn.empresa = h.empresa and vn.obra = h.obra and vn.num_venda = h.num_nova
        left join pessoas pa on pa.cliente = coalesce(va.cliente, ra.cliente) left join pessoas pn on pn.cliente = vn.cliente
        order by h.data_mnt desc, h.empresa, h.obra, h.num_venda, h.num_hist limit 20""",
        CESSAO,
        CESSOES,
    ),
)
def cession_recent_sample(spark, sf):
    live, archived = S.sales_live(spark, sf), S.sales_archived(spark, sf)
    return A.recent_sample(S.history(spark, sf), live, archived, S.people(spark, sf), P, LIVE.start)


def _position_sql(number: str, labels: tuple[str, str, str]) -> str:
    return with_tables(
        f"""select case when r.pago_em < h.data_mnt then '{labels[0]}' when r.pago_em = h.data_mnt then '{labels[1]}'
          else '{labels[2]}' end as posicao, r.tipo, count(*) as qtd_linhas,
        count(distinct concat(r.empresa, '-', r.obra, '-', r.num_venda)) as qtd_vendas,
        cast(sum(cheio) as double) as valor_recebido
        from cessoes_camp h join rec_camp r on r.empresa = h.empresa and r.obra = h.obra and r.num_venda = h.{number}
        group by all""",
        CESSAO,
        CESSOES,
    )


@section.query("technical_receipt_old", _position_sql("num_venda", A.OLD_POSITIONS))
def technical_receipt_old(spark, sf):
    return A.technical_receipts(S.history(spark, sf), S.receipts(spark, sf), P, LIVE, new_side=False)


@section.query("technical_receipt_new", _position_sql("num_nova", A.NEW_POSITIONS))
def technical_receipt_new(spark, sf):
    return A.technical_receipts(S.history(spark, sf), S.receipts(spark, sf), P, LIVE, new_side=True)


@section.query(
    "technical_receipt_settled",
    with_tables(
        f"""select h.empresa, h.obra, h.num_nova as num_venda, h.data_mnt as data_cessao,
        cast(sum(case when pago_em <= h.data_mnt then cheio else 0 end) as double) as valor_no_dia_ou_antes,
        cast(sum(case when pago_em > h.data_mnt then cheio else 0 end) as double) as valor_fora_janela_tecnica
        from cessoes_camp h
        join vendas_rec v on v.empresa = h.empresa and v.obra = h.obra and v.num_venda = h.num_nova and v.status = 3
        join rec_camp r on r.empresa = h.empresa and r.obra = h.obra and r.num_venda = h.num_nova and r.tipo <> '1'
        group by all""",
        CESSAO,
        CESSOES,
    ),
)
def technical_receipt_settled(spark, sf):
    return A.technical_settled(S.history(spark, sf), S.sales_archived(spark, sf), S.receipts(spark, sf), P, LIVE)


@section.query(
    "posting_date_sanity",
    with_tables(
        f"""select count(*) as total_linhas, count(*) filter (cadastrado_em >= pago_em) as cad_maior_igual_rec,
        count(*) filter (cadastrado_em < pago_em) as cad_menor_que_rec, max(cadastrado_em) as ultimo_cadastro
        from recebidas where {PREFIXES} and pago_em >= date '1998-07-01'"""
    ),
)
def posting_date_sanity(spark, sf):
    return A.posting_sanity(S.receipts(spark, sf), P, CLOSE.month_start)


@section.query(
    "late_posting_by_day",
    with_tables(
        f"""select cadastrado_em as dia_cadastro, count(*) as qtd_recebimentos,
        count(distinct concat(empresa, '-', obra, '-', num_venda)) as qtd_vendas, cast(sum(base) as double) as valor_base_cupom
        from recebidas where {PREFIXES} and tipo <> '1' and pago_em >= date '1998-07-01' and pago_em < date '1998-08-01'
          and cadastrado_em >= date '1998-08-01' group by cadastrado_em"""
    ),
)
def late_posting_by_day(spark, sf):
    return A.late_by_day(S.receipts(spark, sf), P, CLOSE)


@section.query(
    "completeness_monitor",
    with_tables(
        f"""select pago_em as dia_pagamento, count(*) as qtd_recebimentos, cast(sum(principal) as double) as valor_principal
        from recebidas where {PREFIXES} and pago_em >= date '1998-07-28' and pago_em < date '1998-08-01' group by pago_em"""
    ),
)
def completeness_monitor(spark, sf):
    return A.completeness(S.receipts(spark, sf), P, CLOSE)


@section.query(
    "late_posting_sample",
    with_tables(
        f"""select {KEY}, num_parcela, num_parcela_geral, tipo, pago_em, cadastrado_em from recebidas
        where {PREFIXES} and pago_em >= date '1998-07-30' and pago_em < date '1998-08-01' and cadastrado_em >= date '1998-08-01'
        order by cadastrado_em desc, {KEY}, num_parcela, num_parcela_geral, tipo, pago_em limit 20"""
    ),
)
def late_posting_sample(spark, sf):
    return A.late_sample(S.receipts(spark, sf), P, CLOSE)


# A literal key list, as an investigation of a handful of sales starts from.
TRACED = [(0, "65000", 0), (5, "65005", 20), (10, "65010", 41), (8, "68008", 33), (24, "69024", 99), (1, "66001", 4)]
_KEYS = "chaves(empresa, obra, num_venda) as (values " + ", ".join(f"({e}, '{o}', {n})" for e, o, n in TRACED) + ")"


@section.query(
    "key_trace",
    with_tables(
        f"""select 'Vendas' as fonte, {KEY}, status as codigo, cast(null as bigint) as numero, data_venda as dia
        from vendas join chaves using ({KEY})
        union all select 'VendasRecebidas', {KEY}, status, null, data_venda from vendas_rec join chaves using ({KEY})
        union all select 'VendaHist', {KEY}, tipo_mnt, num_hist, data_mnt from historico join chaves using ({KEY})
        union all select 'VendaDistrato', {KEY}, status_aprov, num_distrato, data_cad from distratos join chaves using ({KEY})""",
        _KEYS,
    ),
)
def key_trace(spark, sf):
    return A.key_trace(
        A.inline_keys(spark, TRACED),
        S.sales_live(spark, sf),
        S.sales_archived(spark, sf),
        S.history(spark, sf),
        S.cancellations(spark, sf),
    )


@section.query(
    "inline_key_list", with_tables(f"select {KEY}, status, cliente from vendas_rec join chaves using ({KEY})", _KEYS)
)
def inline_key_list(spark, sf):
    joined = S.sales_archived(spark, sf).join(A.inline_keys(spark, TRACED), ["empresa", "obra", "num_venda"])
    return joined.select("empresa", "obra", "num_venda", "status", "cliente")
