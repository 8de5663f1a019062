"""City, regional, legal and export views over the contract frame."""

from __future__ import annotations

from lastro.operators import boards as J
from lastro.operators import kpis as K
from lastro.params import CouponRule
from lastro.plans.kpis import ID
from lastro.plans.oracle_tables import KEY, big, dbl, with_contract
from lastro.plans.registry import Section
from lastro.sources import standin as S

section = Section()
ELIGIBLE = "status_elegibilidade = 'elegivel'"
PENDING = "status_elegibilidade = 'pendente'"
COURT = "(juridico_ativo or juridico_passivo)"
N_ELIGIBLE = f"count(distinct {ID}) filter ({ELIGIBLE})"
N_PENDING = f"count(distinct {ID}) filter ({PENDING})"
_AVERAGE = f"media as (select round_even(100.0::double * {N_ELIGIBLE} / count(distinct {ID}), 1) / 100 as media from contrato)"
_CITIES = f"""
cidades as (
  select cidade, {N_ELIGIBLE} as e, {N_PENDING} as p, sum(cupons_calculados) as cup, sum(valor_total_recebido) as rec,
    sum(valor_vencido_antes) as ven from contrato where cidade is not null group by cidade)"""


@section.query(
    "slice_regional_city",
    with_contract(
        f"""select {KEY}, nome_cliente, regional, cidade from contrato
        where regional in ('ASIA', 'EUROPE') and cidade in ('NATION_2', 'NATION_3', 'NATION_8')"""
    ),
)
def slice_regional_city(spark, sf):
    rows = J.slice_by(S.contract_frame(spark, sf), ["ASIA", "EUROPE"], ["NATION_2", "NATION_3", "NATION_8"])
    return rows.select("empresa", "obra", "num_venda", "nome_cliente", "regional", "cidade")


@section.query(
    "coupons_per_paying_day",
    with_contract(
        f"""select {big("sum(cupons_calculados)", "cupons")}, count(distinct data_recebimento) as dias_pagantes,
        cast(sum(cupons_calculados) as double) / count(distinct data_recebimento) as media_cupons_dia from contrato"""
    ),
)
def coupons_per_paying_day(spark, sf):
    return J.coupons_per_paying_day(S.contract_frame(spark, sf))


@section.query(
    "avg_paid_per_payer",
    with_contract(
        """select count(distinct cpf_titular) as pagantes,
        cast(sum(valor_total_recebido) as double) / count(distinct cpf_titular) as parcela_media
        from contrato where valor_total_recebido > 0"""
    ),
)
def avg_paid_per_payer(spark, sf):
    return J.average_paid(S.contract_frame(spark, sf))


@section.query(
    "avg_days_late", with_contract("select avg(dias_atraso) as dias_atraso_medio from contrato where dias_atraso > 0")
)
def avg_days_late(spark, sf):
    return J.average_days_late(S.contract_frame(spark, sf))


@section.query(
    "registration_rate",
    with_contract(
        f"""select *, 100.0::double * cadastrados / contratos as taxa_cadastro from (
        select count(distinct {ID}) as contratos, count(distinct {ID}) filter (status_cadastro = 'cadastrado') as cadastrados
        from contrato)"""
    ),
)
def registration_rate(spark, sf):
    return J.registration_rate(S.contract_frame(spark, sf))


@section.query("city_status_pivot", with_contract("select cidade, e as elegivel, p as pendente from cidades", _CITIES))
def city_status_pivot(spark, sf):
    return J.city_status_pivot(S.contract_frame(spark, sf))


@section.query(
    "city_above_below_avg",
    with_contract(
        """select cidade, cast(e as double) / greatest(e + p, 1) as adimplencia, media as media_geral,
        case when cast(e as double) / greatest(e + p, 1) >= media then 'acima' else 'abaixo' end as farol
        from cidades, media""",
        _CITIES,
        _AVERAGE,
    ),
)
def city_above_below_avg(spark, sf):
    return J.city_above_below(S.contract_frame(spark, sf))


@section.query(
    "regional_capacity",
    with_contract(
        f"""select regional, {dbl("rec", "recebido")}, {dbl("ven", "vencido")}, {big("cup", "cupons")},
        {dbl("cap", "capacidade")}, 100 * cast(cup as double) / (cast(cap as double) / 100) as pct_cupons,
        100 * cast(rec as double) / cast(cap as double) as pct_recebido,
        100 * cast(sum(cup) over () as double) / (cast(sum(cap) over () as double) / 100) as pct_cupons_geral,
        100 * cast(sum(rec) over () as double) / cast(sum(cap) over () as double) as pct_recebido_geral
        from (select regional, sum(valor_total_recebido) as rec, sum(valor_vencido_antes) as ven, sum(cupons_calculados) as cup,
          greatest(sum(valor_total_recebido) + sum(valor_vencido_antes), 1) as cap from contrato group by regional)"""
    ),
)
def regional_capacity(spark, sf):
    return J.regional_capacity(S.contract_frame(spark, sf))


@section.query(
    "city_summary",
    with_contract(
        f"""select cidade, case when cast(e as double) / greatest(e + p, 1) >= media then 'acima' else 'abaixo' end as farol,
        e + p as contratos, cast(e + p as double) / cast(sum(e + p) over () as double) as representatividade, e as elegiveis,
        p as pendentes, cast(e as double) / greatest(e + p, 1) as pct_adimplente,
        cast(p as double) / greatest(e + p, 1) as pct_inadimplente, {dbl("ven", "saldo_inadimplente")}, {big("cup", "cupons")},
        cast(cup as double) / cast(sum(cup) over () as double) as pct_cupons, {dbl("rec", "valor")} from cidades, media""",
        _CITIES,
        _AVERAGE,
    ),
)
def city_summary(spark, sf):
    return J.city_summary(S.contract_frame(spark, sf))


@section.query(
    "clients_by_status",
    with_contract(
        f"""select count(distinct cpf_titular) filter ({ELIGIBLE}) as elegiveis,
        count(distinct cpf_titular) filter ({PENDING}) as pendentes,
        count(distinct cpf_titular) filter (status_elegibilidade_casas = 'elegivel') as aptos_casas from contrato"""
    ),
)
def clients_by_status(spark, sf):
    return J.clients_by_status(S.contract_frame(spark, sf))


@section.query(
    "legal_split",
    with_contract(
        f"""select {dbl("v", "saldo")}, {dbl("j", "juros")}, {dbl("m", "multa")}, {dbl("vj", "valor_na_justica")},
        contratos_juridico_ativo, contratos_juridico_passivo, contratos_na_justica,
        {dbl("greatest(0, v - vj)", "valor_cobravel")}, 100 * cast(j + m as double) / cast(v as double) as pct_multa_juros
        from (select sum(valor_vencido_antes) as v, sum(valor_juros_inadimplencia) as j, sum(valor_multa_inadimplencia) as m,
          coalesce(sum(valor_vencido_antes) filter ({COURT}), 0) as vj,
          count(distinct {ID}) filter (juridico_ativo) as contratos_juridico_ativo,
          count(distinct {ID}) filter (juridico_passivo) as contratos_juridico_passivo,
          count(distinct {ID}) filter ({COURT}) as contratos_na_justica from contrato)"""
    ),
)
def legal_split(spark, sf):
    return J.legal_split(S.contract_frame(spark, sf))


_OVERDUE_PARTS = (
    "(select sum(valor_vencido_antes) as v, sum(valor_juros_inadimplencia) as j, sum(valor_multa_inadimplencia) as m from contrato)"
)


@section.query(
    "overdue_composition",
    with_contract(
        f"""select 'Principal' as componente, {dbl("greatest(0, v - j - m)", "valor")} from {_OVERDUE_PARTS}
        union all select 'Juros de atraso', {dbl("j", "valor")} from {_OVERDUE_PARTS}
        union all select 'Multa', {dbl("m", "valor")} from {_OVERDUE_PARTS}"""
    ),
)
def overdue_composition(spark, sf):
    return J.overdue_composition(S.contract_frame(spark, sf))


@section.query(
    "legal_vs_collectable",
    with_contract(
        f"""select case when {COURT} then 'Na justiça' else 'Fora da justiça' end as grupo, {N_PENDING} as contratos,
        {dbl("sum(valor_vencido_antes)", "valor")} from contrato group by 1"""
    ),
)
def legal_vs_collectable(spark, sf):
    return J.legal_vs_collectable(S.contract_frame(spark, sf))


@section.query(
    "legal_by_regional",
    with_contract(f"select regional, count(distinct {ID}) as contratos from contrato where {COURT} group by regional"),
)
def legal_by_regional(spark, sf):
    return J.legal_by_regional(S.contract_frame(spark, sf))


@section.query(
    "development_matrix",
    with_contract(
        f"""select obra, {N_ELIGIBLE} as elegiveis, {N_PENDING} as pendentes, {big("sum(cupons_calculados)", "cupons")},
        {dbl("sum(valor_total_recebido)", "valor")} from contrato group by obra"""
    ),
)
def development_matrix(spark, sf):
    return J.development_matrix(S.contract_frame(spark, sf))


@section.query(
    "top15_clients",
    with_contract(
        f"""select nome_cliente, obra, cidade, status_elegibilidade, {big("sum(cupons_calculados)", "cupons")},
        {dbl("sum(valor_total_recebido)", "valor")} from contrato where cidade is not null
        group by 1, 2, 3, 4 order by cupons desc, nome_cliente, obra, cidade, status_elegibilidade limit 15"""
    ),
)
def top15_clients(spark, sf):
    return J.top_clients(S.contract_frame(spark, sf))


@section.query(
    "coupon_potential",
    with_contract(
        """select cupons_realizados, cupons_limite,
        100 * cast(cupons_realizados as double) / greatest(cupons_limite, 1) as pct_cupons from (
        select cast(sum(cupons_calculados) as bigint) as cupons_realizados,
          cast(trunc((sum(valor_total_recebido) + sum(valor_vencido_antes)) / 100) as bigint) as cupons_limite from contrato)"""
    ),
)
def coupon_potential(spark, sf):
    return K.potential(S.contract_frame(spark, sf), CouponRule())


_MATRIX = f"""
matriz as (
  select regional, cidade, empresa_codigo, obra_nome, min(empresa) as empresa_nome, count(distinct {ID}) as contratos,
    {N_ELIGIBLE} as elegiveis, {N_PENDING} as inadimplentes, {big("sum(cupons_calculados)", "cupons")},
    sum(valor_total_recebido) as recebido from contrato where cidade is not null group by 1, 2, 3, 4)"""


@section.query(
    "export_matrix", with_contract(f"select * replace ({dbl('recebido')}) from matriz", _MATRIX)
)
def export_matrix(spark, sf):
    return J.export_matrix(S.contract_frame(spark, sf))


@section.query(
    "export_rollup",
    with_contract(
        f"""select case grouping_id(regional, cidade, empresa_codigo) when 0 then 'empresa' when 1 then 'cidade'
          when 3 then 'regional' end as nivel, regional, cidade, empresa_codigo, {big("sum(contratos)", "contratos")},
        {big("sum(elegiveis)", "elegiveis")}, {big("sum(inadimplentes)", "inadimplentes")}, {big("sum(cupons)", "cupons")},
        {dbl("sum(recebido)", "recebido")} from matriz group by rollup(regional, cidade, empresa_codigo)
        having grouping_id(regional, cidade, empresa_codigo) < 7""",
        _MATRIX,
    ),
)
def export_rollup(spark, sf):
    return J.export_rollup(J.export_matrix(S.contract_frame(spark, sf)))


def _development_value(spark, sf):
    return K.top_developments(S.contract_frame(spark, sf), None).select("obra", "valor")


_BY_DEVELOPMENT = "obras_valor as (select obra, sum(valor_total_recebido) as v from contrato group by obra)"


@section.query(
    "share_of_total_ranking",
    with_contract(
        f"""select row_number() over (order by v desc, obra) as posicao, obra, {dbl("v", "valor")},
        {big("trunc(100 * cast(v as double) / (select cast(max(v) as double) from obras_valor))", "pct_do_maior")},
        100 * cast(v as double) / (select cast(sum(v) as double) from obras_valor) as pct_do_total
        from obras_valor order by v desc, obra limit 10""",
        _BY_DEVELOPMENT,
    ),
)
def share_of_total_ranking(spark, sf):
    return J.share_ranking(_development_value(spark, sf), "obra", "valor", 10)


@section.query(
    "performance_band",
    with_contract(
        f"""select obra, {dbl("v", "valor")}, case when cast(v as double) / m >= 0.8 then 'topo'
          when cast(v as double) / m >= 0.6 then 'alto' when cast(v as double) / m >= 0.4 then 'medio'
          when cast(v as double) / m >= 0.2 then 'atencao' else 'baixo' end as faixa
        from obras_valor, (select cast(max(v) as double) as m from obras_valor)""",
        _BY_DEVELOPMENT,
    ),
)
def performance_band(spark, sf):
    return J.performance_band(_development_value(spark, sf), "obra", "valor")


@section.query(
    "target_gap",
    with_contract(
        """select p as pct_adimplencia, round_even(p - 70, 1) as delta,
        case when p >= 70 then 'meta' when p >= 52.5 then 'proximo' else 'abaixo' end as situacao
        from (select round_even(media * 100, 1) as p from media)""",
        _AVERAGE,
    ),
)
def target_gap(spark, sf):
    return J.target_gap(S.contract_frame(spark, sf))


@section.query(
    "portfolio_split",
    with_contract(
        f"""select 'adimplentes' as situacao, e as contratos, 100.0::double * e / n as pct from (
          select {N_ELIGIBLE} as e, count(distinct {ID}) as n from contrato)
        union all select 'inadimplentes', n - e, 100.0::double * (n - e) / n from (
          select {N_ELIGIBLE} as e, count(distinct {ID}) as n from contrato)"""
    ),
)
def portfolio_split(spark, sf):
    return J.portfolio_split(S.contract_frame(spark, sf))


@section.query("distinct_cities", with_contract("select count(distinct cidade) as cidades from contrato"))
def distinct_cities(spark, sf):
    return J.distinct_cities(S.contract_frame(spark, sf))
