"""Indicators and series over the contract frame."""

from __future__ import annotations

from lastro.operators import kpis as K
from lastro.plans.oracle_tables import KEY, big, dbl, with_contract
from lastro.plans.registry import Section
from lastro.sources import standin as S

section = Section()
AS_OF, START = S.LIVE.as_of, S.LIVE.start
ID = f"concat_ws('|', {KEY})"

_KPIS = f"""
    {dbl("sum(valor_total_recebido)", "valor_total_recebido")}, {dbl("sum(valor_elegivel)", "valor_elegivel")},
    {big("sum(cupons_calculados)", "cupons_calculados")}, count(distinct cpf_titular) as clientes_participantes,
    count(distinct {ID}) as contratos_participantes,
    count(distinct {ID}) filter (status_cadastro = 'cadastrado') as contratos_cadastrados,
    count(distinct {ID}) filter (status_elegibilidade = 'elegivel') as contratos_elegiveis,
    count(distinct {ID}) filter (status_elegibilidade_casas = 'elegivel') as contratos_aptos_casas,
    {big("sum(cupons_casas)", "cupons_casas")},
    {big("sum(cupons_calculados) filter (status_elegibilidade = 'elegivel')", "cupons_elegiveis")},
    {dbl("sum(valor_recuperado)", "valor_recuperado")},
    count(distinct {ID}) filter (classificacao_recebimento = 'recuperacao') as contratos_recuperados,
    {dbl("sum(valor_vencido_antes)", "valor_vencido")}"""


@section.query("kpis_executive", with_contract(f"select {_KPIS} from contrato"))
def kpis_executive(spark, sf):
    return K.kpis_executive(S.contract_frame(spark, sf))


@section.query(
    "kpis_portfolio",
    with_contract(
        f"""select *, contratos_participantes - contratos_elegiveis as contratos_inadimplentes,
        round_even(100.0::double * contratos_elegiveis / contratos_participantes, 1) as pct_adimplencia,
        valor_total_recebido / contratos_participantes as ticket_medio,
        round_even(cast(cupons_calculados as double) / contratos_elegiveis, 1) as cupons_por_contrato_apto
        from (select {_KPIS} from contrato)"""
    ),
)
def kpis_portfolio(spark, sf):
    return K.kpis_portfolio(S.contract_frame(spark, sf))


@section.query(
    "coupons_by_month",
    with_contract(f"select mes_referencia, {big('sum(cupons_calculados)', 'cupons_calculados')} from contrato group by 1"),
)
def coupons_by_month(spark, sf):
    return K.coupons_by_month(S.contract_frame(spark, sf))


def _series_sql(day: str) -> str:
    return with_contract(
        f"""select data, {dbl("v", "valor_total_recebido")}, {dbl("sum(v) over (order by data)", "acumulado")} from (
        select {day} as data, sum(valor_total_recebido) as v from contrato
        where data_recebimento is not null and valor_total_recebido > 0 group by 1)"""
    )


@section.query("receipts_monthly", _series_sql("cast(date_trunc('month', data_recebimento) as date)"))
def receipts_monthly(spark, sf):
    return K.receipts_monthly(S.contract_frame(spark, sf))


@section.query("receipts_daily", _series_sql("data_recebimento"))
def receipts_daily(spark, sf):
    return K.receipts_daily(S.contract_frame(spark, sf))


@section.query(
    "receipts_by_origin",
    with_contract(
        """select origem, cast(valor as double) as valor from (
          select 'Em dia' as origem, greatest(0, sum(valor_total_recebido) - sum(valor_recuperado) - sum(valor_antecipado))
            as valor from contrato
          union all select 'Recuperado', sum(valor_recuperado) from contrato
          union all select 'Antecipado', sum(valor_antecipado) from contrato) where valor > 0"""
    ),
)
def receipts_by_origin(spark, sf):
    return K.receipts_by_origin(S.contract_frame(spark, sf))


@section.query(
    "overdue_bands",
    with_contract(
        f"""select faixa, count(*) as contratos, {dbl("sum(v)", "valor")} from (
          select {ID} as id, sum(valor_vencido_antes) as v, case when max(dias_atraso) <= -1 then null
            when max(dias_atraso) <= 0 then 'Sem atraso informado' when max(dias_atraso) <= 30 then '1-30 dias'
            when max(dias_atraso) <= 60 then '31-60 dias' when max(dias_atraso) <= 90 then '61-90 dias'
            when max(dias_atraso) <= 180 then '91-180 dias' else '180+ dias' end as faixa
          from contrato where status_elegibilidade = 'pendente'
            and {ID} not in (select {ID} from contrato where status_elegibilidade = 'elegivel') group by 1)
        where faixa is not null group by faixa"""
    ),
)
def overdue_bands(spark, sf):
    return K.overdue_bands(S.contract_frame(spark, sf))


@section.query(
    "participation_funnel",
    with_contract(
        f"""select 'Base total' as etapa, count(distinct {ID}) as contratos from contrato
        union all select 'Cadastrados', n from (select count(distinct {ID}) filter (status_cadastro = 'cadastrado') as n,
          count(distinct {ID}) filter (status_elegibilidade = 'elegivel') as e from contrato) where n <> e
        union all select 'Elegíveis', count(distinct {ID}) from contrato where status_elegibilidade = 'elegivel'
        union all select 'Geraram cupons', count(distinct {ID}) from contrato
          where status_elegibilidade = 'elegivel' and cupons_calculados > 0"""
    ),
)
def participation_funnel(spark, sf):
    return K.participation_funnel(S.contract_frame(spark, sf))


@section.query(
    "business_origin",
    with_contract(
        f"""select {KEY}, nome_cliente, case when data_venda >= date '1998-07-01' then 'Nova venda pós-campanha'
        else 'Base existente' end as origem_negocio from contrato"""
    ),
)
def business_origin(spark, sf):
    tagged = K.business_origin(S.contract_frame(spark, sf), START)
    return tagged.select("empresa", "obra", "num_venda", "nome_cliente", "origem_negocio")


_PRIMEIRA = """
primeira as (
  select cpf_titular, min(data_venda) as dia from contrato where cpf_titular is not null group by 1
  having min(data_venda) >= date '1998-07-01'),
regularizou as (
  select cpf_titular, max(data_recebimento) as dia from contrato
  where classificacao_recebimento = 'recuperacao' and data_recebimento is not null and cpf_titular is not null group by 1)"""


@section.query("new_clients", with_contract("select count(*) as novos_clientes from primeira", _PRIMEIRA))
def new_clients(spark, sf):
    return K.new_clients(S.contract_frame(spark, sf), START)


@section.query(
    "new_sales_daily",
    with_contract(
        """select data_venda as data, count(distinct num_venda) as vendas from contrato
        where data_venda >= date '1998-07-01' group by 1"""
    ),
)
def new_sales_daily(spark, sf):
    return K.new_sales_daily(S.contract_frame(spark, sf), START)


_DAYS = "(['Segunda', 'Terça', 'Quarta', 'Quinta', 'Sexta', 'Sábado', 'Domingo'])"


@section.query(
    "coupons_weekday_avg",
    with_contract(
        f"""select {_DAYS}[isodow(data_recebimento)] as dia, {big("round_even(avg(cupons), 0)", "cupons")} from (
          select data_recebimento, sum(cupons_calculados) as cupons from contrato
          where data_recebimento is not null group by 1) group by 1"""
    ),
)
def coupons_weekday_avg(spark, sf):
    return K.coupons_weekday_avg(S.contract_frame(spark, sf))


@section.query(
    "clients_weekday",
    with_contract(
        f"""select {_DAYS}[d] as dia, (select count(*) from primeira where isodow(dia) = d) as novos,
        (select count(*) from regularizou where isodow(dia) = d) as recuperados from generate_series(1, 7) g(d)""",
        _PRIMEIRA,
    ),
)
def clients_weekday(spark, sf):
    return K.clients_weekday(S.contract_frame(spark, sf), START)


def _client_series_sql(source: str) -> str:
    return with_contract(
        f"""select data, quantidade, {big("sum(quantidade) over (order by data)", "acumulado")} from (
        select dia as data, count(*) as quantidade from {source} group by 1)""",
        _PRIMEIRA,
    )


@section.query("clients_daily_series", _client_series_sql("primeira"))
def clients_daily_series(spark, sf):
    return K.clients_daily_series(K.first_sale(S.contract_frame(spark, sf), START))


@section.query("clients_daily_series_recovered", _client_series_sql("regularizou"))
def clients_daily_series_recovered(spark, sf):
    return K.clients_daily_series(K.last_recovery(S.contract_frame(spark, sf)))


@section.query(
    "coupons_by_draw_type",
    with_contract(
        f"""select 'Milhão (final)' as tipo, {big("sum(cupons_calculados)", "cupons")} from contrato
        union all select 'Casas (mês)', {big("sum(cupons_casas)", "cupons")} from contrato"""
    ),
)
def coupons_by_draw_type(spark, sf):
    return K.coupons_by_draw_type(S.contract_frame(spark, sf))


@section.query(
    "top_developments",
    with_contract(
        f"""select obra, {dbl("v", "valor")}, cupons, dias as dias_pagantes,
        round_even(cast(v as double) / dias, 2) as media_diaria
        from (select obra, sum(valor_total_recebido) as v, {big("sum(cupons_calculados)", "cupons")},
          nullif(count(distinct data_recebimento), 0) as dias from contrato group by obra)
        order by v desc, obra limit 6"""
    ),
)
def top_developments(spark, sf):
    return K.top_developments(S.contract_frame(spark, sf))


def _city_sql(value: str, shown: str, n: int) -> str:
    return with_contract(
        f"""select cidade, {shown} from (select cidade, sum({value}) as v from contrato where cidade is not null group by 1)
        order by v desc, cidade limit {n}"""
    )


@section.query("overdue_top_cities", _city_sql("valor_vencido_antes", dbl("v", "valor_vencido_antes"), 5))
def overdue_top_cities(spark, sf):
    return K.top_cities(S.contract_frame(spark, sf), "valor_vencido_antes", 5)


@section.query("coupons_top_cities", _city_sql("cupons_calculados", big("v", "cupons_calculados"), 8))
def coupons_top_cities(spark, sf):
    return K.top_cities(S.contract_frame(spark, sf), "cupons_calculados", 8)


@section.query(
    "draw_calendar",
    with_contract(
        """select strftime(mes, '%Y-%m') as pagamento, strftime(mes + interval 1 month, '%Y-%m') as sorteio,
        cast(mes + interval 1 month + interval 14 days as date) as data_sorteio,
        case when i = 5 then 'R$ 1.000.000' else 'Casa + Carro' end as premio,
        case when mes + interval 1 month + interval 14 days <= date '1998-08-11' then 'Realizado'
          when mes = date '1998-08-01' then 'Em breve' when i = 5 then 'Final' else 'Futuro' end as status, i = 5 as final,
        cast(coalesce((select sum(valor_total_recebido) from contrato
          where date_trunc('month', data_recebimento) = mes), 0) as double) as valor_recebido
        from (select i, cast(date '1998-07-01' + to_months(cast(i as integer)) as date) as mes from generate_series(0, 5) g(i))"""
    ),
)
def draw_calendar(spark, sf):
    return K.draw_calendar(S.contract_frame(spark, sf), S.CAMPAIGN, AS_OF)


@section.query(
    "campaign_progress",
    with_contract(
        """select date '1998-08-11' - date '1998-07-01' as dias_decorridos, date '1998-12-31' - date '1998-07-01' as dias_totais,
        date '1998-12-31' - date '1998-08-11' as dias_restantes, round_even(100.0::double * 41 / 183, 1) as pct,
        cast(sum(valor_total_recebido) filter (data_recebimento between date '1998-07-01' and date '1998-08-11') as double)
          as valor_recebido from contrato"""
    ),
)
def campaign_progress(spark, sf):
    return K.campaign_progress(S.contract_frame(spark, sf), S.CAMPAIGN, AS_OF)


@section.query(
    "current_month_slice",
    with_contract(f"select {KEY}, nome_cliente, mes_referencia, cupons_calculados from contrato where mes_referencia = '1998-08'"),
)
def current_month_slice(spark, sf):
    rows = K.month_slice(S.contract_frame(spark, sf), AS_OF)
    return rows.select("empresa", "obra", "num_venda", "nome_cliente", "mes_referencia", "cupons_calculados")
