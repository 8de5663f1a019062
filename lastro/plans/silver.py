"""Snapshot normalisation, step by step and as a whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from lastro.functions import money as M
from lastro.operators import silver as G
from lastro.plans.oracle_tables import _key, dbl
from lastro.plans.registry import Section
from lastro.sources import standin as S

section = Section()
AS_OF = S.LIVE.as_of
_PRIO = "case when o % 19 <> 0 then prio end"

# SQL: what each step must give, computed from the numbers instead of the texts.
BRONZE = f"""
bronze0 as (
  select {_key("o_orderkey").replace("as num_venda", "as o")}, o_custkey as c, cast(o_orderdate as date) as od,
    o_orderpriority as prio, cast(o_totalprice as decimal(18,2)) as p,
    case when o_orderkey % 61 = 0 then -cast(o_totalprice as decimal(18,2)) else cast(o_totalprice as decimal(18,2)) end as v
  from orders),
bronze as (
  select b.*, n_name, r_name, case when o % 71 <> 0 then 'Customer#' || lpad(cast(c as varchar), 9, '0') end as nome,
    case when o % 43 in (0, 1) then 0 else v end as total,
    case when o % 53 <> 0 and o % 5 <> 4 then od + cast(o % 45 as integer) end as recebido_em, o % 5 <> 0 as apto
  from bronze0 b join nation on n_nationkey = empresa join region on r_regionkey = n_regionkey),
limpo as (select * from bronze where nome is null or nome not like '%#00000010%')"""


def sql(select: str, source: str = "limpo") -> str:
    return f"with {BRONZE}\nselect o as linha, {select} from {source}"


def _step(name: str, select: str, steps, columns: dict[str, str], source: str = "limpo", old: bool = False) -> None:
    """Run ``steps`` over the snapshot and show ``columns`` under their new names."""

    def run(spark, sf):
        raw = S.old_snapshot(spark, sf) if old else S.snapshot(spark, sf)
        done = steps(G.rename_columns(G.development_name(G.normalize_columns(raw))))
        return done.select(
            F.col("num_venda").cast("long").alias("linha"), *(F.col(c).alias(new) for c, new in columns.items())
        )

    section.query(name, sql(select, source))(run)


def _same(*names: str) -> dict[str, str]:
    return {name: name for name in names}


def _clean(df):
    return G.drop_test_rows(df, S.TEST_CLIENT)


_step("development_name", "'DEV ' || obra as obra_nome", lambda d: d, _same("obra_nome"), "bronze")
_step(
    "development_name_by_code",
    f"coalesce(min({_PRIO}) over (partition by obra), obra) as obra_nome",
    lambda d: d,
    _same("obra_nome"),
    "bronze",
    old=True,
)
_step(
    "rename_columns",
    "obra as obra_codigo, nome as nome_cliente, lpad(cast(c as varchar), 11, '0') as cpf_titular, 'user' || c || '@mail.com' as email",
    lambda d: d,
    _same("obra_codigo", "nome_cliente", "cpf_titular", "email"),
    "bronze",
)
_step("drop_test_rows", "nome as nome_cliente", _clean, _same("nome_cliente"))
_step(
    "coupon_coerce",
    "cast(case when o % 59 = 0 then 0 else floor(p / 100) end as bigint) as cupons_calculados, cast(floor(p / 100) as bigint) as cupons_casas",
    lambda d: G.coerce_coupons(_clean(d)),
    _same("cupons_calculados", "cupons_casas"),
)
_step(
    "identifiers",
    """'DEV ' || obra as obra, 'EMPRESA ' || n_name as empresa, cast(empresa as varchar) as empresa_codigo, r_name as regional,
    case when o % 13 = 0 then '' else cast(62900000000 + c as varchar) end as telefone""",
    lambda d: G.identifiers(_clean(d), ""),
    _same("obra", "empresa", "empresa_codigo", "regional", "telefone"),
)
_step(
    "parse_dates",
    "recebido_em as data_recebimento, od as data_venda, timestamp '1998-07-31 21:30:00' + to_seconds(o % 2) as data_ultima_atualizacao",
    lambda d: G.parse_days(_clean(d)),
    _same("data_recebimento", "data_venda", "data_ultima_atualizacao"),
)
_step(
    "reference_month",
    "coalesce(strftime(recebido_em, '%Y-%m'), '1998-08') as mes_referencia",
    lambda d: G.reference_month(G.parse_days(_clean(d)), AS_OF),
    _same("mes_referencia"),
)
_step(
    "eligibility_flags",
    """case when apto then 'elegivel' else 'pendente' end as status_elegibilidade,
    case when o % 5 < 3 then 'elegivel' else 'pendente' end as status_elegibilidade_casas,
    case when apto then 'cadastrado' else 'nao_cadastrado' end as status_cadastro""",
    lambda d: G.eligibility_flags(_clean(d)),
    _same("status_elegibilidade", "status_elegibilidade_casas", "status_cadastro"),
)
_step(
    "recovery_class",
    "case when o % 7 = 2 then 'recuperacao' else 'normal' end as classificacao_recebimento",
    lambda d: G.recovery_class(_clean(d)),
    _same("classificacao_recebimento"),
)
_step(
    "recovery_class_fallback",
    "case when o % 4 = 0 and apto then 'recuperacao' else 'normal' end as classificacao_recebimento",
    lambda d: G.recovery_class(_clean(d)),
    _same("classificacao_recebimento"),
    old=True,
)
_step(
    "recovered_amount",
    dbl("p", "valor_recuperado"),
    lambda d: G.recovered_amount(G.recovery_class(G.received_amounts(_clean(d)))),
    _same("valor_recuperado"),
)
_step(
    "recovered_amount_fallback",
    dbl("case when o % 4 = 0 and apto then total else 0 end", "valor_recuperado"),
    lambda d: G.recovered_amount(G.recovery_class(G.received_amounts(_clean(d)))),
    _same("valor_recuperado"),
    old=True,
)
_step(
    "launch_status",
    "case when o % 6 = 0 then 'inadimplente' else 'adimplente' end as status_inadimplencia_antes",
    lambda d: G.launch_status(_clean(d)),
    _same("status_inadimplencia_antes"),
)
_step(
    "flag_parse_sim_nao",
    """o % 37 = 0 as juridico_ativo, o % 41 = 0 as juridico_passivo, o % 20 = 1 as flag_cessao, o % 23 = 0 as flag_contrato_quitado,
    o % 20 = 0 as flag_contrato_cedido, o % 8 = 5 as flag_antecipacao""",
    lambda d: G.yes_no_flags(_clean(d)),
    {name: name for name in G.YES_NO_FLAGS.values()},
)
_step(
    "days_late",
    "cast(case when o % 3 = 0 then o % 300 else 0 end as bigint) as dias_atraso",
    lambda d: G.days_late(_clean(d)),
    _same("dias_atraso"),
)
_step(
    "contract_defaults",
    f"""{dbl("total", "valor_principal")}, 0.0::double as valor_multa, {dbl("p", "valor_antecipado")},
    {dbl("p", "valor_juros_inadimplencia")}, 0.0::double as valor_multa_inadimplencia, true as titular_principal,
    1 as qtd_compradores, 'adimplente' as status_apos_pagamento""",
    lambda d: G.contract_defaults(G.received_amounts(_clean(d))),
    _same(
        "valor_principal",
        "valor_multa",
        "valor_antecipado",
        "valor_juros_inadimplencia",
        "valor_multa_inadimplencia",
        "titular_principal",
        "qtd_compradores",
        "status_apos_pagamento",
    ),
)


@section.query(
    "bronze_to_contract",
    f"""with {BRONZE}
    select 'EMPRESA ' || n_name as empresa, 'DEV ' || obra as obra, n_name as cidade, {_PRIO} as produto,
      cast(o as varchar) as num_venda, lpad(cast(c as varchar), 11, '0') as cpf_titular, nome as nome_cliente,
      case when o % 13 = 0 then '' else cast(62900000000 + c as varchar) end as telefone, 'user' || c || '@mail.com' as email,
      true as titular_principal, cast(1 as bigint) as qtd_compradores, recebido_em as data_recebimento,
      coalesce(strftime(recebido_em, '%Y-%m'), '1998-08') as mes_referencia, {dbl("total", "valor_principal")},
      0.0::double as valor_multa, 0.0::double as valor_juros, 0.0::double as valor_custas, {dbl("total", "valor_total_recebido")},
      cast(null as varchar) as tipo_parcela, cast(null as varchar) as origem_pagamento, o % 8 = 5 as flag_antecipacao,
      false as flag_negociacao, not apto as flag_vencido, cast(0 as bigint) as qtd_parcelas_pagas,
      case when apto then 'cadastrado' else 'nao_cadastrado' end as status_cadastro,
      case when apto then 'elegivel' else 'pendente' end as status_elegibilidade,
      case when o % 5 < 3 then 'elegivel' else 'pendente' end as status_elegibilidade_casas,
      cast(floor(p / 100) as bigint) as cupons_casas, o % 20 = 1 as flag_cessao, o % 23 = 0 as flag_contrato_quitado,
      o % 20 = 0 as flag_contrato_cedido, case when o % 5 = 0 then 'PARCELA VENCIDA' else 'ADIMPLENTE' end as motivo_bloqueio,
      cast(null as bigint) as cupons_oficiais, false as flag_contemplado_casa, apto as participa_proximos_sorteios,
      timestamp '1998-07-31 21:30:00' + to_seconds(o % 2) as data_ultima_atualizacao,
      case when o % 6 = 0 then 'inadimplente' else 'adimplente' end as status_inadimplencia_antes,
      cast(case when o % 3 = 0 then o % 300 else 0 end as bigint) as dias_atraso, cast(0 as bigint) as qtd_parcelas_vencidas,
      {dbl("case when o % 47 <> 0 then p else 0 end", "valor_vencido_antes")}, {dbl("p", "valor_recuperado")},
      'adimplente' as status_apos_pagamento, case when o % 7 = 2 then 'recuperacao' else 'normal' end as classificacao_recebimento
    from limpo""",
)
def bronze_to_contract(spark, sf):
    contract = G.bronze_to_contract(S.snapshot(spark, sf), AS_OF, S.TEST_CLIENT)
    return contract.select(*G.CONTRACT.fieldNames())


@section.query(
    "parse_money_ingest",
    sql(
        f"""{dbl("total", "valor_total_recebido")}, {dbl("case when o % 47 <> 0 then p else 0 end", "valor_vencido_antes")},
        {dbl("v", "valor_elegivel")}, o % 43 = 0 as falhou"""
    ),
)
def parse_money_ingest(spark, sf):
    """Amounts of the snapshot; ``falhou`` marks texts that had to become zero."""
    named = _clean(G.rename_columns(G.normalize_columns(S.snapshot(spark, sf))))
    failed = M.ingest_failed(F.col("valor_recebido"))
    return G.received_amounts(named).select(
        F.col("num_venda").alias("linha"),
        "valor_total_recebido",
        "valor_vencido_antes",
        "valor_elegivel",
        failed.alias("falhou"),
    )


_ORDER = "o_orderkey % 1000"
_PRICE = "cast(o_totalprice as decimal(18,2))"


@section.query(
    "parse_money_export",
    f"""select o_orderkey as linha,
      {dbl(f"case o_orderkey % 10 when 0 then {_PRICE} when 1 then {_PRICE} when 2 then cast(1000 + ({_ORDER}) as double) / 1000 when 7 then ({_ORDER}) + 0.25 else 0 end", "exportado")},
      {dbl(f"case o_orderkey % 10 when 0 then {_PRICE} when 1 then {_PRICE} when 2 then 1000 + ({_ORDER}) when 3 then -{_PRICE} when 6 then -(({_ORDER}) + 0.5) when 7 then ({_ORDER}) + 0.25 else 0 end", "contabil")},
      {dbl(f"case o_orderkey % 10 when 0 then {_PRICE} when 1 then {_PRICE} * 100 when 2 then 1000 + ({_ORDER}) when 3 then {_PRICE} when 6 then -(({_ORDER}) + 0.5) when 7 then ({_ORDER}) + 0.25 else 0 end", "digitos")},
      o_orderkey % 10 = 5 as falhou
    from orders""",
)
def parse_money_export(spark, sf):
    text = F.col("texto")
    return S.amount_texts(spark, sf).select(
        "linha",
        M.parse_export(text).alias("exportado"),
        F.coalesce(M.parse_signed(text), M.zero_amount()).alias("contabil"),
        M.parse_digits(text).alias("digitos"),
        F.coalesce(M.signed_failed(text), F.lit(False)).alias("falhou"),
    )
