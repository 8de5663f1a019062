"""Queries over sales, dimensions, items, people, transfers and cancellations."""

from __future__ import annotations

from pyspark.sql import functions as F

from lastro.operators import base as B
from lastro.operators import contracts as C
from lastro.operators import eligibility as R
from lastro.operators import ledger as L
from lastro.plans.oracle_tables import EXCLUDED, KEY, PREFIXES, with_tables
from lastro.plans.registry import Section
from lastro.sources import standin as S

section = Section()
P = S.PORTFOLIO

VENDA = f"""
venda0 as (
  select {KEY}, data_venda, data_cadastro, status, cliente, valor_total + acrescimo - desconto as valor_venda
  from vendas where {PREFIXES}
  union
  select {KEY}, data_venda, data_cadastro, status, cliente, valor_total + acrescimo - desconto
  from vendas_rec r where {PREFIXES} and not exists (
    select 1 from vendas v where v.empresa = r.empresa and v.obra = r.obra and v.num_venda = r.num_venda)),
venda as (select distinct {KEY}, data_venda, status, cliente, valor_venda from venda0)"""

DIMENSAO = """
arvore as (
  select o.*, e.empresa_nome, f.codigo as grupo_no, c.descricao as grupo_cidade, g.descricao as grupo_regional
  from obras o join empresas e using (empresa) left join grupos f on f.codigo = o.grupo
  left join grupos c on c.codigo = left(f.codigo, 7) left join grupos g on g.codigo = left(f.codigo, 3)),
dimensao as (
  select distinct empresa, obra, obra_nome, empresa_nome, cidade_obra,
    case when grupo_cidade = 'NATION_9' then 'NATION_8'
      when grupo_cidade is null or grupo_cidade in ('ADMINISTRATIVO', 'INVESTIMENTOS', 'GERENCIAIS/INTERNAS',
        'CONTROLADAS', 'NOVOS NEGOCIOS', 'NOVOS NEGÓCIOS') or grupo_cidade like 'HOLDING%'
      then coalesce(nullif(upper(cidade_obra), ''), grupo_cidade) else grupo_cidade end as cidade,
    replace(grupo_regional, 'REGIONAL', '') as regional
  from arvore)"""

ITEM = f"""
item1 as (
  select * exclude (rn) from (select *, row_number() over (partition by {KEY} order by produto, unidade) rn from itens)
  where rn = 1),
item as (
  select {KEY}, produto, unidade from item1
  union all
  select {KEY}, produto, unidade from (
    select *, row_number() over (partition by {KEY} order by produto, unidade) rn from itens_rec r
    where not exists (select 1 from itens i
      where i.empresa = r.empresa and i.obra = r.obra and i.num_venda = r.num_venda)) where rn = 1)"""

FONE = """
fone_limpo as (
  select cliente, regexp_replace(regexp_replace(trim(ddd), '[-() ]', '', 'g'), '^[^1-9]+', '') as ddd,
    regexp_replace(regexp_replace(trim(fone), '[-() ]', '', 'g'), '^[^1-9]+', '') as fone from telefones),
fone_tipo as (
  select *, ddd || fone as completo,
    case when length(ddd || fone) = 11 and fone like '9%' then 1
      when length(ddd || fone) = 10 and left(fone, 1) in ('6', '7', '8', '9') then 2
      when length(ddd || fone) = 10 and left(fone, 1) in ('2', '3', '4', '5') then 3 else 4 end as prioridade
  from fone_limpo),
fone_todos as (
  select cliente, ddd, fone, completo, prioridade,
    case when prioridade = 2 then ddd || '9' || fone else completo end as telefone,
    (['Celular', 'Celular (corrigido)', 'Fixo', 'Indefinido'])[prioridade] as tipo_telefone from fone_tipo),
melhor_fone as (
  select cliente, telefone, tipo_telefone from (
    select *, row_number() over (partition by cliente order by prioridade, telefone nulls last) rn from fone_todos)
  where rn = 1)"""

JURIDICO = """
juridico as (
  select empresa, documento, cast(sum(case when ocorrencia = 4 then 1 else 0 end) as bigint) as juridico_ativo,
    cast(sum(case when ocorrencia = 32 then 1 else 0 end) as bigint) as juridico_passivo
  from ocorrencias where status = 0 and ocorrencia in (4, 32) group by all)"""

CESSAO = f"""
cessoes as (select * from historico where tipo_mnt = 2 and data_aprovacao is not null and {PREFIXES}),
cessao_nova as (
  select empresa, obra, num_nova as num_venda, max(num_venda) as venda_origem, max(data_mnt) as data_cessao
  from cessoes where num_nova is not null group by all),
cedida as (select {KEY}, max(num_nova) as venda_nova, max(data_mnt) as data_cedida from cessoes group by {KEY}),
cessao_ultima as (
  select {KEY}, data_mnt as data_cedida, data_aprovacao, num_nova as venda_nova from (
    select *, row_number() over (partition by {KEY} order by data_aprovacao desc, num_hist desc nulls last) rn from cessoes)
  where rn = 1)"""

DISTRATO = f"""
distrato_ef as (select *, coalesce(data_aprov, data_cad) as dia from distratos where tipo_aditivo = 0 and status_aprov = 1),
distrato as (
  select {KEY}, tipo_distrato, categoria, data_cad, data_aprov from (
    select *, row_number() over (
      partition by {KEY} order by data_cad desc nulls last, num_distrato desc nulls last) rn from distrato_ef)
  where rn = 1)"""


@section.query(
    "sales_union", with_tables(f"select {KEY}, data_venda, status, cliente, cast(valor_venda as double) as valor_venda from venda0", VENDA)
)
def sales_union(spark, sf):
    return C.all_sales(S.sales_live(spark, sf), S.sales_archived(spark, sf), P).drop("data_cadastro")


@section.query(
    "sales_transition_antijoin",
    with_tables(
        f"select {KEY}, status from vendas_rec r where {PREFIXES} and (empresa, obra, num_venda) not in (select ({KEY}) from vendas)"
    ),
)
def sales_transition_antijoin(spark, sf):
    archived = C.in_universe(S.sales_archived(spark, sf), P)
    return C.archived_only(S.sales_live(spark, sf), archived).select("empresa", "obra", "num_venda", "status")


VENDA_FONTE = f"""
venda_fonte as (
  select {KEY}, status, cliente, fonte_venda from (
    select *, row_number() over (partition by {KEY} order by ordem, status, cliente) rn from (
      select {KEY}, status, cliente, 'VENDAS' as fonte_venda, 1 as ordem from vendas where {PREFIXES}
      union all select {KEY}, status, cliente, 'VENDAS RECEBIDAS', 2 from vendas_rec where {PREFIXES}))
  where rn = 1)"""


@section.query("sales_priority_dedup", with_tables("select * from venda_fonte", VENDA_FONTE))
def sales_priority_dedup(spark, sf):
    return C.ranked_sales(S.sales_live(spark, sf), S.sales_archived(spark, sf), P)


def _net(spark, sf):
    return C.all_sales(S.sales_live(spark, sf), S.sales_archived(spark, sf), P)


@section.query(
    "development_company_join",
    with_tables(
        f"select {KEY}, obra_nome, empresa_nome from venda join obras using (empresa, obra) join empresas using (empresa)",
        VENDA,
    ),
)
def development_company_join(spark, sf):
    erp = S.erp(spark, sf)
    dims = C.development_company(erp.developments, erp.companies)
    return _net(spark, sf).join(dims, ["empresa", "obra"]).select(
        "empresa", "obra", "num_venda", "obra_nome", "empresa_nome"
    )


@section.query(
    "prefix_hierarchy_join",
    with_tables(
        f"select {KEY}, grupo_no, grupo_cidade, grupo_regional from venda join arvore using (empresa, obra)", VENDA, DIMENSAO
    ),
)
def prefix_hierarchy_join(spark, sf):
    erp = S.erp(spark, sf)
    tree = C.with_hierarchy(C.development_company(erp.developments, erp.companies), erp.groups)
    return _net(spark, sf).join(tree, ["empresa", "obra"]).select(
        "empresa", "obra", "num_venda", "grupo_no", "grupo_cidade", "grupo_regional"
    )


def _dimension(erp):
    return C.development_dimension(erp.developments, erp.companies, erp.groups, P)


@section.query(
    "city_canonical",
    with_tables(f"select {KEY}, cidade, regional from venda join dimensao using (empresa, obra)", VENDA, DIMENSAO),
)
def city_canonical(spark, sf):
    joined = _net(spark, sf).join(_dimension(S.erp(spark, sf)), ["empresa", "obra"])
    return joined.select("empresa", "obra", "num_venda", "cidade", "regional")


@section.query(
    "base_group_dedup",
    with_tables(
        f"""select cidade, regional, {KEY}, data_venda, cast(valor_venda as double) as valor_venda, status, obra_nome,
        empresa_nome, cliente from (select * exclude (data_cadastro) from venda0) join dimensao using (empresa, obra) group by all""",
        VENDA,
        DIMENSAO,
    ),
)
def base_group_dedup(spark, sf):
    joined = _net(spark, sf).drop("data_cadastro").join(_dimension(S.erp(spark, sf)), ["empresa", "obra"])
    return C.sale_rows(joined)


@section.query("first_item_per_sale", with_tables("select * from item1", ITEM))
def first_item_per_sale(spark, sf):
    return C.first_item(S.items(spark, sf, live=True))


@section.query(
    "item_fallback_union", with_tables(f"select {KEY}, produto, unidade from venda join item using ({KEY})", VENDA, ITEM)
)
def item_fallback_union(spark, sf):
    items = C.item_per_sale(S.items(spark, sf, live=True), S.items(spark, sf, live=False))
    return _net(spark, sf).join(items, ["empresa", "obra", "num_venda"]).select(*items.columns)


UNIDADE = f"""
item_unidade as (
  select i.*, u.identificador, u.produto as produto_unidade from item i left join (
    select * from unidades where vendido <> 10 and {PREFIXES}) u using (empresa, obra, produto, unidade))"""


def _item_units(spark, sf):
    items = C.item_per_sale(S.items(spark, sf, live=True), S.items(spark, sf, live=False))
    return C.with_unit(items, S.units(spark, sf), P)


@section.query(
    "unit_left_join", with_tables(f"select {KEY}, produto, unidade, identificador from item_unidade", ITEM, UNIDADE)
)
def unit_left_join(spark, sf):
    return _item_units(spark, sf).select("empresa", "obra", "num_venda", "produto", "unidade", "identificador")


@section.query(
    "product_left_join",
    with_tables(
        f"""select {KEY}, identificador, produto_nome from item_unidade i
        left join produtos p on p.produto = i.produto_unidade and p.status = 1""",
        ITEM,
        UNIDADE,
    ),
)
def product_left_join(spark, sf):
    named = C.with_product(_item_units(spark, sf), S.products(spark, sf))
    return named.select("empresa", "obra", "num_venda", "identificador", "produto_nome")


@section.query(
    "client_left_join",
    with_tables(f"select {KEY}, cliente, nome, cpf, email from venda left join pessoas using (cliente)", VENDA),
)
def client_left_join(spark, sf):
    named = C.with_client(_net(spark, sf), S.people(spark, sf))
    return named.select("empresa", "obra", "num_venda", "cliente", "nome", "cpf", "email")


@section.query("phone_clean", with_tables("select cliente, ddd, fone, completo from fone_todos", FONE))
def phone_clean(spark, sf):
    return C.phone_numbers(S.phones(spark, sf))


@section.query(
    "phone_classify", with_tables("select cliente, completo, telefone, tipo_telefone, prioridade from fone_todos", FONE)
)
def phone_classify(spark, sf):
    typed = C.classify_phones(C.phone_numbers(S.phones(spark, sf)))
    return typed.select("cliente", "completo", "telefone", "tipo_telefone", "prioridade")


@section.query("best_phone_per_person", with_tables("select * from melhor_fone", FONE))
def best_phone_per_person(spark, sf):
    return C.best_phone(S.phones(spark, sf))


@section.query("legal_occurrence", with_tables("select * from juridico", JURIDICO))
def legal_occurrence(spark, sf):
    return C.legal_by_document(S.occurrences(spark, sf))


@section.query(
    "composite_text_key_join",
    with_tables(
        f"""select v.empresa, v.obra, v.num_venda, juridico_ativo, juridico_passivo from venda v
        join juridico j on j.empresa = v.empresa and j.documento = concat('VENDAS ', v.num_venda, '-', v.obra)""",
        VENDA,
        JURIDICO,
    ),
)
def composite_text_key_join(spark, sf):
    legal = C.legal_by_sale(S.occurrences(spark, sf))
    return _net(spark, sf).join(legal, ["empresa", "obra", "num_venda"]).select(
        "empresa", "obra", "num_venda", "juridico_ativo", "juridico_passivo"
    )


@section.query("cession_new_side", with_tables("select * from cessao_nova", CESSAO))
def cession_new_side(spark, sf):
    return C.cession_new_side(S.history(spark, sf), P)


@section.query("cession_old_side", with_tables("select * from cedida", CESSAO))
def cession_old_side(spark, sf):
    return C.cession_old_side(S.history(spark, sf), P)


@section.query("cession_latest", with_tables("select * from cessao_ultima", CESSAO))
def cession_latest(spark, sf):
    return C.cession_latest(S.history(spark, sf), P)


HIST_FLAGS = f"""
hist_flags as (
  select {KEY}, max(case when tipo_mnt = 0 and data_aprovacao is not null then 1 else 0 end) as teve_cancelamento,
    max(case when tipo_mnt = 1 and data_aprovacao is not null then 1 else 0 end) as teve_renegociacao,
    max(case when tipo_mnt = 2 and data_aprovacao is not null then 1 else 0 end) as teve_cessao
  from historico where {PREFIXES} group by {KEY})"""


@section.query("sale_history_flags", with_tables("select * from hist_flags", HIST_FLAGS))
def sale_history_flags(spark, sf):
    return C.history_flags(S.history(spark, sf), P)


@section.query("cancellation_latest", with_tables("select * from distrato", DISTRATO))
def cancellation_latest(spark, sf):
    return C.cancellation_latest(S.cancellations(spark, sf))


CATEGORIA = """
distrato_cat as (
  select d.*, case when descricao is null then '' when instr(descricao, ' - ') > 0
      then trim(substr(descricao, 1, instr(descricao, ' - ') - 1)) else trim(descricao) end as categoria_distrato,
    case when descricao is null or instr(descricao, ' - ') = 0 then ''
      else trim(substr(descricao, instr(descricao, ' - ') + 3)) end as motivo_distrato
  from distrato d left join categorias using (categoria))"""


@section.query("cancellation_category_split", with_tables("select * from distrato_cat", DISTRATO, CATEGORIA))
def cancellation_category_split(spark, sf):
    return C.category_split(C.cancellation_latest(S.cancellations(spark, sf)), S.categories(spark, sf))


@section.query(
    "cancellation_antijoin",
    with_tables(
        f"""select {KEY}, status from venda v where not exists (select 1 from distrato_ef d
        where d.empresa = v.empresa and d.obra = v.obra and d.num_venda = v.num_venda)""",
        VENDA,
        DISTRATO,
    ),
)
def cancellation_antijoin(spark, sf):
    kept = C.without_cancelled(_net(spark, sf), S.cancellations(spark, sf))
    return kept.select("empresa", "obra", "num_venda", "status")


@section.query(
    "membership_rule",
    with_tables(
        f"""select v.empresa, v.obra, v.num_venda, v.status from venda v
        left join (select distinct {KEY}, 1 as pagou from recebidas r left join cedida c using ({KEY})
          where {PREFIXES} and tipo <> '1' and pago_em >= date '1998-07-01' and pago_em < date '1999-01-01'
            and (c.data_cedida is null or pago_em < c.data_cedida)) r using ({KEY})
        left join cedida using ({KEY})
        where (status = 0 or (status = 3 and pagou = 1) or (status = 1 and venda_nova is not null and pagou = 1))
          and v.empresa not in {EXCLUDED}""",
        VENDA,
        CESSAO,
    ),
)
def membership_rule(spark, sf):
    ceded = C.cession_old_side(S.history(spark, sf), P)
    window = S.LIVE
    receipts = L.campaign_receipts(S.receipts(spark, sf), ceded, P, window.start, window.end, window.month_start)
    paid = receipts.select("empresa", "obra", "num_venda", F.lit(True).alias("_pagou"))
    joined = _net(spark, sf).join(paid, ["empresa", "obra", "num_venda"], "left")
    joined = joined.withColumn("teve_recebimento", R.is_true(F.col("_pagou")))
    members = C.keep_members(joined.join(ceded, ["empresa", "obra", "num_venda"], "left"), P)
    return members.select("empresa", "obra", "num_venda", "status")


@section.query(
    "cession_chain_resolve",
    with_tables(
        f"""select {KEY}, fim as venda_vigente, passos as profundidade from caminho c
        where not exists (select 1 from elo e where e.empresa = c.empresa and e.obra = c.obra and e.num_venda = c.fim)""",
        CESSAO,
        "elo as (select * from cessao_ultima where venda_nova is not null)",
        f"""caminho as (
          with recursive walk as (
            select {KEY}, venda_nova as fim, cast(1 as bigint) as passos from elo
            union all
            select w.empresa, w.obra, w.num_venda, e.venda_nova, w.passos + 1 from walk w
            join elo e on e.empresa = w.empresa and e.obra = w.obra and e.num_venda = w.fim where w.passos <= (select count(*) from elo))
          select * from walk)""",
    ),
)
def cession_chain_resolve(spark, sf):
    return C.resolve_cession_chain(S.history(spark, sf), P)


@section.query(
    "base_sort",
    with_tables(
        f"select cidade, regional, obra as codobra, empresa as codempresa, num_venda as venda from venda join dimensao using (empresa, obra)",
        VENDA,
        DIMENSAO,
    ),
)
def base_sort(spark, sf):
    joined = _net(spark, sf).join(_dimension(S.erp(spark, sf)), ["empresa", "obra"])
    named = joined.select(
        "cidade", "regional", F.col("obra").alias("codobra"), F.col("empresa").alias("codempresa"), F.col("num_venda").alias("venda")
    )
    return B.base_sort(named)
