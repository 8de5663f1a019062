"""The stand-in tables once more, as DuckDB SQL, for the result checks."""

from __future__ import annotations


def _key(order: str) -> str:
    block = f"({order} // 4)"
    development = f"(({block} + {block} // 40) % 40)"
    return (
        f"cast(({block} % 25 + {block} // 25) % 25 as integer) as empresa, "
        f"cast(65000 + 1000 * ({development} % 5) + {development} as varchar) as obra, "
        f"{order} as num_venda"
    )


_INSTALMENT = (
    _key("l_orderkey")
    + ", l_linenumber as num_parcela, cast(l_suppkey % 2 as integer) as num_parcela_geral,"
    + " (['1', 'P', 'S', 'SA', 'E', 'B', 'R'])[l_linenumber] as tipo"
)
_PRICE = "cast(l_extendedprice as decimal(18,2))"
_DISCOUNT = "cast(l_discount as decimal(4,2))"
_TAX = "cast(l_tax as decimal(4,2))"


def _sale(status: str) -> str:
    return f"""{_key("o_orderkey")}, cast(o_orderdate as date) as data_venda, cast(o_orderdate as date) as data_cadastro,
    {status} as status, o_custkey as cliente, cast(o_totalprice as decimal(18,2)) as valor_total,
    cast(o_custkey % 5 as decimal(18,2)) as acrescimo, cast(o_orderkey % 3 as decimal(18,2)) as desconto"""


def _m(expression: str, name: str) -> str:
    return f"cast({expression} as decimal(18,4)) as {name}"


ERP = f"""
vendas as (
  select {_sale("0")}, case when o_orderkey % 20 = 1 then cast(o_orderdate as date) + 30 end as data_cessao
  from orders where o_orderstatus = 'O'),
vendas_rec as (
  select {_sale("case when o_orderstatus = 'P' then 1 else 3 end")}
  from orders where o_orderstatus <> 'O' or o_orderkey % 50 = 0),
obras as (
  select n_nationkey as empresa, cast(65000 + 1000 * (i % 5) + i as varchar) as obra,
    case when i % 8 = 0 then '' when i % 8 = 1 then null else 'Town ' || i end as cidade_obra,
    'DEV ' || n_nationkey || '/' || i as obra_nome,
    case when i <> 38 then 'R' || lpad(cast(n_regionkey as varchar), 2, '0') ||
      lpad(cast(n_nationkey as varchar), 4, '0') || lpad(cast(i as varchar), 3, '0') end as grupo
  from nation, generate_series(0, 39) g(i) where not (i = 39 and n_nationkey % 10 = 7)),
empresas as (select n_nationkey as empresa, 'EMPRESA ' || n_name as empresa_nome from nation),
grupos as (
  select 'R' || lpad(cast(r_regionkey as varchar), 2, '0') as codigo, 'REGIONAL ' || r_name as descricao from region
  union all
  select 'R' || lpad(cast(n_regionkey as varchar), 2, '0') || lpad(cast(n_nationkey as varchar), 4, '0'),
    case n_nationkey when 4 then 'CONTROLADAS' when 7 then 'HOLDING SUL' else n_name end from nation
  union all
  select 'R' || lpad(cast(n_regionkey as varchar), 2, '0') || lpad(cast(n_nationkey as varchar), 4, '0')
    || lpad(cast(i as varchar), 3, '0'), 'SUB ' || i from nation, generate_series(0, 39) g(i)),
itens_base as (
  select o_orderkey, o_orderstatus, n from orders, generate_series(0, 1) g(n) where n = 0 or o_orderkey % 7 = 0),
itens as (
  select {_key("o_orderkey")}, cast((o_orderkey + n) % 50 as integer) as produto, o_orderkey + n as unidade
  from itens_base where o_orderstatus = 'O' and o_orderkey % 11 <> 0),
itens_rec as (
  select {_key("o_orderkey")}, cast((o_orderkey + n) % 50 as integer) as produto, o_orderkey + n as unidade
  from itens_base where o_orderstatus <> 'O' or o_orderkey % 13 = 0),
unidades as (
  select * exclude (num_venda) from (
    select {_key("o_orderkey")}, cast(o_orderkey % 50 as integer) as produto, o_orderkey as unidade,
      'Q' || (o_orderkey % 30) || ' L' || (o_orderkey % 99) as identificador, o_orderkey % 12 as vendido
    from orders where o_orderkey % 9 <> 0)),
produtos as (
  select cast(p_partkey as integer) as produto, p_name as produto_nome,
    case when p_partkey % 4 <> 0 then 1 else 0 end as status from part),
pessoas as (
  select c_custkey as cliente, c_name as nome, lpad(cast(c_custkey as varchar), 11, '0') as cpf,
    'User' || c_custkey || '@Mail.COM' as email from customer),
telefones as (
  select c_custkey as cliente, ' (0' || (11 + c_custkey % 80) || ')' as ddd,
    case (c_custkey + n) % 5
      when 0 then '9' || lpad(cast(c_custkey + n as varchar), 4, '1') || '-' || lpad(cast(c_custkey as varchar), 4, '2')
      when 1 then '08' || lpad(cast(c_custkey as varchar), 3, '7') || ' ' || lpad(cast(c_custkey + n as varchar), 4, '3')
      when 2 then '3' || lpad(cast(c_custkey as varchar), 3, '4') || '-' || lpad(cast(c_custkey as varchar), 4, '5')
      when 3 then '12' end as fone
  from customer, generate_series(0, 1) g(n) where n = 0 or c_custkey % 3 = 0),
oco_base as (select {_key("o_orderkey")} from orders where o_orderkey % 37 = 0 or o_orderkey % 41 = 0),
ocorrencias as (
  select empresa, 'VENDAS ' || num_venda || '-' || obra as documento, ocorrencia, status from (
    select *, 4 as ocorrencia, case when num_venda % 111 = 0 then 1 else 0 end as status from oco_base where num_venda % 37 = 0
    union all select *, 32, 0 from oco_base where num_venda % 41 = 0
    union all select *, 4, 0 from oco_base where num_venda % 74 = 0
    union all select *, 7, 0 from oco_base where num_venda % 37 = 0)),
historico as (
  select {_key("o_orderkey")}, n as num_hist, t as tipo_mnt, cast(o_orderdate as date) + d as data_mnt,
    case when o_orderkey % 60 <> 0 then cast(o_orderdate as date) + d + a end as data_aprovacao,
    case when s > 0 and o_orderkey % 100 <> 0 then o_orderkey + s end as num_nova
  from orders, (values (20, 0, 1, 2, 365, 7, 1), (40, 0, 2, 2, 400, 3, 2), (40, 1, 1, 2, 700, 2, 2),
                       (20, 5, 1, 1, 90, 1, 0), (20, 10, 1, 0, 120, 5, 0)) h(m, r, n, t, d, a, s)
  where o_orderkey % m = r),
distratos as (
  select {_key("o_orderkey")}, cast(n + 1 as integer) as num_distrato,
    case when o_orderkey % 231 = 0 then 1 else 0 end as tipo_aditivo,
    case when o_orderkey % 99 = 0 then 0 else 1 end as status_aprov,
    cast(o_orderkey % 3 as integer) as tipo_distrato, cast((o_orderkey + n) % 6 as integer) as categoria,
    case when o_orderkey % 363 <> 0 then cast(o_orderdate as date) + 200 + cast(n as integer) end as data_cad,
    case when o_orderkey % 66 <> 0 then cast(o_orderdate as date) + 230 + cast(n as integer) end as data_aprov
  from orders, generate_series(0, 1) g(n) where o_orderkey % 33 = 0 and (n = 0 or o_orderkey % 165 = 0)),
categorias as (
  select r_regionkey as categoria, case r_regionkey when 0 then 'INADIMPLENCIA - FALTA DE PAGAMENTO'
    when 1 then 'Venda teste' when 2 then ' ACORDO - COMERCIAL - B ' when 3 then ' DESISTENCIA ' end as descricao
  from region),
contas as (
  select {_INSTALMENT}, cast(l_shipdate as date) as vencimento from lineitem where l_linestatus = 'O'),
calc as (
  select {_INSTALMENT}, {_m(_PRICE, "val_parcela")}, {_m(f"{_PRICE} * {_DISCOUNT}", "val_principal")},
    {_m(f"{_PRICE} * {_TAX}", "val_juros")},
    {_m("case when l_partkey % 7 <> 0 then 1.25 end", "val_correcao")}, {_m(_DISCOUNT, "val_juro_atraso")},
    {_m("case when l_partkey % 5 <> 0 then 2.00 end", "val_multa_atraso")}
  from lineitem where l_linestatus = 'O' and l_partkey % 10 <> 0),
recebidas0 as (
  select {_INSTALMENT}, cast(l_shipdate as date) as pago_em,
    cast(l_shipdate as date) + cast(l_quantity - 25 as integer) as vencimento,
    cast(l_shipdate as date) + cast(l_partkey % 9 - 4 as integer) as cadastrado_em,
    {_m(f"case when l_partkey % 53 = 0 then -{_PRICE} else {_PRICE} end", "principal")},
    {_m("l_linenumber", "juros_parcela")}, {_m("0.50", "correcao")}, {_m("0", "acrescimo")},
    {_m("2.50", "taxa_boleto")}, {_m(f"{_PRICE} * {_TAX}", "multa")},
    {_m("case when l_quantity < 25 then 1.25 else 0 end", "juros_atraso")}, {_m("0.10", "correcao_atraso")},
    {_m(f"{_PRICE} * {_DISCOUNT}", "desconto")}, {_m("1.10", "desconto_custa")}, {_m("0", "desconto_imposto")},
    {_m("case when l_partkey % 97 <> 0 then 0 end", "desconto_condicional")}
  from lineitem where l_linestatus = 'F'),
recebidas as (
  select *, (principal + juros_parcela + correcao + acrescimo + taxa_boleto + multa + juros_atraso + correcao_atraso)
    - (desconto + desconto_custa + desconto_imposto + desconto_condicional) as cheio,
    (principal + juros_parcela + correcao + acrescimo) - (desconto + desconto_imposto + desconto_condicional) as base
  from recebidas0)"""

PREFIXES = "left(obra, 2) in ('65', '67', '68', '69')"
EXCLUDED = "(3, 204, 226, 229, 301, 302)"
KEY = "empresa, obra, num_venda"
KEY6 = "empresa, obra, num_venda, num_parcela, num_parcela_geral, tipo"


def with_tables(query: str, *more: str) -> str:
    """``query`` preceded by the stand-in tables and further named results."""
    return "with " + ",".join((ERP, *more)) + "\n" + query


_KEY_O = _key("o_orderkey")
CONTRATO = f"""
contrato0 as (
  select {_KEY_O.replace("as empresa", "as empresa_num").replace("as obra", "as obra_num").replace("as num_venda", "as o")},
    o_custkey + n as c, n, cast(o_orderdate as date) as od, o_orderpriority as produto,
    case when o_orderkey % 4 = 3 then 0 when o_orderkey % 61 = 0 then -cast(o_totalprice as decimal(18,2))
      else cast(o_totalprice as decimal(18,2)) end as recebido, cast(o_totalprice as decimal(18,2)) as preco,
    (o_orderkey + n) % 6 = 1 or (o_orderkey % 30 = 0 and n = 1) as pendente, o_orderkey % 4 <> 3 as pago
  from orders, generate_series(0, 1) g(n) where n = 0 or o_orderkey % 10 = 0),
contrato as (
  select 'EMPRESA ' || n_name as empresa, cast(empresa_num as varchar) as empresa_codigo, 'DEV ' || obra_num as obra,
    'DEV ' || obra_num as obra_nome, case when empresa_num <> 11 then n_name end as cidade, r_name as regional, produto,
    cast(o as varchar) as num_venda, case when o % 251 <> 0 then lpad(cast(c as varchar), 11, '0') end as cpf_titular,
    'Customer#' || lpad(cast(c as varchar), 9, '0') as nome_cliente, '62' || lpad(cast(c as varchar), 9, '9') as telefone,
    'user' || c || '@mail.com' as email, case when pago then od + cast(o % 45 as integer) end as data_recebimento,
    od as data_venda, coalesce(case when pago then strftime(od + cast(o % 45 as integer), '%Y-%m') end, '1998-08')
      as mes_referencia,
    {_m("recebido", "valor_principal")}, {_m("recebido * 0.02", "valor_multa")}, {_m("0", "valor_juros")},
    {_m("case when o % 17 <> 0 then 0.50 end", "valor_custas")}, {_m("recebido", "valor_total_recebido")},
    {_m("recebido * 0.9", "valor_elegivel")},
    cast(case when recebido > 0 then floor(recebido / 100) else 0 end as bigint) as cupons_calculados,
    cast(case when recebido > 0 and o % 3 = 0 then floor(recebido / 100) else 0 end as bigint) as cupons_casas,
    cast(case when o % 12 = 0 then greatest(floor(preco / 100) - o % 3, 0) end as bigint) as cupons_oficiais,
    case when pendente then 'pendente' else 'elegivel' end as status_elegibilidade,
    case when o % 5 < 2 then 'elegivel' else 'pendente' end as status_elegibilidade_casas,
    case when o % 9 <> 0 then 'cadastrado' else 'nao_cadastrado' end as status_cadastro,
    case when o % 7 = 2 then 'recuperacao' else 'normal' end as classificacao_recebimento,
    {_m("case when o % 7 = 2 and pago then preco * 0.25 else 0 end", "valor_recuperado")},
    {_m("case when o % 8 = 5 and pago then preco * 0.1 else 0 end", "valor_antecipado")},
    {_m("case when pendente then preco * 0.05 else 0 end", "valor_vencido_antes")},
    {_m("case when pendente then preco * 0.004 else 0 end", "valor_juros_inadimplencia")},
    {_m("case when pendente then preco * 0.001 else 0 end", "valor_multa_inadimplencia")},
    cast(case when pendente then (o * 7) % 230 - 1 else 0 end as bigint) as dias_atraso, o % 37 = 0 as juridico_ativo,
    o % 41 = 0 as juridico_passivo, o % 20 = 1 as flag_cessao, o % 23 = 0 as flag_contrato_quitado,
    o % 20 = 0 as flag_contrato_cedido, o % 29 = 0 as flag_contemplado_casa
  from contrato0 join nation on n_nationkey = empresa_num join region on r_regionkey = n_regionkey)"""


def with_contract(query: str, *more: str) -> str:
    """``query`` over the contract frame."""
    return "with " + ",".join((CONTRATO, *more)) + "\n" + query


def dbl(expression: str, name: str | None = None) -> str:
    return f"cast({expression} as double) as {name or expression}"


def big(expression: str, name: str) -> str:
    return f"cast({expression} as bigint) as {name}"
