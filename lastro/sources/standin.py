"""ERP tables and snapshots derived from the shared star-schema test tables.

Every column is a row-wise formula of one fact row, so a query over a stand-in
table scans what it would scan in production: the facts already carry the full
sale key and no join is needed to find it. Four neighbouring order keys share a
company and a development, which is what lets a transferred sale point at its
successor inside the same development.
"""

from __future__ import annotations

from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastro.params import Campaign, CloseWindow, LiveWindow, Portfolio
from lastro.sources.tables import Erp

PORTFOLIO = Portfolio(city_alias=(("NATION_9", "NATION_8"),))
LIVE = LiveWindow(date(1998, 7, 1), date(1999, 1, 1), date(1998, 8, 11))
PHOTO = LiveWindow(date(1998, 7, 1), date(1999, 1, 1), date(1998, 7, 25))
CLOSE = CloseWindow(date(1998, 7, 1), date(1998, 7, 1), date(1998, 8, 1))
CAMPAIGN = Campaign(date(1998, 7, 1), date(1998, 12, 31))
TEST_CLIENT = "#00000010"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, read with the splits its files give."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _key(order: str) -> list[str]:
    block = f"cast(floor({order} / 4) as bigint)"
    company = f"({block} % 25 + cast(floor({block} / 25) as bigint)) % 25"
    development = f"({block} + cast(floor({block} / 40) as bigint)) % 40"
    return [
        f"cast({company} as int) as empresa",
        f"cast(65000 + 1000 * (({development}) % 5) + ({development}) as string) as obra",
        f"{order} as num_venda",
    ]


_INSTALMENT = [
    *_key("l_orderkey"),
    "l_linenumber as num_parcela",
    "cast(l_suppkey % 2 as int) as num_parcela_geral",
    "element_at(array('1', 'P', 'S', 'SA', 'E', 'B', 'R'), l_linenumber) as tipo",
]
_PRICE = "cast(l_extendedprice as decimal(18,2))"
_RATE = "cast({} as decimal(4,2))"


def _money(expression: str, name: str) -> str:
    return f"cast({expression} as decimal(18,4)) as {name}"


def _sales(orders: DataFrame, status: str) -> DataFrame:
    return orders.selectExpr(
        *_key("o_orderkey"),
        "cast(o_orderdate as date) as data_venda",
        "cast(o_orderdate as date) as data_cadastro",
        f"cast({status} as int) as status",
        "o_custkey as cliente",
        "cast(o_totalprice as decimal(18,2)) as valor_total",
        "cast(o_custkey % 5 as decimal(18,2)) as acrescimo",
        "cast(o_orderkey % 3 as decimal(18,2)) as desconto",
        "case when o_orderkey % 20 = 1 then cast(o_orderdate as date) + 30 end as data_cessao",
    )


def sales_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales(table(spark, sf_dir, "orders").where("o_orderstatus = 'O'"), "0")


def sales_archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where("o_orderstatus <> 'O' or o_orderkey % 50 = 0")
    return _sales(orders, "case when o_orderstatus = 'P' then 1 else 3 end").drop("data_cessao")


def developments(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    grid = nation.selectExpr("*", "explode(sequence(0, 39)) as i").where("not (i = 39 and n_nationkey % 10 = 7)")
    return grid.selectExpr(
        "n_nationkey as empresa",
        "cast(65000 + 1000 * (i % 5) + i as string) as obra",
        "case when i % 8 = 0 then '' when i % 8 = 1 then null else concat('Town ', i) end as cidade_obra",
        "concat('DEV ', n_nationkey, '/', i) as obra_nome",
        "case when i <> 38 then concat('R', lpad(cast(n_regionkey as string), 2, '0'),"
        " lpad(cast(n_nationkey as string), 4, '0'), lpad(cast(i as string), 3, '0')) end as grupo",
    )


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    prefix = "concat('R', lpad(cast(n_regionkey as string), 2, '0'), lpad(cast(n_nationkey as string), 4, '0')"
    regional = region.selectExpr(
        "concat('R', lpad(cast(r_regionkey as string), 2, '0')) as codigo",
        "concat('REGIONAL ', r_name) as descricao",
    )
    city = nation.selectExpr(
        f"{prefix}) as codigo",
        "case n_nationkey when 4 then 'CONTROLADAS' when 7 then 'HOLDING SUL' else n_name end as descricao",
    )
    child = nation.selectExpr("*", "explode(sequence(0, 39)) as i").selectExpr(
        f"{prefix}, lpad(cast(i as string), 3, '0')) as codigo", "concat('SUB ', i) as descricao"
    )
    return regional.unionByName(city).unionByName(child)


def items(spark: SparkSession, sf_dir: str, live: bool) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    kept = "o_orderstatus = 'O' and o_orderkey % 11 <> 0" if live else "o_orderstatus <> 'O' or o_orderkey % 13 = 0"
    copies = "explode(sequence(0, case when o_orderkey % 7 = 0 then 1 else 0 end)) as n"
    return (
        orders.where(kept)
        .selectExpr("o_orderkey", copies)
        .selectExpr(
            *_key("o_orderkey"), "cast((o_orderkey + n) % 50 as int) as produto", "o_orderkey + n as unidade"
        )
    )


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where("o_orderkey % 9 <> 0")
    return orders.selectExpr(
        *_key("o_orderkey"),
        "cast(o_orderkey % 50 as int) as produto",
        "o_orderkey as unidade",
        "concat('Q', o_orderkey % 30, ' L', o_orderkey % 99) as identificador",
        "cast(o_orderkey % 12 as int) as vendido",
    ).drop("num_venda")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey as int) as produto",
        "p_name as produto_nome",
        "cast(case when p_partkey % 4 <> 0 then 1 else 0 end as int) as status",
    )


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as cliente",
        "c_name as nome",
        "lpad(cast(c_custkey as string), 11, '0') as cpf",
        "concat('User', c_custkey, '@Mail.COM') as email",
    )


def phones(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    two = customer.selectExpr("c_custkey as c", "explode(sequence(0, case when c_custkey % 3 = 0 then 1 else 0 end)) n")
    return two.selectExpr(
        "c as cliente",
        "concat(' (0', 11 + c % 80, ')') as ddd",
        """case (c + n) % 5
             when 0 then concat('9', lpad(cast(c + n as string), 4, '1'), '-', lpad(cast(c as string), 4, '2'))
             when 1 then concat('08', lpad(cast(c as string), 3, '7'), ' ', lpad(cast(c + n as string), 4, '3'))
             when 2 then concat('3', lpad(cast(c as string), 3, '4'), '-', lpad(cast(c as string), 4, '5'))
             when 3 then '12'
           end as fone""",
    )


def occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key = orders.where("o_orderkey % 37 = 0 or o_orderkey % 41 = 0").selectExpr(*_key("o_orderkey"))
    doc = "concat('VENDAS ', num_venda, '-', obra) as documento"
    rows = [
        key.where("num_venda % 37 = 0").selectExpr(
            "empresa", doc, "4 as ocorrencia", "case when num_venda % 111 = 0 then 1 else 0 end as status"
        ),
        key.where("num_venda % 41 = 0").selectExpr("empresa", doc, "32 as ocorrencia", "0 as status"),
        key.where("num_venda % 74 = 0").selectExpr("empresa", doc, "4 as ocorrencia", "0 as status"),
        key.where("num_venda % 37 = 0").selectExpr("empresa", doc, "7 as ocorrencia", "0 as status"),
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_of(table(spark, sf_dir, "orders"))


def history_of(orders: DataFrame) -> DataFrame:
    entries = """explode(filter(array(
        case when o_orderkey % 20 = 0 then named_struct('n', 1, 't', 2, 'd', 365, 'a', 7, 's', 1) end,
        case when o_orderkey % 40 = 0 then named_struct('n', 2, 't', 2, 'd', 400, 'a', 3, 's', 2) end,
        case when o_orderkey % 40 = 1 then named_struct('n', 1, 't', 2, 'd', 700, 'a', 2, 's', 2) end,
        case when o_orderkey % 20 = 5 then named_struct('n', 1, 't', 1, 'd', 90, 'a', 1, 's', 0) end,
        case when o_orderkey % 20 = 10 then named_struct('n', 1, 't', 0, 'd', 120, 'a', 5, 's', 0) end
    ), x -> x is not null)) as h"""
    return orders.selectExpr("o_orderkey", "cast(o_orderdate as date) as o_day", entries).selectExpr(
        *_key("o_orderkey"),
        "h.n as num_hist",
        "h.t as tipo_mnt",
        "o_day + h.d as data_mnt",
        "case when o_orderkey % 60 <> 0 then o_day + h.d + h.a end as data_aprovacao",
        "case when h.s > 0 and o_orderkey % 100 <> 0 then o_orderkey + h.s end as num_nova",
    )


def cancellations(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where("o_orderkey % 33 = 0")
    two = orders.selectExpr("*", "explode(sequence(0, case when o_orderkey % 165 = 0 then 1 else 0 end)) as n")
    return two.selectExpr(
        *_key("o_orderkey"),
        "n + 1 as num_distrato",
        "case when o_orderkey % 231 = 0 then 1 else 0 end as tipo_aditivo",
        "case when o_orderkey % 99 = 0 then 0 else 1 end as status_aprov",
        "cast(o_orderkey % 3 as int) as tipo_distrato",
        "cast((o_orderkey + n) % 6 as int) as categoria",
        "case when o_orderkey % 363 <> 0 then cast(o_orderdate as date) + 200 + n end as data_cad",
        "case when o_orderkey % 66 <> 0 then cast(o_orderdate as date) + 230 + n end as data_aprov",
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").selectExpr(
        "r_regionkey as categoria",
        """case r_regionkey when 0 then 'INADIMPLENCIA - FALTA DE PAGAMENTO' when 1 then 'Venda teste'
             when 2 then ' ACORDO - COMERCIAL - B ' when 3 then ' DESISTENCIA ' end as descricao""",
    )


def receivables(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where("l_linestatus = 'O'")
    return lines.selectExpr(*_INSTALMENT, "cast(l_shipdate as date) as vencimento")


def valuations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where("l_linestatus = 'O' and l_partkey % 10 <> 0")
    return lines.selectExpr(
        *_INSTALMENT,
        _money(_PRICE, "val_parcela"),
        _money(f"{_PRICE} * {_RATE.format('l_discount')}", "val_principal"),
        _money(f"{_PRICE} * {_RATE.format('l_tax')}", "val_juros"),
        _money("case when l_partkey % 7 <> 0 then 1.25 end", "val_correcao"),
        _money(_RATE.format("l_discount"), "val_juro_atraso"),
        _money("case when l_partkey % 5 <> 0 then 2.00 end", "val_multa_atraso"),
    )


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return receipts_of(table(spark, sf_dir, "lineitem"))


def receipts_of(lineitem: DataFrame) -> DataFrame:
    lines = lineitem.where("l_linestatus = 'F'")
    signed = f"case when l_partkey % 53 = 0 then -{_PRICE} else {_PRICE} end"
    return lines.selectExpr(
        *_INSTALMENT,
        "cast(l_shipdate as date) as pago_em",
        "cast(l_shipdate as date) + cast(l_quantity - 25 as int) as vencimento",
        "cast(l_shipdate as date) + cast(l_partkey % 9 - 4 as int) as cadastrado_em",
        _money(signed, "principal"),
        _money("l_linenumber", "juros_parcela"),
        _money("0.50", "correcao"),
        _money("0", "acrescimo"),
        _money("2.50", "taxa_boleto"),
        _money(f"{_PRICE} * {_RATE.format('l_tax')}", "multa"),
        _money("case when l_quantity < 25 then 1.25 else 0 end", "juros_atraso"),
        _money("0.10", "correcao_atraso"),
        _money(f"{_PRICE} * {_RATE.format('l_discount')}", "desconto"),
        _money("1.10", "desconto_custa"),
        _money("0", "desconto_imposto"),
        _money("case when l_partkey % 97 <> 0 then 0 end", "desconto_condicional"),
    )


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return nation.selectExpr("n_nationkey as empresa", "concat('EMPRESA ', n_name) as empresa_nome")


def items_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items(spark, sf_dir, live=True)


def items_archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items(spark, sf_dir, live=False)


_READERS = (
    sales_live, sales_archived, developments, companies, groups, items_live, items_archived, units, products,
    people, phones, occurrences, history, cancellations, categories, receivables, valuations, receipts,
)


def erp(spark: SparkSession, sf_dir: str) -> Erp:
    return Erp(**{read.__name__: partial(read, spark, sf_dir) for read in _READERS})


# Contract frame: one row per sale and buyer --------------------------------


def contract_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consumption frame, every column a formula of the order and its buyer."""
    orders = table(spark, sf_dir, "orders")
    nation = table(spark, sf_dir, "nation").selectExpr("n_nationkey as empresa_num", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").selectExpr("r_regionkey as n_regionkey", "r_name")
    places = nation.join(region, "n_regionkey")
    buyers = orders.selectExpr("*", "explode(sequence(0, case when o_orderkey % 10 = 0 then 1 else 0 end)) as n")
    key = [e.replace("as empresa", "as empresa_num").replace("as obra", "as obra_num") for e in _key("o_orderkey")[:2]]
    rows = buyers.selectExpr(
        *key,
        "o_orderkey as o",
        "o_custkey + n as c",
        "n",
        "cast(o_orderdate as date) as od",
        "o_orderpriority as produto",
        """case when o_orderkey % 4 = 3 then 0 when o_orderkey % 61 = 0 then -cast(o_totalprice as decimal(18,2))
             else cast(o_totalprice as decimal(18,2)) end as recebido""",
        "cast(o_totalprice as decimal(18,2)) as preco",
        "(o_orderkey + n) % 6 = 1 or (o_orderkey % 30 = 0 and n = 1) as pendente",
    )
    paid = "o % 4 <> 3"
    return rows.join(places, "empresa_num").selectExpr(
        "concat('EMPRESA ', n_name) as empresa",
        "cast(empresa_num as string) as empresa_codigo",
        "concat('DEV ', obra_num) as obra",
        "concat('DEV ', obra_num) as obra_nome",
        "case when empresa_num <> 11 then n_name end as cidade",
        "r_name as regional",
        "produto",
        "cast(o as string) as num_venda",
        "case when o % 251 <> 0 then lpad(cast(c as string), 11, '0') end as cpf_titular",
        "concat('Customer#', lpad(cast(c as string), 9, '0')) as nome_cliente",
        "concat('62', lpad(cast(c as string), 9, '9')) as telefone",
        "concat('user', c, '@mail.com') as email",
        f"case when {paid} then od + cast(o % 45 as int) end as data_recebimento",
        "od as data_venda",
        f"coalesce(case when {paid} then date_format(od + cast(o % 45 as int), 'yyyy-MM') end, '1998-08') as mes_referencia",
        _money("recebido", "valor_principal"),
        _money("recebido * 0.02", "valor_multa"),
        _money("0", "valor_juros"),
        _money("case when o % 17 <> 0 then 0.50 end", "valor_custas"),
        _money("recebido", "valor_total_recebido"),
        _money("recebido * 0.9", "valor_elegivel"),
        "cast(case when recebido > 0 then floor(recebido / 100) else 0 end as bigint) as cupons_calculados",
        "cast(case when recebido > 0 and o % 3 = 0 then floor(recebido / 100) else 0 end as bigint) as cupons_casas",
        "cast(case when o % 12 = 0 then greatest(floor(preco / 100) - o % 3, 0) end as bigint) as cupons_oficiais",
        "case when pendente then 'pendente' else 'elegivel' end as status_elegibilidade",
        "case when o % 5 < 2 then 'elegivel' else 'pendente' end as status_elegibilidade_casas",
        "case when o % 9 <> 0 then 'cadastrado' else 'nao_cadastrado' end as status_cadastro",
        "case when o % 7 = 2 then 'recuperacao' else 'normal' end as classificacao_recebimento",
        _money(f"case when o % 7 = 2 and {paid} then preco * 0.25 else 0 end", "valor_recuperado"),
        _money(f"case when o % 8 = 5 and {paid} then preco * 0.1 else 0 end", "valor_antecipado"),
        _money("case when pendente then preco * 0.05 else 0 end", "valor_vencido_antes"),
        _money("case when pendente then preco * 0.004 else 0 end", "valor_juros_inadimplencia"),
        _money("case when pendente then preco * 0.001 else 0 end", "valor_multa_inadimplencia"),
        "cast(case when pendente then (o * 7) % 230 - 1 else 0 end as bigint) as dias_atraso",
        "o % 37 = 0 as juridico_ativo",
        "o % 41 = 0 as juridico_passivo",
        "o % 20 = 1 as flag_cessao",
        "o % 23 = 0 as flag_contrato_quitado",
        "o % 20 = 0 as flag_contrato_cedido",
        "o % 29 = 0 as flag_contemplado_casa",
    )


# Published snapshot with text amounts and days ------------------------------


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published form of a contract: accented names, text amounts, odd values."""
    orders = table(spark, sf_dir, "orders")
    nation = table(spark, sf_dir, "nation").selectExpr("n_nationkey as empresa", "n_name", "n_regionkey")
    places = nation.join(table(spark, sf_dir, "region").selectExpr("r_regionkey as n_regionkey", "r_name"), "n_regionkey")
    rows = orders.selectExpr(
        *_key("o_orderkey")[:2],
        "o_orderkey as o",
        "o_custkey as c",
        "cast(o_orderdate as date) as od",
        "o_orderpriority as prio",
        "cast(o_totalprice as decimal(18,2)) as p",
        "case when o_orderkey % 61 = 0 then -cast(o_totalprice as decimal(18,2)) else cast(o_totalprice as decimal(18,2)) end as v",
    )

    def text_money(value: str) -> str:
        return f"concat(case when {value} < 0 then '-' else '' end, 'R$ ', translate(format_number(abs({value}), 2), ',.', '.,'))"

    return rows.join(places, "empresa").selectExpr(
        "n_name as `Cidade`",
        "concat(' ', r_name) as `Regional`",
        "empresa as `CodEmpresa`",
        "obra as `CodObra`",
        "concat('DEV ', obra) as `NomeObra`",
        "concat('EMPRESA ', n_name) as `NomeEmpresa`",
        "case when o % 19 <> 0 then prio end as `Produto`",
        "o as `Venda`",
        "date_format(od, 'dd/MM/yyyy') as `Dt.Venda`",
        "case when o % 71 <> 0 then concat('Customer#', lpad(cast(c as string), 9, '0')) end as `NomeCliente`",
        "lpad(cast(c as string), 11, '0') as `cpf_pes`",
        "concat('user', c, '@mail.com') as `EmailCliente`",
        "case when o % 13 <> 0 then cast(62900000000 + c as double) end as `TelefoneFormatado`",
        "case when o % 6 = 0 then '1' when o % 6 = 1 then null else '0' end as `Inad Junho`",
        "case when o % 7 = 2 then 1 else 0 end as `Recuperação`",
        text_money("p") + " as `Valor Recuperado`",
        "case when o % 8 = 5 then 'Sim' else 'Não' end as `Antecipação`",
        text_money("p") + " as `Valor Antecipado`",
        f"case when o % 47 <> 0 then {text_money('p')} end as `Valor Inadimplência`",
        "p as `Valor Juros Inadimplência`",
        f"case o % 43 when 0 then 'n/d' when 1 then '' else {text_money('v')} end as `Valor Recebido`",
        f"{text_money('v')} as `Valor Gera Cupom`",
        """case when o % 53 = 0 then '99/99/9999' when o % 5 = 4 then null
             else date_format(od + cast(o % 45 as int), 'dd/MM/yyyy') end as `Data Último Recebimento`""",
        "case when o % 59 = 0 then 'x' else cast(cast(floor(p / 100) as bigint) as string) end as `Cupons Milhão`",
        "cast(floor(p / 100) as double) as `Cupons Casas`",
        "case when o % 4 = 0 then 'Não' else 'Sim' end as `Pagou Parcela Mês Anterior`",
        "case when o % 3 = 0 then o % 300 end as `DiasAtraso`",
        "case o % 5 when 0 then 'NÃO APTO' when 1 then ' apto ' else 'APTO' end as `Status Sorteio`",
        "case when o % 5 = 0 then 'PARCELA VENCIDA' else 'ADIMPLENTE' end as `Motivo`",
        "case when o % 37 = 0 then ' sim' else 'Não' end as `Jurídico Ativo`",
        "case when o % 41 = 0 then 'SIM' end as `Jurídico Passivo`",
        "case when o % 20 = 1 then 'Sim' else 'Não' end as `Cessão`",
        "case when o % 23 = 0 then 'Sim' else 'Não' end as `Contrato Quitado`",
        "case when o % 20 = 0 then 'Sim' else 'Não' end as `Contrato Cedido`",
        "case when o % 5 < 3 then 'APTO' else 'NÃO APTO' end as `Aptidão Casas`",
        "case o % 5 when 0 then 'NÃO APTO' when 1 then ' apto ' else 'APTO' end as `Aptidão Sorteio`",
        "timestamp_ntz '1998-07-31 21:30:00' + make_dt_interval(0, 0, 0, o % 2) as `snapshot_gerado_em`",
    )


def old_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier generation: no names, one ruler, no explicit marks."""
    return snapshot(spark, sf_dir).drop(
        "NomeObra", "NomeEmpresa", "Recuperação", "Valor Recuperado", "Valor Gera Cupom", "Inad Junho",
        "Antecipação", "Aptidão Casas", "Aptidão Sorteio", "Cupons Casas", "Jurídico Ativo", "Cessão", "DiasAtraso",
        "Dt.Venda", "snapshot_gerado_em", "Valor Antecipado", "Valor Juros Inadimplência",
    )


def amount_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts in the spellings exports use, one per order."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as linha",
        """case o_orderkey % 10
             when 0 then concat('R$ ', translate(format_number(cast(o_totalprice as decimal(18,2)), 2), ',.', '.,'))
             when 1 then cast(cast(o_totalprice as decimal(18,2)) as string)
             when 2 then concat('1.', lpad(cast(o_orderkey % 1000 as string), 3, '0'))
             when 3 then concat('(', translate(format_number(cast(o_totalprice as decimal(18,2)), 2), ',.', '.,'), ')')
             when 4 then '-'
             when 5 then 'abc'
             when 6 then concat('-R$ ', o_orderkey % 1000, ',50')
             when 7 then concat('R$ ', o_orderkey % 1000, ',25 ')
             when 8 then ''
           end as texto""",
    )


# Run logs -------------------------------------------------------------------


def close_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven daily executions of a close: each sees the receipts posted by its day."""
    paid = receipts(spark, sf_dir).where("pago_em >= date '1998-07-01' and pago_em < date '1998-08-01'")
    runs = "explode(sequence(cast(greatest(datediff(cadastrado_em, date '1998-08-01'), 0) as int), 6)) as dia"
    seen = paid.selectExpr("principal", runs)
    return seen.selectExpr("principal", "date_add(date '1998-08-01', dia) as dt_execucao").groupBy("dt_execucao").agg(
        F.lit("1998_07").alias("anomes"),
        F.count(F.lit(1)).alias("recebimentos"),
        F.sum("principal").alias("valor"),
    )
