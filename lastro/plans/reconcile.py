"""Reconciliation of a photo, the re-executed close and the live base."""

from __future__ import annotations

import re
from pyspark.sql import functions as F

from lastro.operators import base as B
from lastro.operators import contracts as C
from lastro.operators import reconcile as K
from lastro.plans.close import AUDIT_PARTS, CLOSE_PARTS
from lastro.plans.ledger import CONTAS, MES_ANTERIOR, TOTAIS
from lastro.plans.oracle_tables import with_tables
from lastro.plans.published import published
from lastro.plans.registry import Section
from lastro.plans.rulings import NUCLEO
from lastro.sources import standin as S

section = Section()

OFFICIAL_COLUMNS = [
    "empresa", "obra", "num_venda", "cliente", "data_venda", "status_sorteio", "motivo", "cupons_casas",
    "cupons_milhao", "valor_recebido", "data_ultimo_recebimento", "aptidao_casas", "aptidao_sorteio", "cessao",
    "contrato_quitado", "contrato_cedido", "data_cessao", "data_cedida",
]
_PUBLISHED = {"empresa": "codempresa", "obra": "codobra", "num_venda": "venda", "data_venda": "dt_venda"}


def _published(core, people):
    named = C.with_client(core, people).drop("cliente", "email")
    return named.withColumnsRenamed({**_PUBLISHED, "nome": "nomecliente", "cpf": "cpf_pes"})


def _closed(spark, sf):
    erp = S.erp(spark, sf)
    core = B.close_core(erp, S.PORTFOLIO, S.CLOSE, [*OFFICIAL_COLUMNS, "distrato_apos_fechamento"])
    return _published(core, erp.people)


def official(spark, sf):
    """The official month: the re-executed close as it was published."""
    return published(spark, sf, "oficial", lambda: _closed(spark, sf))


def known_at(spark, sf, window, columns):
    """The live base as it looked on a day: receipts paid and posted by then."""
    erp = S.erp(spark, sf)
    day = F.lit(window.as_of)
    seen = erp.receipts.where((F.col("pago_em") <= day) & (F.col("cadastrado_em") <= day))
    return B.live_core(erp.replace(receipts=seen), S.PORTFOLIO, window, columns)


_MINIMAL = ["empresa", "obra", "num_venda", "status_sorteio", "cupons_casas", "cupons_milhao", "valor_recebido"]


def photo(spark, sf):
    """The archived photo of a day."""
    return published(spark, sf, "foto", lambda: known_at(spark, sf, S.PHOTO, _MINIMAL).withColumnsRenamed(_PUBLISHED))


def live(spark, sf):
    """The published live base."""
    return published(spark, sf, "viva", lambda: known_at(spark, sf, S.LIVE, _MINIMAL).withColumnsRenamed(_PUBLISHED))


def audit(spark, sf):
    """The published audit base of the close."""
    return published(spark, sf, "auditoria", lambda: B.close_full(S.erp(spark, sf), S.PORTFOLIO, S.CLOSE))


def _official_side(spark, sf):
    return K.normalize_side(official(spark, sf), "of")


def _photo_side(spark, sf):
    return K.normalize_side(photo(spark, sf), "foto", minimal=True)


def _live_side(spark, sf):
    return K.normalize_side(live(spark, sf), "viva", minimal=True)


def _known_sql(tag: str, as_of: str, month: str, following: str) -> str:
    """The live base's SQL as of another day, over the receipts known then."""
    text = ",".join((CONTAS, TOTAIS, MES_ANTERIOR, NUCLEO))
    text = text.replace("from recebidas r", f"from (select * from recebidas where pago_em <= {as_of} and cadastrado_em <= {as_of}) r")
    text = text.replace("date '1998-08-11'", as_of)
    text = text.replace("case when pago_em >= date '1998-08-01'", f"case when pago_em >= {following}")
    text = text.replace(
        "vencimento >= date '1998-07-01' and vencimento < date '1998-08-01'", f"vencimento >= {month} and vencimento < {following}"
    )
    return re.sub(r"\b(contas_calc|consolidado|totais_linhas|totais|mes_anterior|nucleo|vivo)\b", rf"\1_{tag}", text)


_SIDE = """empresa, obra, num_venda, {status} as status_{tag}, cast(cupons_casas as double) as cupons_casas_{tag},
  cast(cupons_milhao as double) as cupons_milhao_{tag}, cast(valor_recebido as double) as valor_recebido_{tag}"""


def _side(tag: str, more: str = "") -> str:
    status = "replace(status_sorteio, 'NÃO', 'NAO')"
    return "select " + _SIDE.format(tag=tag, status=status) + more


SIDES = (
    *CLOSE_PARTS,
    _known_sql("foto", "date '1998-07-25'", "date '1998-06-01'", "date '1998-07-01'"),
    _known_sql("viva", "date '1998-08-11'", "date '1998-07-01'", "date '1998-08-01'"),
    f"foto as ({_side('foto')} from vivo_foto)",
    f"viva as ({_side('viva')} from vivo_viva)",
    f"""oficial as ({
        _side(
            "of",
            ''', nome as nome_of, cpf as cpf_of, data_venda as data_venda_of, aptidao_casas as aptidao_casas_of,
  aptidao_sorteio as aptidao_sorteio_of, cessao as cessao_of, contrato_quitado as contrato_quitado_of,
  contrato_cedido as contrato_cedido_of, data_cessao as data_cessao_of, data_cedida as data_cedida_of,
  distrato_apos_fechamento as distrato_apos_fechamento_of''',
        )
    } from fechado left join pessoas using (cliente))""",
    """cruzado as (
  select coalesce(f.empresa, o.empresa) as empresa, coalesce(f.obra, o.obra) as obra,
    coalesce(f.num_venda, o.num_venda) as num_venda, f.* exclude (empresa, obra, num_venda),
    o.* exclude (empresa, obra, num_venda),
    case when o.num_venda is null then 'left_only' when f.num_venda is null then 'right_only' else 'both' end as presenca
  from foto f full join oficial o on f.empresa = o.empresa and f.obra = o.obra and f.num_venda = o.num_venda)""",
)
_ROW = "empresa, obra, num_venda"


def _joined(spark, sf):
    return K.compare(_photo_side(spark, sf), _official_side(spark, sf))


@section.query("normalize_side", with_tables("select * from oficial", *SIDES))
def normalize_side(spark, sf):
    return _official_side(spark, sf)


@section.query(
    "duplicate_key_count",
    with_tables(f"select count(*) as linhas, count(*) - count(distinct ({_ROW})) as duplicadas from foto", *SIDES),
)
def duplicate_key_count(spark, sf):
    return K.duplicate_keys(_photo_side(spark, sf))


@section.query(
    "outer_join_indicator", with_tables(f"select {_ROW}, status_foto, status_of, presenca from cruzado", *SIDES)
)
def outer_join_indicator(spark, sf):
    return _joined(spark, sf).select("empresa", "obra", "num_venda", "status_foto", "status_of", "presenca")


@section.query(
    "aptitude_transitions",
    with_tables(
        f"""select {_ROW}, case when status_of = 'APTO' then 'recuperou' else 'perdeu' end as transicao from cruzado
        where (status_foto = 'NAO APTO' and status_of = 'APTO') or (status_foto = 'APTO' and status_of = 'NAO APTO')""",
        *SIDES,
    ),
)
def aptitude_transitions(spark, sf):
    moved = K.aptitude_transitions(_joined(spark, sf), "foto", "of")
    return moved.select("empresa", "obra", "num_venda", "transicao")


@section.query(
    "coupon_changes",
    with_tables(
        f"""select {_ROW}, cupons_casas_foto, cupons_casas_of,
        case when cupons_casas_of > cupons_casas_foto then 'ganhou' else 'perdeu' end as mudanca
        from cruzado where presenca = 'both' and cupons_casas_of <> cupons_casas_foto""",
        *SIDES,
    ),
)
def coupon_changes(spark, sf):
    moved = K.coupon_changes(_joined(spark, sf), "foto", "of")
    return moved.select("empresa", "obra", "num_venda", "cupons_casas_foto", "cupons_casas_of", "mudanca")


_REASON = """coalesce(nullif(concat_ws(' + ',
  case when distrato_apos_fechamento_of = 1 then 'DISTRATO APOS FECHAMENTO (NAO APTO)' end,
  case when contrato_cedido_of = 'Sim' then 'CEDENTE RESGATADO (cessao)' end,
  case when cessao_of = 'Sim' then 'VENDA NOVA DE CESSAO' end,
  case when contrato_quitado_of = 'Sim' then 'QUITADA RESGATADA' end), ''), 'BAIXA TARDIA / OUTROS')"""


@section.query(
    "entries_exits",
    with_tables(
        f"""select {_ROW}, presenca, case when presenca = 'right_only' then {_REASON} end as motivo_entrada
        from cruzado where presenca <> 'both'""",
        *SIDES,
    ),
)
def entries_exits(spark, sf):
    moved = K.entries_exits(_joined(spark, sf), "of")
    return moved.select("empresa", "obra", "num_venda", "presenca", "motivo_entrada")


@section.query(
    "entry_reason",
    with_tables(
        f"""select {_REASON} as motivo_entrada, count(*) as qtd from cruzado where presenca = 'right_only' group by 1""", *SIDES
    ),
)
def entry_reason(spark, sf):
    entered = K.entries_exits(_joined(spark, sf), "of").where("presenca = 'right_only'")
    return entered.groupBy("motivo_entrada").agg(F.count(F.lit(1)).alias("qtd"))


@section.query(
    "retroactive_payments",
    with_tables(
        f"""select {_ROW}, round(valor_recebido_of - valor_recebido_foto, 4) as valor_retroativo,
        cupons_milhao_of - cupons_milhao_foto as cupons_ganhos from cruzado
        where valor_recebido_of > valor_recebido_foto + 0.01::double""",
        *SIDES,
    ),
)
def retroactive_payments(spark, sf):
    grown = K.retroactive_payments(_joined(spark, sf), "foto", "of")
    return grown.select("empresa", "obra", "num_venda", "valor_retroativo", "cupons_ganhos")


@section.query(
    "key_set_diff",
    with_tables(
        f"""select count(*) filter (o.num_venda is not null and v.num_venda is not null) as nas_duas,
        count(*) filter (v.num_venda is null) as so_oficial, count(*) filter (o.num_venda is null) as so_viva,
        count(*) filter (v.num_venda is null and distrato_apos_fechamento_of = 1) as so_oficial_distrato,
        count(*) filter (v.num_venda is null and contrato_cedido_of = 'Sim') as so_oficial_cedida,
        count(*) filter (v.num_venda is null and contrato_quitado_of = 'Sim') as so_oficial_quitada
        from oficial o full join viva v on o.empresa = v.empresa and o.obra = v.obra and o.num_venda = v.num_venda""",
        *SIDES,
    ),
)
def key_set_diff(spark, sf):
    return K.key_set_diff(_official_side(spark, sf), _live_side(spark, sf))


_AUDITED = (
    *SIDES,
    # the audit parts repeat some of the close's; only the new ones are added
    *(part for part in AUDIT_PARTS if part not in CLOSE_PARTS),
    """fotografada as (
  select f.*, a.* exclude (codempresa, codobra, venda), a.venda is null as sem_retorno,
    case when status_foto = 'NAO APTO' and status_fechamento = 'APTO' then 1 else 0 end as resgatado_baixa_tardia,
    case when status_foto = 'APTO' and status_fechamento = 'NAO APTO' then 1 else 0 end as perdeu_aptidao,
    case when a.venda is null then 'SEM RETORNO NA APURACAO - INVESTIGAR'
      when distrato_aprovado = 'Sim' and distrato_apos_fechamento = 1
        then 'DISTRATADA APOS FECHAMENTO - DECISAO PENDENTE'
      when distrato_aprovado = 'Sim' then 'DISTRATADA' when status_venda = 'QUITADA' then 'QUITADA - ' || status_fechamento
      else status_fechamento end as situacao
  from foto f left join auditoria a on a.codempresa = f.empresa and a.codobra = f.obra and a.venda = f.num_venda)""",
)


def _situations(spark, sf):
    joined = K.left_base_join(_photo_side(spark, sf), audit(spark, sf))
    return K.contract_situation(K.rescue_loss_flags(joined, "foto"))


def _situation_query(name: str, columns: list[str]) -> None:
    wanted = ["empresa", "obra", "num_venda", *columns]
    section.query(name, with_tables(f"select {', '.join(wanted)} from fotografada", *_AUDITED))(
        lambda spark, sf: _situations(spark, sf).select(*wanted)
    )


_situation_query("left_base_join", ["status_foto", "status_fechamento", "status_venda", "sem_retorno"])
_situation_query("rescue_loss_flags", ["resgatado_baixa_tardia", "perdeu_aptidao"])
_situation_query("contract_situation", ["situacao"])


@section.query(
    "situation_report",
    with_tables(
        """select 'situacao' as secao, coalesce(situacao, '') as chave, count(*) as qtd from fotografada group by 2
        union all select 'resgatado por status', coalesce(status_venda, ''), count(*) from fotografada
          where resgatado_baixa_tardia = 1 group by 2
        union all select 'teste', 'TESTE', n from (select count(*) as n from fotografada where categoria_distrato ilike '%teste%')
          where n > 0
        union all select * from (select 'categoria', categoria_distrato, count(*) as n from fotografada
          where distrato_aprovado = 'Sim' group by 2 order by n desc, 2 limit 10)
        union all select 'cessao_hist', 'Sim', n from (select count(*) as n from fotografada where cessao_hist = 'Sim') where n > 0
        union all select 'renegociacao_hist', 'Sim', n from (
          select count(*) as n from fotografada where renegociacao_hist = 'Sim') where n > 0""",
        *_AUDITED,
    ),
)
def situation_report(spark, sf):
    return K.situation_report(_situations(spark, sf))


@section.query(
    "reconciliation_summary",
    with_tables(
        """select count(*) filter (presenca = 'both') as nos_dois, count(*) filter (presenca = 'left_only') as sairam,
        count(*) filter (presenca = 'right_only') as entraram,
        count(*) filter (status_foto = 'NAO APTO' and status_of = 'APTO') as recuperaram,
        count(*) filter (status_foto = 'APTO' and status_of = 'NAO APTO') as perderam,
        count(*) filter (cupons_casas_of > cupons_casas_foto) as ganharam_cupons,
        count(*) filter (cupons_casas_of < cupons_casas_foto) as perderam_cupons,
        (select count(*) from foto) as contratos_foto, (select sum(cupons_casas_foto) from foto) as cupons_foto,
        (select count(*) from foto where status_foto = 'APTO') as aptos_foto,
        (select count(*) from oficial) as contratos_of, (select sum(cupons_casas_of) from oficial) as cupons_of,
        (select count(*) from oficial where status_of = 'APTO') as aptos_of from cruzado""",
        *SIDES,
    ),
)
def reconciliation_summary(spark, sf):
    return K.summary(_photo_side(spark, sf), _official_side(spark, sf), "foto", "of")
