"""Classes, diagnoses, draw lists, identifier clean-up and masks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lastro.functions import dates as D
from lastro.functions import privacy
from lastro.functions import text as X
from lastro.operators import classify as L
from lastro.plans.close import CLOSE_PARTS
from lastro.plans.oracle_tables import CONTRATO, big, dbl, with_tables
from lastro.plans.reconcile import official
from lastro.plans.registry import Section
from lastro.sources import standin as S

section = Section()
FIRST, FOLLOWING = D.month_bounds("07_1998")
KEY = ["codempresa", "codobra", "venda"]

CLASSES = """
classificada as (
  select empresa as codempresa, obra as codobra, num_venda as venda, f.* exclude (empresa, obra, num_venda), nome, cpf,
    case when coalesce(data_cedida >= date '1998-07-01' and data_cedida < date '1998-08-01', false)
        or coalesce(data_cessao >= date '1998-07-01' and data_cessao < date '1998-08-01', false) then 'CESSAO'
      when contrato_quitado = 'Sim' then 'QUITADO' when aptidao_sorteio <> 'APTO' then 'INADIMPLENTE'
      else 'ADIMPLENTE' end as classe4,
    case when distrato_apos_fechamento = 1 then 'DISTRATADO' else classe4 end as classificacao,
    coalesce(' — último recebimento ' || strftime(data_ultimo_recebimento, '%d/%m/%Y'), ' — sem recebimento na janela') as sufixo
  from fechado f left join pessoas using (cliente))"""


def _sql(select: str, tail: str = "") -> str:
    return with_tables(f"select codempresa, codobra, venda, {select} from classificada {tail}", *CLOSE_PARTS, CLASSES)


def _classified(spark, sf):
    return L.classify(official(spark, sf), FIRST, FOLLOWING)


@section.query("classify_contract", _sql("classificacao"))
def classify_contract(spark, sf):
    return _classified(spark, sf).select(*KEY, "classificacao")


@section.query(
    "override_eligibility",
    _sql(
        """case when classificacao = 'DISTRATADO' then 'NÃO APTO' else aptidao_casas end as aptidao_casas,
        case when classificacao = 'DISTRATADO' then 'NÃO APTO' else aptidao_sorteio end as aptidao_sorteio"""
    ),
)
def override_eligibility(spark, sf):
    return L.override_eligibility(_classified(spark, sf)).select(*KEY, "aptidao_casas", "aptidao_sorteio")


@section.query(
    "diagnosis_text",
    _sql(
        """case classificacao when 'DISTRATADO' then 'Distrato após fechamento — marcado NÃO APTO'
          when 'CESSAO' then 'Cessão no mês: ' || concat_ws(' e ',
            case when data_cedida >= date '1998-07-01' and data_cedida < date '1998-08-01'
              then 'contrato cedido em ' || strftime(data_cedida, '%d/%m/%Y') end,
            case when data_cessao >= date '1998-07-01' and data_cessao < date '1998-08-01'
              then 'venda nova por cessão em ' || strftime(data_cessao, '%d/%m/%Y') end)
          when 'QUITADO' then 'Contrato quitado' || sufixo
          when 'INADIMPLENTE' then case when motivo <> 'ADIMPLENTE'
            then upper(left(motivo, 1)) || lower(substr(motivo, 2)) else 'Não apto no sorteio' end || sufixo
          else 'Em dia' || sufixo end as diagnostico"""
    ),
)
def diagnosis_text(spark, sf):
    return L.diagnose(_classified(spark, sf), FIRST, FOLLOWING).select(*KEY, "diagnostico")


@section.query(
    "class_summary",
    with_tables(
        f"""select ordem, c.classificacao, coalesce(contratos, 0) as contratos, {dbl("coalesce(v, 0)", "valor_recebido")},
        {big("coalesce(m, 0)", "cupons_milhao")}, {big("coalesce(k, 0)", "cupons_casas")},
        round_even(100.0::double * coalesce(contratos, 0) / (select count(*) from classificada), 2) as pct
        from (values (1, 'DISTRATADO'), (2, 'CESSAO'), (3, 'QUITADO'), (4, 'INADIMPLENTE'), (5, 'ADIMPLENTE'))
          c(ordem, classificacao)
        left join (select classificacao, count(*) as contratos, sum(cast(valor_recebido as decimal(18,4))) as v,
          sum(cupons_milhao) as m, sum(cupons_casas) as k from classificada group by 1) using (classificacao)""",
        *CLOSE_PARTS,
        CLASSES,
    ),
)
def class_summary(spark, sf):
    return L.class_summary(_classified(spark, sf))


@section.query(
    "list_classification",
    _sql(
        """nome as nomecliente, cpf, aptidao_casas, aptidao_sorteio, valor_recebido, data_venda,
        classe4 as classificacao"""
    ),
)
def list_classification(spark, sf):
    return L.list_classification(official(spark, sf), FIRST, FOLLOWING)


@section.query("draw_list_monthly", _sql("nome as nomecliente, cupons_casas", "where aptidao_casas = 'APTO' and cupons_casas > 0"))
def draw_list_monthly(spark, sf):
    return L.draw_list_monthly(official(spark, sf)).select(*KEY, "nomecliente", "cupons_casas")


@section.query(
    "draw_list_final", _sql("nome as nomecliente, cupons_milhao", "where aptidao_sorteio = 'APTO' and cupons_milhao > 0")
)
def draw_list_final(spark, sf):
    return L.draw_list_final(official(spark, sf)).select(*KEY, "nomecliente", "cupons_milhao")


@section.query(
    "winner_exclusion_monthly",
    _sql(
        "cupons_casas",
        """where aptidao_casas = 'APTO' and cupons_casas > 0 and (codempresa, codobra, venda) not in (
          select (codempresa, codobra, venda) from classificada where aptidao_casas = 'APTO' and cupons_casas >= 1000)""",
    ),
)
def winner_exclusion_monthly(spark, sf):
    """Winners of an earlier draw: here, the sales with a thousand coupons or more."""
    monthly = L.draw_list_monthly(official(spark, sf))
    winners = monthly.where("cupons_casas >= 1000")
    return L.exclude_winners(monthly, winners, KEY).select(*KEY, "cupons_casas")


@section.query(
    "month_window",
    f"""with {CONTRATO} select competencia, inicio, cast(inicio + interval 1 month as date) as fim, contratos from (
      select strftime(data_venda, '%m_%Y') as competencia, cast(date_trunc('month', data_venda) as date) as inicio,
        count(*) as contratos from contrato group by 1, 2)""",
)
def month_window(spark, sf):
    """Bounds of every month named in the frame, with the rows it holds."""
    months = S.contract_frame(spark, sf).groupBy(F.date_format("data_venda", "MM_yyyy").alias("competencia")).agg(
        F.count(F.lit(1)).alias("contratos")
    )
    first, following = D.month_window(F.col("competencia"))
    return months.select("competencia", first.alias("inicio"), following.alias("fim"), "contratos")


@section.query(
    "id_cleanup",
    """select o_orderkey as linha, cast(o_orderkey as varchar) as venda,
    case o_custkey % 3 when 0 then lpad(cast(o_custkey as varchar), 11, '0') when 1 then lpad(cast(o_custkey as varchar), 11, '0')
      else o_custkey || '-X' end as cpf from orders""",
)
def id_cleanup(spark, sf):
    rows = S.table(spark, sf, "orders").selectExpr(
        "o_orderkey as linha",
        "concat(o_orderkey, case when o_orderkey % 2 = 0 then '.0' else ' ' end) as venda",
        "concat(o_custkey, case o_custkey % 3 when 0 then '.0' when 1 then '' else '-X' end) as cpf",
    )
    return rows.select(
        "linha", X.clean_identifier(F.col("venda")).alias("venda"), X.clean_tax_id(F.col("cpf")).alias("cpf")
    )


@section.query(
    "mask_pii",
    f"""with {CONTRATO} select nome_cliente, num_venda,
      case when cpf_titular is null then '' else '***.***.***-' || right(cpf_titular, 2) end as cpf,
      left(telefone, 2) || ' ' || substr(telefone, 3, 1) || '****-**' || right(telefone, 2) as telefone,
      left(email, 1) || '***@mail.com' as email from contrato""",
)
def mask_pii(spark, sf):
    return S.contract_frame(spark, sf).select(
        "nome_cliente",
        "num_venda",
        privacy.mask_tax_id(F.col("cpf_titular")).alias("cpf"),
        privacy.mask_phone(F.col("telefone")).alias("telefone"),
        privacy.mask_email(F.col("email")).alias("email"),
    )


_TEXT_MASKS = (
    ("email", r"\b([A-Za-z0-9])[A-Za-z0-9._%+-]*@([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)", r"\1***@\2"),
    ("cpf", r"\b\d{3}\.\d{3}\.\d{3}-(\d{2})\b", r"***.***.***-\1"),
    ("telefone", r"\+?\(?(\d{2,3})\)?[ .-]?(\d)\d{2,4}[ .-]\d{2}(\d{2})\b", r"\1 \2****-**\3"),
)


def _masked_sql(column: str) -> str:
    out = column
    for _, pattern, replacement in _TEXT_MASKS:
        out = f"regexp_replace({out}, '{pattern}', '{replacement}', 'g')"
    return out


@section.query("mask_pii_text", f"select doc_id, {_masked_sql('text')} as text from documents")
def mask_pii_text(spark, sf):
    return S.table(spark, sf, "documents").select("doc_id", privacy.mask_text(F.col("text")).alias("text"))
