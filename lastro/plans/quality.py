"""Data quality, refresh windows, convergence, publication, lookup."""

from __future__ import annotations

from pyspark.sql import functions as F

from lastro.operators import quality as Q
from lastro.params import RefreshSchedule
from lastro.plans.close import CLOSE_PARTS
from lastro.plans.oracle_tables import dbl, with_contract, with_tables
from lastro.plans.reconcile import SIDES, _photo_side, official
from lastro.plans.registry import Section
from lastro.schemas import GRAIN_KEY
from lastro.sources import files
from lastro.sources import standin as S
from lastro.sources.storage import run_folder

section = Section()
_GRAIN = ", ".join(GRAIN_KEY)


@section.query(
    "grain_duplicates",
    with_contract(
        f"""select linhas, duplicadas, cast(duplicadas as double) / linhas as razao from (
        select count(*) as linhas, count(*) - (select count(*) from (select distinct {_GRAIN} from contrato)) as duplicadas
        from contrato)"""
    ),
)
def grain_duplicates(spark, sf):
    return Q.grain_duplicates(S.contract_frame(spark, sf))


def _broken(spark, sf):
    """The contract frame with repeated rows, null amounts and a column missing."""
    frame = S.contract_frame(spark, sf)
    repeated = frame.unionByName(frame.where("cast(num_venda as bigint) % 20 = 0"))
    hole = F.when(F.col("num_venda").cast("long") % 70 != 0, F.col("valor_principal"))
    return repeated.withColumn("valor_principal", hole).drop("valor_juros")


@section.query(
    "validate_contract",
    with_contract(
        f"""select 'base vazia' as checagem, cast(count(*) as double) as valor, 'ok' as nivel from quebrado
        union all select 'colunas ausentes: valor_juros', 1, 'falha'
        union all select 'duplicadas no grao', n - d, case when (n - d) / n > 0.01 then 'aviso' else 'ok' end from (
          select count(*) as n, (select count(*) from (select distinct {_GRAIN} from quebrado)) as d from quebrado)
        union all select 'nulos em valor_total_recebido', count(*) filter (valor_total_recebido is null), 'ok' from quebrado
        union all select 'nulos em valor_principal', count(*) filter (cast(num_venda as bigint) % 70 = 0), 'aviso' from quebrado""",
        "quebrado as (select * from contrato union all select * from contrato where cast(num_venda as bigint) % 20 = 0)",
    ),
)
def validate_contract(spark, sf):
    return Q.validate_contract(_broken(spark, sf))


_STATUS = "replace(status_sorteio, 'NÃO', 'NAO')"


@section.query(
    "close_structural_checks",
    with_tables(
        f"""select '4.1 chaves duplicadas' as checagem, 0.0::double as valor, 'ok' as nivel
        union all select '4.2 status diferente da regua', n, case when n > 0 then 'falha' else 'ok' end from (
          select count(*) filter (status_sorteio <> aptidao_sorteio) as n from fechado)
        union all select '4.3 resgatadas', count(*), 'info' from fechado
          where contrato_quitado = 'Sim' or contrato_cedido = 'Sim'
        union all select '4.4 distrato pos-fechamento apto', n, case when n > 0 then 'falha' else 'ok' end from (
          select count(*) as n from fechado where distrato_apos_fechamento = 1 and {_STATUS} <> 'NAO APTO')
        union all select '4.5 milhao menos casas', n, case when n >= 1 then 'falha' else 'ok' end from (
          select abs(sum(cupons_milhao) - sum(cupons_casas)) as n from fechado)
        union all select '4.6 cupons negativos', n, case when n > 0 then 'falha' else 'ok' end from (
          select count(*) as n from fechado where cupons_milhao < 0 or cupons_casas < 0)""",
        *CLOSE_PARTS,
    ),
)
def close_structural_checks(spark, sf):
    return Q.structural_checks(official(spark, sf), first_month=True)


@section.query(
    "one_line_diagnosis",
    with_tables(
        """select 'DIAGNOSTICO 07_1998: OK | base ' || count(*) || ' | casas '
        || count(*) filter (aptidao_casas = 'APTO' and cupons_casas > 0) || ' eleg/'
        || cast(sum(cupons_casas) filter (aptidao_casas = 'APTO' and cupons_casas > 0) as bigint) || ' cupons | milhao '
        || count(*) filter (aptidao_sorteio = 'APTO' and cupons_milhao > 0) || '/'
        || cast(sum(cupons_milhao) filter (aptidao_sorteio = 'APTO' and cupons_milhao > 0) as bigint) as diagnostico
        from fechado""",
        *CLOSE_PARTS,
    ),
)
def one_line_diagnosis(spark, sf):
    return Q.one_line_diagnosis(official(spark, sf), "07_1998", first_month=True)


_WINDOWS = """
marcado as (
  select *, ts - interval 3 hours - interval 20 minutes as t, date_trunc('day', t) as d,
    case when t >= d + interval 15 hours then d + interval 15 hours when t >= d + interval 8 hours then d + interval 8 hours
      else d - interval 9 hours end as janela,
    case when t >= d + interval 15 hours then d + interval 32 hours when t >= d + interval 8 hours then d + interval 15 hours
      else d + interval 8 hours end + interval 20 minutes as proxima from events)"""


@section.query(
    "refresh_window", f"with {_WINDOWS} select event_id, janela, proxima from marcado"
)
def refresh_window(spark, sf):
    return Q.with_window(S.table(spark, sf, "events"), "ts", RefreshSchedule()).select("event_id", "janela", "proxima")


@section.query(
    "refresh_window_latest",
    f"""with {_WINDOWS} select janela, proxima, count(*) as linhas, max(ts) as ts,
    max_by(event_id, (ts, event_id)) as event_id from marcado group by janela, proxima""",
)
def refresh_window_latest(spark, sf):
    return Q.latest_per_window(S.table(spark, sf, "events"), "ts", RefreshSchedule(), ["event_id"])


_LOG = """
registro as (
  select date '1998-08-01' + cast(d as integer) as dt_execucao, '1998_07' as anomes, count(*) as recebimentos,
    sum(principal) as valor from recebidas, generate_series(0, 6) g(d)
  where pago_em >= date '1998-07-01' and pago_em < date '1998-08-01'
    and greatest(cadastrado_em - date '1998-08-01', 0) <= d group by d)"""


@section.query(
    "close_convergence",
    with_tables(
        f"""select anomes, dt_execucao, recebimentos, {dbl("valor")}, estavel,
        case when estavel then 'fechado' when day(dt_execucao) >= 7 then 'alerta' else 'aberto' end as situacao from (
          select *, coalesce(recebimentos = lag(recebimentos) over w and valor = lag(valor) over w, false) as estavel
          from registro window w as (partition by anomes order by dt_execucao))""",
        _LOG,
    ),
)
def close_convergence(spark, sf):
    return Q.close_convergence(S.close_log(spark, sf), ["recebimentos", "valor"])


@section.query(
    "eligible_publish",
    with_tables(
        """select o.empresa, o.obra, o.num_venda, cast(cupons_milhao_of as bigint) as cupons_milhao,
        cast(cupons_casas_of as bigint) as cupons_casas,
        case when status_foto = 'NAO APTO' then 1 else 0 end as resgatado_baixa_tardia, '1998_07' as anomes
        from oficial o left join foto f on f.empresa = o.empresa and f.obra = o.obra and f.num_venda = o.num_venda
        where aptidao_sorteio_of = 'APTO' and cupons_milhao_of > 0""",
        *SIDES,
    ),
)
def eligible_publish(spark, sf):
    """Written as the month's only version, then read back."""
    keyed = official(spark, sf).withColumnsRenamed({"codempresa": "empresa", "codobra": "obra", "venda": "num_venda"})
    published = Q.eligible_publish(keyed, _photo_side(spark, sf))
    path = run_folder(spark, "elegiveis")
    files.publish_month(published, path, "1998_07")
    return spark.read.parquet(path)


@section.query(
    "overdue_drop_alert",
    f"""with {_WINDOWS}, soma as (
      select janela, sum(cast(value as decimal(18,4))) as valor from marcado group by janela)
    select janela, {dbl("valor")}, {dbl("a", "anterior")}, cast(a - valor as double) / cast(a as double) as queda,
      coalesce(cast(a - valor as double) / cast(a as double) > 0.2::double, false) as alerta
    from (select *, lag(valor) over (order by janela) as a from soma)""",
)
def overdue_drop_alert(spark, sf):
    marked = Q.with_window(S.table(spark, sf, "events"), "ts", RefreshSchedule())
    log = marked.groupBy("janela").agg(F.sum(F.col("value").cast("decimal(18,4)")).alias("valor"))
    return Q.overdue_drop(log, "janela", "valor")


@section.query(
    "calculated_vs_official",
    with_contract(
        """select empresa, obra, num_venda, cpf_titular, cupons_calculados, cupons_oficiais,
        cupons_calculados - cupons_oficiais as diferenca from contrato where cupons_oficiais is not null"""
    ),
)
def calculated_vs_official(spark, sf):
    return Q.calculated_vs_official(S.contract_frame(spark, sf))


@section.query(
    "client_lookup",
    with_contract(
        f"""select cpf_titular, nome_cliente, empresa, obra, num_venda, cidade, status_cadastro, status_elegibilidade,
        cupons_calculados, cupons_oficiais, {dbl("valor_total_recebido")} from contrato where cpf_titular in (
          select cpf_titular from contrato where cpf_titular = '00000000042' or nome_cliente like '%#00000007%'
            or telefone like '%17' or num_venda = '99') or (cpf_titular is null and
          (nome_cliente like '%#00000007%' or telefone like '%17' or num_venda = '99'))"""
    ),
)
def client_lookup(spark, sf):
    frame = S.contract_frame(spark, sf)
    return Q.client_lookup(frame, tax_id="000.000.000-42", name="#00000007", phone="17", sale="99")
