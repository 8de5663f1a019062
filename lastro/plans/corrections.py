"""The coupon rule, and corrections of published coupons."""

from __future__ import annotations

from pyspark.sql import functions as F

from lastro.operators import base as B
from lastro.operators import coupons as H
from lastro.operators import kpis as K
from lastro.operators import silver as G
from lastro.params import CouponRule
from lastro.plans.close import AUDIT_PARTS
from lastro.plans.oracle_tables import CONTRATO, KEY, big, dbl, with_contract, with_tables
from lastro.plans.registry import Section
from lastro.plans.silver import BRONZE
from lastro.sources import standin as S

section = Section()
ROW = ["empresa", "obra", "num_venda", "nome_cliente"]


@section.query(
    "contract_id", with_contract("select nome_cliente, empresa || '|' || obra || '|' || num_venda as contrato from contrato")
)
def contract_id(spark, sf):
    return S.contract_frame(spark, sf).select("nome_cliente", K.contract_id().alias("contrato"))


_AMOUNT = "valor_principal + valor_multa + valor_juros + coalesce(valor_custas, 0)"


@section.query(
    "eligible_amount", with_contract(f"select {', '.join(ROW)}, {dbl(_AMOUNT, 'valor_elegivel')} from contrato")
)
def eligible_amount(spark, sf):
    return H.eligible_amount(S.contract_frame(spark, sf), CouponRule()).select(*ROW, "valor_elegivel")


def _with_amount(spark, sf):
    return H.eligible_amount(S.contract_frame(spark, sf).drop("cupons_calculados"), CouponRule())


@section.query(
    "coupons",
    with_contract(
        f"select {', '.join(ROW)}, {big(f'floor(({_AMOUNT}) / 100)', 'cupons_calculados')}, 'v1-2026-06' as regra_versao from contrato"
    ),
)
def coupons(spark, sf):
    return H.add_coupons(_with_amount(spark, sf), CouponRule()).select(*ROW, "cupons_calculados", "regra_versao")


@section.query(
    "coupons_rounded",
    with_contract(
        f"select {', '.join(ROW)}, {big('round_even(cast(valor_principal as double) / 100, 0)', 'cupons_calculados')} from contrato"
    ),
)
def coupons_rounded(spark, sf):
    rule = CouponRule(fine=False, interest=False, fees=False, whole_blocks_only=False)
    frame = S.contract_frame(spark, sf).drop("cupons_calculados", "valor_elegivel")
    return H.add_coupons(frame, rule).select(*ROW, "cupons_calculados")


@section.query(
    "prepare_passthrough",
    with_contract(f"select {', '.join(ROW)}, cupons_calculados, {dbl('valor_total_recebido', 'valor_elegivel')} from contrato"),
)
def prepare_passthrough(spark, sf):
    frame = S.contract_frame(spark, sf).drop("valor_elegivel")
    return H.prepare(frame, CouponRule()).select(*ROW, "cupons_calculados", "valor_elegivel")


def _snapshot(spark, sf):
    return G.normalize_columns(S.snapshot(spark, sf))


_RECOMPUTED = """
recalculo as (
  select empresa as codempresa, obra as codobra, o as venda,
    cast(case when o % 43 in (0, 1) or v <= 0 then 0 else floor(v / 100) end as double) as cupons,
    cast(floor(p / 100) as double) as casas_antes, case when o % 59 <> 0 then cast(floor(p / 100) as double) end as milhao_antes
  from bronze)"""


@section.query(
    "recompute_coupons_snapshot",
    f"with {BRONZE}, {_RECOMPUTED} select codempresa, codobra, venda, cupons as cupons_casas, cupons as cupons_milhao from recalculo",
)
def recompute_coupons_snapshot(spark, sf):
    return H.recompute_snapshot(_snapshot(spark, sf)).select(*H.SNAPSHOT_KEY, "cupons_casas", "cupons_milhao")


@section.query(
    "before_after_check",
    f"""with {BRONZE}, {_RECOMPUTED}
    select sum(casas_antes) as casas_antes, sum(milhao_antes) as milhao_antes, sum(cupons) as casas_depois,
      sum(cupons) as milhao_depois, min(cupons) as min_cupons, count(*) filter (casas_antes <> cupons) as contratos_alterados
    from recalculo""",
)
def before_after_check(spark, sf):
    before = _snapshot(spark, sf)
    return H.before_after_check(before, H.recompute_snapshot(before))


@section.query(
    "before_after_top",
    f"""with {BRONZE}, {_RECOMPUTED}
    select codempresa, codobra, venda, casas_antes as cupons_casas_antes, cupons as cupons_casas_depois,
      cupons - casas_antes as delta from recalculo where casas_antes <> cupons
    order by delta desc, codempresa, codobra, venda limit 10""",
)
def before_after_top(spark, sf):
    before = _snapshot(spark, sf)
    return H.top_deltas(before, H.recompute_snapshot(before))


@section.query(
    "update_coupons_from_close",
    with_tables(
        f"""select b.empresa as codempresa, b.obra as codobra, o as venda,
        case when a.venda is not null then cupons_casas_mes else cast(floor(p / 100) as bigint) end as cupons_casas,
        case when a.venda is not null then cupons_casas_mes when o % 59 <> 0 then cast(floor(p / 100) as bigint) end
          as cupons_milhao, a.venda is not null as atualizado
        from bronze b left join auditoria a on a.codempresa = b.empresa and a.codobra = b.obra and a.venda = b.o""",
        *AUDIT_PARTS,
        BRONZE,
    ),
)
def update_coupons_from_close(spark, sf):
    close = B.close_full(S.erp(spark, sf), S.PORTFOLIO, S.CLOSE)
    updated = H.update_from_close(_snapshot(spark, sf), close)
    return updated.select(*H.SNAPSHOT_KEY, "cupons_casas", "cupons_milhao", "atualizado")


@section.query(
    "scale_fix_1e6",
    f"with {CONTRATO} select {KEY}, nome_cliente, {dbl('valor_total_recebido')} from contrato",
)
def scale_fix_1e6(spark, sf):
    """A frame whose amounts lost their decimal point comes back in scale."""
    swallowed = F.col("valor_total_recebido") * 1_000_000
    broken = S.contract_frame(spark, sf).withColumn("valor_total_recebido", swallowed)
    return H.scale_fix(broken, "valor_total_recebido", "cupons_calculados").select(*ROW, "valor_total_recebido")
