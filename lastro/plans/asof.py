"""The owner of every receipt on its day."""

from __future__ import annotations

from pyspark.sql import functions as F

from lastro.operators import asof as A
from lastro.operators import base as B
from lastro.plans.contracts import CESSAO, VENDA
from lastro.plans.oracle_tables import KEY, PREFIXES, with_tables
from lastro.plans.registry import Section
from lastro.schemas import SALE_KEY
from lastro.sources import standin as S

section = Section()

# SQL: chains by recursion, then an as-of join.
DONOS = f"""
passos(empresa, obra, num_venda, desde, vigente, passo) as (
  select distinct {KEY}, date '0001-01-01', num_venda, 0 from venda
  union all
  select p.empresa, p.obra, p.num_venda, greatest(p.desde, c.data_cedida), c.venda_nova, p.passo + 1
  from passos p join cessao_ultima c on c.empresa = p.empresa and c.obra = p.obra and c.num_venda = p.vigente
  where c.venda_nova is not null and p.passo < 50),
donos as (
  select {KEY}, desde, arg_max(vigente, passo) as venda_vigente from passos group by {KEY}, desde),
clientes as (select empresa, obra, num_venda as venda_vigente, min(cliente) as cliente_vigente from venda group by all)"""


@section.query(
    "receipt_owner_asof",
    with_tables(
        f"""select r.empresa, r.obra, r.num_venda, r.num_parcela, r.tipo, r.pago_em, cast(r.principal as double) as principal,
        d.venda_vigente, c.cliente_vigente
        from (select * from recebidas where {PREFIXES}) r asof left join donos d
          on r.empresa = d.empresa and r.obra = d.obra and r.num_venda = d.num_venda and r.pago_em >= d.desde
        left join clientes c on c.empresa = d.empresa and c.obra = d.obra and c.venda_vigente = d.venda_vigente""",
        VENDA,
        CESSAO,
        DONOS,
    ).replace("with ", "with recursive ", 1),
)
def receipt_owner_asof(spark, sf):
    erp = S.erp(spark, sf)
    found = A.receipt_owners(erp.receipts, B._sales(erp, S.PORTFOLIO), erp.history, S.PORTFOLIO)
    return found.select(*SALE_KEY, "num_parcela", "tipo", "pago_em", F.col("principal"), "venda_vigente", "cliente_vigente")
