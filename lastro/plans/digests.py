"""The sales that moved between two executions of the live base."""

from __future__ import annotations

from pyspark.sql import functions as F

from lastro.operators import base as B
from lastro.operators import digests as D
from lastro.plans.oracle_tables import with_tables
from lastro.plans.registry import Section
from lastro.plans.rulings import LIVE_PARTS
from lastro.schemas import SALE_KEY
from lastro.sources import standin as S
from lastro.sources.storage import run_folder

section = Section()
_COLUMNS = ["status", "statuvenda", "status_sorteio", "valor_recebido", "cupons_milhao", "dias_atraso", "data_cedida"]


def executions(spark, sf):
    """The base, and the base of a later execution: money, delays and sales of two companies moved."""
    base = B.live_core(S.erp(spark, sf), S.PORTFOLIO, S.LIVE, [*SALE_KEY, *_COLUMNS])
    mine = F.col("empresa").isin(4, 17)
    sale = F.col("num_venda")
    later = base.where(~mine | (sale % 19 != 0)).withColumns(
        {
            "valor_recebido": F.when(mine & (sale % 11 == 0), F.col("valor_recebido") + 1).otherwise(F.col("valor_recebido")),
            "dias_atraso": F.when(mine & (sale % 13 == 0), F.lit(None)).otherwise(F.col("dias_atraso")),
            "num_venda": F.when(mine & (sale % 17 == 0), -sale).otherwise(sale),
        }
    )
    return base, later


EXECUCAO = """
execucao as (
  select empresa, obra, num_venda as antiga, case when num_venda % 17 = 0 then -num_venda else num_venda end as num_venda,
    num_venda % 11 = 0 or (num_venda % 13 = 0 and dias_atraso is not null) as mudou
  from vivo where empresa in (4, 17) and num_venda % 19 <> 0)"""


@section.query(
    "moved_sales",
    with_tables(
        """select empresa, obra, num_venda, 'SAIU' as movimento from vivo v where empresa in (4, 17) and not exists
          (select 1 from execucao d where d.empresa = v.empresa and d.obra = v.obra and d.num_venda = v.num_venda)
        union all select empresa, obra, num_venda, case when num_venda <> antiga then 'ENTROU' else 'MUDOU' end
        from execucao where num_venda <> antiga or mudou""",
        *LIVE_PARTS,
        EXECUCAO,
    ),
)
def moved_sales(spark, sf):
    root = run_folder(spark, "execucoes")
    for name, frame in zip(("antes", "depois"), executions(spark, sf), strict=True):
        D.publish(frame, f"{root}/{name}")
    return D.moved_sales(spark, f"{root}/antes", f"{root}/depois")
