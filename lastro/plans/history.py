"""Photos read back from their archive, and receipts still to be posted."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import functions as F

from lastro.operators import runoff as U
from lastro.plans.oracle_tables import KEY, PREFIXES, with_tables
from lastro.plans.registry import Section
from lastro.schemas import SALE_KEY
from lastro.sources import standin as S
from lastro.sources.photos import PhotoArchive
from lastro.sources.storage import run_folder

section = Section()
DAYS = [date(1998, 7, 25), date(1998, 7, 26), date(1998, 7, 29), date(1998, 8, 11)]


def photo_of(spark, sf, number: int):
    """The live sales as a photo of the given number: values change, sales come and go, some repeat."""
    sales = S.sales_live(spark, sf).select(*SALE_KEY, "cliente", "valor_total")
    sale = F.col("num_venda")
    rows = sales.where(~((sale % 13 == 5) & F.lit(number < 2)) & ~((sale % 17 == 3) & F.lit(number == 2)))
    value = F.when(sale % 29 < number, F.col("valor_total") + number).when(sale % 31 != 0, F.col("valor_total"))
    rows = rows.withColumn("valor_total", value.cast("decimal(18,2)"))
    return rows.unionByName(rows.where((sale % 37 == 0) & F.lit(number % 2 == 1)))


_FOTOS = " union all ".join(
    f"""select {KEY}, cliente, cast(v as double) as valor_total, date '{day}' as dia from (
      select {KEY}, cliente, num_venda % 37 = 0 and {number % 2} = 1 as dobro,
        case when num_venda % 29 < {number} then valor_total + {number} when num_venda % 31 <> 0 then valor_total end as v
      from vendas where not (num_venda % 13 = 5 and {number} < 2) and not (num_venda % 17 = 3 and {number} = 2)),
      range(case when dobro then 2 else 1 end)"""
    for number, day in enumerate(DAYS)
)


@section.query("photos_read_back", with_tables(_FOTOS))
def photos_read_back(spark, sf):
    archive = PhotoArchive(spark, run_folder(spark, "fotos"), SALE_KEY, buckets=8)
    for number, day in enumerate(DAYS):
        archive.add(photo_of(spark, sf, number), day)
    return reduce(lambda a, b: a.unionByName(b), [archive.read(day).withColumn("dia", F.lit(day)) for day in DAYS])


FIRST, MOST = date(1998, 6, 1), 6
_TRIANGULO = f"""
triangulo as (
  select pago_em as dia, least(greatest(cadastrado_em - pago_em, 0), {MOST}) as atraso, sum(base) as valor
  from recebidas where {PREFIXES} and tipo <> '1' and pago_em >= date '{FIRST}' and pago_em <= date '{S.LIVE.as_of}'
    and cadastrado_em <= date '{S.LIVE.as_of}' group by all),
celulas as (
  select dia, cast(a as integer) as atraso from (select distinct dia from triangulo), range({MOST + 1}) t(a)
  where a <= date '{S.LIVE.as_of}' - dia),
somas as (
  select c.dia, c.atraso, coalesce(sum(t.valor), 0) as acumulado
  from celulas c left join triangulo t on t.dia = c.dia and t.atraso <= c.atraso group by all),
fatores as (
  select a as atraso, coalesce(case when sum(b.acumulado) > 0 then cast(sum(s.acumulado) as double) / cast(sum(b.acumulado) as double) end, 1.0) as fator
  from range(1, {MOST + 1}) t(a) left join somas s on s.atraso = a left join somas b on b.dia = s.dia and b.atraso = a - 1 group by a),
dias as (
  select dia, date '{S.LIVE.as_of}' - dia as idade, cast(arg_max(acumulado, atraso) as double) as observado from somas group by dia),
esperados as (
  select d.*, coalesce((select list_reduce(list(fator order by atraso desc), lambda x, y: x * y) from fatores where atraso > d.idade), 1.0) as fator
  from dias d)"""


@section.query(
    "receipts_still_to_come",
    with_tables(
        """select e.dia, e.idade, e.observado, e.fator, e.observado * e.fator as esperado,
        e.observado * e.fator - e.observado as a_entrar,
        coalesce(e.observado * e.fator * 2 < (coalesce(a.observado * a.fator, 0) + coalesce(b.observado * b.fator, 0)
          + coalesce(c.observado * c.fator, 0) + coalesce(d.observado * d.fator, 0))
          / nullif((a.dia is not null)::int + (b.dia is not null)::int + (c.dia is not null)::int + (d.dia is not null)::int, 0), false)
          as dia_curto
        from esperados e left join esperados a on a.dia = e.dia - 7 left join esperados b on b.dia = e.dia - 14
        left join esperados c on c.dia = e.dia - 21 left join esperados d on d.dia = e.dia - 28""",
        _TRIANGULO,
    ),
)
def receipts_still_to_come(spark, sf):
    return U.still_to_come(S.receipts(spark, sf), S.PORTFOLIO, FIRST, S.LIVE.as_of, MOST)
