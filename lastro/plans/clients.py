"""Client counts of several boards from one cube, and a search by index."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from lastro.operators import clients as N
from lastro.operators.search import ClientIndex
from lastro.plans.oracle_tables import dbl, with_contract
from lastro.plans.published import published
from lastro.plans.registry import Section
from lastro.sources import standin as S
from lastro.sources.storage import run_folder

section = Section()
CLIENT = "cpf_titular"
DIMENSIONS = ["regional", "cidade", "status_elegibilidade", "mes_referencia"]


def client_cube(spark, sf):
    def build():
        frame = S.contract_frame(spark, sf)
        return N.cube(frame, N.numbered(frame, CLIENT), CLIENT, DIMENSIONS)

    return published(spark, sf, "cubo-clientes", build)


def _board(cells, name, dimensions, where=None):
    key = F.concat_ws(" | ", *(F.coalesce(F.col(part), F.lit("?")) for part in dimensions)) if dimensions else F.lit("")
    return N.clients_by(cells, dimensions, where).select(F.lit(name).alias("painel"), key.alias("chave"), "clientes")


def _sql(name: str, dimensions: list[str], where: str = "true") -> str:
    key = "concat_ws(' | ', " + ", ".join(f"coalesce({part}, '?')" for part in dimensions) + ")" if dimensions else "''"
    grouped = f"group by {', '.join(dimensions)}" if dimensions else ""
    return f"""select '{name}' as painel, {key} as chave, count(distinct {CLIENT}) as clientes from contrato
      where {where} and {CLIENT} is not null {grouped}"""


_BOARDS = [
    ("regional", ["regional"], None),
    ("cidade", ["cidade"], None),
    ("status por regional", ["regional", "status_elegibilidade"], None),
    ("mes", ["mes_referencia"], None),
    ("elegiveis por cidade", ["cidade"], "status_elegibilidade = 'elegivel'"),
    ("total", [], None),
]


@section.query("client_counts", with_contract(" union all ".join(_sql(n, d, w or "true") for n, d, w in _BOARDS)))
def client_counts(spark, sf):
    cells = client_cube(spark, sf)
    return reduce(lambda a, b: a.unionByName(b), [_board(cells, n, d, F.expr(w) if w else None) for n, d, w in _BOARDS])


_FOUND = "nome_cliente like '%#00000007%' or telefone like '%9017' or num_venda = '99'"


@section.query(
    "client_search",
    with_contract(
        f"""select cpf_titular, nome_cliente, empresa, obra, num_venda, cidade, status_cadastro, status_elegibilidade,
        cupons_calculados, cupons_oficiais, {dbl("valor_total_recebido")} from contrato where cpf_titular in (
          select cpf_titular from contrato where cpf_titular = '00000000042' or {_FOUND}) or (cpf_titular is null and ({_FOUND}))"""
    ),
)
def client_search(spark, sf):
    index = ClientIndex(spark, run_folder(spark, "busca"), buckets=16)
    index.build(S.contract_frame(spark, sf))
    return index.search(tax_id="000.000.000-42", name=" #00000007", phone="9017", sale="99")
