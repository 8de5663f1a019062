"""The wide contract row: live, and rebuilt for a closed month.

``*_core`` joins only what shares the sale key, on one partitioning, and applies
the membership rules; ``enrich`` adds the dimensions afterwards, to members only.
Reports that need rulings and amounts read the core alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro.operators import contracts as C
from lastro.operators import eligibility as R
from lastro.operators import ledger as L
from lastro.params import INSTALMENT_TYPES, STATUS_CANCELLED, CloseWindow, LiveWindow, Portfolio
from lastro.schemas import SALE_ORDER
from lastro.sources.tables import Erp

CORE_COLUMNS = [
    "empresa", "obra", "num_venda", "cliente", "data_venda", "valor_venda", "status",
    "statuvenda", "inad_junho", "recuperacao", "valor_recuperado", "antecipacao", "valor_antecipado",
    "valor_inadimplencia", "valor_juros_inadimplencia", "valor_multa_inadimplencia",
    "valor_recebido", "valor_gera_cupom", "valor_cupom_mes_atual", "data_ultimo_recebimento",
    "cupons_milhao", "cupons_casas", "pagou_parcela_mes_anterior", "dias_atraso",
    "status_sorteio", "motivo", "juridico_ativo", "juridico_passivo",
    "cessao", "venda_origem_cessao", "data_cessao", "contrato_quitado",
    "contrato_cedido", "venda_nova_cessao", "data_cedida", "aptidao_casas", "aptidao_sorteio",
]
COUNT_COLUMNS = [f"qtd_{kind.lower()}" for kind in INSTALMENT_TYPES]

# Published name of each enriched column, in published order.
PUBLISHED = {
    "cidade": "cidade", "regional": "regional", "empresa": "codempresa", "obra": "codobra",
    "obra_nome": "nomeobra", "empresa_nome": "nomeempresa", "produto_nome": "produto",
    "num_venda": "venda", "identificador": "identificador", "data_venda": "dt_venda",
    "valor_venda": "vlrvenda", "nome": "nomecliente", "cpf": "cpf_pes", "email": "emailcliente",
    "telefone": "telefoneformatado", "tipo_telefone": "tipotelefone",
    "qtd_p": "qtd_parcelas", "qtd_s": "qtd_sinal", "qtd_sa": "qtd_sinal_arras",
    "qtd_sn": "qtd_sinal_negoci", "qtd_e": "qtd_entrada", "qtd_er": "qtd_ent_reativacao",
    "qtd_am": "qtd_amortizacao", "qtd_fc": "qtd_financ_cef", "qtd_b": "qtd_balao",
    "qtd_r": "qtd_residuo", "qtd_i": "qtd_intermediacao", "qtd_op": "qtd_operacao_xpi",
    "dias_atraso": "diasatraso",
}


def _sales(erp: Erp, portfolio: Portfolio) -> DataFrame:
    return C.all_sales(erp.sales_live, erp.sales_archived, portfolio).drop("data_cadastro").distinct()


def _with_receipts(sales: DataFrame, receipts: DataFrame) -> DataFrame:
    """``recebeu`` is 1 where a receipt of the window counts."""
    return sales.join(receipts, SALE_ORDER, "left").withColumn("teve_recebimento", R.is_true(F.col("recebeu") == 1))


def _ledger_amounts() -> dict[str, Column]:
    return {
        "valor_a_receber": R.zero("valor_a_receber"),
        "valor_inadimplencia": R.zero("valor_inadimplente"),
        "valor_juros_inadimplencia": R.zero("valor_juros_inadimplencia"),
        "valor_multa_inadimplencia": R.zero("valor_multa_inadimplencia"),
    }


# Published columns each optional side of the row is needed for.
_VALUED = {"valor_a_receber", "valor_inadimplencia", "valor_juros_inadimplencia", "valor_multa_inadimplencia", *COUNT_COLUMNS}
_OVERDUE = {"statuvenda", "inad_junho", "dias_atraso", "status_sorteio", "motivo", "aptidao_casas", "aptidao_sorteio"}
_NEW_SIDE = {"cessao", "venda_origem_cessao", "data_cessao"}
_MARKED = {*_OVERDUE, "pagou_parcela_mes_anterior"}
_LEGAL = {"juridico_ativo", "juridico_passivo"}
LIVE_COLUMNS = [*CORE_COLUMNS, *COUNT_COLUMNS, "valor_a_receber"]
CLOSE_COLUMNS = [*CORE_COLUMNS, "distrato_apos_fechamento", *COUNT_COLUMNS, "valor_a_receber"]


def _join_parts(members: DataFrame, parts: list[tuple[bool, Callable[[], DataFrame]]]) -> DataFrame:
    for needed, build in parts:
        if needed:
            members = members.join(build(), SALE_ORDER, "left")
    return members


def _rule(df: DataFrame, rulings: dict[str, Column], columns: list[str]) -> DataFrame:
    return df.withColumns({name: col for name, col in rulings.items() if name in columns}).select(*columns)


@dataclass(frozen=True)
class LiveParts:
    """What the live row is made of, per sale or per instalment; the callables are asked only if needed."""

    sales: DataFrame
    receipts: DataFrame
    ceded: DataFrame
    cancelled: DataFrame
    open_rows: DataFrame
    valuation: Callable[[], DataFrame]
    new_side: Callable[[], DataFrame]
    legal: Callable[[], DataFrame]


def live_core(
    erp: Erp, portfolio: Portfolio, window: LiveWindow, columns: list[str] | None = None
) -> DataFrame:
    """Members with amounts and rulings. A side no asked-for column needs is not joined."""
    ceded = C.cession_old_side(erp.history, portfolio)
    month = (window.previous_month_start, window.month_start)
    parts = LiveParts(
        _sales(erp, portfolio),
        L.campaign_receipts(erp.receipts, ceded, portfolio, window.start, window.end, window.month_start),
        ceded,
        C.effective_cancellations(erp.cancellations).select(*SALE_ORDER).distinct(),
        L.open_by_instalment(erp.receivables, portfolio, window.as_of, window.start, month),
        lambda: L.valuation_by_instalment(erp.valuations, portfolio),
        lambda: C.cession_new_side(erp.history, portfolio),
        lambda: C.legal_by_sale(erp.occurrences),
    )
    return live_from_parts(parts, portfolio, window, columns)


def live_from_parts(
    parts: LiveParts, portfolio: Portfolio, window: LiveWindow, columns: list[str] | None = None
) -> DataFrame:
    """The same from ledgers that are added up already."""
    columns = columns or LIVE_COLUMNS
    wanted = set(columns)

    def valued() -> DataFrame:
        return L.receivables_by_sale(parts.open_rows, parts.valuation(), portfolio, window.as_of)

    received = parts.receipts.withColumn("recebeu", F.lit(1))
    candidates = _with_receipts(parts.sales, received).join(parts.ceded, SALE_ORDER, "left")
    members = C.keep_members(candidates, portfolio).join(parts.cancelled, SALE_ORDER, "left_anti")
    joined = _join_parts(
        members,
        [
            (bool(wanted & _VALUED), valued),
            (not wanted & _VALUED and bool(wanted & _MARKED), lambda: L.overdue_by_sale(parts.open_rows, window.as_of)),
            (bool(wanted & _NEW_SIDE), parts.new_side),
            (bool(wanted & _LEGAL), parts.legal),
        ],
    )
    rulings = {**_ledger_amounts(), **R.live_ruling(), **R.ledger_columns(), **R.cession_columns(), **R.legal_columns()}
    return _rule(joined.withColumn("paga_depois", F.lit(None).cast("int")), rulings, columns)


def close_core(
    erp: Erp, portfolio: Portfolio, window: CloseWindow, columns: list[str] | None = None
) -> DataFrame:
    """As ``live_core`` at a closed month: paid-late rescue, late payers, cancellations."""
    columns = columns or CLOSE_COLUMNS
    wanted = set(columns)
    ceded = C.cession_old_side(erp.history, portfolio)
    receipts = L.close_window_receipts(
        erp.receipts, ceded, portfolio, window.start, window.cutoff, window.month_start
    )
    paid = L.paid_before(erp.receipts, portfolio, window.cutoff)
    month = (window.previous_month_start, window.month_start)
    rows = L.open_by_instalment(erp.receivables, portfolio, window.cutoff, window.start, month)
    open_rows = L.drop_paid(rows, paid)

    def valued() -> DataFrame:
        valuation = L.valuation_by_instalment(erp.valuations, portfolio)
        return L.receivables_by_sale(open_rows, valuation, portfolio, window.last_day)

    candidates = (
        _with_receipts(_sales(erp, portfolio), receipts)
        .join(ceded, SALE_ORDER, "left")
        .join(C.cancellation_latest(erp.cancellations), SALE_ORDER, "left")
    )
    gone = R.cancelled_after(window.cutoff)
    cancelled_with_money = (F.col("status") == STATUS_CANCELLED) & gone & F.col("teve_recebimento")
    members = C.keep_members(candidates, portfolio, cancelled_with_money)
    joined = _join_parts(
        C.without_cancelled_before(members, erp.cancellations, window.cutoff),
        [
            (bool(wanted & _VALUED), valued),
            (not wanted & _VALUED and bool(wanted & _MARKED), lambda: L.overdue_by_sale(open_rows, window.last_day)),
            (bool(wanted & _NEW_SIDE), lambda: C.cession_new_side(erp.history, portfolio)),
            (bool(wanted & _LEGAL), lambda: C.legal_by_sale(erp.occurrences)),
        ],
    )
    rulings = {
        **_ledger_amounts(),
        **R.close_ruling(window.cutoff, window.last_day),
        **R.ledger_columns(),
        **R.cession_columns(),
        **R.legal_columns(),
    }
    return _rule(joined, rulings, columns)


def enrich(core: DataFrame, erp: Erp, portfolio: Portfolio) -> DataFrame:
    """Development, item, unit, product, client and phone of each member."""
    dimension = C.development_dimension(erp.developments, erp.companies, erp.groups, portfolio)
    placed = core.join(C.item_per_sale(erp.items_live, erp.items_archived), SALE_ORDER).join(dimension, ["empresa", "obra"])
    housed = C.with_product(C.with_unit(placed, erp.units, portfolio), erp.products)
    known = C.with_contact(housed, erp.people, erp.phones)
    core_columns = [c for c in core.columns if c not in ("cliente", "status")]
    lead = list(PUBLISHED)[: list(PUBLISHED).index("qtd_p")]
    order = lead + [c for c in core_columns if c not in lead]
    renamed = known.select(*(F.col(c).alias(PUBLISHED.get(c, c)) for c in order))
    return renamed.withColumns({"nomecliente": F.upper("nomecliente"), "emailcliente": F.lower("emailcliente")})


def contract_base_live(erp: Erp, portfolio: Portfolio, window: LiveWindow) -> DataFrame:
    return enrich(live_core(erp, portfolio, window), erp, portfolio)


def contract_base_close(erp: Erp, portfolio: Portfolio, window: CloseWindow) -> DataFrame:
    return enrich(close_core(erp, portfolio, window), erp, portfolio)


def base_sort(df: DataFrame) -> DataFrame:
    """Published order. A global sort: apply it to the file being written, once."""
    return df.orderBy("cidade", "regional", "codobra")


def close_full(erp: Erp, portfolio: Portfolio, window: CloseWindow) -> DataFrame:
    """Audit base of a close: every sale of every status, situations exposed."""
    ceded = C.cession_old_side(erp.history, portfolio)
    receipts = L.close_receipts(erp.receipts, ceded, portfolio, window.month_start, window.cutoff)
    latest = C.cession_latest(erp.history, portfolio)
    cancellation = C.category_split(C.cancellation_latest(erp.cancellations), erp.categories)
    joined = (
        C.ranked_sales(erp.sales_live, erp.sales_archived, portfolio)
        .where(~F.col("empresa").isin(*portfolio.excluded_companies))
        .join(receipts, SALE_ORDER, "left")
        .join(L.open_at_cutoff(erp.receivables, erp.receipts, portfolio, window.cutoff), SALE_ORDER, "left")
        .join(L.due_before_paid_after(erp.receipts, portfolio, window.cutoff, "paga_depois"), SALE_ORDER, "left")
        .join(cancellation.withColumn("_distrato", F.lit(True)), SALE_ORDER, "left")
        .join(C.history_flags(erp.history, portfolio), SALE_ORDER, "left")
        .join(latest, SALE_ORDER, "left")
        .join(C.cession_new_side(erp.history, portfolio).select(*SALE_ORDER, "venda_origem"), SALE_ORDER, "left")
    )
    late = R.is_true(F.col("aberta_no_corte") == 1) | R.is_true(F.col("paga_depois") == 1)
    cancelled = F.col("_distrato").isNotNull()
    return C.with_client(joined, erp.people).select(
        F.col("empresa").alias("codempresa"),
        F.col("obra").alias("codobra"),
        F.col("num_venda").alias("venda"),
        F.upper("nome").alias("nomecliente"),
        "cpf",
        R.zero("valor_gera_cupom").alias("valor_gera_cupom_mes"),
        R.zero("valor_recebido").alias("valor_recebido_mes"),
        R.coupons(R.zero("valor_recebido")).alias("cupons_casas_mes"),
        F.col("ultimo_recebimento").alias("ultimo_recebimento_mes"),
        F.when(late, "NAO APTO").otherwise("APTO").alias("status_fechamento"),
        F.when(late, R.reason_overdue_close(window.last_day)).otherwise(R.REASON_CLEAR_CLOSE).alias("motivo"),
        R.flag(R.is_true(F.col("pgto_fim_mes") == 1)).alias("pgto_fim_mes"),
        "fonte_venda",
        R.sale_status_label(F.col("status")).alias("status_venda"),
        R.yes_no(cancelled, "Nao").alias("distrato_aprovado"),
        R.cancel_or_transfer(cancelled, F.col("teve_cessao")).alias("classificacao_distrato"),
        R.cancellation_type_label(F.col("tipo_distrato")).alias("tipo_distrato"),
        F.coalesce("categoria_distrato", F.lit("")).alias("categoria_distrato"),
        F.coalesce("motivo_distrato", F.lit("")).alias("motivo_distrato"),
        F.col("data_cad").alias("data_geracao_distrato"),
        F.col("data_aprov").alias("data_aprovacao_distrato"),
        R.flag(cancelled & R.cancelled_after(window.cutoff)).alias("distrato_apos_fechamento"),
        R.yes_no(R.is_true(F.col("teve_cessao") == 1), "Nao").alias("cessao_hist"),
        R.yes_no(R.is_true(F.col("teve_renegociacao") == 1), "Nao").alias("renegociacao_hist"),
        F.col("data_cedida").alias("data_cessao"),
        R.flag(R.is_true(F.col("data_aprovacao") >= F.lit(window.cutoff))).alias("cessao_apos_fechamento"),
        F.col("venda_nova").alias("venda_nova_cessao"),
        F.col("venda_origem").alias("venda_origem_cessao"),
    )
