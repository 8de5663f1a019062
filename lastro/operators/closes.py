"""Many month closes in one pass over the ledgers.

A close asks of every ledger row whether it holds at the cutoff. Turned around, a row
holds for a range of cutoffs: a receipt counts from the first cutoff after its payment
day; a late one marks its sale at the cutoffs after the due day and up to the payment;
an open instalment is overdue at the cutoffs after its due day and up to the first
payment of its key. So each row becomes the two ends of a range on the sorted cutoffs.
Rows of a sale with the same ends are added up first (map side); the few ranges that remain
are carried through the joins on the sale, and the state at a cutoff is read off them once
the cutoffs part, after everything that joins on the sale has joined. The ledgers are read
as often as for a single close.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lastro.functions.money import base_amount, full_amount, zero_amount
from lastro.operators import base as B
from lastro.operators import contracts as C
from lastro.operators import eligibility as R
from lastro.operators import ledger as L
from lastro.params import INSTALMENT_TYPES, STATUS_CANCELLED, STATUS_LIVE, CloseWindow, Portfolio
from lastro.schemas import INSTALMENT_ORDER, SALE_KEY, SALE_ORDER
from lastro.sources.tables import Erp

#: Cutoffs of one pass. Marks of a sale are bits of a long.
MOST = 62


def _checked(windows: Sequence[CloseWindow]) -> list[CloseWindow]:
    """One campaign, successive months that don't overlap, each closed after the campaign's start."""
    ordered = sorted(windows, key=lambda window: window.cutoff)
    if not 0 < len(ordered) <= MOST:
        raise ValueError(f"one to {MOST} closes at a time")
    if len({window.start for window in ordered}) > 1 or ordered[0].cutoff <= ordered[0].start:
        raise ValueError("closes of one pass share the campaign's start, which lies before the first cutoff")
    for before, after in zip(ordered, ordered[1:], strict=False):
        if after.month_start < before.cutoff:
            raise ValueError(f"the months closed on {before.cutoff} and {after.cutoff} overlap")
    return ordered


def _reached(day: Column, windows: list[CloseWindow]) -> Column:
    """Number of cutoffs up to and including the day: the place of the first one after it."""
    return sum((F.when(day >= F.lit(window.cutoff), 1).otherwise(0) for window in windows), F.lit(0))


def _at(days: list[date], place: Column) -> Column:
    return F.get(F.array(*(F.lit(day) for day in days)), place)


# Receipts -------------------------------------------------------------------

_SUMS = ("valor_recebido", "valor_gera_cupom", "valor_antecipado", "valor_recuperado")
_MONTH = ("valor_cupom_mes", "valor_recebido_mes")
_LATEST = ("recebeu", "antecipou", "recuperou", "ultimo_recebimento")


def receipt_steps(receipts: DataFrame, ceded: DataFrame, portfolio: Portfolio, windows: Sequence[CloseWindow]) -> DataFrame:
    """Per sale ``recebimentos``, steps that hold from the place of a cutoff up to that of another, with what
    ``close_window_receipts`` gives for these, and ``pagou_vencida_antes``. Cutoffs before a sale's first receipt are in none."""
    windows = _checked(windows)
    start, count = windows[0].start, len(windows)
    due, paid = F.col("vencimento"), F.col("pago_em")
    ahead, late = F.last_day(paid) < F.last_day(due), paid > due
    rows = C.in_universe(receipts, portfolio).where(paid >= F.lit(start))
    rows = rows.withColumns({"cheio": full_amount(), "base": base_amount()})
    counted = F.col("tipo") != portfolio.fee_type

    def total(amount: Column) -> Column:
        return F.sum(F.when(counted, amount))

    daily = rows.groupBy(*SALE_ORDER, "pago_em").agg(
        F.max(F.when(counted, 1)).alias("contado"),
        total(F.col("cheio")).alias("valor_recebido"),
        total(F.col("base")).alias("valor_gera_cupom"),
        F.max(F.when(counted, F.when(ahead, 1).otherwise(0))).alias("antecipou"),
        total(F.when(ahead, F.col("cheio")).otherwise(zero_amount())).alias("valor_antecipado"),
        F.max(F.when(counted, F.when(late, 1).otherwise(0))).alias("recuperou"),
        total(F.when(late, F.col("cheio")).otherwise(zero_amount())).alias("valor_recuperado"),
        # Of one payment day the longest range of late marks covers the others.
        F.min("vencimento").alias("venceu"),
        F.max(F.when(due < F.lit(start), 1)).alias("pagou_vencida_antes"),
    )
    cut = daily.join(ceded.select(*SALE_KEY, F.col("data_cedida").alias("_corte")), SALE_ORDER, "left")
    ends = _reached(paid, windows)
    counts = (F.col("contado") == 1) & (F.col("_corte").isNull() | (paid < F.col("_corte"))) & (ends < count)
    in_month = counts & (paid >= _at([window.month_start for window in windows], ends))
    begins = F.when(F.col("venceu").isNull(), ends).otherwise(_reached(F.col("venceu"), windows))
    # What happens to the state of the sale, and at which cutoff: 0 money comes in, 1 a late mark begins, 2 it ends.
    events = [
        (0, F.least(ends, F.lit(count - 1))),
        (1, F.when(begins < ends, begins)),
        (2, F.when(begins < ends, ends)),
    ]
    each = F.explode(F.array(*(F.struct(F.lit(kind).alias("kind"), place.alias("k")) for kind, place in events)))
    moved = cut.withColumn("evento", each).where((F.col("evento.k") >= 0) & (F.col("evento.k") < count))
    money = F.col("evento.kind") == 0

    def told(value: Column, when: Column = counts) -> Column:
        return F.when(money & when, value)

    steps = moved.groupBy(*SALE_ORDER, F.col("evento.k").alias("k")).agg(
        F.max(told(F.lit(1))).alias("recebeu"),
        *(F.sum(told(F.col(name))).alias(name) for name in _SUMS),
        F.sum(told(F.col("valor_gera_cupom"), in_month)).alias("valor_cupom_mes"),
        F.sum(told(F.col("valor_recebido"), in_month)).alias("valor_recebido_mes"),
        F.max(told(F.col("antecipou"))).alias("antecipou"),
        F.max(told(F.col("recuperou"))).alias("recuperou"),
        F.max(told(paid)).alias("ultimo_recebimento"),
        F.sum(F.when(F.col("evento.kind") == 1, 1).when(F.col("evento.kind") == 2, -1).otherwise(0)).alias("tardias"),
        F.max("pagou_vencida_antes").alias("pagou_vencida_antes"),
    )
    so_far = Window.partitionBy(*SALE_ORDER).orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    following = Window.partitionBy(*SALE_ORDER).orderBy("k")
    swept = steps.select(
        *SALE_KEY, "k", "pagou_vencida_antes", *_MONTH,
        *(F.sum(name).over(so_far).alias(name) for name in _SUMS),
        *(F.max(name).over(so_far).alias(name) for name in _LATEST),
        F.when(F.sum("tardias").over(so_far) > 0, 1).alias("paga_depois"),
        F.lead("k", 1, count).over(following).alias("ate"),
    )
    state = F.struct("k", "ate", *_SUMS, *_LATEST, "paga_depois", *_MONTH)
    return swept.groupBy(*SALE_ORDER).agg(
        F.collect_list(state).alias("recebimentos"), F.max("pagou_vencida_antes").alias("pagou_vencida_antes")
    )


def _received(place: Column) -> dict[str, Column]:
    """What the receipts of a sale come to at the cutoff of a place; null before the first."""
    found = F.filter("recebimentos", lambda step: (step["k"] <= place) & (place < step["ate"]))
    step = F.get(found, F.lit(0))
    fresh = step["k"] == place  # month totals are not carried on
    whole = {name: step[name] for name in (*_SUMS, *_LATEST, "paga_depois")}
    return {**whole, **{name: F.when(fresh, step[name]) for name in _MONTH}}


def receipts_by_cutoff(receipts: DataFrame, ceded: DataFrame, portfolio: Portfolio, windows: Sequence[CloseWindow]) -> DataFrame:
    """The steps of ``receipt_steps`` written out: ``recebimentos`` is a map from the place of a cutoff to its state."""
    places = F.sequence(F.lit(0), F.lit(len(windows) - 1))

    def reached(place: Column) -> Column:
        return F.exists("recebimentos", lambda step: (step["k"] <= place) & (place < step["ate"]))

    def entry(place: Column) -> Column:
        return F.struct(place.alias("corte"), F.struct(*(value.alias(name) for name, value in _received(place).items())))

    written = F.map_from_entries(F.transform(F.filter(places, reached), entry))
    return receipt_steps(receipts, ceded, portfolio, windows).withColumn("recebimentos", written)


# Open instalments -----------------------------------------------------------

_OVERDUE = ("valor_inadimplente", "valor_juros_inadimplencia", "valor_multa_inadimplencia")
_COUNTS = [f"qtd_{kind.lower()}" for kind in INSTALMENT_TYPES]


def open_by_cutoff(
    receivables: DataFrame, receipts: DataFrame, valuations: DataFrame, portfolio: Portfolio, windows: Sequence[CloseWindow]
) -> DataFrame:
    """Per sale the counts by type and the amount to receive, which no cutoff changes, and ``abertas``:
    ranges of places of cutoffs with the overdue marks and amounts that hold in them."""
    windows = _checked(windows)
    start, count = windows[0].start, len(windows)
    due = F.col("vencimento")
    first_paid = (
        C.in_universe(receipts, portfolio).where("pago_em is not null").groupBy(*INSTALMENT_ORDER).agg(F.min("pago_em").alias("_pago"))
    )
    rows = C.in_universe(receivables, portfolio).groupBy(*INSTALMENT_ORDER, "vencimento").agg(F.count(F.lit(1)).alias("linhas"))
    joined = rows.join(L.valuation_by_instalment(valuations, portfolio), INSTALMENT_ORDER, "left").join(first_paid, INSTALMENT_ORDER, "left")
    not_fee = F.col("tipo") != portfolio.fee_type
    copies = F.col("linhas") * F.greatest(F.coalesce("avaliacoes", F.lit(0)), F.lit(1))
    begins = F.when(due.isNull(), count).otherwise(_reached(due, windows))
    ends = F.when(F.col("_pago").isNull(), count).otherwise(_reached(F.col("_pago"), windows))
    month = F.lit(0).cast("long")
    for place, window in enumerate(windows):
        inside = not_fee & (due >= F.lit(window.previous_month_start)) & (due < F.lit(window.month_start))
        month = month + F.when(inside, F.lit(1 << place).cast("long")).otherwise(0)

    def amount(name: str) -> Column:
        return F.sum(F.when(not_fee, F.col("linhas") * F.coalesce(name, zero_amount())).otherwise(zero_amount()))

    ranges = joined.groupBy(*SALE_ORDER, begins.alias("de"), ends.alias("ate")).agg(
        *(F.sum(F.when(F.col("tipo") == kind, copies).otherwise(F.lit(0))).alias(name) for kind, name in zip(INSTALMENT_TYPES, _COUNTS, strict=True)),
        F.sum(F.when(not_fee, F.col("linhas") * F.col("soma_parcela")).otherwise(zero_amount())).alias("valor_a_receber"),
        F.min("vencimento").alias("mais_antiga"),
        F.max(F.when(due < F.lit(start), 1)).alias("aberta_antes_campanha"),
        F.bit_or(month).alias("_meses"),
        *(amount(name).alias(alias) for name, alias in zip(("soma_vencido", "soma_juros", "soma_multa"), _OVERDUE, strict=True)),
    )
    # The ranges stay as they are: a sale has fewer of them than cutoffs.
    held = F.struct("de", "ate", *_OVERDUE, "mais_antiga", "aberta_antes_campanha", "_meses")
    return ranges.groupBy(*SALE_ORDER).agg(
        *(F.sum(name).alias(name) for name in (*_COUNTS, "valor_a_receber")),
        F.collect_list(F.when(F.col("de") < F.col("ate"), held)).alias("abertas"),
    )


def _overdue(place: Column, kinds: T.StructType) -> dict[str, Column]:
    """Marks and amounts of the ranges that hold at the cutoff of a place; null where none does."""
    met = F.filter("abertas", lambda span: (span["de"] <= place) & (place < span["ate"]))
    some = F.size(met) > 0

    def total(name: str) -> Column:
        kind = kinds[name].dataType
        whole = F.aggregate(met, F.lit(0).cast(kind), lambda so_far, span: (so_far + span[name]).cast(kind))
        return F.when(some, whole)

    in_month = F.exists(met, lambda span: F.getbit(span["_meses"], place) == 1)
    return {
        **{name: total(name) for name in _OVERDUE},
        "mais_antiga": F.array_min(F.transform(met, lambda span: span["mais_antiga"])),
        "aberta_antes_campanha": F.array_max(F.transform(met, lambda span: span["aberta_antes_campanha"])),
        "mes_anterior_aberto": F.when(in_month, 1),
        "inadimplente": F.when(some, 1),
    }


# The row --------------------------------------------------------------------


def close_months_core(erp: Erp, portfolio: Portfolio, windows: Sequence[CloseWindow]) -> DataFrame:
    """``close_core`` of every window, its cutoff in ``corte``: members with amounts and rulings."""
    windows = _checked(windows)
    ceded = C.cession_old_side(erp.history, portfolio)
    first_gone = C.effective_cancellations(erp.cancellations).groupBy(*SALE_ORDER).agg(F.min(C.effective_day()).alias("_distratada"))
    sales = (
        B._sales(erp, portfolio)
        .where(~F.col("empresa").isin(*portfolio.excluded_companies))
        .join(receipt_steps(erp.receipts, ceded, portfolio, windows), SALE_ORDER, "left")
        .where((F.col("status") == STATUS_LIVE) | (F.coalesce(F.size("recebimentos"), F.lit(0)) > 0))
        .join(ceded, SALE_ORDER, "left")
        .join(C.cancellation_latest(erp.cancellations), SALE_ORDER, "left")
        .join(first_gone, SALE_ORDER, "left")
        .join(open_by_cutoff(erp.receivables, erp.receipts, erp.valuations, portfolio, windows), SALE_ORDER, "left")
        .join(C.cession_new_side(erp.history, portfolio), SALE_ORDER, "left")
        .join(C.legal_by_sale(erp.occurrences), SALE_ORDER, "left")
    )
    places = [
        F.struct(F.lit(place).alias("place"), F.lit(window.cutoff).alias("corte"), F.lit(window.last_day).alias("ultimo_dia"))
        for place, window in enumerate(windows)
    ]
    each = sales.select("*", F.explode(F.array(*places)).alias("_em")).select("*", "_em.*")
    each = each.where(F.col("_distratada").isNull() | (F.col("_distratada") >= F.col("corte")))
    kinds = sales.schema["abertas"].dataType.elementType
    place = F.col("place")
    found = each.withColumns({**_received(place), **_overdue(place, kinds)}).drop("recebimentos", "abertas")
    state = found.withColumns(
        {
            "teve_recebimento": R.is_true(F.col("recebeu") == 1),
            "dias_atraso": F.datediff("ultimo_dia", "mais_antiga").cast("long"),
        }
    )
    gone = R.cancelled_after(F.col("corte"))
    with_money = (F.col("status") == STATUS_CANCELLED) & gone & F.col("teve_recebimento")
    members = C.keep_members(state, portfolio, with_money)
    rulings = {
        **B._ledger_amounts(),
        **R.close_ruling(F.col("corte"), F.col("ultimo_dia")),
        **R.ledger_columns(),
        **R.cession_columns(),
        **R.legal_columns(),
    }
    return B._rule(members, rulings, ["corte", *B.CLOSE_COLUMNS])


def close_months(erp: Erp, portfolio: Portfolio, windows: Sequence[CloseWindow]) -> DataFrame:
    """``contract_base_close`` of every window, told apart by ``corte``."""
    return B.enrich(close_months_core(erp, portfolio, windows), erp, portfolio)


def month_closes(start: date, first: date, count: int) -> list[CloseWindow]:
    """``count`` successive months from the one that begins on ``first``, as closes of the campaign."""
    out = []
    for _ in range(count):
        following = first.replace(year=first.year + first.month // 12, month=first.month % 12 + 1)
        out.append(CloseWindow(start, first, following))
        first = following
    return out
