"""Open instalments and receipts, aggregated to one row per sale.

Both ledgers are the large tables, and one sale may hold a great share of their
rows. So each is first aggregated on a finer key than the sale (instalment, or
sale and payment day), which Spark combines on the map side; joins then see at
most one row per finer key, and the sums over joined rows are rebuilt exactly
from counts and sums instead of from row pairs.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro.functions.money import base_amount, full_amount, zero_amount
from lastro.operators.contracts import in_universe, keyed
from lastro.params import INSTALMENT_TYPES, Portfolio
from lastro.schemas import INSTALMENT_KEY, INSTALMENT_ORDER, SALE_KEY, SALE_ORDER

# Open instalments -----------------------------------------------------------


def open_by_instalment(
    receivables: DataFrame,
    portfolio: Portfolio,
    overdue_before: date,
    campaign_start: date,
    month: tuple[date, date] | None = None,
) -> DataFrame:
    """Rows, overdue rows and oldest overdue day of each instalment key.

    With ``month`` also a mark on non-fee instalments due from its first day to
    before its second, so the ledger is read once for both questions.
    """
    due = F.col("vencimento")
    overdue = due < F.lit(overdue_before)
    marks = []
    if month:
        inside = (F.col("tipo") != portfolio.fee_type) & (due >= F.lit(month[0])) & (due < F.lit(month[1]))
        marks = [F.max(F.when(inside, 1)).alias("mes_anterior")]
    return keyed(
        in_universe(receivables, portfolio)
        .groupBy(*INSTALMENT_ORDER)
        .agg(
            F.count(F.lit(1)).alias("linhas"),
            F.count_if(overdue).alias("vencidas"),
            F.min(F.when(overdue, due)).alias("mais_antiga"),
            F.max(F.when(due < F.lit(campaign_start), 1)).alias("antes_campanha"),
            *marks,
        ),
        INSTALMENT_KEY,
    )


def valuation_by_instalment(valuations: DataFrame, portfolio: Portfolio) -> DataFrame:
    """Valuation sums of each instalment key, with the number of rows behind them."""
    overdue = sum((F.coalesce(c, zero_amount()) for c in ("val_principal", "val_juros", "val_correcao")), zero_amount())
    return keyed(
        in_universe(valuations, portfolio)
        .groupBy(*INSTALMENT_ORDER)
        .agg(
            F.count(F.lit(1)).alias("avaliacoes"),
            F.sum("val_parcela").alias("soma_parcela"),
            F.sum(overdue).alias("soma_vencido"),
            F.sum("val_juro_atraso").alias("soma_juros"),
            F.sum("val_multa_atraso").alias("soma_multa"),
        ),
        INSTALMENT_KEY,
    )


def paid_before(receipts: DataFrame, portfolio: Portfolio, cutoff: date) -> DataFrame:
    """Instalment keys with a receipt dated before the cutoff."""
    paid = in_universe(receipts, portfolio).where(F.col("pago_em") < F.lit(cutoff))
    return keyed(paid.select(*INSTALMENT_ORDER).distinct(), INSTALMENT_KEY)


def drop_paid(open_rows: DataFrame, paid: DataFrame) -> DataFrame:
    """Keep the counts of every instalment, but no overdue mark on the paid ones."""
    marked = keyed(open_rows.join(paid.withColumn("_paga", F.lit(True)), INSTALMENT_ORDER, "left"), INSTALMENT_KEY)
    unpaid = F.col("_paga").isNull()
    marks = [c for c in ("mais_antiga", "antes_campanha", "mes_anterior") if c in open_rows.columns]
    return marked.withColumns(
        {
            "vencidas": F.when(unpaid, F.col("vencidas")).otherwise(F.lit(0)),
            **{c: F.when(unpaid, F.col(c)) for c in marks},
        }
    ).drop("_paga")


def overdue_by_sale(open_rows: DataFrame, reference_day: date) -> DataFrame:
    """Overdue marks only; needs no valuation."""
    return keyed(open_rows.groupBy(*SALE_ORDER).agg(*_overdue_marks(open_rows, reference_day)))


def _overdue_marks(open_rows: DataFrame, reference_day: date) -> list[Column]:
    month = [F.max("mes_anterior").alias("mes_anterior_aberto")] if "mes_anterior" in open_rows.columns else []
    return [
        *month,
        F.max(F.when(F.col("vencidas") > 0, 1)).alias("inadimplente"),
        F.max("antes_campanha").alias("aberta_antes_campanha"),
        F.datediff(F.lit(reference_day), F.min("mais_antiga")).cast("long").alias("dias_atraso"),
    ]


def _times(number: Column, amount: Column) -> Column:
    """``number * amount``. Most numbers are 0 or 1; only the others pay for a product of wide decimals."""
    once = F.when((number == 0) & amount.isNotNull(), zero_amount()).when(number == 1, amount)
    return once.otherwise(number * amount)


def receivables_by_sale(
    open_rows: DataFrame, valuation: DataFrame, portfolio: Portfolio, reference_day: date
) -> DataFrame:
    """Counts by type, amount to receive, overdue marks and amounts per sale.

    A left join to the valuations repeats an instalment once per valuation of
    its key. The repeats are not materialised: counts are multiplied by the
    number of valuations, sums by the number of open rows.
    """
    joined = open_rows.join(valuation, INSTALMENT_ORDER, "left")
    copies = F.col("linhas") * F.greatest(F.coalesce("avaliacoes", F.lit(0)), F.lit(1))
    not_fee = F.col("tipo") != portfolio.fee_type

    def overdue_sum(name: str) -> Column:
        amount = _times(F.col("vencidas"), F.coalesce(name, zero_amount()))
        return F.sum(F.when(not_fee, amount).otherwise(zero_amount()))

    totals = joined.groupBy(*SALE_ORDER).agg(
        *(
            F.sum(F.when(F.col("tipo") == kind, copies).otherwise(F.lit(0))).alias(f"qtd_{kind.lower()}")
            for kind in INSTALMENT_TYPES
        ),
        F.sum(F.when(not_fee, _times(F.col("linhas"), F.col("soma_parcela"))).otherwise(zero_amount())).alias("valor_a_receber"),
        *_overdue_marks(open_rows, reference_day),
        overdue_sum("soma_vencido").alias("valor_inadimplente"),
        overdue_sum("soma_juros").alias("valor_juros_inadimplencia"),
        overdue_sum("soma_multa").alias("valor_multa_inadimplencia"),
    )
    return keyed(totals)


def open_in_month(receivables: DataFrame, portfolio: Portfolio, first: date, following: date) -> DataFrame:
    """Non-fee open instalments due in [first, following)."""
    due = F.col("vencimento")
    return in_universe(receivables, portfolio).where(
        (F.col("tipo") != portfolio.fee_type) & (due >= F.lit(first)) & (due < F.lit(following))
    )


def sales_of(df: DataFrame, mark: str) -> DataFrame:
    """Distinct sales of a frame, marked 1."""
    return keyed(df.select(*SALE_ORDER).distinct()).withColumn(mark, F.lit(1))


def previous_month_open(receivables: DataFrame, portfolio: Portfolio, first: date, following: date) -> DataFrame:
    return sales_of(open_in_month(receivables, portfolio, first, following), "mes_anterior_aberto")


def previous_month_open_asof(
    receivables: DataFrame, receipts: DataFrame, portfolio: Portfolio, first: date, following: date, cutoff: date
) -> DataFrame:
    """The same, less the instalments paid before the cutoff."""
    open_keys = open_in_month(receivables, portfolio, first, following).select(*INSTALMENT_ORDER).distinct()
    unpaid = open_keys.join(paid_before(receipts, portfolio, cutoff), INSTALMENT_ORDER, "left_anti")
    return sales_of(unpaid, "mes_anterior_aberto")


def open_at_cutoff(receivables: DataFrame, receipts: DataFrame, portfolio: Portfolio, cutoff: date) -> DataFrame:
    """Sales with an instalment due and unpaid before the cutoff (fees included)."""
    due = in_universe(receivables, portfolio).where(F.col("vencimento") < F.lit(cutoff))
    unpaid = due.select(*INSTALMENT_ORDER).distinct().join(
        paid_before(receipts, portfolio, cutoff), INSTALMENT_ORDER, "left_anti"
    )
    return sales_of(unpaid, "aberta_no_corte")


def due_before_paid_after(receipts: DataFrame, portfolio: Portfolio, day: date, mark: str) -> DataFrame:
    """Sales that owed something before ``day`` and paid it on or after that day."""
    late = (F.col("vencimento") < F.lit(day)) & (F.col("pago_em") >= F.lit(day))
    return sales_of(in_universe(receipts, portfolio).where(late), mark)


# Receipts -------------------------------------------------------------------


def receipts_in_window(receipts: DataFrame, portfolio: Portfolio, start: date, end: date) -> DataFrame:
    """Non-fee receipts paid in [start, end)."""
    paid = F.col("pago_em")
    return in_universe(receipts, portfolio).where(
        (paid >= F.lit(start)) & (paid < F.lit(end)) & (F.col("tipo") != portfolio.fee_type)
    )


def daily_receipts(window: DataFrame, campaign_start: date) -> DataFrame:
    """One row per sale and payment day: everything a total needs from the rows."""
    amounts = window.withColumns({"cheio": full_amount(), "base": base_amount()})
    ahead = F.last_day("pago_em") < F.last_day("vencimento")
    late = F.col("pago_em") > F.col("vencimento")
    daily = amounts.groupBy(*SALE_ORDER, "pago_em").agg(
        F.sum("cheio").alias("cheio"),
        F.sum("base").alias("base"),
        F.max(F.when(F.col("vencimento") < F.lit(campaign_start), 1).otherwise(0)).alias("pagou_vencida_antes"),
        F.max(F.when(ahead, 1).otherwise(0)).alias("antecipou"),
        F.sum(F.when(ahead, F.col("cheio")).otherwise(zero_amount())).alias("valor_antecipado"),
        F.max(F.when(late, 1).otherwise(0)).alias("recuperou"),
        F.sum(F.when(late, F.col("cheio")).otherwise(zero_amount())).alias("valor_recuperado"),
    )
    return keyed(daily)


def before_cession(daily: DataFrame, ceded: DataFrame) -> DataFrame:
    """Receipts of a ceded sale count only up to the day before it was ceded."""
    cut = daily.join(ceded.select(*SALE_KEY, F.col("data_cedida").alias("_corte")), SALE_ORDER, "left")
    return keyed(cut.where(F.col("_corte").isNull() | (F.col("pago_em") < F.col("_corte"))).drop("_corte"))


def receipts_by_sale(daily: DataFrame, month_start: date) -> DataFrame:
    """Totals of the window and of the month that starts on ``month_start``."""
    in_month = F.col("pago_em") >= F.lit(month_start)
    totals = daily.groupBy(*SALE_ORDER).agg(
        F.sum("cheio").alias("valor_recebido"),
        F.sum("base").alias("valor_gera_cupom"),
        F.sum(F.when(in_month, F.col("base")).otherwise(zero_amount())).alias("valor_cupom_mes"),
        F.sum(F.when(in_month, F.col("cheio")).otherwise(zero_amount())).alias("valor_recebido_mes"),
        F.max("pagou_vencida_antes").alias("pagou_vencida_antes"),
        F.max("antecipou").alias("antecipou"),
        F.sum("valor_antecipado").alias("valor_antecipado"),
        F.max("recuperou").alias("recuperou"),
        F.sum("valor_recuperado").alias("valor_recuperado"),
        F.max("pago_em").alias("ultimo_recebimento"),
    )
    return keyed(totals)


def campaign_receipts(
    receipts: DataFrame, ceded: DataFrame, portfolio: Portfolio, start: date, end: date, month_start: date
) -> DataFrame:
    """Window, cession cut and totals in one go."""
    daily = daily_receipts(receipts_in_window(receipts, portfolio, start, end), start)
    return receipts_by_sale(before_cession(daily, ceded), month_start)


def close_window_receipts(
    receipts: DataFrame, ceded: DataFrame, portfolio: Portfolio, start: date, cutoff: date, month_start: date
) -> DataFrame:
    """Everything a close asks of the receipts, in one pass: per sale the window's
    totals, ``recebeu`` where a receipt counts in them, and the marks of those who
    owed something before the cutoff, or before the start, and paid it after.

    The cession cut applies to the totals only.
    """
    due, paid = F.col("vencimento"), F.col("pago_em")
    counted = (paid >= F.lit(start)) & (paid < F.lit(cutoff)) & (F.col("tipo") != portfolio.fee_type)
    after = (due < F.lit(cutoff)) & (paid >= F.lit(cutoff))
    launch = (due < F.lit(start)) & (paid >= F.lit(start))
    ahead, late = F.last_day(paid) < F.last_day(due), paid > due
    rows = in_universe(receipts, portfolio).where(counted | after | launch)
    rows = rows.withColumns({"cheio": full_amount(), "base": base_amount()})

    def total(amount: Column) -> Column:
        return F.sum(F.when(counted, amount))

    daily = rows.groupBy(*SALE_ORDER, "pago_em").agg(
        F.max(F.when(counted, 1)).alias("contado"),
        total(F.col("cheio")).alias("cheio"),
        total(F.col("base")).alias("base"),
        F.max(F.when(counted, F.when(ahead, 1).otherwise(0))).alias("antecipou"),
        total(F.when(ahead, F.col("cheio")).otherwise(zero_amount())).alias("valor_antecipado"),
        F.max(F.when(counted, F.when(late, 1).otherwise(0))).alias("recuperou"),
        total(F.when(late, F.col("cheio")).otherwise(zero_amount())).alias("valor_recuperado"),
        F.max(F.when(after, 1)).alias("paga_depois"),
        F.max(F.when(launch, 1)).alias("pagou_vencida_antes"),
    )
    cut = daily.join(ceded.select(*SALE_KEY, F.col("data_cedida").alias("_corte")), SALE_ORDER, "left")
    counts = (F.col("contado") == 1) & (F.col("_corte").isNull() | (paid < F.col("_corte")))
    in_month = paid >= F.lit(month_start)

    def within(value: Column) -> Column:
        return F.when(counts, value)

    def of_month(name: str) -> Column:
        return F.sum(within(F.when(in_month, F.col(name)).otherwise(zero_amount())))

    totals = cut.groupBy(*SALE_ORDER).agg(
        F.max(within(F.lit(1))).alias("recebeu"),
        F.sum(within(F.col("cheio"))).alias("valor_recebido"),
        F.sum(within(F.col("base"))).alias("valor_gera_cupom"),
        of_month("base").alias("valor_cupom_mes"),
        of_month("cheio").alias("valor_recebido_mes"),
        F.max(within(F.col("antecipou"))).alias("antecipou"),
        F.sum(within(F.col("valor_antecipado"))).alias("valor_antecipado"),
        F.max(within(F.col("recuperou"))).alias("recuperou"),
        F.sum(within(F.col("valor_recuperado"))).alias("valor_recuperado"),
        F.max(within(paid)).alias("ultimo_recebimento"),
        F.max("paga_depois").alias("paga_depois"),
        F.max("pagou_vencida_antes").alias("pagou_vencida_antes"),
    )
    return keyed(totals)


def close_receipts(
    receipts: DataFrame, ceded: DataFrame, portfolio: Portfolio, month_start: date, cutoff: date, last_days: int = 2
) -> DataFrame:
    """Totals of the closed month, and whether one of its last days saw a payment."""
    daily = daily_receipts(receipts_in_window(receipts, portfolio, month_start, cutoff), month_start)
    recent = F.col("pago_em") >= F.date_sub(F.lit(cutoff), last_days)
    return keyed(
        before_cession(daily, ceded)
        .groupBy(*SALE_ORDER)
        .agg(
            F.sum("base").alias("valor_gera_cupom"),
            F.sum("cheio").alias("valor_recebido"),
            F.max(F.when(recent, 1).otherwise(0)).alias("pgto_fim_mes"),
            F.max("pago_em").alias("ultimo_recebimento"),
        )
    )
