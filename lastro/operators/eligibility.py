"""Row-level rulings: default, launch mark, coupons, draw status, eligibility."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro.functions.dates import day_text
from lastro.functions.money import coupons, zero_amount
from lastro.operators.contracts import effective_day
from lastro.params import APTO, NAO_APTO, STATUS_CANCELLED, STATUS_SETTLED

# Reasons and labels stored in the published tables.
REASON_OVERDUE_LIVE = "PARCELA VENCIDA NO ENCERRAMENTO DO PERÍODO"
REASON_CLEAR_LIVE = "ADIMPLENTE"
REASON_CANCELLED_AFTER = "DISTRATO APÓS O FECHAMENTO"
REASON_CLEAR_CLOSE = "ADIMPLENTE NO FECHAMENTO"
SALE_STATUS = {0: "NORMAL", 1: "CANCELADA", 2: "ALTERADA", 3: "QUITADA", 4: "EM ACERTO"}
CANCELLATION_TYPE = {0: "NORMAL", 1: "ADMINISTRATIVO"}
TRANSFER = "TRANSFERENCIA (CESSAO DE DIREITO)"
CANCELLATION = "CANCELAMENTO"


def reason_overdue_close(last_day: date | Column) -> Column:
    return F.concat(F.lit("PARCELA VENCIDA EM ABERTO EM "), F.date_format(F.lit(last_day), "dd/MM"))


def yes_no(condition: Column, no: str = "Não") -> Column:
    return F.when(condition, "Sim").otherwise(no)


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def is_true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def overdue() -> Column:
    """Overdue at the reference day; a frame without late payers has no such column."""
    return is_true(F.col("inadimplente") == 1) | is_true(F.col("paga_depois") == 1)


def overdue_at_launch() -> Column:
    return is_true(F.col("aberta_antes_campanha") == 1) | is_true(F.col("pagou_vencida_antes") == 1)


def zero(name: str) -> Column:
    return F.coalesce(name, zero_amount())


def eligible(overdue_now: Column) -> Column:
    return F.when(overdue_now, NAO_APTO).otherwise(APTO)


def eligible_monthly(overdue_now: Column) -> Column:
    """Settled and ceded sales are eligible only in a month with money in it."""
    rescued = (F.col("status") == STATUS_SETTLED) | (
        (F.col("status") == STATUS_CANCELLED) & F.col("venda_nova").isNotNull()
    )
    moved = zero("valor_recebido_mes") > 0
    return F.when(rescued, eligible(~moved)).otherwise(eligible(overdue_now))


def cancelled_after(cutoff: date | Column) -> Column:
    """Effective cancellation on or after the cutoff; undated ones are neither."""
    return is_true(effective_day() >= F.lit(cutoff))


def ledger_columns() -> dict[str, Column]:
    """Amounts, coupons and payment marks every base shares."""
    return {
        "inad_junho": flag(overdue_at_launch()),
        "recuperacao": flag(is_true(F.col("recuperou") == 1)),
        "valor_recuperado": zero("valor_recuperado"),
        "antecipacao": yes_no(is_true(F.col("antecipou") == 1)),
        "valor_antecipado": zero("valor_antecipado"),
        "valor_recebido": zero("valor_recebido"),
        "valor_gera_cupom": zero("valor_gera_cupom"),
        "valor_cupom_mes_atual": zero("valor_cupom_mes"),
        "data_ultimo_recebimento": F.col("ultimo_recebimento"),
        "cupons_milhao": coupons(zero("valor_recebido")),
        "cupons_casas": coupons(zero("valor_recebido_mes")),
        "pagou_parcela_mes_anterior": F.when(is_true(F.col("mes_anterior_aberto") == 1), "Não").otherwise("Sim"),
    }


def cession_columns() -> dict[str, Column]:
    return {
        "cessao": yes_no(F.col("venda_origem").isNotNull()),
        "venda_origem_cessao": F.col("venda_origem"),
        "data_cessao": F.col("data_cessao"),
        "contrato_quitado": yes_no(F.col("status") == STATUS_SETTLED),
        "contrato_cedido": yes_no(F.col("venda_nova").isNotNull()),
        "venda_nova_cessao": F.col("venda_nova"),
        "data_cedida": F.col("data_cedida"),
    }


def legal_columns() -> dict[str, Column]:
    """'Sim' for exactly one open occurrence; two of a kind read 'Não' in the source."""
    return {
        "juridico_ativo": yes_no(is_true(F.col("juridico_ativo") == 1)),
        "juridico_passivo": yes_no(is_true(F.col("juridico_passivo") == 1)),
    }


def live_ruling() -> dict[str, Column]:
    late = overdue()
    return {
        "statuvenda": F.when(late, "Inadimplente").otherwise("Adimplente"),
        "status_sorteio": eligible(late),
        "motivo": F.when(late, REASON_OVERDUE_LIVE).otherwise(REASON_CLEAR_LIVE),
        "aptidao_casas": eligible_monthly(late),
        "aptidao_sorteio": eligible(late),
    }


def close_ruling(cutoff: date | Column, last_day: date | Column) -> dict[str, Column]:
    """As live, but a cancellation after the close comes first."""
    late, gone = overdue(), cancelled_after(cutoff)
    final = F.when(gone, NAO_APTO).otherwise(eligible(late))
    return {
        "statuvenda": F.when(late, "Inadimplente").otherwise("Adimplente"),
        "status_sorteio": final,
        "motivo": F.when(gone, REASON_CANCELLED_AFTER)
        .when(late, reason_overdue_close(last_day))
        .otherwise(REASON_CLEAR_LIVE),
        "distrato_apos_fechamento": flag(gone),
        "aptidao_casas": F.when(gone, NAO_APTO).otherwise(eligible_monthly(late)),
        "aptidao_sorteio": final,
    }


def label(code: Column, labels: dict[int, str], unknown: Column) -> Column:
    out = unknown
    for value, text in labels.items():
        out = F.when(code == value, text).otherwise(out)
    return out


def sale_status_label(code: Column) -> Column:
    unknown = F.concat(F.lit("DESCONHECIDO ("), F.coalesce(code.cast("string"), F.lit("")), F.lit(")"))
    return label(code, SALE_STATUS, unknown)


def cancellation_type_label(code: Column) -> Column:
    return label(code, CANCELLATION_TYPE, F.lit(""))


def cancel_or_transfer(cancelled: Column, transferred: Column) -> Column:
    return F.when(~cancelled, "").when(is_true(transferred == 1), TRANSFER).otherwise(CANCELLATION)


def presentation(df: DataFrame) -> DataFrame:
    """Text form of the published row: names upper, mail lower, days as dd/MM/yyyy."""
    shown = {
        "nomecliente": F.upper("nomecliente"),
        "emailcliente": F.lower("emailcliente"),
        "regional": F.replace("regional", F.lit("REGIONAL"), F.lit("")),
    }
    days = {c: day_text(F.col(c)) for c in ("dt_venda", "data_ultimo_recebimento", "data_cessao", "data_cedida")}
    return df.withColumns({name: col for name, col in {**shown, **days}.items() if name in df.columns})
