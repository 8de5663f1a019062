"""Contract classes, their texts and summary, and the draw lists."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro.functions.dates import day_text, parse_day_first
from lastro.functions.ratios import rounded, totals
from lastro.functions.text import capitalize, is_one, is_yes, normalize_status, text_or_empty
from lastro.params import NAO_APTO

# Classes in priority order, and the texts of the diagnosis.
CLASSES = ("DISTRATADO", "CESSAO", "QUITADO", "INADIMPLENTE", "ADIMPLENTE")
TEXT_CANCELLED = "Distrato após fechamento — marcado NÃO APTO"
TEXT_CESSION = "Cessão no mês: "
TEXT_CEDED = "contrato cedido em "
TEXT_NEW = "venda nova por cessão em "
TEXT_SETTLED = "Contrato quitado"
TEXT_NOT_ELIGIBLE = "Não apto no sorteio"
TEXT_ON_TIME = "Em dia"
TEXT_LAST = " — último recebimento "
TEXT_NO_RECEIPT = " — sem recebimento na janela"


def day(name: str) -> Column:
    return parse_day_first(F.col(name))


def in_month(name: str, first: date, following: date) -> Column:
    moved = (day(name) >= F.lit(first)) & (day(name) < F.lit(following))
    return F.coalesce(moved, F.lit(False))


def is_eligible(name: str) -> Column:
    return normalize_status(F.col(name)) == "APTO"


def _cession_settled_overdue(first: date, following: date) -> Column:
    moved = in_month("data_cedida", first, following) | in_month("data_cessao", first, following)
    return (
        F.when(moved, "CESSAO")
        .when(is_yes(F.col("contrato_quitado")), "QUITADO")
        .when(~is_eligible("aptidao_sorteio"), "INADIMPLENTE")
        .otherwise("ADIMPLENTE")
    )


def classify(df: DataFrame, first: date, following: date) -> DataFrame:
    """Five classes; the cession counts only when it moved inside the month."""
    cancelled = is_one(F.col("distrato_apos_fechamento")) if "distrato_apos_fechamento" in df.columns else F.lit(False)
    others = _cession_settled_overdue(first, following)
    return df.withColumn("classificacao", F.when(cancelled, "DISTRATADO").otherwise(others))


def override_eligibility(df: DataFrame) -> DataFrame:
    """Cancelled contracts are eligible under neither ruler."""
    cancelled = F.col("classificacao") == "DISTRATADO"
    return df.withColumns(
        {name: F.when(cancelled, NAO_APTO).otherwise(text_or_empty(F.col(name))) for name in ("aptidao_casas", "aptidao_sorteio")}
    )


def diagnose(df: DataFrame, first: date, following: date) -> DataFrame:
    """One sentence per contract."""
    last = day_text(day("data_ultimo_recebimento"))
    suffix = F.coalesce(F.concat(F.lit(TEXT_LAST), last), F.lit(TEXT_NO_RECEIPT))
    moves = F.concat_ws(
        " e ",
        F.when(in_month("data_cedida", first, following), F.concat(F.lit(TEXT_CEDED), day_text(day("data_cedida")))),
        F.when(in_month("data_cessao", first, following), F.concat(F.lit(TEXT_NEW), day_text(day("data_cessao")))),
    )
    reason = text_or_empty(F.col("motivo")) if "motivo" in df.columns else F.lit("")
    told = (reason != "") & (normalize_status(reason) != "ADIMPLENTE")
    kind = F.col("classificacao")
    text = (
        F.when(kind == "DISTRATADO", TEXT_CANCELLED)
        .when(kind == "CESSAO", capitalize(F.concat(F.lit(TEXT_CESSION), moves)))
        .when(kind == "QUITADO", F.concat(F.lit(TEXT_SETTLED), suffix))
        .when(kind == "INADIMPLENTE", F.concat(F.when(told, capitalize(reason)).otherwise(TEXT_NOT_ELIGIBLE), suffix))
        .otherwise(F.concat(F.lit(TEXT_ON_TIME), suffix))
    )
    return df.withColumn("diagnostico", text)


def class_summary(df: DataFrame) -> DataFrame:
    """All five classes in order, absent ones with zeros, and their share."""
    spark = df.sparkSession
    order = spark.createDataFrame(list(enumerate(CLASSES, 1)), "ordem int, classificacao string")
    sums = df.groupBy("classificacao").agg(
        F.count(F.lit(1)).alias("contratos"),
        F.sum("valor_recebido").alias("valor_recebido"),
        F.sum("cupons_milhao").alias("cupons_milhao"),
        F.sum("cupons_casas").alias("cupons_casas"),
    )
    whole = totals(df, n=F.count(F.lit(1)))["n"]
    measures = ("contratos", "valor_recebido", "cupons_milhao", "cupons_casas")
    filled = order.join(sums, "classificacao", "left").select(
        "ordem", "classificacao", *(F.coalesce(name, F.lit(0)).alias(name) for name in measures)
    )
    share = F.try_divide(100 * F.col("contratos").cast("double"), whole.cast("double"))
    return filled.withColumn("pct", rounded(F.coalesce(share, F.lit(0.0)), 2))


def list_classification(df: DataFrame, first: date, following: date) -> DataFrame:
    """Ten-column cut of the whole base under the four-class variant."""
    return df.select(
        "codempresa",
        "codobra",
        "venda",
        "nomecliente",
        F.col("cpf_pes").alias("cpf"),
        "aptidao_casas",
        "aptidao_sorteio",
        "valor_recebido",
        F.col("dt_venda").alias("data_venda"),
        _cession_settled_overdue(first, following).alias("classificacao"),
    )


def draw_list(df: DataFrame, ruler: str, coupons: str) -> DataFrame:
    """Eligible under the ruler with coupons, most coupons first."""
    chosen = df.where(is_eligible(ruler) & (F.col(coupons) > 0))
    return chosen.orderBy(F.desc(coupons), "codempresa", "codobra", "venda")


def draw_list_monthly(df: DataFrame) -> DataFrame:
    return draw_list(df, "aptidao_casas", "cupons_casas")


def draw_list_final(df: DataFrame) -> DataFrame:
    return draw_list(df, "aptidao_sorteio", "cupons_milhao")


def exclude_winners(monthly: DataFrame, winners: DataFrame, key: list[str]) -> DataFrame:
    """Earlier house winners leave the monthly lists; the final list keeps them."""
    return monthly.join(winners.select(*key).distinct(), key, "left_anti")
