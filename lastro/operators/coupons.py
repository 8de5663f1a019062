"""The coupon rule over contract rows, and corrections of published coupons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro.functions.money import coupons, parse_digits, zero_amount
from lastro.functions.ratios import totals
from lastro.params import CouponRule


def eligible_amount(df: DataFrame, rule: CouponRule) -> DataFrame:
    """Sum of the components the rule enables and the frame has; null counts 0."""
    present = [F.coalesce(c, zero_amount()) for c in rule.components if c in df.columns]
    return df.withColumn("valor_elegivel", sum(present, zero_amount()))


def add_coupons(df: DataFrame, rule: CouponRule) -> DataFrame:
    """Blocks of the eligible amount, without a clamp; the rule version is stamped."""
    if "valor_elegivel" not in df.columns:
        df = eligible_amount(df, rule)
    blocks = F.col("valor_elegivel") / rule.amount_per_coupon
    number = F.floor(blocks) if rule.whole_blocks_only else F.bround(blocks)
    return df.withColumns({"cupons_calculados": number.cast("long"), "regra_versao": F.lit(rule.version)})


def prepare(df: DataFrame, rule: CouponRule) -> DataFrame:
    """Published coupons are kept as they are; otherwise the rule is applied."""
    if "cupons_calculados" not in df.columns:
        return add_coupons(eligible_amount(df, rule), rule)
    if "valor_elegivel" in df.columns:
        return df
    return df.withColumn("valor_elegivel", F.coalesce("valor_total_recebido", zero_amount()))


def recompute_snapshot(snapshot: DataFrame) -> DataFrame:
    """First month: both coupon columns from the text amount received, clamped at 0."""
    number = coupons(parse_digits(F.col("valor_recebido"))).cast("double")
    return snapshot.withColumns({"cupons_casas": number, "cupons_milhao": number})


SNAPSHOT_KEY = ["codempresa", "codobra", "venda"]


def update_from_close(snapshot: DataFrame, close: DataFrame) -> DataFrame:
    """Coupons of the close where it knows the sale, published ones elsewhere.

    ``close`` has one row per sale with ``valor_recebido_mes``.
    """
    new = close.select(*SNAPSHOT_KEY, F.col("valor_recebido_mes").alias("_valor"), F.lit(True).alias("_achou"))
    joined = snapshot.join(new, SNAPSHOT_KEY, "left")
    number = coupons(F.col("_valor"))

    def updated(name: str) -> Column:
        published = F.col(name).cast("string").try_cast("double").cast("long")
        return F.when(F.col("_achou"), number).otherwise(published)

    found = F.coalesce("_achou", F.lit(False))
    return joined.withColumns(
        {"cupons_casas": updated("cupons_casas"), "cupons_milhao": updated("cupons_milhao"), "atualizado": found}
    ).drop("_valor", "_achou")


def scale_fix(df: DataFrame, value: str, coupon: str, factor: int = 1_000_000, limit: int = 1000) -> DataFrame:
    """Undo a swallowed decimal point: amounts a million times their coupons' worth."""
    sums = totals(df, valor=F.sum(value), cupons=F.sum(coupon))
    worth = F.greatest(F.coalesce(sums["cupons"].cast("double"), F.lit(0.0)) * 100, F.lit(1.0))
    swallowed = F.coalesce(sums["valor"].cast("double"), F.lit(0.0)) / worth > limit
    return df.withColumn(value, F.when(swallowed, F.col(value).cast("double") / factor).otherwise(F.col(value).cast("double")))


def _numbers(df: DataFrame, suffix: str) -> DataFrame:
    return df.select(
        *SNAPSHOT_KEY,
        *(
            F.col(c).cast("string").try_cast("double").alias(f"{c}_{suffix}")
            for c in ("cupons_casas", "cupons_milhao")
        ),
    )


def coupon_deltas(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per sale: coupons before and after. Both sides have one row per sale."""
    joined = _numbers(before, "antes").join(_numbers(after, "depois"), SNAPSHOT_KEY)
    return joined.withColumn("delta", F.col("cupons_casas_depois") - F.col("cupons_casas_antes"))


def before_after_check(before: DataFrame, after: DataFrame) -> DataFrame:
    """Sums before and after, the smallest coupon, and how many sales changed: each side read once."""
    joined = _numbers(before, "antes").join(_numbers(after, "depois"), SNAPSHOT_KEY, "full")
    return joined.agg(
        F.sum("cupons_casas_antes").alias("casas_antes"),
        F.sum("cupons_milhao_antes").alias("milhao_antes"),
        F.sum("cupons_casas_depois").alias("casas_depois"),
        F.sum("cupons_milhao_depois").alias("milhao_depois"),
        F.min("cupons_casas_depois").alias("min_cupons"),
        F.count_if(F.col("cupons_casas_antes") != F.col("cupons_casas_depois")).alias("contratos_alterados"),
    )


def top_deltas(before: DataFrame, after: DataFrame, n: int = 10) -> DataFrame:
    changed = coupon_deltas(before, after).where("cupons_casas_antes <> cupons_casas_depois")
    return changed.select(*SNAPSHOT_KEY, "cupons_casas_antes", "cupons_casas_depois", "delta").orderBy(
        F.desc("delta"), *SNAPSHOT_KEY
    ).limit(n)
