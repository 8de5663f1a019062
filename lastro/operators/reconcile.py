"""An old photo against a re-execution: joins, transitions, reasons, situations.

Both sides are one row per sale, so the full join is one to one and every report
after it is a filter or an aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lastro.functions.money import parse_export
from lastro.functions.text import is_one, is_yes, normalize_status
from lastro.schemas import SALE_KEY
from lastro.sources.files import named, resolve_column

# Labels of the reconciliation reports.
AFTER_CLOSE = "DISTRATO APOS FECHAMENTO (NAO APTO)"
RESCUED_OLD = "CEDENTE RESGATADO (cessao)"
RESCUED_NEW = "VENDA NOVA DE CESSAO"
RESCUED_SETTLED = "QUITADA RESGATADA"
OTHER_ENTRY = "BAIXA TARDIA / OUTROS"
NO_RETURN = "SEM RETORNO NA APURACAO - INVESTIGAR"
CANCELLED_AFTER = "DISTRATADA APOS FECHAMENTO - DECISAO PENDENTE"
CANCELLED = "DISTRATADA"
SETTLED = "QUITADA"
TOLERANCE = 0.01
OPTIONAL = {
    "aptidao_casas": "Aptidao Casas",
    "aptidao_sorteio": "Aptidao Sorteio",
    "cessao": "Cessao",
    "contrato_quitado": "Contrato Quitado",
    "contrato_cedido": "Contrato Cedido",
    "data_cessao": "Data Cessao",
    "data_cedida": "Data Cedida",
    "distrato_apos_fechamento": "Distrato Apos Fechamento",
}
FLAGS = ["cessao", "contrato_quitado", "contrato_cedido", "distrato_apos_fechamento"]


def number(df: DataFrame, name: str) -> Column:
    """Numeric column as double; text through the export spelling, null as 0."""
    field = df.schema[name]
    if field.dataType.simpleString() == "string":
        return parse_export(named(name)).cast("double")
    return F.coalesce(named(name).cast("double"), F.lit(0.0))


def normalize_side(df: DataFrame, suffix: str, minimal: bool = False) -> DataFrame:
    """Typed key, folded status, numeric measures; column names found tolerantly."""

    def found(name: str) -> str:
        return resolve_column(df, name)

    columns = [
        named(found("codempresa")).cast("string").try_cast("long").alias("empresa"),
        F.trim(named(found("codobra")).cast("string")).alias("obra"),
        named(found("venda")).cast("string").try_cast("long").alias("num_venda"),
        normalize_status(named(found("status_sorteio"))).alias(f"status_{suffix}"),
    ]
    for measure in ("cupons_casas", "cupons_milhao", "valor_recebido"):
        columns.append(number(df, found(measure)).alias(f"{measure}_{suffix}"))
    if minimal:
        return df.select(*columns)
    columns += [named(found(name)).alias(f"{alias}_{suffix}") for name, alias in (("nomecliente", "nome"), ("cpf_pes", "cpf"))]
    for alias, name in {"data_venda": "Dt Venda", **OPTIONAL}.items():
        source = resolve_column(df, name, required=False)
        columns.append((named(source) if source else F.lit("")).alias(f"{alias}_{suffix}"))
    return df.select(*columns)


def duplicate_keys(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each sale."""
    counted = df.groupBy(*SALE_KEY).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("linhas"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicadas"),
    )


def compare(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full outer join on the sale with where each row comes from."""
    joined = left.withColumn("_e", F.lit(True)).join(right.withColumn("_d", F.lit(True)), SALE_KEY, "full")
    side = F.when(F.col("_d").isNull(), "left_only").when(F.col("_e").isNull(), "right_only").otherwise("both")
    return joined.withColumn("presenca", side).drop("_e", "_d")


def aptitude_transitions(joined: DataFrame, before: str, after: str) -> DataFrame:
    """Sales that became eligible or ceased to be."""
    old, new = F.col(f"status_{before}"), F.col(f"status_{after}")
    moved = F.when((old == "NAO APTO") & (new == "APTO"), "recuperou").when(
        (old == "APTO") & (new == "NAO APTO"), "perdeu"
    )
    return joined.withColumn("transicao", moved).where("transicao is not null and presenca = 'both'")


def coupon_changes(joined: DataFrame, before: str, after: str) -> DataFrame:
    old, new = F.col(f"cupons_casas_{before}"), F.col(f"cupons_casas_{after}")
    moved = F.when(new > old, "ganhou").when(new < old, "perdeu")
    return joined.where("presenca = 'both'").withColumn("mudanca", moved).where("mudanca is not null")


def entry_reason(suffix: str) -> Column:
    """Why a sale is in the re-execution and not in the photo."""
    reasons = F.concat_ws(
        " + ",
        F.when(is_one(F.col(f"distrato_apos_fechamento_{suffix}")), AFTER_CLOSE),
        F.when(is_yes(F.col(f"contrato_cedido_{suffix}")), RESCUED_OLD),
        F.when(is_yes(F.col(f"cessao_{suffix}")), RESCUED_NEW),
        F.when(is_yes(F.col(f"contrato_quitado_{suffix}")), RESCUED_SETTLED),
    )
    return F.when(reasons == "", OTHER_ENTRY).otherwise(reasons)


def entries_exits(joined: DataFrame, after: str) -> DataFrame:
    """Entered (with the reason) and left."""
    one_sided = joined.where("presenca <> 'both'")
    return one_sided.withColumn("motivo_entrada", F.when(F.col("presenca") == "right_only", entry_reason(after)))


def retroactive_payments(joined: DataFrame, before: str, after: str, tolerance: float = TOLERANCE) -> DataFrame:
    """Sales whose money grew after the photo, with what they gained."""
    grown = F.col(f"valor_recebido_{after}") > F.col(f"valor_recebido_{before}") + tolerance
    return joined.where(grown & (F.col("presenca") == "both")).withColumns(
        {
            "valor_retroativo": F.bround(F.col(f"valor_recebido_{after}") - F.col(f"valor_recebido_{before}"), 4),
            "cupons_ganhos": F.col(f"cupons_milhao_{after}") - F.col(f"cupons_milhao_{before}"),
        }
    )


def key_set_diff(official: DataFrame, live: DataFrame) -> DataFrame:
    """Sales in both, only official, only live; and what the official-only ones are."""
    keys = live.select(*SALE_KEY).distinct().withColumn("_viva", F.lit(True))
    flags = {
        "distrato": F.max(is_one(F.col("distrato_apos_fechamento_of"))),
        "cedida": F.max(is_yes(F.col("contrato_cedido_of"))),
        "quitada": F.max(is_yes(F.col("contrato_quitado_of"))),
    }
    ours = official.groupBy(*SALE_KEY).agg(*(column.alias(name) for name, column in flags.items()))
    joined = ours.withColumn("_oficial", F.lit(True)).join(keys, SALE_KEY, "full")
    only = F.col("_viva").isNull()
    return joined.agg(
        F.count_if(F.col("_oficial") & F.col("_viva")).alias("nas_duas"),
        F.count_if(only).alias("so_oficial"),
        F.count_if(F.col("_oficial").isNull()).alias("so_viva"),
        *(F.count_if(only & F.col(name)).alias(f"so_oficial_{name}") for name in flags),
    )


# Photo completed by the audit of the close ----------------------------------


def left_base_join(photo: DataFrame, audit: DataFrame) -> DataFrame:
    """Every photo sale with its audit row; audit rows without a photo are dropped."""
    keyed = audit.withColumnsRenamed({"codempresa": "empresa", "codobra": "obra", "venda": "num_venda"})
    typed = keyed.withColumn("empresa", F.col("empresa").cast("long"))
    return photo.join(typed.withColumn("_achou", F.lit(True)), SALE_KEY, "left").withColumn(
        "sem_retorno", F.col("_achou").isNull()
    ).drop("_achou")


def rescue_loss_flags(joined: DataFrame, photo: str) -> DataFrame:
    old, new = F.col(f"status_{photo}"), F.coalesce(F.trim("status_fechamento"), F.lit(""))

    def flag(was: str, became: str) -> Column:
        return F.when((old == was) & (new == became), 1).otherwise(0)

    return joined.withColumns(
        {"resgatado_baixa_tardia": flag("NAO APTO", "APTO"), "perdeu_aptidao": flag("APTO", "NAO APTO")}
    )


def contract_situation(joined: DataFrame) -> DataFrame:
    """One reading per sale; the first that applies."""
    cancelled = F.col("distrato_aprovado") == "Sim"
    situation = (
        F.when(F.col("sem_retorno"), NO_RETURN)
        .when(cancelled & (F.col("distrato_apos_fechamento") == 1), CANCELLED_AFTER)
        .when(cancelled, CANCELLED)
        .when(F.col("status_venda") == SETTLED, F.concat(F.lit(f"{SETTLED} - "), "status_fechamento"))
        .otherwise(F.col("status_fechamento"))
    )
    return joined.withColumn("situacao", situation)


def situation_report(situations: DataFrame, top: int = 10) -> DataFrame:
    """Counts by situation, rescues by status, test sales, cancellation categories, flags.

    Each sale names the report lines it belongs to; one aggregation counts them
    all, so the joins behind ``situations`` run once.
    """

    def line(section: str, label: Column, condition: Column | None = None) -> Column:
        entry = F.struct(F.lit(section).alias("secao"), F.coalesce(label, F.lit("")).alias("chave"))
        return entry if condition is None else F.when(condition, entry)

    lines = F.array_compact(
        F.array(
            line("situacao", F.col("situacao")),
            line("resgatado por status", F.col("status_venda"), F.col("resgatado_baixa_tardia") == 1),
            line("teste", F.lit("TESTE"), F.col("categoria_distrato").ilike("%teste%")),
            line("categoria", F.col("categoria_distrato"), F.col("distrato_aprovado") == "Sim"),
            line("cessao_hist", F.lit("Sim"), F.col("cessao_hist") == "Sim"),
            line("renegociacao_hist", F.lit("Sim"), F.col("renegociacao_hist") == "Sim"),
        )
    )
    counts = situations.select(F.inline(lines)).groupBy("secao", "chave").agg(F.count(F.lit(1)).alias("qtd"))
    rank = F.row_number().over(Window.partitionBy("secao").orderBy(F.desc("qtd"), "chave"))
    return counts.withColumn("_n", rank).where((F.col("secao") != "categoria") | (F.col("_n") <= top)).drop("_n")


def summary(left: DataFrame, right: DataFrame, before: str, after: str) -> DataFrame:
    """Sizes, coupons and eligible counts of both sides, and every kind of change.

    One pass over the full join: each sale is one row of it, on whichever side it is.
    """
    both = F.col("presenca") == "both"
    old, new = F.col(f"status_{before}"), F.col(f"status_{after}")
    old_coupons, new_coupons = F.col(f"cupons_casas_{before}"), F.col(f"cupons_casas_{after}")
    sides = []
    for name, other, status, coupon in (
        (before, "right_only", old, old_coupons),
        (after, "left_only", new, new_coupons),
    ):
        sides += [
            F.count_if(F.col("presenca") != other).alias(f"contratos_{name}"),
            F.coalesce(F.sum(coupon), F.lit(0.0)).alias(f"cupons_{name}"),
            F.count_if(status == "APTO").alias(f"aptos_{name}"),
        ]
    return compare(left, right).agg(
        F.count_if(both).alias("nos_dois"),
        F.count_if(F.col("presenca") == "left_only").alias("sairam"),
        F.count_if(F.col("presenca") == "right_only").alias("entraram"),
        F.count_if(both & (old == "NAO APTO") & (new == "APTO")).alias("recuperaram"),
        F.count_if(both & (old == "APTO") & (new == "NAO APTO")).alias("perderam"),
        F.count_if(both & (new_coupons > old_coupons)).alias("ganharam_cupons"),
        F.count_if(both & (new_coupons < old_coupons)).alias("perderam_cupons"),
        *sides,
    )
