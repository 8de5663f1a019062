"""Published snapshot (text amounts, text days, drifting columns) to the contract.

Every step is a column expression over one row, chosen by the columns the
snapshot has; the only aggregate is the development name of old snapshots.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lastro.functions.dates import competence, parse_day_first
from lastro.functions.money import parse_ingest, zero_amount
from lastro.functions.text import begins_with, normalize_name
from lastro.schemas import CONTRACT

# Snapshot column -> contract column.
RENAMES = {
    "codobra": "obra_codigo",
    "venda": "num_venda",
    "nomecliente": "nome_cliente",
    "cpf_pes": "cpf_titular",
    "emailcliente": "email",
    "telefoneformatado": "telefone",
    "data_ultimo_recebimento": "data_recebimento",
    "motivo": "motivo_bloqueio",
}
YES_NO_FLAGS = {
    "juridico_ativo": "juridico_ativo",
    "juridico_passivo": "juridico_passivo",
    "cessao": "flag_cessao",
    "contrato_quitado": "flag_contrato_quitado",
    "contrato_cedido": "flag_contrato_cedido",
    "antecipacao": "flag_antecipacao",
}


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def amount(df: DataFrame, name: str, fallback: Column | None = None) -> Column:
    """Amount column, text or numeric; ``fallback`` where the snapshot lacks it."""
    if name in df.columns:
        return parse_ingest(F.col(name), is_text(df, name))
    return zero_amount() if fallback is None else fallback


def whole_number(df: DataFrame, name: str) -> Column:
    """Integer column, text or numeric; unreadable, null and absent are 0."""
    if name not in df.columns:
        return F.lit(0).cast("long")
    number = F.col(name).cast("string").try_cast("double")
    return F.coalesce(number.cast("long"), F.lit(0).cast("long"))


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*(normalize_name(c) for c in df.columns))


def development_name(df: DataFrame) -> DataFrame:
    """``obra_nome`` from its own column, else one product name per code, else the code."""
    if "nomeobra" in df.columns:
        return df.withColumn("obra_nome", F.col("nomeobra"))
    named = df.where("produto is not null").groupBy("codobra").agg(F.min("produto").alias("_nome"))
    joined = df.join(named, "codobra", "left")
    return joined.withColumn("obra_nome", F.coalesce("_nome", F.col("codobra").cast("string"))).drop("_nome")


def rename_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({old: new for old, new in RENAMES.items() if old in df.columns})


def drop_test_rows(df: DataFrame, marker: str) -> DataFrame:
    """Drop sales to the company itself; rows without a client name stay."""
    is_test = F.upper("nome_cliente").contains(marker.upper())
    return df.where(~F.coalesce(is_test, F.lit(False)))


def received_amounts(df: DataFrame) -> DataFrame:
    total = amount(df, "valor_recebido")
    return df.withColumns(
        {
            "valor_total_recebido": total,
            "valor_vencido_antes": amount(df, "valor_inadimplencia"),
            "valor_elegivel": amount(df, "valor_gera_cupom", fallback=total),
        }
    )


def coerce_coupons(df: DataFrame) -> DataFrame:
    source = "cupons_milhao" if "cupons_milhao" in df.columns else "cupons_gerados"
    return df.withColumns(
        {"cupons_calculados": whole_number(df, source), "cupons_casas": whole_number(df, "cupons_casas")}
    )


def identifiers(df: DataFrame, default_company: str) -> DataFrame:
    columns = {
        "obra": F.col("obra_nome"),
        "num_venda": F.col("num_venda").cast("string"),
        "empresa": F.col("nomeempresa") if "nomeempresa" in df.columns else F.lit(default_company),
    }
    if "codempresa" in df.columns:
        columns["empresa_codigo"] = F.col("codempresa").cast("string")
    if "regional" in df.columns:
        columns["regional"] = F.trim("regional")
    if not is_text(df, "telefone"):
        columns["telefone"] = F.coalesce(F.col("telefone").cast("long").cast("string"), F.lit(""))
    return df.withColumns(columns)


def parse_days(df: DataFrame) -> DataFrame:
    columns = {"data_recebimento": parse_day_first(F.col("data_recebimento"))}
    if "dt_venda" in df.columns:
        columns["data_venda"] = parse_day_first(F.col("dt_venda"))
    stamp = F.col("snapshot_gerado_em") if "snapshot_gerado_em" in df.columns else F.lit(None)
    columns["data_ultima_atualizacao"] = stamp.cast("timestamp_ntz")
    return df.withColumns(columns)


def reference_month(df: DataFrame, as_of: date) -> DataFrame:
    month = F.coalesce(competence(F.col("data_recebimento")), F.lit(f"{as_of:%Y-%m}"))
    return df.withColumn("mes_referencia", month)


def is_apto(name: str) -> Column:
    return F.coalesce(F.upper(F.trim(F.col(name))) == "APTO", F.lit(False))


def final_ruler(df: DataFrame) -> Column:
    return is_apto("aptidao_sorteio" if "aptidao_sorteio" in df.columns else "status_sorteio")


def eligibility_flags(df: DataFrame) -> DataFrame:
    """Two rulers; a snapshot with one status uses it for both."""
    final = final_ruler(df)
    monthly = is_apto("aptidao_casas") if "aptidao_casas" in df.columns else final
    return df.withColumns(
        {
            "status_elegibilidade": F.when(final, "elegivel").otherwise("pendente"),
            "status_elegibilidade_casas": F.when(monthly, "elegivel").otherwise("pendente"),
            "status_cadastro": F.when(final, "cadastrado").otherwise("nao_cadastrado"),
            "flag_vencido": ~final,
            "participa_proximos_sorteios": final,
        }
    )


def recovered(df: DataFrame) -> Column:
    """Explicit mark, else 'paid while overdue', else a weak sign, else false."""
    if "recuperacao" in df.columns:
        mark = F.col("recuperacao").cast("string").try_cast("double")
        return F.coalesce(mark, F.lit(0.0)) > 0
    if "inadimplente_no_mes_pago" in df.columns:
        return begins_with(F.col("inadimplente_no_mes_pago"), "S")
    if "pagou_parcela_mes_anterior" in df.columns:
        return begins_with(F.col("pagou_parcela_mes_anterior"), "N") & final_ruler(df)
    return F.lit(False)


def recovery_class(df: DataFrame) -> DataFrame:
    return df.withColumn("classificacao_recebimento", F.when(recovered(df), "recuperacao").otherwise("normal"))


def recovered_amount(df: DataFrame) -> DataFrame:
    was_recovered = F.col("classificacao_recebimento") == "recuperacao"
    fallback = F.when(was_recovered, F.col("valor_total_recebido")).otherwise(zero_amount())
    return df.withColumn("valor_recuperado", amount(df, "valor_recuperado", fallback))


def launch_status(df: DataFrame) -> DataFrame:
    """Overdue at the launch of the campaign."""
    if "inad_junho" in df.columns:
        mark = F.coalesce(F.col("inad_junho").cast("string").try_cast("double"), F.lit(0.0)) > 0
        return df.withColumn("status_inadimplencia_antes", F.when(mark, "inadimplente").otherwise("adimplente"))
    if "status_inadimplencia_antes" in df.columns:
        return df
    return df.withColumn("status_inadimplencia_antes", F.lit("adimplente"))


def yes_no_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            flag: begins_with(F.col(source), "S") if source in df.columns else F.lit(False)
            for source, flag in YES_NO_FLAGS.items()
        }
    )


def days_late(df: DataFrame) -> DataFrame:
    return df.withColumn("dias_atraso", whole_number(df, "diasatraso"))


def contract_defaults(df: DataFrame) -> DataFrame:
    """Constants for what a snapshot does not tell apart."""
    return df.withColumns(
        {
            "valor_principal": F.col("valor_total_recebido"),
            "valor_multa": zero_amount(),
            "valor_juros": zero_amount(),
            "valor_custas": zero_amount(),
            "valor_antecipado": amount(df, "valor_antecipado"),
            "valor_juros_inadimplencia": amount(df, "valor_juros_inadimplencia"),
            "valor_multa_inadimplencia": amount(df, "valor_multa_inadimplencia"),
            "flag_negociacao": F.lit(False),
            "titular_principal": F.lit(True),
            "qtd_compradores": F.lit(1),
            "flag_contemplado_casa": F.lit(False),
            "qtd_parcelas_pagas": F.lit(0),
            "qtd_parcelas_vencidas": F.lit(0),
            "status_apos_pagamento": F.lit("adimplente"),
        }
    )


def to_contract(df: DataFrame) -> DataFrame:
    """Contract columns first, cast to their types; absent ones null; extras kept."""
    fixed = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in CONTRACT.fields
    ]
    known = set(CONTRACT.fieldNames())
    return df.select(*fixed, *(F.col(c) for c in df.columns if c not in known))


def bronze_to_contract(raw: DataFrame, as_of: date, test_marker: str, default_company: str = "") -> DataFrame:
    """All steps. ``test_marker`` is the company name that marks internal test sales."""
    named = rename_columns(development_name(normalize_columns(raw)))
    amounts = coerce_coupons(received_amounts(drop_test_rows(named, test_marker)))
    dated = reference_month(parse_days(identifiers(amounts, default_company)), as_of)
    ruled = recovered_amount(recovery_class(eligibility_flags(dated)))
    return to_contract(contract_defaults(days_late(yes_no_flags(launch_status(ruled)))))
