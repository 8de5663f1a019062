"""Data quality, refresh windows, convergence of a close, publication, lookup."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lastro.functions.ratios import ratio
from lastro.functions.text import fold_accents, is_one, is_yes, normalize_status
from lastro.params import RefreshSchedule
from lastro.schemas import GRAIN_KEY, MANDATORY, SALE_KEY

OK, WARNING, FAILURE, INFO = "ok", "aviso", "falha", "info"
MONEY_CHECKED = ("valor_total_recebido", "valor_principal")


def report(row: DataFrame, checks: list[tuple[str, Column, Column]]) -> DataFrame:
    """(check, value, level) rows out of one row of aggregates."""
    entries = F.array(
        *(
            F.struct(F.lit(name).alias("checagem"), value.cast("double").alias("valor"), level.alias("nivel"))
            for name, value, level in checks
        )
    )
    return row.select(F.inline(entries))


def level(condition: Column, bad: str) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), bad).otherwise(OK)


# Contract -------------------------------------------------------------------


def grain_duplicates(df: DataFrame) -> DataFrame:
    """Rows beyond the first per grain key, and their share of all rows."""
    key = [c for c in GRAIN_KEY if c in df.columns]
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    sums = counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("linhas"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicadas")
    )
    return sums.withColumn("razao", ratio(F.col("duplicadas"), F.col("linhas")))


def validate_contract(df: DataFrame, tolerated: float = 0.01) -> DataFrame:
    """Empty, missing columns, grain repeats and null money, one row per check."""
    missing = [c for c in MANDATORY if c not in df.columns]
    key = [c for c in GRAIN_KEY if c in df.columns]
    checked = [c for c in MONEY_CHECKED if c in df.columns]
    null_sums = [F.count_if(F.col(c).isNull()).alias(f"nulos_{c}") for c in checked]
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), *null_sums)
    row = counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("linhas"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicadas"),
        *(F.coalesce(F.sum(f"nulos_{c}"), F.lit(0)).alias(f"nulos_{c}") for c in checked),
    )
    repeats = F.col("duplicadas") if key else F.lit(0)
    absent = F.lit(len(missing))
    checks = [
        ("base vazia", F.col("linhas"), level(F.col("linhas") == 0, FAILURE)),
        (f"colunas ausentes: {', '.join(missing)}" if missing else "colunas ausentes", absent, level(absent > 0, FAILURE)),
        ("duplicadas no grao", repeats, level(ratio(repeats, F.col("linhas")) > tolerated, WARNING)),
        *((f"nulos em {c}", F.col(f"nulos_{c}"), level(F.col(f"nulos_{c}") > 0, WARNING)) for c in checked),
    ]
    return report(row, checks)


def _structure(official: DataFrame) -> DataFrame:
    """One row with everything the structural checks and the diagnosis ask."""
    settled, ceded = is_yes(F.col("contrato_quitado")), is_yes(F.col("contrato_cedido"))
    status = normalize_status(F.col("status_sorteio"))
    ruler = normalize_status(F.col("aptidao_sorteio"))
    after_close = is_one(F.col("distrato_apos_fechamento"))
    monthly = (normalize_status(F.col("aptidao_casas")) == "APTO") & (F.col("cupons_casas") > 0)
    final = (ruler == "APTO") & (F.col("cupons_milhao") > 0)
    sums = {
        "divergentes": F.count_if(status != ruler),
        "com_regua": F.count_if(ruler != ""),
        "resgatadas": F.count_if(settled | ceded),
        "distratadas": F.count_if(after_close),
        "distratadas_aptas": F.count_if(after_close & (status != "NAO APTO")),
        "negativos": F.count_if((F.col("cupons_casas") < 0) | (F.col("cupons_milhao") < 0)),
        "casas": F.sum("cupons_casas"),
        "milhao": F.sum("cupons_milhao"),
        "eleg_casas": F.count_if(monthly),
        "eleg_cupons_casas": F.sum(F.when(monthly, F.col("cupons_casas"))),
        "eleg_milhao": F.count_if(final),
        "eleg_cupons_milhao": F.sum(F.when(final, F.col("cupons_milhao"))),
    }
    marked = official.groupBy("codempresa", "codobra", "venda").agg(
        F.count(F.lit(1)).alias("n"), *(value.alias(name) for name, value in sums.items())
    )
    return marked.agg(
        F.sum("n").alias("base"), F.sum(F.col("n") - 1).alias("duplicadas"), *(F.sum(c).alias(c) for c in sums)
    )


def _structural(first_month: bool) -> list[tuple[str, Column, Column]]:
    """Checks over the row of ``_structure``."""
    gap = F.abs(F.col("milhao") - F.col("casas"))
    no_ruler = F.coalesce(F.col("com_regua"), F.lit(0)) == 0
    return [
        ("4.1 chaves duplicadas", F.col("duplicadas"), level(F.col("duplicadas") > 0, FAILURE)),
        ("4.2 status diferente da regua", F.col("divergentes"), level(no_ruler | (F.col("divergentes") > 0), FAILURE)),
        ("4.3 resgatadas", F.col("resgatadas"), F.lit(INFO)),
        (
            "4.4 distrato pos-fechamento apto",
            F.col("distratadas_aptas"),
            level(F.col("distratadas_aptas") > 0, FAILURE),
        ),
        ("4.5 milhao menos casas", gap, level(gap >= 1, FAILURE) if first_month else F.lit(INFO)),
        ("4.6 cupons negativos", F.col("negativos"), level(F.col("negativos") > 0, FAILURE)),
    ]


def structural_checks(official: DataFrame, first_month: bool) -> DataFrame:
    """Checks a closed base must pass before lists are drawn from it."""
    return report(_structure(official), _structural(first_month))


def one_line_diagnosis(official: DataFrame, month: str, first_month: bool) -> DataFrame:
    """The run in one row: failures, base size, both lists. The base is read once."""
    failed = [F.when(state == FAILURE, 1).otherwise(0) for _, _, state in _structural(first_month)]
    failures = sum(failed[1:], failed[0])

    def number(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    text = F.format_string(
        f"DIAGNOSTICO {month}: %s | base %d | casas %d eleg/%d cupons | milhao %d/%d",
        F.when(failures > 0, F.concat(failures.cast("string"), F.lit(" FALHAS"))).otherwise("OK"),
        *map(number, ("base", "eleg_casas", "eleg_cupons_casas", "eleg_milhao", "eleg_cupons_milhao")),
    )
    return _structure(official).select(text.alias("diagnostico"))


# Freshness ------------------------------------------------------------------


def with_window(df: DataFrame, ts: str, schedule: RefreshSchedule) -> DataFrame:
    """Refresh window of each UTC instant, and when the next one can be read."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(schedule.timezone), F.col(ts).cast("timestamp_ntz"))
    margin = F.make_dt_interval(mins=F.lit(schedule.margin_minutes))
    settled = F.col("_local") - margin
    today = F.col("_settled").cast("date").cast("timestamp_ntz")
    hours = sorted(schedule.hours)

    def at(day_shift: int, hour: int) -> Column:
        return today + F.make_dt_interval(days=F.lit(day_shift), hours=F.lit(hour))

    current, upcoming = at(-1, hours[-1]), at(0, hours[0])
    for i, hour in enumerate(hours):
        reached = F.col("_settled") >= at(0, hour)
        following = at(0, hours[i + 1]) if i + 1 < len(hours) else at(1, hours[0])
        current = F.when(reached, at(0, hour)).otherwise(current)
        upcoming = F.when(reached, following).otherwise(upcoming)
    return (
        df.withColumn("_local", local)
        .withColumn("_settled", settled)
        .withColumns({"janela": current, "proxima": upcoming + margin})
        .drop("_local", "_settled")
    )


def latest_per_window(df: DataFrame, ts: str, schedule: RefreshSchedule, payload: list[str]) -> DataFrame:
    """Rows per window and the last one: what a reader of the window gets."""
    windowed = with_window(df, ts, schedule)
    last = F.max(F.struct(F.col(ts), *(F.col(c) for c in payload))).alias("_ultimo")
    grouped = windowed.groupBy("janela", "proxima").agg(F.count(F.lit(1)).alias("linhas"), last)
    return grouped.select("janela", "proxima", "linhas", *(F.col(f"_ultimo.{c}").alias(c) for c in [ts, *payload]))


# Convergence ----------------------------------------------------------------


def close_convergence(log: DataFrame, measures: list[str], give_up_day: int = 7) -> DataFrame:
    """Is an execution identical to the one before? Unstable on the last day alerts.

    ``log`` has one row per month and execution day, so its windows are short.
    """
    order = Window.partitionBy("anomes").orderBy("dt_execucao")
    same = F.lag("dt_execucao").over(order).isNotNull()
    for name in measures:
        same = same & F.col(name).eqNullSafe(F.lag(name).over(order))
    state = (
        F.when(F.col("estavel"), "fechado")
        .when(F.dayofmonth("dt_execucao") >= give_up_day, "alerta")
        .otherwise("aberto")
    )
    return log.withColumn("estavel", same).withColumn("situacao", state)


def overdue_drop(log: DataFrame, order: str, value: str, threshold: float = 0.2) -> DataFrame:
    """Windows whose overdue amount fell by more than ``threshold``."""
    previous = F.lag(value).over(Window.orderBy(order))
    drop = F.try_divide((F.col("_antes") - F.col(value)).cast("double"), F.col("_antes").cast("double"))
    return (
        log.withColumn("_antes", previous)
        .withColumn("queda", drop)
        .select(order, value, F.col("_antes").alias("anterior"), "queda", F.coalesce(F.col("queda") > threshold, F.lit(False)).alias("alerta"))
    )


def eligible_publish(official: DataFrame, photo: DataFrame) -> DataFrame:
    """Publishable list: eligible with coupons, rescues by late posting marked.

    ``photo`` has one row per sale with ``status_foto``.
    """
    eligible = (normalize_status(F.col("aptidao_sorteio")) == "APTO") & (F.col("cupons_milhao") > 0)
    joined = official.where(eligible).join(photo.select(*SALE_KEY, "status_foto"), SALE_KEY, "left")
    rescued = F.when(F.col("status_foto") == "NAO APTO", 1).otherwise(0)
    return joined.select(*SALE_KEY, "cupons_milhao", "cupons_casas", rescued.alias("resgatado_baixa_tardia"))


def calculated_vs_official(df: DataFrame) -> DataFrame:
    """Calculated less official coupons, where an official number exists."""
    known = df.where("cupons_oficiais is not null")
    difference = F.col("cupons_calculados") - F.col("cupons_oficiais")
    return known.select(*SALE_KEY, "cpf_titular", "cupons_calculados", "cupons_oficiais", difference.alias("diferenca"))


def client_lookup(
    df: DataFrame, tax_id: str | None = None, name: str | None = None, phone: str | None = None, sale: str | None = None
) -> DataFrame:
    """Every contract row of the clients that match any given search term.

    The clients found are looked up in the frame, so a client found through one
    sale comes with all of them, one row each; a contract without a tax id comes
    by itself. Terms may be formatted: tax ids and phones are compared by their
    digits, names without accents and case.
    """
    digits = F.regexp_replace("telefone", r"\D", "")
    ids = F.regexp_replace("cpf_titular", r"\D", "")
    wanted_id, wanted_phone = (re.sub(r"\D", "", term or "") for term in (tax_id, phone))
    wanted_name = F.upper(F.trim(fold_accents(F.lit(name or ""))))
    terms = [
        condition
        for value, condition in (
            (wanted_id, ids == wanted_id.zfill(11)),
            ((name or "").strip(), F.upper(fold_accents(F.col("nome_cliente"))).contains(wanted_name)),
            (wanted_phone, digits.endswith(wanted_phone)),
            ((sale or "").strip(), F.col("num_venda") == (sale or "").strip()),
        )
        if value
    ]
    if not terms:
        raise ValueError("give at least one search term")
    found = terms[0]
    for term in terms[1:]:
        found = found | term
    matched = F.coalesce(found, F.lit(False))
    clients = df.where(matched & F.col("cpf_titular").isNotNull()).select("cpf_titular").distinct()
    rows = df.join(clients, "cpf_titular", "left_semi").unionByName(df.where(matched & F.col("cpf_titular").isNull()))
    return rows.select(
        "cpf_titular", "nome_cliente", *SALE_KEY, "cidade", "status_cadastro", "status_elegibilidade",
        "cupons_calculados", "cupons_oficiais", "valor_total_recebido",
    )
