"""Sales, their dimensions, items, people, transfers and cancellations.

Every right-hand side is reduced to one row per join key before it is joined,
so a sale is never multiplied except where the source relation itself repeats
(units and products). No join carries a broadcast hint: Spark broadcasts the
sides whose measured size allows it and shuffles the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lastro.params import (
    HISTORY_CANCELLATION,
    HISTORY_CESSION,
    HISTORY_RENEGOTIATION,
    OCCURRENCE_ACTIVE,
    OCCURRENCE_PASSIVE,
    STATUS_CANCELLED,
    STATUS_LIVE,
    STATUS_SETTLED,
    UNIT_UNAVAILABLE,
    Portfolio,
)
from lastro.schemas import SALE_KEY, SALE_ORDER


def in_universe(df: DataFrame, portfolio: Portfolio) -> DataFrame:
    """Rows whose development code starts with one of the portfolio prefixes."""
    return df.where(F.left("obra", F.lit(2)).isin(*portfolio.prefixes))


def keyed(df: DataFrame, key: list[str] = SALE_KEY) -> DataFrame:
    """The key in its published order, then the other columns."""
    return df.select(*key, *(c for c in df.columns if c not in key))


def first_per(df: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """First row per key under a total order. Ranks are cut off before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


# Sales ----------------------------------------------------------------------


def _net_sales(df: DataFrame, portfolio: Portfolio) -> DataFrame:
    net = F.col("valor_total") + F.col("acrescimo") - F.col("desconto")
    return in_universe(df, portfolio).select(
        *SALE_KEY, "data_venda", "data_cadastro", "status", "cliente", net.alias("valor_venda")
    )


def archived_only(live: DataFrame, archived: DataFrame) -> DataFrame:
    """Archived sales that are not (still) in the live table."""
    return keyed(archived.join(live.select(*SALE_ORDER).distinct(), SALE_ORDER, "left_anti"))


def all_sales(live: DataFrame, archived: DataFrame, portfolio: Portfolio) -> DataFrame:
    """Live sales plus the archived ones that are not live, without repeats."""
    current = _net_sales(live, portfolio)
    past = archived_only(live, _net_sales(archived, portfolio))
    return current.unionByName(past).distinct()


def ranked_sales(live: DataFrame, archived: DataFrame, portfolio: Portfolio) -> DataFrame:
    """One row per sale with its source; the live row wins."""
    columns = [*SALE_KEY, "status", "cliente"]
    tagged = [
        in_universe(df, portfolio).select(*columns, F.lit(source).alias("fonte_venda"), F.lit(rank).alias("ordem"))
        for df, source, rank in ((live, "VENDAS", 1), (archived, "VENDAS RECEBIDAS", 2))
    ]
    both = tagged[0].unionByName(tagged[1])
    return first_per(both, SALE_ORDER, F.col("ordem"), F.col("status"), F.col("cliente")).drop("ordem")


# Development dimension ------------------------------------------------------


def development_company(developments: DataFrame, companies: DataFrame) -> DataFrame:
    return developments.join(companies, "empresa")


def with_hierarchy(df: DataFrame, groups: DataFrame) -> DataFrame:
    """Group node, then its ancestors by code prefix (7 = city, 3 = regional)."""

    def level(name: str) -> DataFrame:
        return groups.select(F.col("codigo").alias(f"_{name}"), F.col("descricao").alias(name))

    node = groups.select(F.col("codigo").alias("grupo_no"))
    out = df.join(node, F.col("grupo") == F.col("grupo_no"), "left")
    for name, width in (("grupo_cidade", 7), ("grupo_regional", 3)):
        out = out.join(level(name), F.left("grupo_no", F.lit(width)) == F.col(f"_{name}"), "left").drop(f"_{name}")
    return out


def canonical_city(group: Column, registered: Column, portfolio: Portfolio) -> Column:
    """City of the group tree; administrative groups give way to the registered city."""
    administrative = group.isNull() | group.isin(*portfolio.admin_groups) | group.startswith(portfolio.admin_prefix)
    fallback = F.coalesce(F.nullif(F.upper(registered), F.lit("")), group)
    renamed = F.lit(None).cast("string")
    for district, city in portfolio.city_alias:
        renamed = F.when(group == district, F.lit(city)).otherwise(renamed)
    return F.coalesce(renamed, F.when(administrative, fallback).otherwise(group))


def development_dimension(
    developments: DataFrame, companies: DataFrame, groups: DataFrame, portfolio: Portfolio
) -> DataFrame:
    """One row per distinct description of a development, city and regional resolved."""
    joined = with_hierarchy(development_company(developments, companies), groups)
    raw = ["empresa", "obra", "obra_nome", "empresa_nome", "cidade_obra", "grupo_cidade", "grupo_regional"]
    city = canonical_city(F.col("grupo_cidade"), F.col("cidade_obra"), portfolio)
    return (
        joined.select(*raw)
        .distinct()
        .withColumns({"cidade": city, "regional": F.replace("grupo_regional", F.lit("REGIONAL"), F.lit(""))})
        .drop("cidade_obra", "grupo_cidade", "grupo_regional")
    )


def sale_rows(df: DataFrame) -> DataFrame:
    """Grouping by every column without an aggregate: exact repeats collapse."""
    return df.dropDuplicates(df.columns)


# Items, units, products, people ---------------------------------------------

_ITEM_ORDER = ("produto", "unidade")


def first_item(items: DataFrame) -> DataFrame:
    """One item per sale; the lowest product and unit, so reruns agree."""
    picked = first_per(items, SALE_ORDER, *(F.col(c).asc_nulls_last() for c in _ITEM_ORDER))
    return picked.select(*SALE_KEY, *_ITEM_ORDER)


def item_per_sale(live: DataFrame, archived: DataFrame) -> DataFrame:
    """The live item of a sale, else its archived one: one window over both tables."""
    tagged = live.withColumn("_fonte", F.lit(1)).unionByName(archived.withColumn("_fonte", F.lit(2)))
    order = [F.col("_fonte"), *(F.col(c).asc_nulls_last() for c in _ITEM_ORDER)]
    return first_per(tagged, SALE_ORDER, *order).select(*SALE_KEY, *_ITEM_ORDER)


def with_unit(df: DataFrame, units: DataFrame, portfolio: Portfolio) -> DataFrame:
    """Unit of the item, unless it is marked unavailable."""
    key = ["empresa", "obra", "produto", "unidade"]
    usable = in_universe(units, portfolio).where(F.col("vendido") != UNIT_UNAVAILABLE)
    found = usable.select(*key, "identificador", F.col("produto").alias("produto_unidade"))
    return df.join(found, key, "left")


def with_product(df: DataFrame, products: DataFrame) -> DataFrame:
    """Active product of the unit; a sale without one keeps its row.

    Sales without a unit get a key of their own that no product has, so they do
    not all meet on the null key.
    """
    active = products.where("status = 1 and produto is not null").select(
        F.struct(F.col("produto").alias("produto"), F.lit(None).cast("long").alias("sem")).alias("_chave"), "produto_nome"
    )
    alone = F.when(F.col("produto_unidade").isNull(), F.xxhash64(*SALE_KEY))
    keyed = df.withColumn("_chave", F.struct(F.col("produto_unidade").alias("produto"), alone.alias("sem")))
    return keyed.join(active, "_chave", "left").drop("_chave")


def with_client(df: DataFrame, people: DataFrame) -> DataFrame:
    return df.join(people.select("cliente", "nome", "cpf", "email"), "cliente", "left")


def clean_phone(col: Column) -> Column:
    """Drop blanks and punctuation, then everything before the first digit 1-9."""
    return F.regexp_replace(F.regexp_replace(F.trim(col), r"[-() ]", ""), r"^[^1-9]+", "")


def phone_numbers(phones: DataFrame) -> DataFrame:
    parts = phones.select("cliente", clean_phone(F.col("ddd")).alias("ddd"), clean_phone(F.col("fone")).alias("fone"))
    return parts.withColumn("completo", F.concat("ddd", "fone"))


def classify_phones(numbers: DataFrame) -> DataFrame:
    """Type of each number and its rank among the numbers of a person."""
    digits, lead = F.length("completo"), F.left("fone", F.lit(1))
    mobile = (digits == 11) & (lead == "9")
    short_mobile = (digits == 10) & lead.between("6", "9")
    landline = (digits == 10) & lead.between("2", "5")
    return numbers.withColumns(
        {
            "telefone": F.when(short_mobile, F.concat("ddd", F.lit("9"), "fone")).otherwise(F.col("completo")),
            "tipo_telefone": F.when(mobile, "Celular")
            .when(short_mobile, "Celular (corrigido)")
            .when(landline, "Fixo")
            .otherwise("Indefinido"),
            "prioridade": F.when(mobile, 1).when(short_mobile, 2).when(landline, 3).otherwise(4),
        }
    )


def best_phone(phones: DataFrame) -> DataFrame:
    ranked = classify_phones(phone_numbers(phones))
    picked = first_per(ranked, ["cliente"], F.col("prioridade"), F.col("telefone").asc_nulls_last())
    return picked.select("cliente", "telefone", "tipo_telefone")


def with_contact(df: DataFrame, people: DataFrame, phones: DataFrame) -> DataFrame:
    """Client and best phone in one join.

    Both sides are put together first: a client who holds many sales then skews a
    single join, which adaptive execution can split.
    """
    named = people.select("cliente", "nome", "cpf", "email")
    return df.join(named.join(best_phone(phones), "cliente", "full"), "cliente", "left")


# Legal occurrences ----------------------------------------------------------


def open_occurrences(occurrences: DataFrame) -> DataFrame:
    return occurrences.where((F.col("status") == 0) & F.col("ocorrencia").isin(OCCURRENCE_ACTIVE, OCCURRENCE_PASSIVE))


def legal_by_document(occurrences: DataFrame) -> DataFrame:
    """Open active and passive occurrences counted per document."""
    return open_occurrences(occurrences).groupBy("empresa", "documento").agg(
        F.count_if(F.col("ocorrencia") == OCCURRENCE_ACTIVE).alias("juridico_ativo"),
        F.count_if(F.col("ocorrencia") == OCCURRENCE_PASSIVE).alias("juridico_passivo"),
    )


def sale_document() -> Column:
    return F.concat(F.lit("VENDAS "), F.col("num_venda").cast("string"), F.lit("-"), F.col("obra"))


def legal_by_sale(occurrences: DataFrame) -> DataFrame:
    return keyed_by_document(legal_by_document(occurrences))


def keyed_by_document(documents: DataFrame) -> DataFrame:
    """Documents that name a sale, keyed by it.

    The sale key is read out of the (few) documents instead of being written
    into every sale, so this side joins on the key the sales are already
    partitioned by. Only documents that spell the key exactly are kept.
    """
    pattern = r"(?s)^VENDAS (\d+)-(.*)$"
    keyed = documents.withColumns(
        {
            "num_venda": F.regexp_extract("documento", pattern, 1).try_cast("long"),
            "obra": F.regexp_extract("documento", pattern, 2),
        }
    )
    return keyed.where(F.col("documento") == sale_document()).drop("documento")


# Transfers and cancellations ------------------------------------------------


def approved_cessions(history: DataFrame, portfolio: Portfolio) -> DataFrame:
    approved = (F.col("tipo_mnt") == HISTORY_CESSION) & F.col("data_aprovacao").isNotNull()
    return in_universe(history, portfolio).where(approved)


def cession_new_side(history: DataFrame, portfolio: Portfolio) -> DataFrame:
    """Per NEW sale the highest old number and, independently, the latest date."""
    named = approved_cessions(history, portfolio).where("num_nova is not null")
    grouped = named.groupBy("num_nova", "obra", "empresa").agg(
        F.max("num_venda").alias("venda_origem"), F.max("data_mnt").alias("data_cessao")
    )
    return keyed(grouped.withColumnRenamed("num_nova", "num_venda"))


def cession_old_side(history: DataFrame, portfolio: Portfolio) -> DataFrame:
    """Per OLD sale the highest new number and, independently, the latest date."""
    ceded = approved_cessions(history, portfolio).groupBy(*SALE_ORDER)
    return keyed(ceded.agg(F.max("num_nova").alias("venda_nova"), F.max("data_mnt").alias("data_cedida")))


def cession_latest(history: DataFrame, portfolio: Portfolio) -> DataFrame:
    """Per OLD sale the whole latest cession (approval, then number)."""
    latest = first_per(
        approved_cessions(history, portfolio), SALE_ORDER, F.desc("data_aprovacao"), F.desc_nulls_last("num_hist")
    )
    return latest.select(
        *SALE_KEY, F.col("data_mnt").alias("data_cedida"), "data_aprovacao", F.col("num_nova").alias("venda_nova")
    )


def history_flags(history: DataFrame, portfolio: Portfolio) -> DataFrame:
    def had(kind: int) -> Column:
        approved = (F.col("tipo_mnt") == kind) & F.col("data_aprovacao").isNotNull()
        return F.max(F.when(approved, 1).otherwise(0))

    return keyed(
        in_universe(history, portfolio)
        .groupBy(*SALE_ORDER)
        .agg(
            had(HISTORY_CANCELLATION).alias("teve_cancelamento"),
            had(HISTORY_RENEGOTIATION).alias("teve_renegociacao"),
            had(HISTORY_CESSION).alias("teve_cessao"),
        )
    )


def effective_cancellations(cancellations: DataFrame) -> DataFrame:
    return cancellations.where("tipo_aditivo = 0 and status_aprov = 1")


def cancellation_latest(cancellations: DataFrame) -> DataFrame:
    order = F.desc_nulls_last("data_cad"), F.desc_nulls_last("num_distrato")
    latest = first_per(effective_cancellations(cancellations), SALE_ORDER, *order)
    return latest.select(*SALE_KEY, "tipo_distrato", "categoria", "data_cad", "data_aprov")


def effective_day() -> Column:
    return F.coalesce("data_aprov", "data_cad")


def category_split(df: DataFrame, categories: DataFrame) -> DataFrame:
    """'KIND - REASON' split at the first ' - '; both '' when there is no category."""
    named = categories.select("categoria", F.col("descricao").alias("_descricao"))
    text = F.col("_descricao")
    at = F.instr(text, " - ")
    kind = F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise(text)
    reason = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))
    return (
        df.join(named, "categoria", "left")
        .withColumns(
            {
                "categoria_distrato": F.coalesce(F.trim(kind), F.lit("")),
                "motivo_distrato": F.when(text.isNull(), "").otherwise(F.trim(reason)),
            }
        )
        .drop("_descricao")
    )


def without_cancelled(df: DataFrame, cancellations: DataFrame) -> DataFrame:
    """Drop sales with any effective approved cancellation."""
    return keyed(df.join(effective_cancellations(cancellations).select(*SALE_ORDER).distinct(), SALE_ORDER, "left_anti"))


def without_cancelled_before(df: DataFrame, cancellations: DataFrame, cutoff) -> DataFrame:
    """Drop sales cancelled before the cutoff; an undated cancellation does not count."""
    before = effective_cancellations(cancellations).where(effective_day() < F.lit(cutoff))
    return keyed(df.join(before.select(*SALE_ORDER).distinct(), SALE_ORDER, "left_anti"))


def keep_members(df: DataFrame, portfolio: Portfolio, *more: Column) -> DataFrame:
    """Live sales; settled ones that paid; ceded ones that paid before ceding."""
    paid = F.col("teve_recebimento")
    member = (
        (F.col("status") == STATUS_LIVE)
        | ((F.col("status") == STATUS_SETTLED) & paid)
        | ((F.col("status") == STATUS_CANCELLED) & F.col("venda_nova").isNotNull() & paid)
    )
    for clause in more:
        member = member | clause
    return df.where(member & ~F.col("empresa").isin(*portfolio.excluded_companies))


def resolve_cession_chain(history: DataFrame, portfolio: Portfolio) -> DataFrame:
    """Each ceded sale walked along its cessions to the sale in force.

    Pointer doubling: a round joins every open link with the link its end points
    at, so the reach doubles per round; links that have reached an end are set
    aside and only looked up. A chain with links left to walk finishes some in
    every round, so a round that finishes none leaves cycles only; they come back
    with a null end and depth. Rounds are cut at checkpoints, so a lost executor
    replays one round. The loop reads no rows.
    """
    key, end = ["empresa", "obra"], F.col("num_venda").alias("fim")
    step = cession_latest(history, portfolio).where("venda_nova is not null")
    links = _stored(step.select(*SALE_KEY, F.col("venda_nova").alias("fim"), F.lit(1).cast("long").alias("passos")))
    starts = links.select(*key, end)
    done = links.join(starts, [*key, "fim"], "left_anti").select(*SALE_KEY, "fim", "passos")
    open_ = links.join(starts, [*key, "fim"], "left_semi").select(*SALE_KEY, "fim", "passos")
    done, open_ = _stored(done), _stored(open_)
    while not open_.isEmpty():
        ahead = done.withColumn("_acabou", F.lit(True)).unionByName(open_.withColumn("_acabou", F.lit(False)))
        onward = ahead.select(
            *key, end, F.col("fim").alias("_fim"), F.col("passos").alias("_passos"), "_acabou"
        )
        moved = _stored(
            open_.join(onward, [*key, "fim"]).select(
                *SALE_KEY, F.col("_fim").alias("fim"), (F.col("passos") + F.col("_passos")).alias("passos"), "_acabou"
            )
        )
        finished = moved.where("_acabou").drop("_acabou")
        if finished.isEmpty():
            break
        done, open_ = done.unionByName(finished), moved.where("not _acabou").drop("_acabou")
    return done.unionByName(
        open_.withColumns({"fim": F.lit(None).cast(links.schema["fim"].dataType), "passos": F.lit(None).cast("long")})
    ).select(*SALE_KEY, F.col("fim").alias("venda_vigente"), F.col("passos").alias("profundidade"))


def _stored(df: DataFrame) -> DataFrame:
    from lastro.sources.storage import checkpoint

    return checkpoint(df)
