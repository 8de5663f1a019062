"""Streaming queries, run over the events until no input is left."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from lastro.plans.contracts import CESSAO
from lastro.plans.ledger import TOTAIS
from lastro.plans.oracle_tables import KEY, dbl, with_tables
from lastro.plans.registry import Section
from lastro.sources import standin as S
from lastro.sources.storage import run_folder
from lastro.streaming import cessions as Y
from lastro.streaming import receipts as X

section = Section()
CUTOFF = date(2024, 1, 15)
_SIGNED = "case when event_type = 'error' then -value else value end"


def _events(spark, sf):
    schema = S.table(spark, sf, "events").schema
    stream = X.read_stream(spark, sf, schema, "events.parquet")
    signed = F.when(F.col("event_type") == "error", -F.col("value")).otherwise(F.col("value"))
    return stream.withColumn("valor", signed.cast("decimal(18,4)"))


def _sink(spark, name: str) -> tuple[str, str]:
    root = run_folder(spark, name)
    return f"{root}/saida", f"{root}/checkpoint"


@section.query(
    "stream_receipts_daily",
    f"""select cast(ts as date) as dia, count(*) as recebimentos,
    {dbl(f"sum(cast({_SIGNED} as decimal(18,4)))", "valor")} from events group by 1""",
)
def stream_receipts_daily(spark, sf):
    path, checkpoint = _sink(spark, "diario")
    X.run_available(X.daily_sums(_events(spark, sf), "ts", "valor"), path, checkpoint, "update", ["dia"])
    return X.current(spark, path, ["dia"])


@section.query(
    "stream_coupons_by_contract",
    f"""select user_id, {dbl("v", "valor")}, cast(case when v > 0 then floor(v / 100) else 0 end as bigint) as cupons
    from (select user_id, sum(cast({_SIGNED} as decimal(18,4))) as v from events group by user_id)""",
)
def stream_coupons_by_contract(spark, sf):
    path, checkpoint = _sink(spark, "contrato")
    X.run_available(X.contract_totals(_events(spark, sf), "user_id", "valor"), path, checkpoint, "update", ["user_id"])
    return X.contract_coupons(spark, path, "user_id")


@section.query(
    "stream_late_postings",
    "select event_id, case when ts < timestamp '2024-01-15' then 'correcao' else 'corrente' end as destino from events",
)
def stream_late_postings(spark, sf):
    path, checkpoint = _sink(spark, "tardias")
    X.run_available(X.route_late(_events(spark, sf), "ts", CUTOFF), path, checkpoint, "append")
    return spark.read.parquet(path).select("event_id", "destino")


_CUT = ["valor_recebido", "valor_gera_cupom", "valor_cupom_mes", "valor_recebido_mes", "valor_antecipado", "valor_recuperado"]


@section.query(
    "stream_cession_cut",
    with_tables(
        f"""select {KEY}, {", ".join(dbl(f"coalesce({name}, 0)", name) for name in _CUT)}, pagou_vencida_antes, antecipou, recuperou,
        ultimo_recebimento from totais""",
        CESSAO,
        TOTAIS,
    ),
)
def stream_cession_cut(spark, sf):
    """Receipts first, the cessions that cut them afterwards."""
    root = run_folder(spark, "cessoes")
    live = S.LIVE
    totals = Y.CededTotals(spark, root, S.PORTFOLIO, live.start, live.end, live.month_start, buckets=16)
    for name, make, take in (("lineitem", S.receipts_of, totals.on_receipts), ("orders", S.history_of, totals.on_cessions)):
        stream = X.read_stream(spark, sf, S.table(spark, sf, name).schema, f"{name}.parquet")
        Y.run_available(make(stream), take, f"{root}/checkpoint-{name}")
    return totals.current()
