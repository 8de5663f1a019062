"""Money per sale from a stream of receipts that a stream of cessions cuts afterwards.

Receipts of a ceded sale count up to the day before it was ceded, and the cession may arrive
long after the receipts it takes away. So receipts are kept per sale and payment day, as
sums, beside the cessions; a micro-batch of either adds what it brings and works out anew
the totals of the sales it names, from their buckets. State and totals are bucket tables;
a replayed batch adds nothing twice and finishes what it had begun. The two streams take
turns, as a table has one writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lastro.operators import contracts as C
from lastro.operators import ledger as L
from lastro.params import Portfolio
from lastro.schemas import SALE_KEY
from lastro.sources.buckets import BucketTable

_AMOUNTS = ["cheio", "base", "valor_antecipado", "valor_recuperado"]
_MARKS = ["pagou_vencida_antes", "antecipou", "recuperou"]
_TOTALS = [
    "valor_recebido", "valor_gera_cupom", "valor_cupom_mes", "valor_recebido_mes", *_MARKS, "valor_antecipado", "valor_recuperado",
    "ultimo_recebimento",
]


class CededTotals:
    """Totals of the campaign [start, end) and of the month that starts on ``month_start``, below a folder."""

    def __init__(
        self, spark: SparkSession, path: str, portfolio: Portfolio, start: date, end: date, month_start: date, buckets: int = 64
    ) -> None:
        self.portfolio, self.start, self.end, self.month_start = portfolio, start, end, month_start
        day = [*SALE_KEY, "pago_em"]
        self.receipts = BucketTable(spark, f"{path}/recebidas", day, SALE_KEY, buckets, ["linhas", *_AMOUNTS, *_MARKS], "linhas")
        self.cessions = BucketTable(spark, f"{path}/cessoes", [*SALE_KEY, "num_nova", "data_mnt"], SALE_KEY, buckets, ["vezes"], "vezes")
        self.totals = BucketTable(spark, f"{path}/totais", SALE_KEY, SALE_KEY, buckets)

    def on_receipts(self, batch: DataFrame, number: int) -> None:
        rows = L.receipts_in_window(batch, self.portfolio, self.start, self.end)
        daily = L.daily_receipts(rows, self.start)
        counted = rows.groupBy(*SALE_KEY, "pago_em").agg(F.count(F.lit(1)).alias("linhas"))
        told = daily.join(counted, [*SALE_KEY, "pago_em"])
        # A sum over amounts that are all null is no amount.
        told = told.withColumns({name: F.coalesce(name, F.lit(0).cast(told.schema[name].dataType)) for name in _AMOUNTS})
        told = told.withColumns({name: F.col(name).cast("long") for name in _MARKS})
        self._take(self.receipts, told.select(*SALE_KEY, "pago_em", "linhas", *_AMOUNTS, *_MARKS), number)

    def on_cessions(self, batch: DataFrame, number: int) -> None:
        rows = C.approved_cessions(batch, self.portfolio).groupBy(*SALE_KEY, "num_nova", "data_mnt")
        self._take(self.cessions, rows.agg(F.count(F.lit(1)).alias("vezes")), number)

    def _take(self, table: BucketTable, rows: DataFrame, number: int) -> None:
        """Add the rows, then the totals of their sales."""
        rows = rows.persist()
        try:
            table.write(rows, number)
            self._work_out(rows.select(*SALE_KEY).distinct())
            for each in (table, self.totals):
                each.compact()
                each.clean()
        finally:
            rows.unpersist()

    def _held(self, table: BucketTable, buckets: list[int]) -> DataFrame | None:
        return table.read(buckets) if table.manifest().schema is not None else None

    def _work_out(self, sales: DataFrame) -> None:
        buckets = self.totals.touched(sales)
        daily, cessions = self._held(self.receipts, buckets), self._held(self.cessions, buckets)
        if not buckets or daily is None:
            return
        daily = daily.join(sales, SALE_KEY, "left_semi")
        if cessions is not None:
            ceded = cessions.groupBy(*SALE_KEY).agg(F.max("data_mnt").alias("data_cedida"))
            daily = L.before_cession(daily, ceded)
        marked = daily.withColumns({name: (F.col(name) > 0).cast("int") for name in _MARKS})
        # A sale that a cession leaves without receipts keeps a row that says so.
        found = sales.join(L.receipts_by_sale(marked, self.month_start).withColumn("recebeu", F.lit(True)), SALE_KEY, "left")
        self.totals.write(found.select(*SALE_KEY, *_TOTALS, F.coalesce("recebeu", F.lit(False)).alias("recebeu")))

    def current(self) -> DataFrame:
        """The totals as of what has arrived; sales without receipts that count are absent."""
        return self.totals.read().where("recebeu").drop("recebeu")


def run_available(stream: DataFrame, take: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Process what is there, then stop. The same call resumes from the checkpoint."""
    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
