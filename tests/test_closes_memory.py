"""A sale carries a few ranges through the joins, not a state for every cutoff."""

from datetime import date

from pyspark.sql import functions as F

from lastro.operators import closes as M
from lastro.sources import standin as S

KEY = "empresa int, obra string, num_venda long, num_parcela int, num_parcela_geral int, tipo string"


def test_open_instalments_are_ranges(spark):
    rows = [(1, "65001", 7, n, 0, "P", date(2026, 7, 10)) for n in range(1, 5)]
    receivables = spark.createDataFrame(rows, f"{KEY}, vencimento date")
    receipts = spark.createDataFrame([(1, "65001", 7, 4, 0, "P", date(2027, 3, 2))], f"{KEY}, pago_em date")
    money = ["val_parcela", "val_principal", "val_juros", "val_correcao", "val_juro_atraso", "val_multa_atraso"]
    valuations = spark.createDataFrame([], f"{KEY}, " + ", ".join(f"{name} decimal(18,4)" for name in money))
    windows = M.month_closes(date(2026, 7, 1), date(2026, 7, 1), 24)
    sale = M.open_by_cutoff(receivables, receipts, valuations, S.PORTFOLIO, windows).withColumn("n", F.size("abertas")).collect()
    assert len(sale) == 1 and sale[0].n == 2 and sale[0].qtd_p == 4
    assert sorted((span["de"], span["ate"]) for span in sale[0].abertas) == [(0, 8), (0, 24)]
