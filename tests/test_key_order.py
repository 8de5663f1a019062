"""Joins sort by the sale number first; products of wide decimals are worked out only for numbers above one."""

import re
from decimal import Decimal

from pyspark.sql import functions as F

from lastro.operators import base as B
from lastro.operators import ledger as L
from lastro.sources import standin as S

SF = "/root/testdata/sf0.001"


def test_sorts_of_a_close_begin_with_the_sale_number(spark, capsys):
    B.close_core(S.erp(spark, SF), S.PORTFOLIO, S.CLOSE).explain()
    sorts = re.findall(r"Sort \[(\w+)#", capsys.readouterr().out)
    assert sorts and "num_venda" in sorts and "empresa" not in sorts


def test_times_is_the_product(spark):
    rows = [(n, None if v is None else Decimal(v)) for n in (None, 0, 1, 2, 7) for v in (None, "0", "-3.25", "12345678901234.5678")]
    frame = spark.createDataFrame(rows, "n long, v decimal(28,4)")
    out = frame.select(L._times(F.col("n"), F.col("v")).alias("a"), (F.col("n") * F.col("v")).alias("b"))
    assert out.schema["a"].dataType == out.schema["b"].dataType
    assert all(row.a == row.b for row in out.collect())
