"""Many closes in one pass: the rows of as many single closes, and the ledgers read as often as for one."""

from datetime import date
from decimal import Decimal

import pytest

from lastro.operators import base as B
from lastro.operators import closes as M
from lastro.params import CloseWindow
from lastro.plans.closes import WINDOWS
from lastro.sources import standin as S

SF = "/root/testdata/sf0.001"


def test_twelve_closes_equal_twelve_runs(spark):
    erp = S.erp(spark, SF)
    found = {}
    for row in M.close_months_core(erp, S.PORTFOLIO, WINDOWS).collect():
        found.setdefault(row["corte"], []).append(tuple(row)[1:])
    assert sorted(found) == [window.cutoff for window in WINDOWS]
    for window in WINDOWS:
        alone = B.close_core(erp, S.PORTFOLIO, window)
        assert sorted(map(repr, found[window.cutoff])) == sorted(repr(tuple(row)) for row in alone.collect())


def test_published_columns_are_those_of_one_close(spark):
    erp = S.erp(spark, SF)
    several = M.close_months(erp, S.PORTFOLIO, WINDOWS[:2])
    alone = B.contract_base_close(erp, S.PORTFOLIO, WINDOWS[1])
    mine = several.where(several["corte"] == WINDOWS[1].cutoff).drop("corte")
    assert mine.columns == alone.columns
    assert sorted(map(repr, mine.collect())) == sorted(map(repr, alone.collect()))


def test_ledgers_are_read_as_often_as_for_one_close(spark):
    def scans(frame):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("l_shipdate"), plan.count("Relation")

    erp = S.erp(spark, SF)
    twelve, one = (M.close_months_core(erp, S.PORTFOLIO, windows) for windows in (WINDOWS, WINDOWS[:1]))
    alone = B.close_core(erp, S.PORTFOLIO, WINDOWS[0])
    assert scans(twelve)[1] == scans(one)[1] <= scans(alone)[1]


@pytest.mark.parametrize(
    "windows",
    [
        [],
        [CloseWindow(date(2026, 7, 1), date(2026, 7, 1), date(2026, 8, 1)), CloseWindow(date(2026, 6, 1), date(2026, 8, 1), date(2026, 9, 1))],
        [CloseWindow(date(2026, 7, 1), date(2026, 7, 1), date(2026, 8, 1)), CloseWindow(date(2026, 7, 1), date(2026, 7, 1), date(2026, 9, 1))],
        [CloseWindow(date(2026, 7, 1), date(2026, 6, 1), date(2026, 7, 1))],
    ],
)
def test_closes_that_do_not_go_together_are_refused(spark, windows):
    with pytest.raises(ValueError):
        M.close_months_core(S.erp(spark, SF), S.PORTFOLIO, windows)


LATE = """empresa int, obra string, num_venda long, num_parcela int, num_parcela_geral int, tipo string, vencimento date, pago_em date,
principal decimal(18,4), juros_parcela decimal(18,4), correcao decimal(18,4), acrescimo decimal(18,4), taxa_boleto decimal(18,4),
multa decimal(18,4), juros_atraso decimal(18,4), correcao_atraso decimal(18,4), desconto decimal(18,4),
desconto_custa decimal(18,4), desconto_imposto decimal(18,4), desconto_condicional decimal(18,4)"""


def test_late_rows_and_reversals_fall_into_their_ranges(spark):
    """Paid two months late, reversed a month later, paid again on a cutoff; a fee; a receipt without a due day."""

    def row(due, paid, amount, kind="P"):
        return (1, "65001", 7, 1, 0, kind, due, paid, *(Decimal(amount if i == 0 else 0) for i in range(12)))

    rows = [
        row(date(2026, 7, 10), date(2026, 9, 5), 100),
        row(date(2026, 7, 10), date(2026, 10, 5), -100),
        row(date(2026, 7, 10), date(2026, 11, 1), 250),
        row(date(2026, 6, 1), date(2026, 12, 3), 5, "1"),
        row(None, date(2026, 8, 2), 40),
    ]
    receipts = spark.createDataFrame(rows, LATE)
    ceded = spark.createDataFrame([], "empresa int, obra string, num_venda long, data_cedida date")
    windows = M.month_closes(date(2026, 7, 1), date(2026, 7, 1), 6)
    found = M.receipts_by_cutoff(receipts, ceded, S.PORTFOLIO, windows).collect()
    state = found[0]["recebimentos"]
    assert found[0]["pagou_vencida_antes"] == 1 and len(found) == 1
    assert {k: state[k]["valor_recebido"] for k in state} == {0: None, 1: 40, 2: 140, 3: 40, 4: 290, 5: 290}
    assert {k: state[k]["valor_recebido_mes"] for k in state} == {0: None, 1: 40, 2: 100, 3: -100, 4: 250, 5: None}
    # Owed at every cutoff from August on: the last receipt of July's instalment comes on 1 November, the fee's in December.
    assert [state[k]["paga_depois"] for k in range(6)] == [1, 1, 1, 1, 1, None]
