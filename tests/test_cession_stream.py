"""The cession cut in the stream equals the batch operator, whatever comes first."""

import uuid

import pytest
from pyspark.sql import functions as F

from lastro.operators import contracts as C
from lastro.operators import ledger as L
from lastro.sources import standin as S
from lastro.streaming.cessions import CededTotals

SF = "/root/testdata/sf0.001"


def content(frame, names):
    plain = [F.coalesce(F.col(f.name).cast("double"), F.lit(0.0)) if "decimal" in f.dataType.simpleString() else F.col(f.name) for f in frame.select(*names).schema.fields]
    return sorted(repr(tuple(row)) for row in frame.select(*plain).collect())


@pytest.mark.parametrize("order", ["receipts first", "cessions first", "mixed"])
def test_equals_the_batch_operator_in_any_order(spark, tmp_path, order):
    live = S.LIVE
    totals = CededTotals(spark, f"{tmp_path}/{uuid.uuid4().hex}", S.PORTFOLIO, live.start, live.end, live.month_start, buckets=4)
    receipts, history = S.receipts(spark, SF), S.history(spark, SF)
    turn = F.pmod(F.xxhash64("num_venda", "num_parcela", "pago_em"), F.lit(3))
    feeds = {
        "receipts first": [("r", receipts, 0), ("c", history, 0)],
        "cessions first": [("c", history, 0), ("r", receipts, 0)],
        "mixed": [("r", receipts.where(turn == 0), 0), ("c", history.where("num_venda % 40 = 0"), 0), ("r", receipts.where(turn == 1), 1),
                  ("r", receipts.where(turn == 1), 1), ("c", history.where("num_venda % 40 <> 0"), 1), ("c", history.where("num_venda % 40 <> 0"), 1),
                  ("r", receipts.where(turn == 2), 2)],
    }[order]
    for kind, rows, number in feeds:
        (totals.on_receipts if kind == "r" else totals.on_cessions)(rows, number)
    expected = L.campaign_receipts(receipts, C.cession_old_side(history, S.PORTFOLIO), S.PORTFOLIO, live.start, live.end, live.month_start)
    found = totals.current()
    assert content(found, expected.columns) == content(expected, expected.columns)
    cut = L.campaign_receipts(receipts, C.cession_old_side(history.limit(0), S.PORTFOLIO), S.PORTFOLIO, live.start, live.end, live.month_start)
    assert content(cut, expected.columns) != content(expected, expected.columns)  # the cessions do cut something


def test_a_batch_that_died_before_the_totals_is_finished(spark, tmp_path, monkeypatch):
    live = S.LIVE
    totals = CededTotals(spark, f"{tmp_path}/t", S.PORTFOLIO, live.start, live.end, live.month_start, buckets=4)
    receipts = S.receipts(spark, SF)
    with monkeypatch.context() as broken:
        broken.setattr(totals.totals, "write", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            totals.on_receipts(receipts, 0)
    totals.on_receipts(receipts, 0)
    none = C.cession_old_side(S.history(spark, SF).limit(0), S.PORTFOLIO)
    expected = L.campaign_receipts(receipts, none, S.PORTFOLIO, live.start, live.end, live.month_start)
    assert content(totals.current(), expected.columns) == content(expected, expected.columns)
