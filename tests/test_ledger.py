"""Traps of the ledger: fees, cession cut, valuation repeats, hot sales, chains."""

import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from lastro.operators import audits as A
from lastro.operators import contracts as C
from lastro.operators import eligibility as R
from lastro.operators import ledger as L
from lastro.params import LiveWindow, Portfolio

P = Portfolio()
W = LiveWindow()
KEY = "empresa int, obra string, num_venda long"
KEY6 = f"{KEY}, num_parcela int, num_parcela_geral int, tipo string"
RECEIPT = f"""{KEY6}, pago_em date, vencimento date, principal decimal(18,4), juros_parcela decimal(18,4),
  correcao decimal(18,4), acrescimo decimal(18,4), taxa_boleto decimal(18,4), multa decimal(18,4),
  juros_atraso decimal(18,4), correcao_atraso decimal(18,4), desconto decimal(18,4), desconto_custa decimal(18,4),
  desconto_imposto decimal(18,4), desconto_condicional decimal(18,4)"""
HISTORY = f"{KEY}, num_hist int, tipo_mnt int, data_mnt date, data_aprovacao date, num_nova long"


def receipt(sale, paid, due, amount, kind="P", fine=0, parcel=1):
    money = [Decimal(amount), 0, 0, 0, 0, Decimal(fine), 0, 0, 0, 0, 0, 0]
    return (1, "65001", sale, parcel, 0, kind, paid, due, *(Decimal(m) for m in money))


def receipts(spark, rows):
    return spark.createDataFrame(rows, RECEIPT)


def history(spark, rows):
    return spark.createDataFrame([(1, "65001", *row) for row in rows], HISTORY)


def open_rows(spark, rows):
    return spark.createDataFrame([(1, "65001", *row) for row in rows], f"{KEY6}, vencimento date")


def valuations(spark, rows):
    names = ("val_parcela", "val_principal", "val_juros", "val_correcao", "val_juro_atraso", "val_multa_atraso")
    schema = ", ".join(f"{name} decimal(18,4)" for name in names)
    return spark.createDataFrame(
        [(1, "65001", *row[:4], *(None if v is None else Decimal(v) for v in row[4:])) for row in rows], f"{KEY6}, {schema}"
    )


def receivable_totals(spark, open_, values, paid=None):
    rows = L.open_by_instalment(open_rows(spark, open_), P, W.as_of, W.start)
    if paid is not None:
        rows = L.drop_paid(rows, paid)
    valued = L.valuation_by_instalment(valuations(spark, values), P)
    return {r.num_venda: r for r in L.receivables_by_sale(rows, valued, P, W.as_of).collect()}


def test_overdue_flag_counts_fees_and_the_amount_does_not(spark):
    row = receivable_totals(spark, [(1, 1, 0, "1", date(2026, 8, 1))], [(1, 1, 0, "1", 50, 40, 5, 5, 1, 1)])[1]
    assert (row.inadimplente, row.dias_atraso, row.valor_inadimplente, row.valor_a_receber) == (1, 10, 0, 0)


def test_due_on_the_day_is_not_overdue(spark):
    row = receivable_totals(spark, [(1, 1, 0, "P", W.as_of)], [(1, 1, 0, "P", 50, 40, 5, 5, 1, 1)])[1]
    assert row.inadimplente is None and row.dias_atraso is None and row.valor_a_receber == 50


def test_repeated_keys_give_what_a_left_join_gives(spark):
    rng = random.Random(7)
    kinds = ["1", "P", "S"]
    open_ = [(rng.randint(1, 4), rng.randint(1, 2), 0, rng.choice(kinds), date(2026, 8, rng.randint(1, 20))) for _ in range(60)]
    values = [
        (rng.randint(1, 4), rng.randint(1, 2), 0, rng.choice(kinds), *(rng.choice([None, rng.randint(1, 99)]) for _ in range(6)))
        for _ in range(40)
    ]
    expected = defaultdict(lambda: {"a_receber": 0, "vencido": 0, "qtd_p": 0})
    for sale, *rest, due in open_:
        total = expected[sale]
        for match in [v for v in values if v[:4] == (sale, *rest)] or [(*rest, None, None, None, None, None, None, None)]:
            parcel, *parts = match[-6:]
            total["qtd_p"] += rest[-1] == "P"
            if rest[-1] != "1":
                total["a_receber"] += parcel or 0
                total["vencido"] += sum(p or 0 for p in parts[:3]) if due < W.as_of else 0
    for sale, row in receivable_totals(spark, open_, values).items():
        got = {"a_receber": row.valor_a_receber or 0, "vencido": row.valor_inadimplente, "qtd_p": row.qtd_p}
        assert got == expected[sale]


def test_late_posting_rescue(spark):
    paid = L.paid_before(receipts(spark, [receipt(1, date(2026, 7, 20), date(2026, 7, 10), 9)]), P, W.as_of)
    open_ = [(1, 1, 0, "P", date(2026, 7, 10)), (2, 1, 0, "P", date(2026, 7, 10))]
    rows = receivable_totals(spark, open_, [(1, 1, 0, "P", 5, 5, 0, 0, 0, 0)], paid)
    assert rows[1].inadimplente is None and rows[1].valor_inadimplente == 0 and rows[1].qtd_p == 1
    assert rows[2].inadimplente == 1


def totals(spark, rows, cessions=()):
    ceded = C.cession_old_side(history(spark, list(cessions)), P)
    done = L.campaign_receipts(receipts(spark, rows), ceded, P, W.start, W.end, W.month_start)
    return {r.num_venda: r for r in done.collect()}


def test_cession_cut_is_strict_and_uses_the_latest_date(spark):
    cut = date(2026, 8, 5)
    cessions = [
        (1, 1, 2, date(2026, 7, 20), date(2026, 7, 21), 9),
        (1, 2, 2, cut, date(2026, 8, 6), 8),
        (1, 3, 2, date(2026, 12, 1), None, 7),
    ]
    days = [cut - timedelta(days=1), cut, cut + timedelta(days=1)]
    got = totals(spark, [receipt(1, day, day, 100) for day in days], cessions)
    assert got[1].valor_recebido == 100


def test_full_and_base_amounts_differ_by_the_charges(spark):
    row = totals(spark, [receipt(1, date(2026, 8, 2), date(2026, 7, 1), 100, fine=30)])[1]
    assert (row.valor_recebido, row.valor_gera_cupom, row.recuperou, row.valor_recuperado) == (130, 100, 1, 130)


def test_anticipation_is_monthly_and_recovery_daily(spark):
    rows = [
        receipt(1, date(2026, 8, 1), date(2026, 8, 31), 10),
        receipt(2, date(2026, 7, 31), date(2026, 8, 1), 10),
        receipt(3, date(2026, 8, 2), date(2026, 8, 2), 10),
    ]
    got = totals(spark, rows)
    assert [(got[s].antecipou, got[s].recuperou) for s in (1, 2, 3)] == [(0, 0), (1, 0), (0, 0)]


def test_hot_sale_totals(spark):
    """A third of all receipts on one sale: the same totals as summing row by row."""
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        paid = W.start + timedelta(days=rng.randint(0, 60))
        rows.append(receipt(1 if i % 3 == 0 else i + 10, paid, paid + timedelta(days=rng.randint(-40, 40)), rng.randint(1, 500)))
    got = totals(spark, rows)
    hot = [r for r in rows if r[2] == 1]
    assert got[1].valor_recebido == sum(r[8] for r in hot)
    assert got[1].valor_recuperado == sum(r[8] for r in hot if r[6] > r[7])
    assert got[1].valor_recebido_mes == sum(r[8] for r in hot if r[6] >= W.month_start)
    assert len(got) == 1 + sum(1 for i in range(3000) if i % 3)


def test_hot_sale_in_the_cession_audit(spark):
    """Pairs of cessions and receipts are counted without being formed."""
    cession_days = [date(2026, 7, 10), date(2026, 7, 20), date(2026, 7, 20)]
    cessions = [(1, i, 2, day, day, 50 + i) for i, day in enumerate(cession_days)]
    paid_days = [date(2026, 7, 1) + timedelta(days=i % 30) for i in range(300)]
    report = A.technical_receipts(
        history(spark, cessions), receipts(spark, [receipt(1, d, d, 2) for d in paid_days]), P, W, new_side=False
    )
    pairs = [(c, p) for c in cession_days for p in paid_days]
    expected = [sum(p < c for c, p in pairs), sum(p == c for c, p in pairs), sum(p > c for c, p in pairs)]
    got = sorted(report.collect(), key=lambda r: r.posicao)
    assert [r.qtd_linhas for r in got] == expected and {r.qtd_vendas for r in got} == {1}
    assert [r.valor_recebido for r in got] == [2 * n for n in expected]


def test_independent_maxima_and_whole_latest_row(spark):
    rows = [(1, 1, 2, date(2026, 9, 1), date(2026, 7, 1), 90), (1, 2, 2, date(2026, 8, 1), date(2026, 8, 2), 10)]
    mixed = C.cession_old_side(history(spark, rows), P).collect()[0]
    whole = C.cession_latest(history(spark, rows), P).collect()[0]
    assert (mixed.venda_nova, mixed.data_cedida) == (90, date(2026, 9, 1))
    assert (whole.venda_nova, whole.data_cedida) == (10, date(2026, 8, 1))


def test_cession_chains_of_any_length_and_cycles(spark):
    day = date(2026, 7, 1)
    rows = [(n, 1, 2, day, day, n + 1) for n in range(1, 101)]
    rows += [(500, 1, 2, day, day, 501), (501, 1, 2, day, day, 500), (700, 1, 2, day, day, 50)]
    got = {r.num_venda: r for r in C.resolve_cession_chain(history(spark, rows), P).collect()}
    assert (got[1].venda_vigente, got[1].profundidade) == (101, 100)
    assert (got[700].venda_vigente, got[700].profundidade) == (101, 52)
    assert got[500].venda_vigente is None and got[501].profundidade is None


def test_two_open_occurrences_do_not_read_as_one(spark):
    frame = spark.createDataFrame([(1,), (2,), (None,)], "juridico_ativo long").withColumn("juridico_passivo", F.lit(0))
    assert [r.juridico_ativo for r in frame.select(R.legal_columns()["juridico_ativo"].alias("juridico_ativo")).collect()] == [
        "Sim",
        "Não",
        "Não",
    ]


def test_undated_cancellation_is_neither_before_nor_after(spark):
    schema = f"{KEY}, num_distrato int, tipo_aditivo int, status_aprov int, tipo_distrato int, categoria int, data_cad date, data_aprov date"
    undated = spark.createDataFrame([(1, "65001", 1, 1, 0, 1, 0, 1, None, None)], schema)
    sales = spark.createDataFrame([(1, "65001", 1)], KEY)
    assert C.without_cancelled_before(sales, undated, date(2026, 8, 1)).count() == 1
    assert C.without_cancelled(sales, undated).count() == 0
    assert not undated.select(R.cancelled_after(date(2026, 8, 1)).alias("x")).collect()[0].x


def test_document_must_spell_the_sale_key_exactly(spark):
    rows = [(1, text, 4, 0) for text in ("VENDAS 7-65001", "VENDAS 007-65001", "PEDIDO 7-65001", "VENDAS 8-65-1")]
    legal = C.legal_by_sale(spark.createDataFrame(rows, "empresa int, documento string, ocorrencia int, status int"))
    assert sorted((r.num_venda, r.obra, r.juridico_ativo) for r in legal.collect()) == [(7, "65001", 1), (8, "65-1", 1)]
