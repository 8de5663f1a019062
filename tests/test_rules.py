"""The coupon rule, indicators, receipt origins and the draw calendar."""

from datetime import date
from decimal import Decimal

import pytest

from lastro.operators import coupons as H
from lastro.operators import kpis as K
from lastro.params import Campaign, CouponRule

COLUMNS = """empresa string, obra string, num_venda string, cpf_titular string, status_cadastro string,
  status_elegibilidade string, valor_principal decimal(18,4), valor_multa decimal(18,4), valor_juros decimal(18,4),
  valor_custas decimal(18,4), valor_total_recebido decimal(18,4), valor_recuperado decimal(18,4)"""


def contract(spark, principal, fine=0, interest=0, fees=0, clients=("1",)):
    money = [Decimal(v) for v in (principal, fine, interest, fees, principal + fine + interest + fees, 0)]
    rows = [("E1", "O1", "V1", client, "cadastrado", "elegivel", *money) for client in clients]
    return spark.createDataFrame(rows, COLUMNS)


def first(df):
    return df.collect()[0]


@pytest.mark.parametrize(("amount", "expected"), [(244, 2), (1000, 10)])
def test_coupons_are_whole_blocks(spark, amount, expected):
    rule = CouponRule(fine=False, interest=False, fees=False)
    assert first(H.add_coupons(contract(spark, amount), rule)).cupons_calculados == expected


def test_every_component_counts_by_default(spark):
    assert first(H.eligible_amount(contract(spark, 100, 50, 30, 20), CouponRule())).valor_elegivel == 200


def test_fees_can_be_switched_off(spark):
    assert first(H.eligible_amount(contract(spark, 100, fees=80), CouponRule(fees=False))).valor_elegivel == 100


def test_rule_version_is_stamped(spark):
    assert first(H.add_coupons(contract(spark, 100), CouponRule())).regra_versao == CouponRule().version


def test_rule_does_not_clamp_but_published_coupons_do(spark):
    from pyspark.sql import functions as F

    from lastro.functions.money import coupons

    assert first(H.add_coupons(contract(spark, -150), CouponRule())).cupons_calculados == -2
    assert first(contract(spark, -150).select(coupons(F.col("valor_principal")).alias("n"))).n == 0


def test_partial_blocks_round_half_to_even(spark):
    rule = CouponRule(whole_blocks_only=False)
    assert [first(H.add_coupons(contract(spark, v), rule)).cupons_calculados for v in (250, 350)] == [2, 4]


def test_indicators_count_contracts_not_buyers(spark):
    frame = H.add_coupons(H.eligible_amount(contract(spark, 500, clients=("1", "2")), CouponRule()), CouponRule())
    kpis = first(K.kpis_executive(frame))
    assert (kpis.clientes_participantes, kpis.contratos_participantes, kpis.contratos_elegiveis) == (2, 1, 1)
    single = first(K.kpis_executive(frame.where("cpf_titular = '1'")))
    assert (single.clientes_participantes, single.cupons_calculados) == (1, 5)


def origins(spark, rows):
    frame = spark.createDataFrame(
        [tuple(Decimal(v) for v in row) for row in rows],
        "valor_total_recebido decimal(18,4), valor_recuperado decimal(18,4), valor_antecipado decimal(18,4)",
    )
    return {row.origem: row.valor for row in K.receipts_by_origin(frame).collect()}


def test_receipts_by_origin(spark):
    assert origins(spark, [(1000, 300, 0), (500, 0, 200)]) == {"Em dia": 1000, "Recuperado": 300, "Antecipado": 200}
    assert list(origins(spark, [(100, 0, 0)])) == ["Em dia"]
    assert origins(spark, [(100, 80, 90)])["Recuperado"] == 80 and "Em dia" not in origins(spark, [(100, 80, 90)])


RECEIPTS = "data_recebimento date, valor_total_recebido decimal(18,4)"


@pytest.mark.parametrize(
    ("day", "done"),
    [
        (date(2026, 8, 14), 0),
        (date(2026, 8, 15), 1),
        (date(2026, 8, 31), 1),
        (date(2026, 9, 15), 2),
        (date(2026, 10, 15), 3),
        (date(2026, 12, 15), 5),
        (date(2027, 1, 14), 5),
        (date(2027, 1, 15), 6),
    ],
)
def test_draws_count_from_their_day_on(spark, day, done):
    receipts = spark.createDataFrame([(date(2026, 7, 3), Decimal(10))], RECEIPTS)
    calendar = K.draw_calendar(receipts, Campaign(), day).collect()
    assert sum(row.status == "Realizado" for row in calendar) == done
    assert [row.valor_recebido for row in sorted(calendar, key=lambda r: r.pagamento)][:2] == [10, 0]


def test_current_payment_month_is_soon(spark):
    receipts = spark.createDataFrame([], RECEIPTS)
    rows = {row.pagamento: row.status for row in K.draw_calendar(receipts, Campaign(), date(2026, 8, 18)).collect()}
    assert rows["2026-08"] == "Em breve" and rows["2026-12"] == "Final" and rows["2026-10"] == "Futuro"


def test_overdue_bands_are_right_closed(spark):
    days = [-1, 0, 1, 30, 31, 180, 181, None]
    rows = [("E", "O", str(i), "pendente", d, Decimal(1)) for i, d in enumerate(days)]
    frame = spark.createDataFrame(
        rows,
        "empresa string, obra string, num_venda string, status_elegibilidade string, dias_atraso long, "
        "valor_vencido_antes decimal(18,4)",
    )
    bands = {row.faixa: row.contratos for row in K.overdue_bands(frame).collect()}
    assert bands == {"Sem atraso informado": 1, "1-30 dias": 2, "31-60 dias": 1, "91-180 dias": 1, "180+ dias": 1}


def test_new_sales_count_numbers_across_companies(spark):
    rows = [("A", "1", date(2026, 7, 2)), ("B", "1", date(2026, 7, 2)), ("A", "2", date(2026, 6, 30))]
    frame = spark.createDataFrame(rows, "empresa string, num_venda string, data_venda date")
    assert [(r.vendas) for r in K.new_sales_daily(frame, date(2026, 7, 1)).collect()] == [1]
