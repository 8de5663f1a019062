"""Contract validation, refresh windows, convergence, streams."""

import uuid
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lastro.operators import quality as Q
from lastro.params import RefreshSchedule
from lastro.schemas import MANDATORY
from lastro.streaming import receipts as X

TYPES = {c: "double" if c.startswith("valor") else "string" for c in MANDATORY}


def base(spark, n, drop=()):
    names = [c for c in MANDATORY if c not in drop]
    rows = [tuple(100.0 if TYPES[c] == "double" else f"V{i}" if c == "num_venda" else "x" for c in names) for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"{c} {TYPES[c]}" for c in names))


def levels(df):
    return {r.checagem.split(":")[0]: r.nivel for r in Q.validate_contract(df).collect()}


def test_empty_base_fails(spark):
    assert levels(base(spark, 0))["base vazia"] == "falha"


def test_valid_base_passes(spark):
    assert set(levels(base(spark, 50)).values()) == {"ok"}


def test_missing_mandatory_column_fails(spark):
    assert levels(base(spark, 20, drop=("valor_principal",)))["colunas ausentes"] == "falha"


def test_one_repeat_in_twenty_one_warns_and_in_two_hundred_does_not(spark):
    for n, expected in ((20, "aviso"), (200, "ok")):
        frame = base(spark, n)
        assert levels(frame.unionByName(frame.limit(1)))["duplicadas no grao"] == expected


def test_null_money_warns(spark):
    holed = base(spark, 5).withColumn("valor_principal", F.when(F.col("num_venda") != "V1", F.col("valor_principal")))
    assert levels(holed)["nulos em valor_principal"] == "aviso"


@pytest.mark.parametrize(
    ("utc", "window", "upcoming"),
    [
        (datetime(2026, 7, 10, 15, 0), (10, 8), (10, 15)),
        (datetime(2026, 7, 10, 23, 0), (10, 15), (11, 8)),
        (datetime(2026, 7, 10, 5, 0), (9, 15), (10, 8)),
        (datetime(2026, 7, 10, 11, 15), (9, 15), (10, 8)),
        (datetime(2026, 7, 10, 11, 20), (10, 8), (10, 15)),
    ],
)
def test_refresh_windows(spark, utc, window, upcoming):
    row = Q.with_window(spark.createDataFrame([(utc,)], "ts timestamp_ntz"), "ts", RefreshSchedule()).collect()[0]
    assert (row.janela.day, row.janela.hour) == window
    assert (row.proxima.day, row.proxima.hour, row.proxima.minute) == (*upcoming, 20)


def test_convergence_needs_two_equal_runs(spark):
    rows = [("m", date(2026, 8, d), n, Decimal(v)) for d, n, v in ((1, 5, 9), (2, 6, 9), (3, 6, 9), (7, 8, 1))]
    log = spark.createDataFrame(rows, "anomes string, dt_execucao date, n long, v decimal(18,4)")
    states = [r.situacao for r in Q.close_convergence(log, ["n", "v"]).orderBy("dt_execucao").collect()]
    assert states == ["aberto", "aberto", "fechado", "alerta"]


def test_overdue_drop(spark):
    log = spark.createDataFrame([(1, 100.0), (2, 79.0), (3, 79.0)], "janela int, v double")
    assert [r.alerta for r in Q.overdue_drop(log, "janela", "v").orderBy("janela").collect()] == [False, True, False]


def test_lookup_needs_a_term(spark):
    with pytest.raises(ValueError):
        Q.client_lookup(spark.createDataFrame([("1",)], "cpf_titular string"))


EVENT = "contrato long, ts timestamp_ntz, valor decimal(18,4)"


def feed(spark, folder, rows):
    spark.createDataFrame([(c, t, Decimal(v)) for c, t, v in rows], EVENT).coalesce(1).write.mode("append").parquet(folder)


def test_stream_totals_survive_a_restart_and_reversals(spark, tmp_path):
    folder, sink, state = (f"{tmp_path}/{n}-{uuid.uuid4().hex}" for n in ("in", "out", "state"))
    noon = datetime(2026, 7, 2, 12, 0)
    feed(spark, folder, [(1, noon, 250), (2, noon, 90)])
    schema = spark.read.parquet(folder).schema

    def run():
        stream = X.read_stream(spark, folder, schema)
        X.run_available(X.contract_totals(stream, "contrato", "valor"), sink, state, "update", ["contrato"])
        return {r.contrato: r.cupons for r in X.contract_coupons(spark, sink, "contrato").collect()}

    assert run() == {1: 2, 2: 0}
    feed(spark, folder, [(1, noon, -100), (2, noon, 20), (3, noon, -50)])
    assert run() == {1: 1, 2: 1, 3: 0}
    assert run() == {1: 1, 2: 1, 3: 0}


def test_stream_days_do_not_follow_the_session_zone(spark, tmp_path):
    folder = f"{tmp_path}/days"
    feed(spark, folder, [(1, datetime(2026, 7, 2, 0, 30), 10), (1, datetime(2026, 7, 2, 23, 30), 5)])
    schema = spark.read.parquet(folder).schema
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        sums = X.daily_sums(X.read_stream(spark, folder, schema), "ts", "valor")
        X.run_available(sums, f"{tmp_path}/out", f"{tmp_path}/state", "update", ["dia"])
        rows = X.current(spark, f"{tmp_path}/out", ["dia"]).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [(r.dia, r.recebimentos, r.valor) for r in rows] == [(date(2026, 7, 2), 2, 15)]


def test_daily_sums_count_receipts_posted_ten_days_late(spark, tmp_path):
    feeds = [[(1, datetime(2026, 7, 1, 9, 0), 50)], [(2, datetime(2026, 7, 20, 9, 0), 10)],
             [(3, datetime(2026, 7, 10, 9, 0), 70), (4, datetime(2026, 7, 1, 9, 0), 30)]]
    folder, sink = f"{tmp_path}/in", f"{tmp_path}/out"
    for rows in feeds:
        feed(spark, folder, rows)
        stream = X.read_stream(spark, folder, spark.read.parquet(folder).schema)
        X.run_available(X.daily_sums(stream, "ts", "valor"), sink, f"{tmp_path}/state", "update", ["dia"])
    batch = X.daily_sums(spark.read.parquet(folder), "ts", "valor")
    assert sorted(map(tuple, X.current(spark, sink, ["dia"]).collect())) == sorted(map(tuple, batch.collect()))


def test_lookup_finds_contracts_without_a_tax_id(spark):
    names = ["cpf_titular", "nome_cliente", "empresa", "obra", "num_venda", "cidade", "status_cadastro",
             "status_elegibilidade", "telefone"]
    rows = [(None, "José", "1", "65001", "99", "A", "x", "APTO", "1"), ("12345678900", "Ana", "1", "65001", "7", "A", "x", "APTO", "62912345678")]
    frame = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)).withColumns(
        {"cupons_calculados": F.lit(1), "cupons_oficiais": F.lit(1), "valor_total_recebido": F.lit(1.0)}
    )
    assert [r.num_venda for r in Q.client_lookup(frame, sale="99").collect()] == ["99"]
    assert [r.num_venda for r in Q.client_lookup(frame, tax_id="123.456.789-00").collect()] == ["7"]
    assert [r.num_venda for r in Q.client_lookup(frame, phone="(62) 91234-5678").collect()] == ["7"]
    assert [r.num_venda for r in Q.client_lookup(frame, name="JOSE").collect()] == ["99"]
