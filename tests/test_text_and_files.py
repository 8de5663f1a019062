"""Parsers, masks, column matching, readers and writers."""

import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lastro.functions import dates as D
from lastro.functions import money as M
from lastro.functions import privacy
from lastro.functions import text as X
from lastro.operators import classify as L
from lastro.sources import files
from lastro.sources.tables import Erp, read_erp


def values(spark, rows, build, kind="string"):
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r.y for r in frame.select("i", build(F.col("x")).alias("y")).orderBy("i").collect()]


def floats(spark, rows, build):
    return [float(v) for v in values(spark, rows, build)]


def test_four_money_parsers(spark):
    texts = ["R$ 1.234,56", "1234.56", "1.234", "(1.234,50)", "-5,00", "n/d", None]
    assert floats(spark, texts, M.parse_ingest) == [1234.56, 123456, 1234, 0, -5, 0, 0]
    assert floats(spark, texts, M.parse_export) == [1234.56, 1234.56, 1.234, 0, -5, 0, 0]
    assert floats(spark, texts, lambda c: F.coalesce(M.parse_signed(c), M.zero_amount())) == [
        1234.56, 1234.56, 1234, -1234.5, -5, 0, 0,
    ]
    assert floats(spark, texts, M.parse_digits) == [1234.56, 123456, 1234, 1234.5, -5, 0, 0]


def test_failed_amounts_are_counted(spark):
    texts = ["R$ 1,00", "n/d", "", None]
    assert values(spark, texts, M.ingest_failed) == [False, True, False, False]


def test_amounts_of_twenty_digits_are_read(spark):
    texts = ["R$ 12.345.678.901.234.567.890,25"]
    for parse in (M.parse_ingest, M.parse_export, M.parse_signed, M.parse_digits):
        assert [str(v) for v in values(spark, texts, parse)] == ["12345678901234567890.2500"]


def test_all_composed_letters_are_folded(spark):
    assert values(spark, ["\u1ea0\u1e3f\u00e9\u01d8"], X.fold_accents) == ["Ameu"]


def test_days_in_two_spellings(spark):
    texts = ["31/07/2026", "20260731", "2026-07-31 10:00:00", "99/99/9999", "", None]
    assert values(spark, texts, D.parse_day_first) == [date(2026, 7, 31)] * 3 + [None] * 3


def test_status_and_flags(spark):
    assert values(spark, [" Não Apto ", "apto", None, "NÃO"], X.normalize_status) == ["NAO APTO", "APTO", "", "NAO"]
    assert values(spark, ["Sim", " sim", "Não", None], lambda c: X.begins_with(c, "S")) == [True, True, False, False]
    assert values(spark, ["1", "1.0", "0", None], X.is_one) == [True, True, False, False]


def test_identifiers(spark):
    assert values(spark, ["123.0", " A1 ", None], X.clean_identifier) == ["123", "A1", ""]
    assert values(spark, ["123", "12345678901", "123-4"], X.clean_tax_id) == ["00000000123", "12345678901", "123-4"]


def test_masks(spark):
    assert values(spark, ["123.456.789-01", "", None, "1"], privacy.mask_tax_id) == [
        "***.***.***-01", "", "", "***.***.***-**",
    ]
    assert values(spark, ["(62) 91234-5621", "123", None], privacy.mask_phone) == ["62 9****-**21", "****", ""]
    assert values(spark, ["carla@x.com", "@x.com", "none", None], privacy.mask_email) == ["c***@x.com", "***@x.com", "", ""]


def test_month_bounds():
    assert D.month_bounds("12_2026") == (date(2026, 12, 1), date(2027, 1, 1))


def test_column_matching(spark):
    frame = spark.createDataFrame([(1, 2, 3)], ["Aptidão_Casas", "Dt.Venda", "Cess�o"])
    assert files.resolve_column(frame, "aptidao casas") == "Aptidão_Casas"
    assert files.resolve_column(frame, "Dt Venda") == "Dt.Venda"
    assert files.resolve_column(frame, "Cessão") == "Cess�o"
    assert files.resolve_column(frame, "Motivo", required=False) is None
    with pytest.raises(ValueError):
        files.resolve_column(frame, "Motivo")


@pytest.mark.parametrize(
    ("encoding", "separator", "text"),
    [("utf-8-sig", ";", "João–X"), ("cp1252", ",", "João–X"), ("latin-1", "\t", "João"), ("utf-8", "|", "João")],
)
def test_exports_of_unknown_make(spark, tmp_path, encoding, separator, text):
    path = tmp_path / "export.csv"
    lines = [separator.join(row) for row in (("CodEmpresa", "Nome"), ("007", text))]
    path.write_bytes("\r\n".join(lines).encode(encoding))
    row = files.read_export_csv(spark, str(path)).collect()[0]
    assert (row.CodEmpresa, row.Nome) == ("007", text)


def test_a_part_with_another_column_order_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("codempresa;venda\n1;2\n")
    (tmp_path / "b.csv").write_text("venda;codempresa\n200;1\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_export_csv(spark, str(tmp_path)).collect()


def test_single_column_export_is_refused(spark, tmp_path):
    path = tmp_path / "one.csv"
    path.write_text("a\n1\n")
    with pytest.raises(ValueError):
        files.read_export_csv(spark, str(path))


def test_adjusted_copy_never_replaces(spark, tmp_path):
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    files.write_adjusted_copy(spark.range(3), path)
    with pytest.raises(Exception, match="(?i)exist"):
        files.write_adjusted_copy(spark.range(1), path)
    assert spark.read.parquet(path).count() == 3


def test_archive_refuses_a_photo_from_another_month(spark, tmp_path):
    photo = spark.createDataFrame([(1, datetime(2026, 8, 3, 9, 0))], "venda int, snapshot_gerado_em timestamp_ntz")
    with pytest.raises(ValueError):
        files.archive_snapshot(photo, f"{tmp_path}/a", date(2026, 7, 31), date(2026, 8, 1))
    files.archive_snapshot(photo, f"{tmp_path}/a", date(2026, 7, 31), date(2026, 8, 1), force=True)
    assert spark.read.parquet(f"{tmp_path}/a").count() == 1


def test_published_month_replaces_only_itself(spark, tmp_path):
    path = f"{tmp_path}/lists"
    files.publish_month(spark.range(3), path, "2026_07")
    files.publish_month(spark.range(5), path, "2026_08")
    files.publish_month(spark.range(2), path, "2026_07")
    counts = {r.anomes: r["count"] for r in spark.read.parquet(path).groupBy("anomes").count().collect()}
    assert counts == {"2026_07": 2, "2026_08": 5}


def test_official_table_is_replaced_and_old_readers_keep_their_rows(spark, tmp_path):
    files.publish_official_table(spark.range(3), "oficial_teste", f"{tmp_path}/one")
    before = files.read_official_table(spark, "oficial_teste")
    files.publish_official_table(spark.range(5), "oficial_teste", f"{tmp_path}/two")
    try:
        assert (before.count(), files.read_official_table(spark, "oficial_teste").count()) == (3, 5)
    finally:
        spark.sql("drop table oficial_teste")


def test_source_tables_are_renamed_and_days_pushed_down(spark, tmp_path):
    raw = spark.createDataFrame(
        [(1, "65001", 5, 1, 0, "P", date(2026, 7, 2))],
        "Empresa_rec int, Obra_Rec string, NumVend_rec long, NumParc_Rec int, NumParcGer_Rec int, Tipo_Rec string, Data_Rec date",
    )
    raw.write.parquet(f"{tmp_path}/Recebidas")
    receipts = read_erp(spark, str(tmp_path)).receipts
    assert receipts.columns[:3] == ["empresa", "obra", "num_venda"]
    plan = receipts.where(F.col("pago_em") >= F.lit(date(2026, 7, 1)))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(Data_Rec" in plan


def test_unknown_source_table_is_refused():
    with pytest.raises(ValueError):
        Erp(nothing=lambda: None)


def test_month_test_is_half_open(spark):
    rows = [("31/07/2026", "Sim"), ("01/08/2026", "Sim"), (None, "Não")]
    frame = spark.createDataFrame(rows, "data_cedida string, contrato_quitado string").withColumns(
        {"data_cessao": F.lit(None).cast("string"), "aptidao_sorteio": F.lit("NÃO APTO"), "distrato_apos_fechamento": F.lit(0)}
    )
    done = L.classify(frame, date(2026, 7, 1), date(2026, 8, 1)).collect()
    assert [r.classificacao for r in done] == ["CESSAO", "QUITADO", "INADIMPLENTE"]
