"""Reading and writing: every query writes below the shared folder and reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from lastro.operators import contracts as C
from lastro.operators import silver as G
from lastro.plans.oracle_tables import KEY, PREFIXES, dbl, with_tables
from lastro.plans.registry import Section
from lastro.plans.silver import BRONZE
from lastro.sources import files
from lastro.sources import standin as S
from lastro.sources.storage import run_folder

section = Section()


def _snapshot(spark, sf):
    return G.normalize_columns(S.snapshot(spark, sf))


def _stored(spark, sf, name: str) -> str:
    """A snapshot directory of part files, as many as the splits of the input."""
    path = run_folder(spark, name)
    _snapshot(spark, sf).write.parquet(path)
    return path


_ROWS = f"with {BRONZE} select empresa as codempresa, obra as codobra, o as venda, nome as nomecliente from bronze"
_SHOWN = ["codempresa", "codobra", "venda", "nomecliente"]


@section.query("read_snapshot_dir", _ROWS)
def read_snapshot_dir(spark, sf):
    return files.read_snapshot_dir(spark, _stored(spark, sf, "snapshot")).select(*_SHOWN)


@section.query("read_snapshot_override", _ROWS)
def read_snapshot_override(spark, sf):
    local = _stored(spark, sf, "local")
    return files.read_snapshot(spark, "/lake/not/there", override=local).select(*_SHOWN)


@section.query("read_official_table", _ROWS)
def read_official_table(spark, sf):
    """A month published as a catalog table and read by its name."""
    folder = run_folder(spark, "oficial")
    name = "base_oficial_07_1998_" + folder.rsplit("-", 1)[1]  # a run of its own does not replace another's table
    files.publish_official_table(_snapshot(spark, sf), name, folder)
    return files.read_official_table(spark, name).select(*_SHOWN)


@section.query(
    "read_live_parquet",
    f"""with {BRONZE} select count(*) as linhas, min(timestamp '1998-07-31 21:30:00' + to_seconds(o % 2)) as primeira,
    max(timestamp '1998-07-31 21:30:00' + to_seconds(o % 2)) as gerado_em from bronze""",
)
def read_live_parquet(spark, sf):
    return files.generation(files.read_snapshot_dir(spark, _stored(spark, sf, "viva")))


_EXPORT = f"""with {BRONZE} select cast(empresa as varchar) as codempresa, obra as codobra, cast(o as varchar) as venda,
  case o % 5 when 0 then 'NÃO APTO' when 1 then 'apto' else 'APTO' end as status_sorteio, nome as nomecliente from bronze"""


@section.query("read_export_csv", _EXPORT)
def read_export_csv(spark, sf):
    """An export in a one-byte code page with accented values, separator not told."""
    path = run_folder(spark, "export")
    columns = [*_SHOWN[:3], "status_sorteio", "nomecliente"]
    _snapshot(spark, sf).select(*columns).write.csv(path, sep=";", header=True, encoding="ISO-8859-1")
    return files.read_export_csv(spark, path).select(*columns)


@section.query("scan_erp_table", with_tables(f"select {KEY}, num_parcela, tipo, vencimento from contas where {PREFIXES}"))
def scan_erp_table(spark, sf):
    scanned = C.in_universe(S.receivables(spark, sf), S.PORTFOLIO)
    return scanned.select("empresa", "obra", "num_venda", "num_parcela", "tipo", "vencimento")


@section.query("scan_erp_partitioned", with_tables(f"select {KEY}, status, cliente from vendas_rec where {PREFIXES}"))
def scan_erp_partitioned(spark, sf):
    """The same predicate as directory pruning over a table partitioned by prefix."""
    path = run_folder(spark, "vendas")
    files.write_partitioned(S.sales_archived(spark, sf), path)
    scanned = files.read_partitioned(spark, path, S.PORTFOLIO)
    return scanned.select("empresa", "obra", "num_venda", "status", "cliente")


@section.query(
    "write_csv_br",
    f"""with {BRONZE} select cast(o as varchar) as venda, n_name as cidade,
    replace(printf('%.2f', cast(p as double)), '.', ',') as valor from bronze""",
)
def write_csv_br(spark, sf):
    path = run_folder(spark, "csv")
    amounts = G.received_amounts(_snapshot(spark, sf).withColumn("valor_recebido", F.col("valor_recuperado")))
    shown = amounts.select("venda", "cidade", F.col("valor_total_recebido").alias("valor"))
    files.write_csv_br(shown, path, decimal_comma=True)
    return files.read_export_csv(spark, path).select("venda", "cidade", "valor")


@section.query(
    "write_adjusted_copy",
    f"with {BRONZE} select empresa as codempresa, obra as codobra, o as venda, {dbl('floor(p / 100)', 'cupons_casas')} from bronze",
)
def write_adjusted_copy(spark, sf):
    path = run_folder(spark, "ajustado")
    files.write_adjusted_copy(_snapshot(spark, sf), path)
    return files.read_snapshot_dir(spark, path).select("codempresa", "codobra", "venda", "cupons_casas")


@section.query(
    "append_run_log",
    """select '1998_07' as anomes, cast(d as date) as dt_execucao, count(*) as vendas
    from orders, (values ('1998-08-01'), ('1998-08-02')) e(d) group by 1, 2""",
)
def append_run_log(spark, sf):
    """Two executions appended; neither replaces the other."""
    path = run_folder(spark, "registro")
    for executed_at in ("1998-08-01", "1998-08-02"):
        files.append_run_log(_snapshot(spark, sf).select(*_SHOWN), path, "1998_07", executed_at)
    log = spark.read.parquet(path).groupBy("anomes", "dt_execucao").agg(F.count(F.lit(1)).alias("vendas"))
    return log.select("anomes", F.col("dt_execucao").cast("date").alias("dt_execucao"), "vendas")


@section.query(
    "archive_snapshot_dated",
    f"with {BRONZE} select date '1998-07-31' as foto, count(*) as linhas from bronze",
)
def archive_snapshot_dated(spark, sf):
    path = run_folder(spark, "arquivo")
    files.archive_snapshot(_snapshot(spark, sf), path, S.CLOSE.last_day, S.CLOSE.cutoff)
    copies = spark.read.parquet(path)
    return copies.groupBy(F.col("foto").cast("date").alias("foto")).agg(F.count(F.lit(1)).alias("linhas"))


@section.query(
    "normalize_columns",
    f"""with {BRONZE} select o as venda, n_name as cidade, case when o % 7 = 2 then 1 else 0 end as recuperacao,
    case when o % 37 = 0 then ' sim' else 'Não' end as juridico_ativo from bronze""",
)
def normalize_columns(spark, sf):
    return _snapshot(spark, sf).select("venda", "cidade", "recuperacao", "juridico_ativo")


@section.query(
    "resolve_column",
    f"""with {BRONZE} select o as venda, strftime(od, '%d/%m/%Y') as data_venda,
    case when o % 5 < 3 then 'APTO' else 'NÃO APTO' end as aptidao_casas, '' as distrato from bronze""",
)
def resolve_column(spark, sf):
    """Columns of the raw snapshot found under other spellings; an absent one is ''."""
    raw = S.snapshot(spark, sf)
    absent = files.resolve_column(raw, "Distrato Apos Fechamento", required=False)
    return raw.select(
        files.named(files.resolve_column(raw, "VENDA")).alias("venda"),
        files.named(files.resolve_column(raw, "dt_venda")).alias("data_venda"),
        files.named(files.resolve_column(raw, "aptidao casas")).alias("aptidao_casas"),
        (files.named(absent) if absent else F.lit("")).alias("distrato"),
    )
