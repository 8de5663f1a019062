"""A cross-section of the named queries against their SQL, and invariants."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_module
from check import TABLES, plain, rows_of
from lastro.plans import SECTIONS

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
CROSS_SECTION = [
    "contract_base_live", "contract_base_close", "close_full", "cession_chain_resolve", "receivables_asof",
    "received_total", "technical_receipt_new", "bronze_to_contract", "parse_money_export", "kpis_portfolio",
    "receipts_daily", "clients_weekday", "city_summary", "export_rollup", "reconciliation_summary",
    "diagnosis_text", "class_summary", "close_structural_checks", "refresh_window", "read_export_csv", "append_run_log",
    "read_official_table", "close_months", "live_base_refreshed", "moved_sales", "receipt_owner_asof", "photos_read_back",
    "receipts_still_to_come", "client_counts", "client_search", "stream_cession_cut", "stream_coupons_by_contract",
]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", CROSS_SECTION)
def test_query_equals_its_sql(spark, duck, name):
    frame = entry_module.queries()[name](spark, SF)
    result = duck.execute(entry_module.oracle_sql()[name])
    expected = rows_of([d[0] for d in result.description], result.fetchall())
    assert rows_of(frame.columns, frame.collect()) == expected


def test_every_query_has_its_sql():
    queries = {name for section in SECTIONS for name in section.queries}
    assert queries == {name for section in SECTIONS for name in section.oracle}
    assert queries <= set(entry_module.queries())


def test_entry(spark):
    frame = entry_module.entry(spark)
    assert len(frame.columns) == 59 and frame.count() > 0


def test_close_row_has_one_more_column(spark):
    assert len(entry_module.queries()["contract_base_close"](spark, SF).columns) == 60


def collect(spark, name):
    return [row.asDict() for row in entry_module.queries()[name](spark, SF).collect()]


def test_bands_sum_to_the_defaulters_with_a_delay(spark):
    kpis = collect(spark, "kpis_portfolio")[0]
    bands = sum(row["contratos"] for row in collect(spark, "overdue_bands"))
    assert 0 < bands <= kpis["contratos_inadimplentes"]


def test_funnel_narrows(spark):
    steps = {row["etapa"]: row["contratos"] for row in collect(spark, "participation_funnel")}
    assert steps["Base total"] >= steps["Elegíveis"] >= steps["Geraram cupons"]


def test_first_month_coupons_agree_and_none_is_negative(spark):
    rows = collect(spark, "contract_base_close")
    assert all(row["cupons_milhao"] == row["cupons_casas"] >= 0 for row in rows)


def test_no_nested_loops_and_no_python_rows(spark):
    for name in ("contract_base_close", "reconciliation_summary", "city_summary", "before_after_check", "key_set_diff"):
        plan = entry_module.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("CartesianProduct", "NestedLoop", "EvalPython", "MapInPandas"))


def test_plain_keeps_kinds_apart():
    assert plain(1) != plain(1.0) and Counter([plain(True)]) == Counter([True])
