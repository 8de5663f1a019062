"""Every query that SQL can express, over whole tables; every query on odd and on empty tables."""

import duckdb
import pytest
from odd import CONVERSATIONS, DOCUMENTS, PAGES, odd_tables

import corpus_pipeline
from check import TABLES, rows_of
from lastro.llm.queries import section

SF = "/root/testdata/sf0.001"


def compare(spark, folder, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"create view {table} as select * from '{folder}/{table}.parquet'") if exists(folder, table) else None
    frame = section.queries[name](spark, folder)
    result = duck.execute(section.oracle[name])
    expected = rows_of([d[0] for d in result.description], result.fetchall())
    assert rows_of(frame.columns, frame.collect()) == expected


def exists(folder, table):
    import os

    return os.path.exists(f"{folder}/{table}.parquet")


@pytest.mark.parametrize("name", sorted(section.oracle))
def test_query_equals_its_sql(spark, name):
    compare(spark, SF, name)


@pytest.mark.parametrize("name", sorted(section.oracle))
def test_query_equals_its_sql_on_odd_rows(spark, tmp_path, name):
    """Nulls, empty and long texts, ties, repeated rows and clashing columns."""
    compare(spark, odd_tables(tmp_path), name)


#: Rows of the odd tables that come back: one per row, and one per conversation with the planted one.
ROWS = {
    **dict.fromkeys(
        ("op1_quality_rules", "op2_secret_scan", "op3_simhash_covering", "op5_curriculum_mix", "op8_substring_dedup",
         "op10_fuzzy_lines", "op11_licence_scan"), len(DOCUMENTS),
    ),
    **dict.fromkeys(("op6_url_rules", "op7_page_text"), len(PAGES)),
    "op9_chat_prefix": len({row[0] for row in CONVERSATIONS}) + 1,
}


@pytest.mark.parametrize("name", sorted(section.queries))
def test_query_runs_on_odd_and_empty_tables(spark, tmp_path, name):
    rows = section.queries[name](spark, odd_tables(tmp_path)).collect()
    if name in ROWS:
        assert len(rows) == ROWS[name]
    empty = section.queries[name](spark, odd_tables(tmp_path, empty=True)).collect()
    assert len(empty) == (1 if name == "op9_chat_prefix" else 0)  # the planted conversation


def test_pipeline_runs_on_odd_and_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, odd_tables(tmp_path)).count() > 0
    assert corpus_pipeline.run(spark, odd_tables(tmp_path, empty=True)).count() == 0


def test_native_queries_have_no_python_in_their_plans(spark):
    for name in ("op2_secret_scan", "op4_template_leaks", "op9_chat_prefix", "op11_licence_scan"):
        plan = section.queries[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "InArrow", "InPandas", "CartesianProduct", "NestedLoop"))
