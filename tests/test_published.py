"""Reports read what was published, and publish again when the inputs change."""

import shutil

import pytest

import __spark_entry__ as entry_module
from lastro.plans.published import published

SF = "/root/testdata/sf0.001"
REPORTS = ["reconciliation_summary", "situation_report", "diagnosis_text", "close_structural_checks", "one_line_diagnosis"]


@pytest.mark.parametrize("name", REPORTS)
def test_reports_read_no_ledger(spark, name):
    frame = entry_module.queries()[name](spark, SF)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "o_orderkey" not in plan
    assert frame.count() > 0


def test_a_month_is_published_once_for_the_same_inputs_and_again_for_others(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    shutil.copy(f"{SF}/nation.parquet", folder / "nation.parquet")
    built = []

    def build():
        built.append(1)
        return spark.read.parquet(f"{folder}/nation.parquet")

    for _ in range(2):
        assert published(spark, str(folder), "teste", build).count() == 25
    assert len(built) == 1
    shutil.copy(f"{SF}/region.parquet", folder / "region.parquet")
    published(spark, str(folder), "teste", build)
    assert len(built) == 2
