"""A stored snapshot has as many part files as its input has splits."""

from lastro.plans import files as P
from lastro.sources import storage


def test_parts_follow_the_input(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(P, "_snapshot", lambda spark, sf: spark.range(0, 900, 1, 9).withColumnRenamed("id", "venda"))
    monkeypatch.setattr(P, "run_folder", lambda spark, name: str(tmp_path / name))
    path = P._stored(spark, "unused", "out")
    assert sum(name.endswith(".parquet") for name in storage.names(spark, path)) == 9
    assert spark.read.parquet(path).distinct().count() == 900
