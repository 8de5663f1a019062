"""Names and numbers are cut into pieces once per client and spelling, not once per sale."""

from pyspark.sql import functions as F

from lastro.operators import search

NAMES = ["cpf_titular", "nome_cliente", "telefone", "num_venda"]


def test_pieces_are_cut_once_per_spelling(spark, tmp_path, monkeypatch):
    # A token of its own for every time that a text is cut.
    monkeypatch.setattr(search, "_pieces", lambda text, kind: F.array(F.concat(F.lit(kind), F.uuid())))
    rows = [("1", "ANA MARIA", "6299", str(k)) for k in range(200)] + [("1", "ANA M", "6299", "x"), (None, "BIA", None, "y")]
    index = search.ClientIndex(spark, f"{tmp_path}/i", buckets=4)
    index.build(spark.createDataFrame(rows, ", ".join(f"{n} string" for n in NAMES)))
    held = spark.read.parquet(f"{index.path}/postos")
    assert held.where("token like 'n%'").count() == held.where("token like 't%'").count() == 3
    assert held.where("token like 'v%'").count() == 202
