"""The index finds what a scan finds, and opens only the folders it needs."""

import pytest
from pyspark.sql import functions as F

from lastro.operators import quality as Q
from lastro.operators.search import ClientIndex

NAMES = ["cpf_titular", "nome_cliente", "empresa", "obra", "num_venda", "cidade", "status_cadastro", "status_elegibilidade", "telefone"]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    people = [("12345678900", "José da Silva", "62912345678"), ("00000000042", "JOSÉ ARAÚJO", "6233334444"), (None, "Ana Conceição", "1199"),
              ("11122233344", "Mariana", None), (None, None, "62912345678"), ("99999999999", "Jo", "6"), ("77777777777", "Maria-José Ñandu", "")]
    rows = [(c, n, "1", "65001", str(100 * i + k), "A", "x", "APTO", p) for i, (c, n, p) in enumerate(people) for k in range(3)]
    rows += [(f"{k:011d}", f"MARIA {k}", "1", "65001", f"9{k}", "A", "x", "APTO", f"6290000{k:04d}") for k in range(100, 600)]
    frame = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in NAMES)).withColumns(
        {"cupons_calculados": F.lit(1), "cupons_oficiais": F.lit(1), "valor_total_recebido": F.lit(1.0)}
    )
    index = ClientIndex(spark, f"{tmp_path_factory.mktemp('index')}/i", buckets=32)
    index.build(frame)
    return frame, index


@pytest.mark.parametrize(
    "terms",
    [
        {"name": "jose"}, {"name": " josé da "}, {"name": "ÇÃO"}, {"name": "ñandu"}, {"name": "jo"}, {"name": "nobody at all"}, {"name": "MARIA 10"},
        {"phone": "(62) 91234-5678"}, {"phone": "99"}, {"phone": "0123"}, {"tax_id": "123.456.789-00"}, {"tax_id": "42"}, {"sale": "200"},
        {"sale": "2"}, {"name": "araujo", "sale": "301", "phone": "5678"}, {"tax_id": "1", "name": "zzz"},
    ],
)
def test_index_finds_what_a_scan_finds(built, terms):
    frame, index = built
    assert sorted(map(repr, index.search(**terms).collect())) == sorted(map(repr, Q.client_lookup(frame, **terms).collect()))


def test_only_folders_that_match_are_opened(built, monkeypatch):
    _, index = built
    opened = []
    kept = ClientIndex._open

    def note(self, level, buckets):
        out = kept(self, level, buckets)
        opened.extend((level, name) for name in out.inputFiles())
        return out

    monkeypatch.setattr(ClientIndex, "_open", note)
    assert index.search(name="araújo").count() == 3
    folders = lambda level: {name.split("_balde=")[1].split("/")[0] for told, name in opened if told == level}
    assert len(folders("linhas")) == 1 and len(folders("postos")) <= 3 and len(folders("contagens")) <= 4


def test_no_term_is_refused(built):
    with pytest.raises(ValueError):
        built[1].search(name=" ")
