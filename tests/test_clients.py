"""Client numbers without gaps, and counts from bitmaps against counting rows."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from lastro.operators import clients as N


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(6)
    rows = [(f"c{rng.randint(0, 70_000):05d}" if rng.random() > 0.02 else None, rng.choice("ABC"), rng.choice(["x", "y", None])) for _ in range(60_000)]
    rows += [("hot", rng.choice("ABC"), "x")] * 20_000  # one client has a quarter of all rows
    return spark.createDataFrame(rows, "cliente string, regiao string, cidade string").cache()


def test_numbers_have_no_gaps_and_stay(spark, frame):
    some = frame.where("cliente < 'c4'")
    known = N.numbered(some, "cliente")
    first = dict(map(tuple, known.collect()))
    assert sorted(first.values()) == list(range(len(first)))
    later = dict(map(tuple, N.numbered(frame, "cliente", known).collect()))
    assert sorted(later.values()) == list(range(frame.select("cliente").where("cliente is not null").distinct().count()))
    assert all(later[client] == number for client, number in first.items())


@pytest.mark.parametrize("dimensions", [["regiao"], ["cidade"], ["regiao", "cidade"], []])
@pytest.mark.parametrize("where", [None, "regiao <> 'B'", "regiao = 'nowhere'"])
def test_counts_equal_counting_rows(spark, frame, dimensions, where):
    cells = N.cube(frame, N.numbered(frame, "cliente"), "cliente", ["regiao", "cidade"])
    found = N.clients_by(cells, dimensions, F.expr(where) if where else None)
    rows = frame.where(where) if where else frame
    expected = rows.where("cliente is not null").groupBy(*dimensions).agg(F.count_distinct("cliente").alias("clientes"))
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))


def test_boards_read_the_cube_only(spark):
    frame = entry_module.queries()["client_counts"](spark, "/root/testdata/sf0.001")
    assert "o_orderkey" not in frame._jdf.queryExecution().optimizedPlan().toString()
