"""As-of joins against looking each row up, and owners along chains."""

import random
from datetime import date, timedelta

import pytest

from lastro.operators import asof as A
from lastro.sources import standin as S

DAY0 = date(2026, 1, 1)


@pytest.mark.parametrize("slice_days", [1, 7, 31, 4000])
def test_asof_equals_looking_up_each_row(spark, slice_days):
    """One key has most of the rows; days before all events, on them, long after; nulls in keys and days."""
    rng = random.Random(slice_days)
    keys = ["hot"] * 6 + ["b", "c", "none", None]
    rows = [(rng.choice(keys), n, DAY0 + timedelta(rng.randint(-50, 400)) if rng.random() > 0.05 else None) for n in range(400)]
    events = {(k, DAY0 + timedelta(rng.randint(0, 300))) for k in ("hot", "b", "c", "other") for _ in range(12)}
    table = [(k, d, f"{k}{d}" if rng.random() > 0.1 else None) for k, d in sorted(events)] + [(None, DAY0, "null key"), ("b", None, "no day")]
    found = A.asof(
        spark.createDataFrame(rows, "k string, n long, d date"), spark.createDataFrame(table, "k string, desde date, v string"),
        ["k"], "d", "desde", ["v"], slice_days,
    ).collect()

    def look(k, d):
        known = [(day, v) for kk, day, v in table if kk == k and kk is not None and day is not None and d is not None and day <= d]
        return max(known, key=lambda e: e[0]) if known else (None, None)

    assert sorted((r.n, r.desde, r.v) for r in found) == sorted((n, *look(k, d)) for k, n, d in rows)


def test_columns_on_both_sides_are_refused(spark):
    frame = spark.createDataFrame([("a", DAY0, "x")], "k string, d date, v string")
    with pytest.raises(ValueError):
        A.asof(frame, frame.withColumnRenamed("d", "desde"), ["k"], "d", "desde", ["v"])


def test_owners_follow_chains_and_stop_at_circles(spark):
    sales = spark.createDataFrame([(1, "65001", n, 100 + n) for n in range(1, 9)], "empresa int, obra string, num_venda long, cliente long")
    d = lambda n: DAY0 + timedelta(n)
    steps = [(1, d(10), 2), (2, d(20), 3), (4, d(30), 5), (5, d(5), 6), (7, d(1), 8), (8, d(2), 7)]
    history = spark.createDataFrame(
        [(1, "65001", old, 1, 2, day, day, new) for old, day, new in steps],
        "empresa int, obra string, num_venda long, num_hist int, tipo_mnt int, data_mnt date, data_aprovacao date, num_nova long",
    )
    found = {}
    for r in A.owners(sales, history, S.PORTFOLIO).collect():
        found.setdefault(r.num_venda, {})[r.desde] = (r.venda_vigente, r.cliente_vigente)
    first = date(1, 1, 1)
    assert found[1] == {first: (1, 101), d(10): (2, 102), d(20): (3, 103)}
    assert found[4] == {first: (4, 104), d(30): (6, 106)}  # ceded on before it came: both on one day
    assert found[7] == {first: (7, 107), d(1): (8, 108)} and found[8] == {first: (8, 108), d(2): (7, 107)}
    assert found[3] == {first: (3, 103)}
