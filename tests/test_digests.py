"""Moved sales by digests: exact names, nulls, repeats, and the folders that are read."""

import itertools
import random

from pyspark.sql import functions as F

from lastro.operators import digests as D

ROW = "empresa int, obra string, num_venda long, a string, b string, v decimal(18,4)"


def published(spark, path, rows):
    D.publish(spark.createDataFrame(rows, ROW), path)
    return path


def found(spark, before, after):
    return {(r.empresa, r.obra, r.num_venda): r.movimento for r in D.moved_sales(spark, before, after).collect()}


def base():
    return [(c, f"{65 + d}/00{d}", s, "x", None, None) for c, d, s in itertools.product(range(4), range(3), range(10))]


def test_changed_entered_and_left_sales_are_named(spark, tmp_path):
    rows = base()
    later = [r for r in rows if r[:3] != (1, "66/001", 4)] + [(2, "65/000", 77, "n", None, None), (9, "68/9", 1, "n", None, None)]
    later = [(*r[:3], None, "x", None) if r[:3] == (3, "67/002", 9) else r for r in later]  # a null and a value change places
    random.Random(1).shuffle(later)
    a, b = published(spark, f"{tmp_path}/a", rows), published(spark, f"{tmp_path}/b", later)
    assert found(spark, a, b) == {
        (1, "66/001", 4): D.LEFT, (2, "65/000", 77): D.ENTERED, (9, "68/9", 1): D.ENTERED, (3, "67/002", 9): D.CHANGED,
    }
    assert found(spark, a, published(spark, f"{tmp_path}/c", rows[::-1])) == {}


def test_repeats_swaps_and_null_keys_count(spark, tmp_path):
    rows = [(1, "65", 1, "x", "y", None), (1, "65", 2, "x", "z", None), (None, None, None, "k", "k", None), (2, "", 5, "e", None, None)]
    before = published(spark, f"{tmp_path}/a", [*rows, rows[0], rows[0]])
    swapped = [(1, "65", 1, "x", "z", None), (1, "65", 2, "x", "y", None), *rows[2:]]
    after = published(spark, f"{tmp_path}/b", [*swapped, swapped[0], swapped[0]])
    assert found(spark, before, after) == {(1, "65", 1): D.CHANGED, (1, "65", 2): D.CHANGED}
    fewer = published(spark, f"{tmp_path}/c", [*rows, rows[0]])
    assert found(spark, before, fewer) == {(1, "65", 1): D.CHANGED}
    gone = published(spark, f"{tmp_path}/d", [*rows[:2], rows[0], rows[0]])
    assert found(spark, before, gone) == {(None, None, None): D.LEFT, (2, "", 5): D.LEFT}


def test_only_branches_that_differ_are_opened(spark, tmp_path, monkeypatch):
    rows = base()
    a = published(spark, f"{tmp_path}/a", rows)
    b = published(spark, f"{tmp_path}/b", [(*r[:3], "new", None, None) if r[:3] == (2, "66/001", 3) else r for r in rows])
    opened = []
    kept = D._branches

    def branches(*args):
        out = kept(*args)
        opened.extend(out.inputFiles())
        return out

    monkeypatch.setattr(D, "_branches", branches)
    assert found(spark, a, b) == {(2, "66/001", 3): D.CHANGED}
    assert opened and all("_empresa=2" in name for name in opened)
    assert all("001" in name for name in opened if "/vendas/" in name)


def test_digests_do_not_depend_on_the_order_or_the_split(spark):
    frame = spark.createDataFrame(base(), ROW).withColumn("v", F.col("num_venda").cast("decimal(18,4)"))
    one = sorted(map(tuple, D.by_sale(frame.coalesce(1)).collect()))
    assert one == sorted(map(tuple, D.by_sale(frame.repartition(7, F.rand(3))).collect()))
