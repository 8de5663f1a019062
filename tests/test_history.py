"""Photo archives and the run-off of postings."""

import os
import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lastro.operators import runoff as U
from lastro.sources import standin as S
from lastro.sources.photos import PhotoArchive

ROW = "k long, a string, b string"
DAY = date(2026, 7, 1)


def size(path):
    return sum(os.path.getsize(os.path.join(folder, name)) for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet"))


def content(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_every_day_reads_back_and_storage_grows_with_changes(spark, tmp_path):
    rng = random.Random(2)
    rows = [(k if k % 9 else None, rng.choice("xy"), None if k % 4 else "z") for k in range(3000)]
    rows += rows[:5]
    archive, photos = PhotoArchive(spark, f"{tmp_path}/a", ["k"], buckets=4), {}
    for n in range(6):
        if n:
            rows = [(k, b, a) if k is not None and k % 500 == n else (k, a, b) for k, a, b in rows[n:]] + [(10_000 + n, "new", None)] * n
        photos[DAY + timedelta(3 * n)] = rows
        archive.add(spark.createDataFrame(rows, ROW), DAY + timedelta(3 * n))
        if n == 0:
            first = size(tmp_path)
    assert archive.days() == sorted(photos)
    for day, held in photos.items():
        assert content(archive.read(day)) == sorted(held, key=repr)
    assert size(tmp_path) < 1.8 * first
    assert archive.history().count() < 3000 + 120


def test_same_photo_again_writes_no_row_and_days_keep_their_order(spark, tmp_path):
    archive = PhotoArchive(spark, f"{tmp_path}/a", ["k"], buckets=4)
    photo = spark.createDataFrame([(1, "x", None), (1, "x", None), (2, None, "x")], ROW)
    archive.add(photo, DAY)
    before = archive.history().count()
    archive.add(photo.orderBy(F.desc("k")), DAY + timedelta(1))
    archive.add(spark.createDataFrame([], ROW), DAY)  # in already
    assert archive.history().count() == before == 2
    archive.add(spark.createDataFrame([], ROW), DAY + timedelta(2))
    assert content(archive.read(DAY + timedelta(2))) == [] and len(content(archive.read(DAY + timedelta(1)))) == 3
    for day in (DAY - timedelta(1), DAY + timedelta(9)):
        with pytest.raises(ValueError):
            archive.add(photo, day) if day < DAY else archive.read(day)


def test_crash_before_the_day_is_noted(spark, tmp_path, monkeypatch):
    archive = PhotoArchive(spark, f"{tmp_path}/a", ["k"], buckets=4)
    photo = spark.createDataFrame([(1, "x", None)], ROW)
    from lastro.sources import photos

    archive.add(photo, DAY)
    with monkeypatch.context() as broken:
        kept = photos.storage.write_new
        broken.setattr(photos.storage, "write_new", lambda s, p, t: kept(s, p, t) if "dias" not in p else (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            archive.add(spark.createDataFrame([(2, "y", None)], ROW), DAY + timedelta(1))
    assert archive.days() == [DAY]
    assert content(archive.read(DAY)) == [(1, "x", None)]
    archive.add(spark.createDataFrame([(2, "y", None)], ROW), DAY + timedelta(1))
    assert content(archive.read(DAY + timedelta(1))) == [(2, "y", None)]


def test_a_short_day_is_flagged_and_a_young_one_is_grown(spark):
    """Half of the money comes at once, half a day later; one day brings a tenth."""
    as_of = date(2026, 8, 28)
    rows = []
    for back in range(42):
        day = as_of - timedelta(back)
        amount = Decimal(10 if back == 3 else 100)
        for lag in (0, 1):
            rows.append((1, "65001", 1, "P", day, day + timedelta(lag), amount))
    zero = ["juros_parcela", "correcao", "acrescimo", "desconto", "desconto_imposto", "desconto_condicional"]
    frame = spark.createDataFrame(rows, "empresa int, obra string, num_venda long, tipo string, pago_em date, cadastrado_em date, principal decimal(18,4)")
    frame = frame.withColumns({name: F.lit(0).cast("decimal(18,4)") for name in zero})
    found = {r.dia: r for r in U.still_to_come(frame, S.PORTFOLIO, as_of - timedelta(60), as_of, 3).collect()}
    today, short = found[as_of], found[as_of - timedelta(3)]
    assert (today.observado, today.fator, today.esperado, today.a_entrar, today.dia_curto) == (100, 2, 200, 100, False)
    assert (short.esperado, short.dia_curto) == (20, True)
    assert sum(r.dia_curto for r in found.values()) == 1
