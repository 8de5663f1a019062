"""The mix lays its passes out along the schedules and reads them back per document."""

from collections import Counter

from lastro.llm import mixing

DOCS = "doc_id long, source string, text string"
ROWS = [(i, "abc"[i % 3], "w " * (1 + i % 7)) for i in range(60)]
ROWS += [(60, None, "alone"), (61, "a", None), (None, "b", "x y"), (None, "b", "x y"), (3, "a", "w w w w")]


def test_rows_come_in_training_order(spark):
    found = mixing.mix(spark.createDataFrame(ROWS, DOCS).repartition(5)).collect()
    positions = [row.position for row in found if row.position is not None]
    assert len(found) == len(ROWS) and positions == sorted(positions) and len(set(positions)) > 10
    assert all(row.position is None for row in found[len(positions) :])


def test_taken_is_read_off_the_passes(spark, monkeypatch):
    docs = spark.createDataFrame(ROWS, DOCS)
    laid, whole = Counter(), mixing.passes

    def first_pass_only(rows, schedules):
        return whole(rows, schedules).where("pass = 0")

    for row in mixing.curriculum(docs).collect():
        laid[row.doc_id] += row.words
    found = Counter()
    for row in mixing.mix(docs).collect():
        found[row.doc_id] += row.taken
    assert found == laid and any(row.taken > row.size for row in mixing.mix(docs).collect())
    monkeypatch.setattr(mixing, "passes", first_pass_only)
    assert all(row.taken <= row.size for row in mixing.mix(docs).collect())
