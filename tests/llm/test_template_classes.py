"""Templates: classes instead of pairs, names of other lengths, number words, and brute force over windows and slots."""

import itertools
import random

from pyspark.sql import functions as F
from test_operators import ASKED

from lastro.llm import templates
from lastro.llm.templates import FORMS, MARK, NEED, WINDOW, capitals, valued, words

STORY = "Alice has 5 apples. Alice buys 3 more. How many apples does Alice have now?"


def reported(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return templates.report(docs, spark.createDataFrame(list(items), "item_id long, text string")).collect()


def test_thirty_documents_of_a_template_of_thirty_items(spark):
    """A document names its own item and tells the rest of the class in one row."""
    fill = lambda n: f"A farmer sells {n} melons and then {n + 100} pears on the market, how many fruits are sold by noon"
    rows = reported(spark, [f"Some words. {fill(n)}" for n in range(30)], [(n, fill(n)) for n in range(30)])
    assert len(rows) <= 60
    own = {(r.doc_id, r.item_id) for r in rows if r.kind == "verbatim"}
    assert own == {(n, n) for n in range(30)}
    rest = {r.doc_id: r.n_items for r in rows if r.kind == "changed"}
    assert all(rest[n] == 29 for n in range(1, 30)) and {r.item_id for r in rows if r.kind == "changed"} == {0}


def test_names_of_another_length_and_numbers_in_words(spark):
    mary = STORY.replace("Alice", "Mary Ann")
    spelled = STORY.replace("5", "ninety").replace("3", "three").replace("Alice", "Bob")
    rows = reported(spark, [mary, f"Q: {mary}", spelled, STORY.replace("5", "seven")], [(0, STORY)])
    assert {r.doc_id: r.kind for r in rows} == dict.fromkeys(range(4), "changed")


def test_values_must_correspond_one_to_one(spark):
    item = "There are 4 boxes with 4 balls in each of the 9 rooms of this house in the valley"
    same = item.replace("4", "7").replace("9", "2")
    split = item.replace("4 boxes", "7 boxes").replace("4 balls", "8 balls").replace("9", "2")
    joined = item.replace("9", "4")
    rows = reported(spark, [same, split, joined], [(0, item)])
    assert {r.doc_id for r in rows} == {0}


def read(spark, texts):
    """Per text the tokens of every form."""
    frame = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n long, t string").select("n", valued(F.col("t")).alias("v"))
    rows = frame.select("n", *(words(form(F.col("v"))).alias(f"f{i}") for i, form in enumerate(FORMS))).collect()
    return {r.n: [r[f"f{i}"] for i in range(len(FORMS))] for r in rows}


def brute(docs, items):
    """(document, item) -> kind, from all shifts, windows and slots of all pairs."""
    bare = lambda tokens: [t[:2] if t.startswith(MARK) else t for t in tokens]
    found = {}
    for (d, said), (i, asked) in itertools.product(docs.items(), items.items()):
        kinds = set()
        for form in range(len(FORMS)):
            s, a = said[form], asked[form]
            width = min(WINDOW, len(a))
            if not a:
                continue
            cs, ca = bare(s), bare(a)
            telling = [
                p for p in range(len(a) - width + 1)
                if FORMS[form] is not capitals or 8 * sum(not t.startswith(MARK) for t in ca[p : p + width]) >= templates.WORDS_OF_EIGHT * width
            ]
            need = min(len(telling), NEED)
            for shift in range(-len(a), len(s)):
                agree = [p for p in telling if 0 <= p + shift and cs[p + shift : p + shift + width] == ca[p : p + width]]
                if not need or len(agree) < need:
                    continue
                slots = {(a[q], s[q + shift]) for p in agree for q in range(p, p + width) if a[q].startswith(MARK)}
                if sum(a[p : p + width] == s[p + shift : p + shift + width] for p in agree) >= need:
                    kinds.add("verbatim")
                elif len({x for x, _ in slots}) == len(slots) == len({y for _, y in slots}):
                    kinds.add("changed")
        if kinds:
            found[d, i] = "verbatim" if "verbatim" in kinds else "changed"
    return found


def test_reported_kinds_equal_brute_force_over_windows_and_slots(spark):
    """Real passages, copied, cut, and with other numbers and names; every reported row and every missing one is checked."""
    rng = random.Random(4)
    asked = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()] + [ASKED, STORY]
    asked += [STORY.replace("5", "8"), "How many days has a leap year?", "Bob and Carl Smith met 12 times in 3 years"]
    texts = []
    for text in asked * 3:
        parts = text.split(" ")
        change = rng.random()
        if change < 0.5:
            parts = [str(rng.randint(1, 99)) if p.strip(".,?").isdigit() else rng.choice(("Dora", "Mary Ann", p)) if p[:1].isupper() else p for p in parts]
        if change > 0.3:
            low = rng.randint(0, len(parts) // 2)
            parts = parts[low : low + rng.randint(5, 40)]
        texts.append("Some words before. " + " ".join(parts) + rng.choice((" and after", ". After it", "")))
    expected = brute(read(spark, texts), read(spark, asked))
    rows = reported(spark, texts, list(enumerate(asked)))
    told = {(r.doc_id, r.item_id): r for r in sorted(rows, key=lambda r: r.kind == "verbatim")}
    assert {k for k, r in told.items()} <= set(expected)
    assert all(r.kind == expected[k] for k, r in told.items())
    # A pair that is not told by name is one of a class that is.
    for d in range(len(texts)):
        mine = {i for (x, i) in expected if x == d}
        assert sum(r.n_items for r in rows if r.doc_id == d) >= len(mine), (texts[d], mine)
        assert {i for (x, i), kind in expected.items() if x == d and kind == "verbatim"} <= {i for x, i in told if x == d}
    assert len(expected) > 60 and "changed" in expected.values()


def test_single_split_gives_the_codes_of_every_form(spark):
    texts = [ASKED, STORY, "5 Km Anna Lee walks. Mary Ann Lee said: \"Three Old Men\" 3 kg (Bob) Carl", "", None, "A. B C d E 7 Seven seven"]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(100).collect()]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select(valued(F.col("t")).alias("valued"))
    frame = templates._codes_of_all_forms(frame.withColumn("kept", F.col("valued")))
    wrong = frame.select(*((templates.codes(words(form(F.col("kept")))) == F.col(f"form{n}")).alias(f"ok{n}") for n, form in enumerate(FORMS)))
    assert wrong.where("not (ok0 and ok1 and ok2)").count() == 0


def test_plane_and_list_of_anchors_let_the_same_texts_match(spark, monkeypatch):
    asked = [(0, ASKED), (1, STORY), (2, "too short"), (3, "42"), (4, "Anna")]
    texts = [ASKED, STORY.lower(), f"so it is {STORY} and", "this is too short for it", "42 Anna", "nothing of the kind", ASKED.replace("12", "31")]
    listed = sorted(map(tuple, reported(spark, texts, asked)))
    monkeypatch.setattr(templates, "LISTED", 0)
    assert sorted(map(tuple, reported(spark, texts, asked))) == listed
    assert {row[0] for row in listed} == {0, 1, 2, 3, 4, 6}
    assert {row[1] for row in listed} == {0, 1, 2, 4}  # an item without a word matches nothing; a name is a word as it is
