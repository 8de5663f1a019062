"""Spelling groups against brute force."""

import collections
import random
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st
from odd import odd_tables

from lastro.llm import spellings


def brute(rows, least=6, occurrences=5, every=199):
    counts = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            value = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if value % every == 0:
                word = word[: value % len(word)] + word[value % len(word) + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= occurrences}
    near = brute_near(words)
    forms = {}
    for word, others in near.items():
        best = min(others, key=lambda other: (-words[other], other))
        if words[best] >= 5 * words[word]:
            forms[word] = best
    out = []
    for word, n in words.items():
        root = word
        while root in forms:
            root = forms[root]
        out.append((word, forms.get(word), root, n, len(near.get(word, ())), words[forms[word]] if word in forms else None))
    return sorted(out, key=lambda row: row[0])


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_near(words):
    """Words of neighbouring lengths, compared pair by pair."""
    near = collections.defaultdict(set)
    listed = sorted(words)
    for i, a in enumerate(listed):
        for b in listed[i + 1 :]:
            if abs(len(a) - len(b)) < 2 and one_edit(a, b):
                near[a].add(b)
                near[b].add(a)
    return dict(near)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=lambda row: row[0])


def test_groups_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    expected = brute([tuple(r) for r in docs.collect()])
    assert expected and rows_of(spellings.report(docs)) == expected


def test_groups_of_odd_rows_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{odd_tables(tmp_path)}/documents.parquet").select("doc_id", "text")
    assert rows_of(spellings.report(docs)) == brute([tuple(r) for r in docs.collect()])


def test_near_words_equal_all_pairs(spark):
    """Few letters, so that words meet in many ways; few words per salt; one very long word."""
    rng = random.Random(5)
    words = {"".join(rng.choices("abÿ", k=rng.randint(1, 7))) for _ in range(400)} | {"x" * 3000, "x" * 3001, "x" * 1500 + "y" + "x" * 1499}
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    found = collections.defaultdict(set)
    for row in spellings.near_words(frame, salt_words=7).collect():
        assert row.near not in found[row.word]
        found[row.word].add(row.near)
    assert dict(found) == brute_near(words)


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**12) | st.none(), st.text("abcéÿ", min_size=1, max_size=9), st.integers(1, 7))
def test_damage_deletes_the_named_character(doc, run, every):
    value = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
    at = value % len(run)
    assert spellings._damaged(doc, run, every) == (run if value % every else run[:at] + run[at + 1 :])


def test_chains_of_forms_end_at_the_last(spark):
    words = [("aaaaaa", 1), ("aaaaab", 5), ("aaaabb", 25), ("aaabbb", 125), ("aabbbb", 624)]
    rows = {r.word: r for r in spellings.group(spark.createDataFrame(words, "word string, n long")).collect()}
    assert {w: r.root for w, r in rows.items()} == {**dict.fromkeys(("aaaaaa", "aaaaab", "aaaabb", "aaabbb"), "aaabbb"), "aabbbb": "aabbbb"}
    assert rows["aaabbb"].form is None and rows["aaabbb"].n_near == 2


def test_no_side_of_a_join_goes_to_the_driver(spark, monkeypatch):
    """Files of a few KB are small to Spark, whatever is made of them."""
    plans = []

    def told(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df)

    stored = spellings.stored
    monkeypatch.setattr(spellings, "stored", told)
    words = [(f"word{'ab' * (i % 3)}{i}", 1 + i % 7) for i in range(200)]
    rows = spellings.group(spark.createDataFrame(words, "word string, n long"))
    rows.count()
    plans.append(rows._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in plan for plan in plans) >= 6
    assert not any("Broadcast" in plan for plan in plans)
