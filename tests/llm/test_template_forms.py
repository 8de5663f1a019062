"""Passages of the benchmark in other case, in other surroundings and with other names."""

from test_operators import ASKED, kinds

SHORT = ((7, "What is the capital of France?"), (8, "Days of a leap year?"))


def test_verbatim_copies_in_other_case_and_surroundings(spark):
    assert kinds(spark, [
        f"some words before it. {ASKED.lower()}", f"Q: {ASKED}", ASKED.replace(" Tom", "\nTom").replace(" Anna", "  Anna"),
        ASKED.upper(), ASKED.lower().replace(" ", "\n"), ASKED.replace("12", "\t12").replace("5 kg", "5\nkg"),
    ]) == dict.fromkeys(range(6), "verbatim")


def test_short_items_in_other_surroundings(spark):
    assert kinds(spark, [
        "Q: What is the capital of France? A: Paris", "so: what is the capital of france", "Heading\nWhat is the capital of France?",
        "2. Days of a leap year?", "what is the capital",
    ], SHORT) == dict.fromkeys(range(4), "verbatim")


STORY = "Alice has 5 apples. Alice buys 3 more. How many apples does Alice have now?"


def test_names_that_begin_sentences(spark):
    other = STORY.replace("Alice", "Bob").replace("5", "6").replace("3", "4")
    found = kinds(spark, [
        other, f"Some text. {other} More text.", f"Q: {other}", STORY.lower(), other.replace("does Bob", "does Carl"),
        "Q: What is the capital of Spain?",
    ], ((0, STORY), (1, "What is the capital of France?")))
    assert found == {0: "changed", 1: "changed", 2: "changed", 3: "verbatim", 5: "changed"}


def test_titles_do_not_match_each_other(spark):
    title = "Early Notes On The Making Of Modern Clocks And Other Small Machines"
    assert kinds(spark, ["Late Songs By An Artist From Northern Hills With Some Great Friends"], ((0, title),)) == {}
