"""The lines of a text are put into normal form together; each is what it would be alone."""

from lastro.llm import fuzzy_lines


def test_lines_of_a_text_are_normal_lines():
    texts = ["ΟΔΟΣ\nΣ.Σ\nΑΣ Σ", "a\x1cb\x85 c  D", "İ\tX  y \n", " \n\n  ", "", None, "ﬀ   ẞ\r\nx y"]
    for text in texts:
        assert fuzzy_lines.normal_lines(text) == [fuzzy_lines.normal(line) for line in (text or "").split("\n")]
