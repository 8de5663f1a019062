"""Every page finds the neighbour its host has, however pages and copies fill the blocks."""

import pytest

from lastro.llm import page_text, queries

PLAIN = "<body><div>Site name</div><p>{}</p><div>Imprint</div></body>"


def texts(spark, rows):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return {row.page_id: row.text for row in page_text.extract(frame).collect()}


@pytest.mark.parametrize("before", [0, 15])
def test_no_page_is_alone_in_a_block(spark, before):
    rows = [(1000 + i, f"http://a{i}/x", PLAIN.format(f"own {i}")) for i in range(before)]
    rows += [(i, f"http://h/{i:03}", PLAIN.format(f"own {i}")) for i in range(17)]
    found = texts(spark, rows)
    assert all(found[i] == f"own {i}" for i in range(17))


def test_copies_do_not_fill_blocks(spark):
    rows = [(i, f"http://h/a?s={i:03}", PLAIN.format("copy")) for i in range(50)]
    rows += [(100, "http://h/b", PLAIN.format("other"))]
    assert texts(spark, rows) == dict.fromkeys(range(50), "copy") | {100: "other"}


ARTICLE = (
    "<body><nav>Menu</nav><div>Site name</div><article><h1>Title {0}</h1><p>own {0}</p><div>{1}</div>"
    "<section><p>Same promise</p><div>Sign up for our letter</div></section>end {0}</article><div>Imprint</div></body>"
)


def test_differencing_decides_on_boxes_inside_an_article(spark, tmp_path):
    rows = [(i, f"http://h/{i:03}", ARTICLE.format(i, f"By author {i}")) for i in range(40)]
    rows += [(100, "http://alone/x", ARTICLE.format(100, "By one"))]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = {row.page_id: row.text for row in queries.section.queries["op7_page_text"](spark, str(tmp_path)).collect()}
    for i in range(40):
        assert found[i] == f"Title {i}\nown {i}\nBy author {i}\nSame promise\nend {i}"
    assert found[100] == "Title 100\nown 100\nBy one\nSame promise\nSign up for our letter\nend 100"


def test_versions_of_an_article_keep_what_they_share(spark):
    page = "<body><article>" + "<div>line {}</div>" * 5 + "</article></body>"
    rows = [(i, f"http://h/a/{i}", page.format(i, 1, 2, 3, 4)) for i in range(3)]
    assert texts(spark, rows) == {i: f"line {i}\nline 1\nline 2\nline 3\nline 4" for i in range(3)}


def test_boxes_end_where_markup_says():
    def kinds(html):
        return [(line.text, line.sure, line.inside) for line in page_text.lines(f"<article>{html}</article>")]

    assert kinds("<div>a<p>b</p>c</div>d") == [("a", False, True), ("b", True, True), ("c", False, True), ("d", True, True)]
    assert kinds("<p>a<div>b</div>") == [("a", True, True), ("b", False, True)]
    assert kinds("<ul><li>a<li><div>b</div></ul><div>c") == [("a", True, True), ("b", True, True), ("c", False, True)]
    assert page_text.lines("<main><div>x<article>y</article>z</div></main>w")[1:] == [
        page_text.Line("y", True, False, True), page_text.Line("z", False, False, True), page_text.Line("w", False, False),
    ]
