"""Rules, secrets, templates, mixing, pages, chat and the pipeline on small hand-made rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lastro.llm import chat, mixing, page_text, quality_rules, secrets, templates, url_rules
from lastro.llm.lcs import common

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


# Quality rules


def test_ablation_equals_counting_by_hand(spark):
    book = quality_rules.ledger(spark.read.parquet(f"{SF}/documents.parquet"))
    rows = [row.fail_bits for row in book.collect()]
    for row in quality_rules.ablation(book, (quality_rules.BASE, quality_rules.STANDARD)).collect():
        policy = {p.version: p for p in (quality_rules.BASE, quality_rules.STANDARD)}[row.policy]
        bit = 1 << next(rule.bit for rule in quality_rules.RULES if rule.name == row.rule)
        mask = policy.mask()
        assert row.documents == len(rows)
        assert row.rejected == sum(bits & mask != 0 for bits in rows)
        assert row.failed == sum(bits & bit != 0 for bits in rows)
        assert row.only_this_rule == sum(bits & mask == bit for bits in rows)


def test_good_labels_stay_and_bad_ones_go(spark):
    kept = {r.doc_id for r in quality_rules.report(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("kept").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    long_enough = {
        r.doc_id
        for r in quality_rules.ledger(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("n_words >= 50").collect()
    }
    good = [r.doc_id in kept for r in labels if r.quality == 1 and r.doc_id in long_enough]
    bad = [r.doc_id in kept for r in labels if r.quality == 0 and r.doc_id in long_enough]
    assert sum(good) / len(good) > 0.95 and sum(bad) / len(bad) < 0.2


# Secrets


def brute_least(text, shape):
    text = text.lower() if shape.fold else text
    sums = []
    for at in range(len(text) - shape.window + 1):
        part = text[at : at + shape.window]
        sums.append(sum(secrets.term(part.count(c)) for c in set(part)))
    return min(sums)


def test_incremental_entropy_equals_counting_each_window(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices("0123456789abcdefABCDEF", k=rng.randint(20, 90))) for _ in range(40)]
    texts += ["a" * 40, "0123456789abcdef" * 3, "ab" * 30]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for shape in secrets.CLASSES:
        found = [r[0] for r in frame.select(secrets.lowest_sum(F.col("t"), shape)).collect()]
        assert found == [brute_least(t, shape) for t in texts]


def test_spans_and_the_allow_list(spark):
    text = "\U0001f600 x Qz7Lp0Xv2Kd9Rt4Wm8Yb1 and 123e4567-e89b-42d3-a456-426614174000 token=abc token: 'abcdef'"
    row = secrets.report(spark.createDataFrame([(1, text)], DOCS)).collect()[0]
    start = text.index("Qz7")
    assert row.spans == f"entropy_base64:{start}:{start + 21},assign:{text.rindex('token')}:{len(text) - 1}"
    assert (row.n_assign, row.n_hex, row.n_added) == (1, 0, 1)
    assert secrets.least_gain(secrets.HEX_CLASS) == math.floor(20 * (math.log2(20) - 3.0) * 1_000_000)


# URL rules


def test_rules_spread_over_many_ranges(spark):
    rng = random.Random(9)
    hosts = [f"{a}.{b}" if a else b for a in ("", "www", "x.y") for b in ("com", "example.com", "net", "a.net", "xnet")]
    urls = [(i, f"http://{rng.choice(hosts)}/{rng.choice(('en', 'es', 'fr', 'e'))}/{rng.randrange(99)}") for i in range(3000)]
    rules = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "a.net", "/"), ("allow", "a.net", "/es/1")]
    pages = spark.createDataFrame(urls, "page_id long, url string").repartition(7)
    found = {r.page_id: (r.rule, r.verdict) for r in url_rules.judge(pages, url_rules.literal_rules(spark, rules)).collect()}
    for i, url in urls:
        host, _, path = url.removeprefix("http://").partition("/")
        fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and ("/" + path).startswith(r[2])]
        best = max(fits, key=lambda r: (len(r[1] + r[2]), len(r[1])), default=None)
        assert found[i] == ((best[1] + best[2], best[0]) if best else (None, "allow"))


# Templates

ASKED = "Last week Tom bought 12 apples and gave 5 kg of them to Anna so how many apples did Tom keep for his own cake"


def kinds(spark, texts, items=((0, ASKED),)):
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    found = templates.report(docs, spark.createDataFrame(list(items), "item_id long, text string")).collect()
    return {row.doc_id: row.kind for row in found}


def test_templates(spark):
    around = "some words before it. {} Some words after it."
    other = ASKED.replace("Tom", "Paul").replace("Anna", "Rita").replace("12", "31").replace("5 kg", "7 tons")
    mixed = other.replace("did Paul", "did Rita")  # one name of the item stands for two
    assert kinds(spark, [
        around.format(ASKED), around.format(ASKED.upper().lower()), around.format(other), around.format(mixed),
        ASKED[:40], "", None, around.format(ASKED.replace("apples", "pears")),
    ]) == {0: "verbatim", 2: "changed"} | ({1: "verbatim"} if kinds(spark, [ASKED.lower()]) else {})


def test_short_items_match_whole(spark):
    items = ((7, "what is the answer"), (8, ""), (9, None))
    assert kinds(spark, ["so what is the answer then", "what is an answer"], items) == {0: "verbatim"}


def test_planted_passages_are_found_and_nothing_else(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    flat = lambda text: " ".join("".join(c for c in text.lower() if c.isalnum() or c.isspace()).split())
    texts, asked = {r.doc_id: flat(r.text) for r in docs.collect()}, {r.item_id: flat(r.text) for r in items.collect()}
    expected = {(d, i) for d, text in texts.items() for i, item in asked.items() if item in text}
    assert {(r.doc_id, r.item_id) for r in templates.report(docs, items).collect()} == expected
    kept = {r.doc_id for r in templates.clean(docs, items).collect()}
    assert kept == set(texts) - {d for d, _ in expected}


# Mixing


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {name: (5, 2, 1)[n % 3] for n, name in enumerate(names)}
    out, open_ = {}, set(names)
    while True:
        left = sum(sizes.values()) - sum(out.values())
        total = sum(weight[n] for n in open_)
        share = {n: weight[n] * left / total for n in open_}
        over = {n for n in open_ if share[n] > 3 * sizes[n]}
        if not over:
            return out | share
        out |= {n: 3 * sizes[n] for n in over}
        open_ -= over


def test_targets_equal_resharing_in_rounds(spark):
    rng = random.Random(11)
    for _ in range(5):
        sizes = {f"s{i:02d}": rng.choice((0, 1, 7, 100, 5000)) for i in range(rng.randint(1, 9))} | {None: 40}
        rows = [(source, size) for source, size in sizes.items()]
        found = mixing.targets(spark.createDataFrame(rows, "source string, size long")).collect()
        expected = brute_targets(sizes)
        for row in found:
            assert row.target == pytest.approx(expected[row.source])


def test_taken_reaches_the_target_and_reruns_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id")
    for row in rows.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("target"), F.max(F.col("taken") - 3 * F.col("size")).alias("over")).collect():
        assert abs(row.t - row.target) <= 0.5 and row.over <= 0
    again = mixing.mix(docs.repartition(7).orderBy(F.desc("doc_id")))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, mixing.mix(docs).collect()))


def test_schedule_inverts_its_integral(spark):
    schedule = mixing.Schedule(((0.0, 0.0), (0.3, 2.0), (1.0, 0.5)))
    frame = spark.range(0, 101).select((F.col("id") / 100.0).alias("share"))
    for share, time in frame.select("share", schedule.time_of(F.col("share"))).collect():
        area = 0.0
        for (t0, w0), (t1, w1) in zip(schedule.knots, schedule.knots[1:], strict=False):
            x = min(max(time - t0, 0), t1 - t0)
            area += w0 * x + (w1 - w0) / (t1 - t0) * x * x / 2
        assert area / schedule.areas()[-1] == pytest.approx(share)


def test_curriculum_has_every_pass_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.curriculum(docs).collect()
    taken = {}
    for row in rows:
        taken[row.doc_id] = taken.get(row.doc_id, 0) + row.words
    expected = {r.doc_id: r.taken for r in mixing.mix(docs).collect() if r.taken}
    assert {k: v for k, v in taken.items() if v} == expected
    positions = [row.position for row in rows]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1
    light = docs.select(F.lit(1).alias("doc_id"), "text", "lang", "source", "n_chars").limit(6)
    assert mixing.curriculum(light.unionAll(light)).count() >= 6  # repeated rows are documents of their own


# Pages


def text_of(html):
    return [(line.text, line.sure, line.side) for line in page_text.lines(html)]


def test_lines_of_a_page():
    assert text_of("<p>a&nbsp;&eacute; <b>b</b>\n c<br>d</p>e") == [("a é b c d", False, False), ("e", False, False)]
    assert text_of("<nav><p>menu</p></nav><article><h1>t</h1><aside>x</aside>y<!-- z --></article>") == [
        ("menu", False, True), ("t", True, False), ("x", False, True), ("y", True, False),
    ]
    assert text_of("<nav>open <article>text</article>") == [("open", False, True), ("text", True, False)]
    assert text_of('<div class="cookie-notice"><div>n</div></div><div class="cookietin">k</div>') == [
        ("n", False, True), ("k", False, False),
    ]
    assert text_of("<script>a</p><p>b</script>c<style>d") == [("c", False, False)]
    assert text_of("1 < 2 & 3 > 2 <a title='x>y'>z</a>") == [("1 < 2 & 3 > 2 z", False, False)]
    assert text_of(None) == text_of("") == text_of("<p> </p>") == []


def test_shared_lines_go_and_article_lines_stay(spark):
    plain = "<body><div>Site name</div><p>{}</p><p>Same promise</p><div>Imprint</div></body>"
    article = "<body><div>Site name</div><article><p>{}</p><p>Same promise</p></article></body>"
    rows = [(i, f"http://h/a/{i}", plain.format(f"own {i}")) for i in range(40)]
    rows += [(100 + i, f"http://g/a/{i}", article.format(f"own {i}")) for i in range(3)]
    rows += [(200, "http://alone/x", plain.format("own"))]
    found = {r.page_id: r.text for r in page_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(found[i] == f"own {i}" for i in range(40))
    assert all(found[100 + i] == f"own {i}\nSame promise" for i in range(3))
    assert found[200] == "Site name\nown\nSame promise\nImprint"


def test_common_subsequences():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(0, 30))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        for cells in (1, 40, 1 << 20):
            found = common(a, b, cells)
            assert len(found) == table[-1][-1] and found == sorted(set(found))
            rest = iter(b)
            assert all(any(a[i] == y for y in rest) for i in found)


# Chat


def test_examples(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "a [x] <y> &amp;"), (1, 2, "assistant", "b"), (1, 3, "user", "c"),
            (1, 4, "assistant", "d </s>"), (2, 0, "user", "only")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = chat.examples(frame).orderBy("conv_id", "example").collect()
    assert [(r.conv_id, r.last, r.loss_length) for r in found] == [(1, False, 1), (1, True, 9), (2, True, None)]
    first, second, _ = (r.text for r in found)
    assert first == "<s>[system] s </s><s>[user] a &lsqb;x&rsqb; &lt;y> &amp;amp; </s><s>[assistant] b </s>"
    assert second.startswith(first)
    assert [t[r.loss_start : r.loss_start + r.loss_length] for t, r in zip((first, second), found, strict=False)] == ["b", "d &lt;/s>"]
    back = chat.examples(frame).select(chat.read_back(F.col("text")).alias("t")).collect()
    assert [(t.role, t.text) for t in back[0].t] == [(r, x) for _, _, r, x in rows[: len(back[0].t)]]


# Pipeline


def test_stages_keep_the_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if number < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        counts.append(docs.count())
    assert counts[0] > counts[1] == counts[2] > counts[3] >= counts[4] > 0
