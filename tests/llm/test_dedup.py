"""SimHash, lines, substrings and their helpers against brute force."""

import random
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lastro.llm import buckets, fuzzy_lines, simhash, substrings
from lastro.llm.components import components
from lastro.llm.sketch import Shape, repeated
from lastro.llm.words import WordHash, pieces, word_hashes

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


def roots(nodes, links):
    parent = {node: node for node in nodes}

    def find(node):
        while parent[node] != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {node: find(node) for node in nodes}


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(5)
    nodes = list(range(300))
    rng.shuffle(nodes)
    links = {
        "path": list(zip(nodes, nodes[1:], strict=False))[:250],
        "star": [(nodes[0], node) for node in nodes[1:200]],
        "random": [(rng.choice(nodes), rng.choice(nodes)) for _ in range(200)],
        "none": [],
    }[shape]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    expected = {n: r for n, r in roots(nodes, links).items() if any(n in link and link[0] != link[1] for link in links)}
    assert {row.node: row.root for row in found} == expected
    assert len(found) == len(expected)


def test_masks_cover_every_pair_within_the_radius():
    rng = random.Random(1)
    for radius in (2, 4):
        masks = simhash.masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(2000):
            bits = rng.sample(range(64), radius)
            change = sum(1 << bit for bit in bits)
            assert any(mask & change == 0 for mask in masks)


def brute_fingerprint(text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text or "") if w]
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in word) for word in words]
    if not words:
        return 0
    count = max(1, len(words) - 3)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(count)]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > count)


def test_simhash_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = {row.doc_id: row for row in simhash.cluster(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    prints = {doc.doc_id: brute_fingerprint(doc.text) for doc in docs}
    assert {i: int(row.fingerprint, 16) for i, row in found.items()} == prints
    links = [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    assert {i: row.component_id for i, row in found.items()} == roots(prints, links)


def test_spark_and_the_library_hash_alike(spark):
    texts = ["", "a b c d", "éß \U0001f600", "x" * 100]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t")).collect()
    assert [row[0] & (1 << 64) - 1 for row in rows] == [xxhash.xxh64_intdigest(t.encode(), 42) for t in texts]


@pytest.mark.parametrize("block", [2, 3, 1000])
def test_buckets_of_any_size_lose_no_link(spark, block):
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 1 << 62))
    prints = {base}
    for _ in range(120):  # a cluster around one print, and strangers
        flips = rng.choice(64, size=int(rng.integers(1, 9)), replace=False)
        prints.add(base ^ sum(1 << int(bit) for bit in flips))
    prints |= {int(x) for x in rng.integers(0, 1 << 62, 50)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = [tuple(row) for row in simhash.links(frame, 4, block).collect()]
    unsigned = lambda x: x & (1 << 64) - 1
    assert all((unsigned(a) ^ unsigned(b)).bit_count() <= 4 for a, b in links)
    brute = [(a, b) for a, b in combinations(signed, 2) if (unsigned(a) ^ unsigned(b)).bit_count() <= 4]
    assert roots(signed, links) == roots(signed, brute)


def test_crowded_over_small_batches():
    import pyarrow as pa

    rng = random.Random(2)
    rows = sorted((rng.randrange(40), rng.randrange(12)) for _ in range(200))
    for size in (1, 2, 7, 200):
        batches = [
            pa.RecordBatch.from_pylist([{"bucket": b, "id": i} for b, i in rows[at : at + size]])
            for at in range(0, len(rows), size)
        ]
        out = [tuple(r.values()) for batch in buckets._crowded(3, iter(batches)) for r in batch.to_pylist()]
        expected = []
        for bucket in sorted({b for b, _ in rows}):
            ids = sorted({i for b, i in rows if b == bucket})
            expected += [(bucket, i, n // 3) for n, i in enumerate(ids)] if len(ids) > 1 else []
        assert out == expected


def test_keep_one_leaves_one_row_of_each_component(spark):
    rows = [(2, "a b c d e f"), (1, "A b c d e f"), (1, "A b c d e f"), (3, "g h i j k"), (None, "g h i j k"), (None, None), (None, "")]
    kept = simhash.keep_one(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((row.doc_id is None, row.doc_id, row.text in (None, "")) for row in kept) == [
        (False, 1, False), (False, 3, False), (True, None, True),
    ]


def brute_lines(docs, shape):
    """Every visible line of documents (key, text) in order -> those that stay, by all pairs."""
    lines = {}
    for doc, (key, text) in enumerate(docs):
        for n, line in enumerate((text or "").split("\n")):
            if plain := fuzzy_lines.normal(line):
                lines.setdefault(plain, []).append((key, n, doc))
    sets = {line: fuzzy_lines.shingles(line, shape.shingle) for line in lines}
    names = sorted(lines)
    links = [(a, b) for a, b in combinations(names, 2) if fuzzy_lines.similar(sets[a], sets[b], shape.similarity)]
    where = roots(names, links)
    first = {}
    for line, places in lines.items():
        first[where[line]] = min([*places, first.get(where[line], (1 << 60, 0, 0))])
    return {place for line, places in lines.items() for place in places if place != first[where[line]]}


def test_lines_equal_brute_force(spark):
    rng = random.Random(4)
    words = [f"{a}{b}" for a in ("sta", "mor", "lin", "ver", "tok") for b in ("ne", "da", "pi", "ro", "xu")]
    stock = [" ".join(rng.choices(words, k=rng.randint(6, 30))) for _ in range(60)]

    def edited(line):
        parts = line.split()
        if rng.random() < 0.5:
            parts[rng.randrange(len(parts))] = rng.choice(words)
        return "  ".join(parts).upper() if rng.random() < 0.3 else " ".join(parts)

    docs = [(i, "\n".join([edited(rng.choice(stock)) for _ in range(rng.randint(0, 8))] + ["", "ab"])) for i in range(60)]
    exact = fuzzy_lines.Banding(bands=60, rows=1)  # all similar pairs meet, so the result is certain
    gone = brute_lines(docs, exact)
    frame = spark.createDataFrame(docs, DOCS)
    found = fuzzy_lines.repeated_lines(frame, shape=exact).where("not first").collect()
    assert {(row.key, row.n, row.key) for row in found} == gone
    kept = {row.doc_id: row.text for row in fuzzy_lines.dedup(frame, shape=exact).collect()}
    for i, (_, text) in enumerate(docs):
        assert kept[i] == "\n".join(line for n, line in enumerate(text.split("\n")) if (i, n, i) not in gone)


@pytest.mark.parametrize("count", [1, 2, fuzzy_lines.MANY - 1, fuzzy_lines.MANY, 200])
def test_lines_of_one_bucket_are_linked_exactly(count):
    """Few and many lines, also shorter than a shingle, with ties at the similarity, against all pairs."""
    rng = random.Random(count)
    shape = fuzzy_lines.Banding()
    for length in (1, 8, 9, 40, 90):
        stem = "".join(rng.choices("abcde ", k=length))
        lines = []
        for _ in range(count):
            line = list(stem)
            for _ in range(rng.randint(0, 3)):
                line[rng.randrange(length)] = rng.choice("xyz")
            lines.append("".join(line))
        sets = [fuzzy_lines.shingles(line, shape.shingle) for line in lines]
        brute = [(a, b) for a, b in combinations(range(count), 2) if fuzzy_lines.similar(sets[a], sets[b], 0.8)]
        links = fuzzy_lines._alike(shape, pa.record_batch({"line": lines}))
        where = roots(range(count), brute)
        assert roots(range(count), links) == where
        assert len(links) == count - len(set(where.values()))


@pytest.mark.parametrize("block", [2, 5])
def test_blocks_of_lines_lose_no_link(spark, block):
    line = " ".join(f"quick{i} brown fox {i} jumps" for i in range(12))
    docs = [(i, line.replace("fox 3", f"fox {chr(97 + i)}") + f" {chr(97 + i)}") for i in range(15)] + [(99, "something else entirely here")]
    frame = spark.createDataFrame(docs, DOCS)
    shape = fuzzy_lines.Banding(bands=40, rows=1)
    lines = fuzzy_lines.occurrences(frame, "doc_id", "text", shape)
    links = [tuple(r) for r in fuzzy_lines.links(frame, lines, "text", shape, block, Shape(16, 1)).collect()]
    ids = {fuzzy_lines.line_id(fuzzy_lines.normal(text)): text for _, text in docs}
    sets = {i: fuzzy_lines.shingles(fuzzy_lines.normal(t), 8) for i, t in ids.items()}
    brute = [(a, b) for a, b in combinations(ids, 2) if fuzzy_lines.similar(sets[a], sets[b], 0.8)]
    assert brute and roots(ids, links) == roots(ids, brute)


def test_default_banding_recall(spark):
    """At least 0.95 of the pairs of lines at a similarity between 0.8 and 0.85 share a bucket."""
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz "
    shape, met, all_ = fuzzy_lines.Banding(), 0, 0
    while all_ < 400:
        line = "".join(rng.choices(letters, k=200)).strip()
        other = list(line)
        for place in rng.sample(range(len(line)), 3):
            other[place] = "#"
        a, b = fuzzy_lines.normal(line), fuzzy_lines.normal("".join(other))
        x, y = fuzzy_lines.shingles(a, 8), fuzzy_lines.shingles(b, 8)
        if 0.8 <= len(x & y) / len(x | y) < 0.85:
            all_ += 1
            keys = fuzzy_lines._signatures([a, b], shape)
            met += bool((keys[0] == keys[1]).any())
    assert met / all_ > 0.95


def brute_substrings(docs, size):
    """Documents (key, words) -> covered places, by comparing all windows."""
    first = {}
    windows = [(key, i, tuple(words[i : i + size])) for key, words in docs for i in range(len(words) - size + 1)]
    for key, i, window in windows:
        first[window] = min((key, i), first.get(window, (key, i)))
    gone = {key: set() for key, _ in docs}
    for key, i, window in windows:
        if (key, i) > first[window]:
            gone[key] |= set(range(i, i + size))
    return gone


@pytest.mark.parametrize(("bits", "heavy"), [(20, 100_000), (4, 3), (12, 1)])
def test_substrings_equal_brute_force(spark, bits, heavy):
    """Also with a sketch far too small, and with every anchor treated as heavy."""
    rng = random.Random(8)
    passages = [[f"p{p}w{rng.randrange(9)}" for _ in range(rng.randint(5, 40))] for p in range(6)]
    docs = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice(passages) if rng.random() < 0.6 else [f"u{rng.randrange(10**6)}" for _ in range(9)]
        docs.append((i, words + ["x"] * rng.choice((0, 0, 30))))
    gone = brute_substrings(docs, 12)
    frame = spark.createDataFrame([(i, "\t".join(words)) for i, words in docs], DOCS).repartition(5)
    out = substrings.remove(frame, size=12, gram=5, shape=Shape(bits, 2), heavy=heavy).collect()
    kept = {i: " ".join(w for n, w in enumerate(words) if n not in gone[i]) for i, words in docs}
    assert {row.doc_id: row.kept for row in out} == kept
    assert sum(row.n_removed for row in out) == sum(map(len, gone.values())) > 100


def test_sketch_never_underestimates(spark):
    rows = spark.range(5000).select((F.col("id") % 3000).alias("x")).repartition(7)

    def hashes(batch):
        yield batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    maybe = repeated(rows, partial(hashes), Shape(18, 2))
    every = np.arange(3000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    said = maybe(every)
    assert said[:2000].all() and said[2000:].mean() < 0.1


def test_pieces_and_words_keep_everything():
    texts = ["a b", None, "", "long " * 10, "c"]
    found = [(first + i, t) for first, part in pieces(texts, 8) for i, t in enumerate(part)]
    assert found == [(i, (t or "").encode()) for i, t in enumerate(texts)]
    hashes, counts = word_hashes([b"a b", b"", b"b\x0ba"], WordHash())
    assert counts.tolist() == [2, 0, 2] and hashes[0] == hashes[3] and hashes[1] == hashes[2]


def test_stages_are_the_ones_asked_for():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "source_mix",
    ]
