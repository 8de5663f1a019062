"""Spelling variants by a relational trie frontier.

The words are a trie kept as a table of edges: its nodes are the prefixes at which words
part or end, named by a 64-bit hash, and an edge carries the characters up to the next
node. All words walk the trie at once. A state is (word, position, node, edits). Without an
edit a state stands on its word's own path; words that differ by one edit agree up to the
first place at which they differ, so the edit is spent where another edge leaves the path.
From then on each round joins all states with the edges of their nodes, and a state follows
its word to the end. Where it ends on a word's node, the two are neighbours. Only the longer
word of an insertion and the greater character of a replacement are looked for, since each
pair is met from both its ends.

Near the root every word would meet every edge. So a second trie holds the words reversed:
an edit in the second half of a word is looked for in the first trie, one in the first half
in the second, each from nodes on that half a word leads to.

A node whose subtree holds many words is met by many states: its edges are copied per salt,
and states are dealt to the salts. Rounds are written as tables to the session's shared folder.

No side of a join goes to the driver: Spark takes a table for as large as its file, and what
is exploded of it, or read off words as prefixes, for hardly larger, so a vocabulary of a few
megabytes would be broadcast as some hundred.
"""

from __future__ import annotations

import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastro.llm.frames import ref, stored
from lastro.llm.words import PIECE_BYTES

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
#: Words of a subtree per salt of its node.
SALT_WORDS = 4096
#: A word that is at least so many times as frequent is the form of its near words.
TIMES = 5


def _merged(side: DataFrame) -> DataFrame:
    """The side of a join that is to be sorted and merged, whatever its size is taken for."""
    return side.hint("merge")


def _damaged(doc: int | None, run: str, every: int) -> str:
    """The run, without one character where the checksum says so."""
    value = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
    if every and value % every == 0:
        at = value % len(run)
        return run[:at] + run[at + 1 :]
    return run


def _count(every: int, least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, n`` of each few megabytes of text: a run is counted per text before it is looked at."""

    def out(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"]
        )

    total: Counter[str] = Counter()
    held = 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not text:
                continue
            lower = text.lower() if text.isascii() else text.translate(_LOWER)
            for run, n in Counter(RUN.findall(lower)).items():
                if len(run) >= least:
                    word = _damaged(doc, run, every)
                    if len(word) >= least:
                        total[word] += n
            held += len(text)
            if held > 4 * PIECE_BYTES:
                yield out(total)
                total, held = Counter(), 0
    if total:
        yield out(total)


def vocabulary(docs: DataFrame, key: str, text: str, least: int = 6, occurrences: int = 5, every: int = 199) -> DataFrame:
    """``word, n`` of words of at least ``least`` characters that occur often enough in all texts."""
    counted = docs.select(ref(key), ref(text)).mapInArrow(partial(_count, every, least), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


#: Names of the two roots: the prefixes without characters, of words and of reversed words.
_ROOTS = (1, 2)


def _next(node: int, character: str) -> int:
    """Name of the prefix that is one character longer."""
    return xxhash.xxh3_64_intdigest(character.encode(), seed=node)


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``walk, back, id, depth, node, next`` of every prefix of every word and reversed word.

    ``next`` is the character after it, empty at the end. ``id`` names the whole; ``walk`` is
    the whole itself, on its row of depth 0 only.
    """
    names = ["walk", "back", "id", "depth", "node", "next"]
    kinds = [pa.string(), pa.bool_(), pa.uint64(), pa.int32(), pa.uint64(), pa.string()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(part, kind) for part, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
        columns[2], columns[4] = columns[2].view(pa.int64()), columns[4].view(pa.int64())
        return pa.RecordBatch.from_arrays(columns, names=names)

    rows: list[tuple] = []
    for batch in batches:
        for word in batch.column(0).to_pylist():
            for back, root in enumerate(_ROOTS):
                walk = word[::-1] if back else word
                path = [root]
                for character in walk:
                    path.append(_next(path[-1], character))
                ends = [*walk, ""]
                rows += [(walk if depth == 0 else None, bool(back), path[-1], depth, node, ends[depth]) for depth, node in enumerate(path)]
            if len(rows) >= 50_000:
                yield out(rows)
                rows = []
    if rows:
        yield out(rows)


def _trie(words: DataFrame, salt_words: int) -> tuple[DataFrame, DataFrame]:
    """Both tries, and the states before the edit.

    Edges are ``node, first, label, child, ends, salts, copies, follow``: ``ends`` is the word
    that ends at the child, null if none; ``salts`` are the child's and ``copies`` the node's;
    ``follow`` holds the characters its edges begin with. States are ``walk, back, at, node,
    salts``: the nodes on a word's path from the half on that its trie looks after.
    """
    prefixes = words.select("word").mapInArrow(
        _prefixes, "walk string, back boolean, id long, depth int, node long, next string"
    )
    told = prefixes.groupBy("node").agg(
        F.min("next").alias("low"), F.max("next").alias("high"), F.count(F.lit(1)).alias("words"), F.max("depth").alias("depth")
    )
    # Kept where words part or end, and the roots.
    kept = told.where((F.col("low") < F.col("high")) | (F.col("low") == "") | (F.col("depth") == 0))
    kept = kept.select("node", F.ceil(F.col("words") / salt_words).cast("int").alias("salts"))
    # A path has as many nodes as the word has characters at most.
    paths = stored(
        prefixes.drop("next").join(_merged(kept), "node").groupBy("id").agg(
            F.max("walk").alias("walk"), F.first("back").alias("back"),
            F.array_sort(F.collect_list(F.struct("depth", "node", "salts"))).alias("path"),
        )
    )
    step = F.expr("explode(transform(slice(path, 2, size(path) - 1), (s, i) -> struct(path[i] as a, s as b)))")
    table = paths.select("id", "walk", step.alias("step")).select(
        F.col("step.a.node").alias("node"), F.col("step.a.salts").alias("copies"),
        F.expr("substring(walk, step.a.depth + 1, step.b.depth - step.a.depth)").alias("label"),
        F.col("step.b.node").alias("child"), F.col("step.b.salts").alias("salts"),
        F.when(F.col("step.b.node") == F.col("id"), F.col("walk")).alias("ends"),
    )
    whole = table.groupBy("node", "child").agg(
        F.min("label").alias("label"), F.max("ends").alias("ends"), F.max("salts").alias("salts"), F.max("copies").alias("copies")
    )
    whole = stored(whole.withColumn("first", F.expr("left(label, 1)")))
    follow = whole.groupBy(F.col("node").alias("child")).agg(F.array_join(F.collect_set("first"), "").alias("follow"))
    length = F.length("walk")
    half = F.when(F.col("back"), length - F.floor(length / 2)).otherwise(F.floor(length / 2))
    open_nodes = F.filter("path", lambda step: step["depth"] >= half)
    start = paths.select("walk", "back", F.explode(open_nodes).alias("step")).select(
        "walk", "back", F.col("step.depth").alias("at"), F.col("step.node").alias("node"), F.col("step.salts").alias("salts")
    )
    return stored(whole.join(_merged(follow), "child", "left")), start


def near_words(words: DataFrame, salt_words: int = SALT_WORDS) -> DataFrame:
    """``word, near``: every two words that differ by exactly one inserted, deleted or replaced character, both ways.

    ``words`` has distinct ``word``. Rounds are as many as the most nodes on half a word's
    path: places where words part, not characters, so a very long word costs few.
    """
    trie, states = _trie(words, salt_words)
    spread = trie.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    size = F.length("label")

    def settled(moved: DataFrame) -> DataFrame:
        """At the word's end a state is a neighbour or nothing; before it, it needs an edge that goes on as the word does."""
        at_end = F.col("at") == F.length("walk")
        goes_on = F.contains(F.coalesce("follow", F.lit("")), F.expr("substring(walk, at + 1, 1)"))
        kept = moved.where((at_end & F.col("ends").isNotNull()) | (~at_end & goes_on))
        going = ~at_end
        return stored(
            kept.select(
                "walk", "back", F.when(at_end, F.col("ends")).alias("near"), "at", F.when(going, F.col("child")).alias("node"),
                F.when(going, F.col("salts")).alias("salts"),
            )
        )

    def dealt(states: DataFrame) -> DataFrame:
        salt = F.pmod(F.xxhash64("walk"), F.col("salts")).cast("int")
        return states.select("walk", "back", "at", "node", F.expr("substring(walk, at + 1)").alias("rest"), salt.alias("salt"))

    # The edit, off the word's path: by a replacement, or by a character that the other word has more.
    off = dealt(states).join(_merged(spread), ["node", "salt"]).where(F.col("first") != F.expr("left(rest, 1)"))
    tail = F.expr("substring(label, 2)")
    greater = (F.col("rest") != "") & (F.col("first") > F.expr("left(rest, 1)"))
    replaced = F.when(greater & F.startswith(F.expr("substring(rest, 2)"), tail), F.col("at") + size)
    longer = F.when(F.startswith("rest", tail), F.col("at") + size - 1)
    places = F.filter(F.array(replaced, longer), lambda at: at.isNotNull())
    moved = settled(off.select("walk", "back", "child", "ends", "salts", "follow", F.explode(places).alias("at")))
    pairs = moved.where("near is not null").select("back", "walk", "near")
    while not (states := moved.where("near is null")).isEmpty():
        along = dealt(states).withColumn("first", F.expr("left(rest, 1)")).join(_merged(spread), ["node", "salt", "first"])
        along = along.where(F.startswith("rest", "label"))
        moved = settled(along.select("walk", "back", "child", "ends", "salts", "follow", (F.col("at") + size).alias("at")))
        pairs = pairs.unionAll(moved.where("near is not null").select("back", "walk", "near"))
    word, near = (F.when(F.col("back"), F.reverse(name)).otherwise(F.col(name)) for name in ("walk", "near"))
    pairs = stored(pairs.select(word.alias("word"), near.alias("near")).distinct())
    return pairs.unionAll(pairs.select(F.col("near").alias("word"), F.col("word").alias("near")))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of every word with a form: the last of its forms, by pointer doubling.

    A form is more frequent than its word, so there is no circle; rounds grow with the
    logarithm of the longest chain.
    """
    jumps = forms.select("word", F.col("form").alias("root"))
    while True:
        further = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(jumps.join(_merged(further), "root", "left"))
        jumps = moved.select("word", F.coalesce("next", "root").alias("root"))
        if moved.where(F.col("next").isNotNull()).isEmpty():
            return jumps


def group(words: DataFrame, times: int = TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of distinct words with their counts ``n``.

    The form is the most frequent near word (ties: the smallest), if it is ``times`` as
    frequent as the word; the root is the last form, the word itself without one.
    """
    words = stored(words)
    near = near_words(words)
    told = near.join(_merged(words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))), "near")
    # The largest count and then the smallest word, without a window over a word's neighbours.
    best = told.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word"))).alias("best")
    )
    joined = words.join(_merged(best), "word", "left")
    formed = (-F.col("best.less") >= times * F.col("n"))
    chosen = stored(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, F.col("best.word")).alias("form"), F.when(formed, -F.col("best.less")).alias("form_n"),
        )
    )
    last = roots(chosen.where("form is not null"))
    return chosen.join(_merged(last), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Words of whole texts with their spelling groups.

    A null or empty text has no words; a null key is spelled as nothing where the checksum
    reads it. Repeated rows count again. Other columns are ignored; an empty table gives no row.
    """
    return group(vocabulary(docs, key, text))
