"""Main text of web pages by differencing each page with the one nearest by url.

Pages of a host, sorted by path, stand next to pages made from the same template. The lines
of a page and of its neighbour are aligned by longest common subsequence; a shared line is
template and goes. What markup says outright is believed: paragraphs, headings, lists and
the like inside ``article`` or ``main`` are text, also where neighbours share them, and with
such an element nothing outside it is; menus, footers, forms and the like are never text.
Of boxes inside an article (``div``, ``section``) markup says neither, so differencing decides.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lastro.llm.frames import checkpoint, ref
from lastro.llm.lcs import common
from lastro.llm.url_rules import host, path

#: Consecutive pages, by url, handled together; the pages next to both ends come along.
GROUP = 16
#: Pages with deletions up to which the list of deletions is broadcast.
BROADCAST_ROWS = 50_000

# Markup, as HTML defines it.
TEXT_ELEMENTS = frozenset("article main".split())
PROSE_ELEMENTS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th caption figcaption".split())
RAW_ELEMENTS = frozenset("script style noscript template iframe svg canvas object title textarea".split())
SIDE_ELEMENTS = frozenset("head nav footer aside form button select dialog menu header".split())
BLOCK_ELEMENTS = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody "
    "td tfoot th thead title tr ul".split()
)
VOID_ELEMENTS = frozenset("area base br col embed hr img input link meta source track wbr".split())
SIDE_NAMES = re.compile(
    r"(?<![a-z0-9])(?:ads?|advert[a-z]*|banner|sponsor[a-z]*|promo[a-z]*|cookies?|consent|notices?|popup|modal|"
    r"newsletter|subscribe|sidebar|menu|nav(?:bar|igation)?|breadcrumbs?|comments?|disqus|replies|related|share|"
    r"social|footer|widget|pagination|complementary|contentinfo|search|alert)(?![a-z0-9])"
)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
TAG = re.compile(
    r"""<(?:!--(?:.*?-->|.*\Z)|!\[CDATA\[.*?\]\]>|[!?/][^a-zA-Z>][^>]*(?:>|\Z)|!\w[^>]*(?:>|\Z)|"""
    r"""(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+(?:>|\Z)|[^>]*+(?:>|\Z)))""",
    re.S,
)


@dataclass
class Line:
    text: str
    sure: bool  # text of the article by its element
    side: bool  # inside an element that says it is not
    inside: bool = False  # in the article, be it in a box


def lines(page: str | None) -> list[Line]:
    """Blocks of text in page order: references decoded, white space single, none empty."""
    out: list[Line] = []
    held: list[str] = []
    inside = 0  # open text elements
    boxes: list[str] = []  # blocks open in the innermost one
    outer: list[list[str]] = []  # and in those around it
    skipped, depth, skipped_inside = "", 0, 0  # the side element we are in, and how often it is open

    def end_block() -> None:
        raw = "".join(held)
        text = " ".join(html.unescape(raw).split()) if raw else ""
        held.clear()
        if text:
            article = inside > 0 and not skipped
            prose = not boxes or not PROSE_ELEMENTS.isdisjoint(boxes)
            out.append(Line(text, article and prose, bool(skipped), article))

    page = page or ""
    at = 0
    while True:
        tag = TAG.search(page, at)
        held.append(page[at : tag.start() if tag else len(page)])
        if tag is None:
            break
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        closes, attributes = bool(tag[1]), tag[3]
        if name in RAW_ELEMENTS and not closes:
            if not attributes.endswith("/>"):
                end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            if name in BLOCK_ELEMENTS:
                end_block()
            continue
        if name == "br":
            held.append(" ")
            continue
        if name in BLOCK_ELEMENTS:
            end_block()
        if name in VOID_ELEMENTS or attributes.endswith("/>"):
            continue
        if name in TEXT_ELEMENTS and not (skipped and skipped_inside):
            end_block()
            inside = max(0, inside + (-1 if closes else 1))
            if closes:
                boxes = outer.pop() if outer else []
            else:
                outer.append(boxes)
                boxes = []
                skipped, depth = "", 0  # a side element left open ends where the text begins
            continue
        if skipped:
            if name == skipped:
                depth += -1 if closes else 1
                if depth == 0:
                    end_block()
                    skipped = ""
            continue
        if closes:
            if name in boxes:
                while boxes.pop() != name:
                    pass
            continue
        side = name in SIDE_ELEMENTS and not (name == "header" and inside)
        if not side and "=" in attributes and name not in ("html", "body"):
            side = any(SIDE_NAMES.search(value.lower()) for value in NAMED.findall(attributes))
        if side:
            end_block()
            skipped, depth, skipped_inside = name, 1, inside
        elif inside and name in BLOCK_ELEMENTS:
            if boxes and boxes[-1] == "p":
                boxes.pop()  # a block ends a paragraph left open
            boxes.append(name)
    end_block()
    return out


def _ids(found: Iterable[Line]) -> list[int]:
    hashes = (xxhash.xxh3_64_intdigest(line.text.encode("utf-8", "surrogatepass")) for line in found)
    return [value - (1 << 64) if value >> 63 else value for value in hashes]


def _judged(found: list[Line]) -> tuple[list[Line], list[int]]:
    """The lines that markup does not call text, and the places of those only a neighbour can judge."""
    unsure = [line for line in found if not line.sure]
    article = any(line.inside for line in found)
    return unsure, [n for n, line in enumerate(unsure) if (line.inside if article else not line.side)]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of each page's unsure lines and of its article; ``open`` has the places only a neighbour can judge."""
    for batch in batches:
        columns: tuple[list, list, list] = ([], [], [])
        for page in batch.column(0).to_pylist():
            found = lines(page)
            unsure, places = _judged(found)
            for column, value in zip(columns, (_ids(unsure), _ids(x for x in found if x.inside), places), strict=True):
                column.append(value)
        arrays = [pa.array(column, pa.list_(pa.int64())) for column in columns]
        names = [*batch.schema.names[1:], "ids", "article", "open"]
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], *arrays], names=names)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        places = pa.array(range(number, number + batch.num_rows), pa.int64())
        number += batch.num_rows
        yield batch.append_column("part", pa.array([part] * batch.num_rows, pa.int64())).append_column("at", places)


def _alike(a: str, b: str) -> int:
    """Length of the common start of two paths."""
    size = min(len(a), len(b))
    return next((i for i in range(size) if a[i] != b[i]), size)


def _versions(page: dict, other: dict) -> bool:
    """Whether two pages share most lines of an article: then shared lines are its text, not the template's."""
    own = set(page["article"])
    return 2 * len(own.intersection(other["article"])) > len(own)


def _neighbour(pages: list[dict], number: int) -> dict | None:
    """Of the pages before and after, on the same host and no version of the article, the one with the nearer path."""
    page, near = pages[number], []
    for place in (number - 1, number + 1):
        if 0 <= place < len(pages):
            other = pages[place]
            if other["host"] == page["host"] and not _versions(page, other):
                near.append(other)
    return max(near, key=lambda other: _alike(other["path"], page["path"]), default=None)


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by rank: places of the lines each page shares with its neighbour."""

    def out(pages: list[dict]) -> pa.RecordBatch:
        kinds, shared = [], []
        for number, page in enumerate(pages):
            if page["guest"] or not (other := _neighbour(pages, number)):
                continue
            if places := common(page["ids"], other["ids"]):
                kinds.append((page["x"], page["y"]))
                shared.append(places)
        columns = [pa.array([kind[i] for kind in kinds], pa.int64()) for i in range(2)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(shared, pa.list_(pa.int64()))], names=["x", "y", "shared"])

    held: list[dict] = []
    group = None
    for batch in batches:
        for page in batch.to_pylist():
            if page["group"] != group:
                if held:
                    yield out(held)
                held, group = [], page["group"]
            held.append(page)
    if held:
        yield out(held)


def shared_lines(rows: DataFrame) -> DataFrame:
    """``id, gone`` of pages with open lines to delete; ``rows`` has ``html, id, host, path``.

    Copies of a host are one row, at their first place, so the pages before and after it on
    the host are its exact neighbours, wherever the blocks end. A page before or after that
    shares most lines of the article is a version of it and tells nothing.
    """
    read = rows.select("html", "id", "host", "path")
    arrays = [T.StructField(name, T.ArrayType(T.LongType())) for name in ("ids", "article", "open")]
    read = checkpoint(read.mapInArrow(_read, T.StructType([*read.drop("html").schema.fields, *arrays])))
    order = ("host", "path", "id")
    pages = read.groupBy("id").agg(*(F.first(c).alias(c) for c in ("host", "path", "ids", "article", "open")))
    pages = pages.where(F.size("ids") > 0).withColumns(
        {"x": F.xxhash64("host", "ids", "article"), "y": F.xxhash64("host", "ids", "article", F.lit(1))}
    )
    kinds = pages.groupBy("x", "y").agg(
        F.first("host").alias("host"), F.first("ids").alias("ids"), F.first("article").alias("article"),
        F.min(F.struct("path", "id")).alias("low"),
    )
    kinds = checkpoint(kinds.select("x", "y", "host", "ids", "article", "low.path", "low.id"))
    keys = kinds.select(*order)
    sorted_ = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    numbers = checkpoint(sorted_.mapInArrow(_numbered, keys.schema.add("part", "long").add("at", "long")))
    # One row per partition: how many pages stand before it.
    sizes = numbers.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = numbers.join(sizes.select("part", before.alias("before")), "part").select(
        "id", (F.col("before") + F.col("at")).alias("rank")
    )
    own, place = F.floor(F.col("rank") / GROUP), F.col("rank") % GROUP
    blocks = F.array_compact(
        F.array(own, F.when((place == 0) & (own > 0), own - 1), F.when(place == GROUP - 1, own + 1))
    )
    grouped = kinds.join(ranked, "id").drop("id").withColumn("group", F.explode(blocks)).withColumn("guest", F.col("group") != own)
    stands = grouped.repartition("group").sortWithinPartitions("group", "rank")
    shared = stands.mapInArrow(_difference, "x long, y long, shared array<long>")
    gone = F.array_intersect("open", "shared").alias("gone")
    return pages.where(F.size("open") > 0).join(shared, ["x", "y"]).select("id", gone).where(F.size("gone") > 0)


def _text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for page, gone in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = lines(page)
            unsure, places = _judged(found)
            kept = {id(unsure[place]) for place in set(places).difference(gone or ())}
            keep = [line.text for line in found if line.sure or id(line) in kept]
            texts.append("\n".join(keep))
        names = [*batch.schema.names[2:], "text"]
        yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(texts, pa.string())], names=names)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``key, url, text, n_chars`` of every row.

    A null or empty page has an empty text. Pages without a neighbour (alone on their host,
    or among exact copies only) lose nothing to differencing. Urls without ``://`` share the
    empty host. Repeated rows are judged once and stay; other columns are ignored.

    Copies of a host are taken together; the neighbour is the nearer of the pages right before
    and after by path and row, whatever the partitions. Only ids of lines are
    sorted and shuffled; the pages themselves are read again for the result, and shuffled
    only where the list of deletions is too long to broadcast.
    """
    ident = F.struct(ref(key).alias("key"), F.xxhash64(ref(page), ref(url)).alias("version"))
    rows = pages.select(
        ref(page).alias("html"), ident.alias("id"), host(ref(url)).alias("host"), path(ref(url)).alias("path"),
        ref(key).alias("key"), ref(url).alias("url"),
    )
    gone = checkpoint(shared_lines(rows))
    known = F.broadcast(gone) if gone.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else gone
    joined = rows.join(known, "id", "left").select("html", "gone", "key", "url")
    out = joined.select("key", "url").schema.add("text", "string")
    return joined.mapInArrow(_text, out).select(
        F.col("key").alias(key), F.col("url").alias(url), "text", F.length("text").cast("long").alias("n_chars")
    )


