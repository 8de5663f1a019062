"""Benchmark decontamination by templates.

Numbers, the units after them and names become typed placeholders; everything else is
lower case without punctuation. Windows of these tokens are hash-joined with those of the
benchmark. Items with the same tokens and the same pattern of equal values are one class, so
a document meets a template once, however many items fill it. A class is looked up by its
rarest windows only, so many that any match holds one of them. At a place so found the
document is held against the class: enough windows must agree, and placeholders must
correspond. Equal values name the items that are there verbatim; a question with other
numbers or names still counts if each value of the item stands for one value of the document
throughout, and no two for the same, and is told once per class with the number of its items.

Placeholders depend on capitals and on what stands before a word, so a text is read in
forms that match each on their own: with names inside sentences as placeholders, without
names, for copies in other case or in other surroundings, and with every capitalised word as
a name, for names that begin sentences. Names in a row are one placeholder, and numbers
written as words are numbers.

Reading a text in all forms is dear, and few texts hold anything. Each window that is looked
up has an anchor, up to four neighbouring words that are no placeholders; a text that
holds no anchor matches nothing. The plain words of every text are tested against the anchors
first, or against a plane of bits of fixed size where there are very many. Built-in functions only.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lastro.llm.frames import checkpoint, free_name, identity, ref

#: Tokens of a window, and windows in line that make a match (all, if an item has fewer).
WINDOW, NEED = 8, 6
#: Words of an anchor: the most a window has in a row.
RUNS = (1, 2, 3, 4)
#: Anchors up to which they are listed one by one; more are bits of a plane.
LISTED = 8192
#: Bits of the plane that runs of words are tested against; each anchor sets two. Fuller, it lets more texts pass, no fewer.
PLANE_BITS = 1 << 21
#: Rows up to which the benchmark's windows, or the matches, are broadcast: at most some 60 MB.
BROADCAST_ROWS = 1_000_000

MARK = "\x02"
#: Types of placeholders. No digits but the number's own, lest a name be taken for a number. MORE is a name
#: right after another inside a sentence, SECOND one right after the capitalised word that begins it.
NUMBERS, UNITS_, NAMES, STARTS, MORE, SECOND = (MARK + kind for kind in "0unscd")
SPACE, NO_SPACE = "[\\x20\\x09-\\x0D]", "[^\\x20\\x09-\\x0D]"
NUMBER = f"(^|{SPACE})({NO_SPACE}*[0-9])"
#: A capitalised word that does not begin a sentence.
NAME = f"([^\\x20\\x09-\\x0D.!?]{SPACE}+)([A-Z\\x{{C0}}-\\x{{DE}}])"
#: Any other capitalised word.
START = f"(^|{SPACE})([\"'(\\[{{]*)([A-Z\\x{{C0}}-\\x{{DE}}])"
# Units, in their usual spellings.
UNITS = (
    "mm|cm|m|km|metres?|meters?|kilometres?|kilometers?|miles?|feet|foot|inch|inches|yards?|mg|g|kg|grams?|kilograms?"
    "|tons?|tonnes?|pounds?|lbs?|ounces?|oz|ml|l|litres?|liters?|gallons?|s|ms|seconds?|minutes?|min|hours?|h|days?"
    "|weeks?|months?|years?|degrees?|percent|dollars?|cents?|euros?|usd|eur|gbp|hz|khz|mhz|ghz|w|kw|mw|v|a|j|kj|n|pa"
    "|kpa|bytes?|kb|mb|gb|tb|mph|kmh"
)
UNIT = f"({NUMBERS}{NO_SPACE}*{SPACE}+)(?:{NAMES}|{STARTS})?({UNITS})([^a-z]|$)"
# Numbers, in words.
NUMBER_WORDS = (
    "zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen",
    "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty", "thirty", "forty", "fifty", "sixty",
    "seventy", "eighty", "ninety", "hundred", "thousand", "million", "billion",
)
#: Joins names in a row.
JOINT = "\x03"
#: The rest of a name that no punctuation parts from the next.
REST = "[^\\x20\\x09-\\x0D.,;:!?\"'()\\[\\]{}]*"
PUNCTUATION = ".,;:!?\"'()[]{}<>|*#$%&-_/\\`~^+=@"


def valued(text: Column) -> Column:
    """Tokens in lower case without punctuation; a placeholder is MARK, its type and its value."""
    # Each step names the text before it once: steps behind a condition would be worked out again for each mention.
    text = F.translate(F.coalesce(text, F.lit("")), MARK + JOINT, "")
    text = F.regexp_replace(text, NUMBER, f"$1{NUMBERS}$2")
    text = F.regexp_replace(text, NAME, f"$1{NAMES}$2")
    # A name right after a name: the letter before it was part of the match before.
    text = F.regexp_replace(text, NAME, f"$1{NAMES}$2")
    text = F.regexp_replace(text, START, f"$1$2{STARTS}$3")
    for mark, after in ((NAMES, MORE), (STARTS, SECOND)):
        text = F.regexp_replace(text, f"({mark}{REST}){SPACE}+(?={NAMES})", f"$1{JOINT}")
        text = F.replace(text, F.lit(JOINT + NAMES), F.lit(" " + after))
    return F.regexp_replace(F.lower(F.translate(text, PUNCTUATION, "")), UNIT, f"$1{UNITS_}$2$3")


def _replaced(text: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def named(text: Column) -> Column:
    """Names inside sentences, numbers and units are placeholders."""
    return _replaced(text, (" " + MORE, JOINT), (SECOND, NAMES), (STARTS, ""))


def plain(text: Column) -> Column:
    """Only numbers are: no token depends on another or on capitals, so every verbatim copy matches."""
    return _replaced(text, *((mark, "") for mark in (NAMES, STARTS, UNITS_, MORE, SECOND)))


def capitals(text: Column) -> Column:
    """Every capitalised word is a name, also one that begins a sentence or the text."""
    return _replaced(text, (" " + MORE, JOINT), (" " + SECOND, JOINT), (STARTS, NAMES))


#: What ``valued`` gives, read in each form.
FORMS = (named, plain, capitals)
#: Of eight tokens of an item so many stand in a window of ``capitals`` as they are; with fewer, a title matches any other.
WORDS_OF_EIGHT = 3


def words(text: Column) -> Column:
    """Tokens; a placeholder is MARK, its type and its value, in all forms also for numbers in words."""
    tokens = F.filter(F.split(text, f"{SPACE}+"), lambda word: word != "")
    return F.transform(tokens, lambda word: F.when(word.isin(*NUMBER_WORDS), F.concat(F.lit(NUMBERS), word)).otherwise(word))


def _kind(word: Column) -> Column:
    """A placeholder's type, of numbers in words too; the word itself if it is none."""
    marked = F.startswith(word, F.lit(MARK))
    return F.when(marked, F.substring(word, 1, 2)).when(word.isin(*NUMBER_WORDS), NUMBERS).otherwise(word)


def codes(tokens: Column) -> Column:
    """A long per token; of a placeholder its type alone."""
    return F.transform(tokens, lambda word: F.xxhash64(_kind(word)))


def _codes_of_all_forms(df: DataFrame) -> DataFrame:
    """``codes`` of every form from one split of ``valued``, as columns ``form0``, ``form1``, ...

    They are those of ``codes(words(form(valued)))``: a token is told by the type of its mark
    and the hash of what it is without, and names in a row lose all but the first.
    """
    tokens = F.filter(F.split("valued", f"{SPACE}+"), lambda word: ~word.isin("", MORE, SECOND, NAMES, STARTS))
    df = df.withColumn("tokens", tokens)
    marked = lambda word: F.startswith(word, F.lit(MARK)) & ~F.startswith(word, F.lit(NUMBERS))
    each = F.transform(
        "tokens",
        lambda word: F.struct(
            F.when(marked(word), F.substring(word, 2, 1)).otherwise(F.lit("")).alias("kind"),
            F.xxhash64(_kind(F.when(marked(word), F.substring(word, 3, 1 << 30)).otherwise(word))).alias("bare"),
        ),
    )
    df = df.select(*(name for name in df.columns if name not in ("valued", "tokens")), each.alias("each"))
    number = {kind: F.xxhash64(F.lit(mark)) for kind, mark in (("u", UNITS_), ("n", NAMES))}

    def form(names: tuple[str, ...], dropped: tuple[str, ...]) -> Column:
        kept = F.filter("each", lambda token: ~token["kind"].isin(*dropped)) if dropped else F.col("each")
        if not names:
            return F.transform(kept, lambda token: token["bare"])
        return F.transform(
            kept,
            lambda token: F.when(token["kind"].isin(*names), number["n"]).when(token["kind"] == "u", number["u"]).otherwise(token["bare"]),
        )

    forms = [form(("n", "d"), ("c",)), form((), ()), form(("n", "s"), ("c", "d"))]
    return df.select(*(name for name in df.columns if name != "each"), *(part.alias(f"form{n}") for n, part in enumerate(forms)))


def _with_windows(df: DataFrame, sizes: list[int], form: int, source: str) -> tuple[DataFrame, dict[int, Column]]:
    """Hash of each window of codes, in order, for each size; different in each form.

    A window's hash is made of those of its halves, so each is a few steps, and each step a column of its own.
    """
    powers = {1: source}
    while max(powers) * 2 <= max(sizes):
        size = max(powers)
        half, name = F.col(powers[size]), f"{source}_{size * 2}"
        df = df.withColumn(name, F.zip_with(half, F.slice(half, size + 1, F.size(half)), lambda a, b: F.xxhash64(a, b)))
        powers[size * 2] = name
    out = {}
    for size in sizes:
        parts = [1 << bit for bit in range(size.bit_length()) if size >> bit & 1]
        whole, at = None, 0
        for part in reversed(parts):
            shifted = F.slice(powers[part], at + 1, F.greatest(F.size(powers[part]), F.lit(0)))
            whole = shifted if whole is None else F.zip_with(whole, shifted, lambda a, b: F.xxhash64(a, b))
            at += part
        full = F.slice(whole, 1, F.greatest(F.size(source) - (size - 1), F.lit(0)))
        out[size] = F.transform(full, lambda hashed: hashed.bitwiseXOR(F.lit(form * 0x1F123BB5)))
    return df, out


def _forms(rows: DataFrame) -> DataFrame:
    """``valued`` as tokens, a row for each form."""
    each = F.array(*(F.struct(F.lit(number).alias("form"), words(form(F.col("valued"))).alias("tokens")) for number, form in enumerate(FORMS)))
    kept = [name for name in rows.columns if name != "valued"]
    return rows.select(*kept, F.explode(each).alias("read")).select(*kept, "read.*")


def _at_most(df: DataFrame, rows: int) -> bool:
    return df.limit(rows + 1).count() <= rows


def _bounded(df: DataFrame) -> DataFrame:
    """Marked for broadcast where it is small; else Spark joins by shuffle and splits hot keys."""
    return F.broadcast(df) if _at_most(df, BROADCAST_ROWS) else df


def classes(items: DataFrame, item: str, item_text: str, size: int, need: int) -> tuple[DataFrame, DataFrame]:
    """The benchmark's classes, and their items with values.

    Classes are ``class, form, codes, pattern, width, telling, need, n_items, item``: ``pattern``
    has per token the place of the first token with its value (from 1), 0 for a word; ``telling``
    are the places of windows that count, of which ``need`` make a match, all of an item that
    has fewer; ``item`` is the smallest. An item shorter than a window is one window of its own length.
    A window without a word counts for nothing, so an item of numbers and names alone has no class.
    """
    bench = items.select(identity(item, item_text).alias("item"), valued(ref(item_text)).alias("valued")).dropDuplicates(["item"])
    read = _forms(bench).where(F.size("tokens") > 0)
    marked = lambda word: F.startswith(word, F.lit(MARK))
    pattern = F.transform("tokens", lambda word: F.when(marked(word), F.array_position("tokens", word)).otherwise(0).cast("int"))
    read = read.select("item", "form", "tokens", codes(F.col("tokens")).alias("codes"), pattern.alias("pattern"))
    read = read.withColumns(
        {"width": F.least(F.size("tokens"), F.lit(size)), "class": F.xxhash64("form", "codes", "pattern")}
    )
    read = checkpoint(read)
    told = read.groupBy("class", "form", "width", "codes", "pattern").agg(
        F.count(F.lit(1)).alias("n_items"), F.min("item").alias("item"), F.min("tokens").alias("tokens")
    )
    starts = F.sequence(F.lit(0), F.size("codes") - F.col("width"))
    as_they_are = lambda at: F.size(F.filter(F.slice("pattern", at + 1, F.col("width")), lambda slot: slot == 0))
    tells = lambda at: (as_they_are(at) > 0) & (
        (F.col("form") != FORMS.index(capitals)) | (as_they_are(at) * 8 >= WORDS_OF_EIGHT * F.col("width"))
    )
    told = told.withColumn("telling", F.filter(starts, tells)).where(F.size("telling") > 0)
    return checkpoint(told.withColumn("need", F.least(F.size("telling"), F.lit(need)))), read.select("class", "item", "tokens", "pattern", "width")


def _index(told: DataFrame, sizes: list[int]) -> DataFrame:
    """``hash, class, form, place, length, anchor, lead, run``: of each class its rarest windows; any ``need`` of its windows hold one of them.

    ``anchor`` is the hash of the window's longest run of so many neighbouring words, as many as it has of ``RUNS``,
    ``lead`` that of its first two.
    """
    told = told.withColumn("sizes", F.transform("tokens", lambda word: F.length(word)))
    hashed = F.array().cast("array<bigint>")
    for form in range(len(FORMS)):
        told = told.withColumn(f"codes{form}", F.col("codes"))
        told, by_size = _with_windows(told, sizes or [1], form, f"codes{form}")
        for width in sizes:
            hashed = F.when((F.col("form") == form) & (F.col("width") == width), by_size[width]).otherwise(hashed)
    each = told.select(
        "class", "form", "need", "telling", "width", "codes", "pattern", "sizes", F.size("codes").alias("length"),
        F.posexplode(hashed).alias("place", "hash"),
    )
    each = each.where(F.array_contains("telling", F.col("place")))
    # A window that many classes have is looked up for those alone that have nothing rarer.
    common = each.groupBy("hash").agg(F.count(F.lit(1)).alias("times"))
    rank = F.row_number().over(Window.partitionBy("class").orderBy("times", "place"))
    ranked = each.join(common, "hash").withColumn("rank", rank)
    ranked = ranked.where(F.col("rank") <= F.size("telling") - F.col("need") + 1)
    places = F.sequence(F.col("place"), F.col("place") + F.col("width") - 1)
    end = F.col("place") + F.col("width")
    anchor, lead, run = F.lit(None).cast("long"), F.lit(None).cast("long"), F.lit(None).cast("int")
    for count in sorted(RUNS):
        free = partial(_free, end, count)
        size = partial(_size, count)
        longest = F.array_max(_mapped(_kept(places, free), lambda at, size=size: F.struct(size(at).alias("size"), (-at).alias("at"))))["at"]
        hashed = _run_hash([F.get("codes", -longest + i) for i in range(count)])
        first = _run_hash([F.get("codes", -longest + i) for i in range(min(count, 2))])
        anchor, lead = F.when(longest.isNotNull(), hashed).otherwise(anchor), F.when(longest.isNotNull(), first).otherwise(lead)
        run = F.when(longest.isNotNull(), count).otherwise(run)
    return ranked.select("hash", "class", "form", "place", "length", anchor.alias("anchor"), lead.alias("lead"), run.alias("run"))


def _free(end: Column, count: int, at: Column) -> Column:
    """Whether so many words without a placeholder stand from a place on, before the window's end."""
    return (at + count <= end) & F.forall(F.slice("pattern", at + 1, count), lambda slot: slot == 0)


def _size(count: int, at: Column) -> Column:
    return F.aggregate(F.slice("sizes", at + 1, count), F.lit(0), lambda a, b: a + b)


def _kept(values: Column, test) -> Column:
    return F.filter(values, lambda value: test(value))


def _mapped(values: Column, change) -> Column:
    return F.transform(values, lambda value: change(value))


def _run_hash(parts: list[Column]) -> Column:
    """Hash of a run of codes, made of its pairs'."""
    while len(parts) > 1:
        pairs = [F.xxhash64(a, b) for a, b in zip(parts[::2], parts[1::2], strict=False)]
        parts = [*pairs, *parts[len(pairs) * 2 :]]
    return parts[0]


def _bits(hashed: Column) -> list[tuple[Column, Column]]:
    """Word and bit of the plane that a hash sets, twice."""
    words_ = PLANE_BITS // 64
    return [
        (F.shiftright(hashed, low).bitwiseAND(F.lit(words_ - 1)).cast("int"), F.shiftright(hashed, low + 24).bitwiseAND(F.lit(63)).cast("int"))
        for low in (0, 30)
    ]


def _plane(known: DataFrame, name: str) -> Column:
    """The bits that hashes set, as one constant: ``PLANE_BITS`` bits however many hashes there are."""
    set_ = known.select(F.explode(F.array(*(F.struct(w.alias("w"), b.alias("b")) for w, b in _bits(F.col(name))))).alias("s")).select("s.*")
    found = set_.groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("bits")).collect()
    bits = ["0"] * (PLANE_BITS // 64)
    for row in found:
        bits[row["w"]] = str(row["bits"])
    # A constant that Spark folds; thousands of single literals would be slow to plan.
    return F.split(F.lit(",".join(bits)), ",").cast("array<bigint>")


def _holds(codes_: str, known: DataFrame, name: str) -> Column:
    """Whether any code is one of the index's; beyond ``LISTED`` of them, whether it has both its bits in their plane."""
    listed = [row[0] for row in known.select(name).distinct().limit(LISTED + 1).collect()]
    if len(listed) <= LISTED:
        return F.exists(codes_, lambda code: code.isin(listed))
    plane = _plane(known, name)

    def held(code: Column) -> Column:
        first, second = (F.getbit(F.get(plane, word), bit) == 1 for word, bit in _bits(code))
        return first & second

    return F.exists(codes_, held)


def _may_match(docs: DataFrame, key: str, text: str, known: DataFrame) -> DataFrame:
    """``key, text`` of the rows whose plain words hold an anchor of the index. Few others pass.

    The first two words of the anchors are tested first, whole anchors only where they are found.
    """
    runs = sorted(row["run"] for row in known.select("run").distinct().collect())  # of four
    if not runs:
        return docs.select(ref(key).alias("key"), ref(text).alias("text")).limit(0)
    # The tokens of ``plain``, but for numbers, which no anchor holds.
    lower = F.lower(F.translate(F.coalesce(ref(text), F.lit("")), MARK + JOINT + PUNCTUATION, ""))
    tokens = F.filter(F.split(lower, f"{SPACE}+"), lambda word: word != "")
    rows = docs.select(ref(key).alias("key"), ref(text).alias("text"), F.transform(tokens, lambda word: F.xxhash64(word)).alias("run1"))
    # The number of the row keeps Spark from working the runs out again inside the conditions.
    number = F.monotonically_increasing_id()
    two = F.zip_with("run1", F.slice("run1", 2, F.size("run1")), lambda a, b: F.xxhash64(a, b))
    rows = rows.select("*", two.alias("run2"), number.alias("row"))
    starts = F.lit(False)
    if 1 in runs:
        starts = _holds("run1", known.where("run = 1"), "lead")
    if max(runs) > 1:
        starts = _holds("run2", known.where("run > 1"), "lead") | starts
    rows = rows.where(starts & (F.col("row") >= 0)).drop("row")
    three = F.zip_with("run2", F.slice("run1", 3, F.size("run1")), lambda a, b: F.xxhash64(a, b))
    four = F.zip_with("run2", F.slice("run2", 3, F.size("run2")), lambda a, b: F.xxhash64(a, b))
    rows = rows.select("*", three.alias("run3"), four.alias("run4"), number.alias("row"))
    whole = F.lit(False)
    for run in runs:
        whole = whole | _holds(f"run{run}", known.where(F.col("run") == run), "anchor")
    return rows.where(whole & (F.col("row") >= 0)).select("key", "text")


def found_places(docs: DataFrame, told: DataFrame, key: str, text: str) -> DataFrame:
    """``id, class, form, shift, length``: where a class may begin in a document (it may begin before it)."""
    sizes = sorted(row["width"] for row in told.select("width").distinct().collect())  # at most ``size`` numbers
    index = checkpoint(_index(told, sizes))
    some = _may_match(docs, key, text, index)
    read = _codes_of_all_forms(some.select(identity("key", "text").alias("id"), valued(F.col("text")).alias("valued")))
    hashes = []
    for form in range(len(FORMS)):
        read, by_size = _with_windows(read, sizes or [1], form, f"form{form}")
        hashes.append(by_size)
    known = _bounded(index.drop("anchor", "lead", "run"))
    out = None
    for width in sizes:
        hashed = F.concat(*(by_size[width] for by_size in hashes))
        # Places count on through the forms, whose hashes differ; the join brings the form back.
        counts = [F.greatest(F.size(f"form{form}") - (width - 1), F.lit(0)).alias(f"n{form}") for form in range(len(FORMS))]
        each = read.select("id", *counts, F.posexplode(hashed).alias("at", "hash")).join(known, "hash")
        before = F.when(F.col("form") == 0, 0).when(F.col("form") == 1, F.col("n0")).otherwise(F.col("n0") + F.col("n1"))
        met = each.select("id", "class", "form", (F.col("at") - before - F.col("place")).alias("shift"), "length")
        out = met if out is None else out.unionAll(met)
    if out is None:  # an empty benchmark
        return read.select("id").limit(0).selectExpr("id", "0L as class", "0 as form", "0 as shift", "0 as length")
    return out.distinct()


def _held_against(docs: DataFrame, places: DataFrame, told: DataFrame, key: str, text: str) -> DataFrame:
    """The places at which enough windows agree, with what the document says there.

    A text is joined to all its places at once, and read once.
    """
    per_doc = places.groupBy("id").agg(F.collect_list(F.struct("class", "form", "shift", "length")).alias("places"))
    texts = docs.select(identity(key, text).alias("id"), valued(ref(text)).alias("valued"))
    own = texts.join(_bounded(per_doc), "id").groupBy("id").agg(F.first("valued").alias("valued"), F.first("places").alias("places"))
    own = own.select("id", "places", *(words(form(F.col("valued"))).alias(f"form{number}") for number, form in enumerate(FORMS)))

    def said(place: Column) -> Column:
        out = None
        for number in range(len(FORMS)):
            tokens = F.col(f"form{number}")
            part = F.transform(F.sequence(F.lit(0), place["length"] - 1), lambda i: F.get(tokens, place["shift"] + i))
            out = part if out is None else F.when(place["form"] == number, part).otherwise(out)
        return out

    parts = F.transform("places", lambda place: F.struct(place["class"].alias("class"), place["shift"].alias("shift"), said(place).alias("said")))
    each = own.select("id", F.explode(parts).alias("part")).select("id", "part.*")
    both = each.join(_bounded(told.drop("tokens")), "class")
    equal = F.zip_with(codes(F.coalesce("said", F.array().cast("array<string>"))), F.col("codes"), lambda a, b: F.coalesce(a == b, F.lit(False)))
    both = both.withColumn("equal", equal)
    agree = F.filter("telling", lambda at: F.forall(F.slice("equal", at + 1, F.col("width")), lambda same: same))
    return both.withColumn("places", agree).where(F.size("places") >= F.col("need")).drop("equal", "codes", "telling")


def leaks(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", size: int = WINDOW, need: int = NEED,
) -> DataFrame:
    """``id, item, kind, n_windows, n_equal, shift, n_items``: the best match of a document with an item or a class.

    An item that is there ``verbatim`` (enough windows have equal values) is named. The other
    items of its class are one row more, under the smallest of the class, with their number in
    ``n_items``: ``verbatim`` if the windows without placeholders are enough already, else
    ``changed`` where the values correspond one to one. Others are left out. ``id`` holds the key
    and a hash of the text, and so does ``item``. Rows that repeat both are one; null keys are
    kept; a null or empty text, or item, matches nothing. Other columns are ignored.
    """
    told, read = classes(items, item, item_text, size, need)
    places = checkpoint(found_places(docs, told, key, text))
    met = checkpoint(_held_against(docs, places, told, key, text))
    window = lambda values, at: F.slice(values, at + 1, F.col("width"))
    open_ones = lambda at: F.exists(window("pattern", at), lambda slot: slot > 0)
    met = met.withColumns(
        {"slotted": F.filter("places", open_ones), "without": F.size(F.filter("places", lambda at: ~open_ones(at)))}
    )
    # Items by the values of windows that have placeholders.
    values = lambda tokens: F.explode(F.transform("at", lambda at: F.struct(at.alias("at"), F.xxhash64(window(tokens, at)).alias("values"))))
    starts = F.sequence(F.lit(0), F.size("tokens") - F.col("width"))
    bench = read.withColumn("at", F.filter(starts, open_ones)).select("class", F.col("item").alias("own"), values("tokens").alias("w")).select("class", "own", "w.*")
    said = met.withColumn("at", F.col("slotted")).select("id", "class", "shift", "need", "without", F.size("places").alias("n_windows"), values("said").alias("w"))
    equal = said.select("id", "class", "shift", "need", "without", "n_windows", "w.*").join(bench, ["class", "at", "values"])
    by_name = equal.groupBy("id", "class", "shift", "own", "need", "without", "n_windows").agg(F.count(F.lit(1)).alias("n"))
    by_name = by_name.withColumn("n_equal", F.col("n") + F.col("without")).where(F.col("n_equal") >= F.col("need"))
    by_name = checkpoint(by_name.select("id", "class", "shift", F.col("own").alias("item"), "n_windows", "n_equal"))
    # The rest of the class.
    covered = F.array_distinct(F.flatten(F.transform("places", lambda at: F.sequence(at, at + F.col("width") - 1))))
    slots = F.filter(covered, lambda at: F.get("pattern", at) > 0)
    pairs = F.array_distinct(F.transform(slots, lambda at: F.struct(F.get("pattern", at).alias("asked"), F.get("said", at).alias("said"))))
    one_to_one = (F.size(F.array_distinct(F.transform("pairs", lambda p: p["asked"]))) == F.size("pairs")) & (
        F.size(F.array_distinct(F.transform("pairs", lambda p: p["said"]))) == F.size("pairs")
    )
    # An item named in one form is not told again by its classes in the others.
    named = by_name.select("id", "item").distinct().join(read.select("item", "class"), "item")
    named = named.groupBy("id", "class").agg(F.count(F.lit(1)).alias("named"))
    rest = met.withColumn("pairs", pairs).select(
        "id", "class", "item", "shift", F.size("places").alias("n_windows"), F.col("without").alias("n_equal"), "n_items",
        F.when(F.col("without") >= F.col("need"), "verbatim").when(one_to_one, "changed").alias("kind"),
    ).where("kind is not null")
    rest = rest.join(named, ["id", "class"], "left").withColumn("n_items", F.col("n_items") - F.coalesce("named", F.lit(0)))
    columns = ["id", "item", "kind", "n_windows", "n_equal", "shift", "n_items"]
    both = by_name.withColumns({"kind": F.lit("verbatim"), "n_items": F.lit(1).cast("long")}).select(
        *columns, F.lit(True).alias("by_name")
    ).unionAll(rest.where("n_items > 0").select(*columns, F.lit(False)))
    best = F.max_by(
        F.struct(*columns[2:]), F.struct(F.col("kind") == "verbatim", "n_windows", "n_equal", "n_items", -F.col("shift"))
    )
    return both.groupBy("id", "item", "by_name").agg(best.alias("best")).select("id", "item", "best.*")


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per contaminated document and item, or class of items."""
    return leaks(docs, items).select(
        F.col("id.key").alias("doc_id"), F.col("item.key").alias("item_id"), "kind",
        *(F.col(name).cast("long").alias(name) for name in ("n_windows", "n_equal", "n_items")),
    )


def clean(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows of documents that match no item, with all columns. All repeats of a match go."""
    name = free_name(docs, "ident")
    found = checkpoint(leaks(docs, items, key, text, item, item_text).select("id").distinct())
    bad = _bounded(found.select(F.col("id").alias(name)))
    return docs.withColumn(name, identity(key, text)).join(bad, name, "left_anti").select(*(ref(c) for c in docs.columns))
