"""Licence scans by a positional index of rare words.

Licence notices are templates. Of each template the words that fewest documents hold are
indexed with their places. A file's rarest indexed words are looked up; postings that
agree on where the template would begin in the file vote for that place. A template with
enough votes counts if all its key phrases stand in the file. Short phrases that name a
licence are counted on their own. Built-in functions only; texts are read twice, once
for the document frequencies and once for the words, and everything after that works on
the indexed words alone.
"""

from __future__ import annotations

import re
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro.llm.frames import checkpoint, ref

#: What parts words: every ASCII character but digits and lower-case letters.
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


@dataclass(frozen=True)
class Template:
    """A notice, its label, and phrases without which it is not that licence."""

    label: str
    text: str
    phrases: tuple[str, ...]

    @property
    def words(self) -> list[str]:
        return [word for word in re.split(GAP, self.text.lower()) if word]


# Phrases that name a licence, and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# The notices licences ask to be put into files.
TEMPLATES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0.", ("apache license version 2 0",)),
    Template(
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied.",
        ("except in compliance with the license", "without warranties or conditions of any kind"),
    ),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3.",
             ("gnu general public license version 3",)),
    Template(
        "gpl-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version of the License, or (at your "
        "option) any later version.",
        ("gnu general public license", "at your option any later version"),
    ),
    Template(
        "lgpl-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation",
        ("gnu lesser general public license",),
    ),
    Template(
        "agpl-or-later",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        ("gnu affero general public license",),
    ),
    Template("mit", "Released under the MIT License.", ("under the mit license",)),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        ("hereby granted free of charge", "to deal in the software without restriction"),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer.",
        ("redistribution and use in source and binary forms", "with or without modification"),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        ("for any purpose with or without fee",),
    ),
    Template(
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at",
        ("mozilla public license v 2 0",),
    ),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0.", ("cc by nc 4 0",)),
    Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0.", ("cc by sa 4 0",)),
    Template("cc-by-4.0", "Licensed under CC BY 4.0.", ("cc by 4 0",)),
    Template(
        "cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        ("creative commons attribution 4 0 international",),
    ),
    Template(
        "unlicense", "This is free and unencumbered software released into the public domain.",
        ("free and unencumbered software",),
    ),
)


@dataclass(frozen=True)
class Scan:
    """Words indexed per template, words looked up per file, and votes that make a candidate (all, of fewer words)."""

    templates: tuple[Template, ...] = TEMPLATES
    phrases: tuple[tuple[str, str], ...] = PHRASES
    indexed: int = 12
    looked_up: int = 12
    votes: int = 3

    @property
    def vocabulary(self) -> list[str]:
        return sorted({word for template in self.templates for word in template.words})


def words(text: Column) -> Column:
    """Runs of digits, lower-case ASCII letters and characters beyond ASCII; only A-Z change case."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(lower, GAP), lambda word: word != "")


def document_frequencies(docs: DataFrame, text: str, vocabulary: list[str]) -> dict[str, int]:
    """Rows that hold each word of the vocabulary, which bounds what is returned; all rows are read."""
    held = F.array_distinct(F.filter(words(ref(text)), lambda word: word.isin(vocabulary)))
    counted = docs.select(F.explode(held).alias("word")).groupBy("word").count()
    found = {row["word"]: row["count"] for row in counted.collect()}
    return {word: found.get(word, 0) for word in vocabulary}


def postings(scan: Scan, frequencies: dict[str, int]) -> list[tuple[str, int, int, int]]:
    """``word, rank, template, place`` of each template's rarest words. Rank 1 is the rarest; ties by word."""
    order = sorted(frequencies, key=lambda word: (frequencies[word], word))
    rank = {word: number for number, word in enumerate(order, 1)}
    out = []
    for number, template in enumerate(scan.templates):
        kept = sorted(set(template.words), key=rank.__getitem__)[: scan.indexed]
        out += [(word, rank[word], number, place) for place, word in enumerate(template.words) if word in kept]
    return out


def _starts(phrase: list[str]) -> Column:
    """Places at which the words of a phrase stand one after the other."""
    parts = F.array(*(F.lit(word) for word in phrase))
    return F.filter("places", lambda i: F.slice("words", i + 1, len(phrase)) == parts)


def _read(docs: DataFrame, key: str, text: str, scan: Scan, indexed: list[str]) -> DataFrame:
    """One small row per row of ``docs``: counts, phrases and indexed words with their places."""
    starts = sorted({phrase.split()[0] for phrase, _ in scan.phrases})
    wanted = sorted({*indexed, *starts})
    rows = docs.select(ref(key).alias("key"), words(ref(text)).alias("words"))
    place = F.transform("words", lambda word, i: F.when(word.isin(wanted), i))
    rows = rows.select("key", "words", F.filter(place, lambda i: i.isNotNull()).alias("places"))
    named = [_starts(phrase.split()).alias(f"phrase{number}") for number, (phrase, _) in enumerate(scan.phrases)]
    # Words stand between single blanks, so a phrase is found whole.
    padded = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    rows = rows.select("*", *named, F.when(F.size("places") > 0, padded).alias("padded"))
    keys = sorted({phrase for template in scan.templates for phrase in template.phrases})
    held = F.filter(
        F.array(*(F.when(F.contains("padded", F.lit(f" {phrase} ")), F.lit(phrase)) for phrase in keys)),
        lambda phrase: phrase.isNotNull(),
    )
    tokens = F.transform(
        F.filter("places", lambda i: F.get("words", i).isin(indexed)),
        lambda i: F.struct(i.alias("at"), F.get("words", i).alias("word")),
    )
    return checkpoint(
        rows.select(
            F.monotonically_increasing_id().alias("row"), "key", F.size("words").alias("n_words"),
            *(f"phrase{number}" for number in range(len(scan.phrases))), held.alias("held"), tokens.alias("tokens"),
        )
    )


def _templates(rows: DataFrame, scan: Scan, index: list[tuple[str, int, int, int]]) -> DataFrame:
    """``row, template, label, score`` of the templates that pass, at their best place."""
    spark = rows.sparkSession
    table = F.broadcast(spark.createDataFrame(index, "word string, rank int, template int, place int"))
    sizes = [sum(1 for entry in index if entry[2] == number) for number in range(len(scan.templates))]
    notices = F.broadcast(
        spark.createDataFrame(
            [
                (number, template.label, list(template.phrases), sizes[number], min(scan.votes, sizes[number]))
                for number, template in enumerate(scan.templates)
            ],
            "template int, label string, phrases array<string>, size int, need int",
        )
    )
    ranks = F.map_from_arrays(*(F.lit(list(part)) for part in zip(*sorted({entry[:2] for entry in index}), strict=True)))
    # The file's rarest indexed words, by their distinct ranks.
    own = F.array_sort(F.array_distinct(F.transform("tokens", lambda token: F.element_at(ranks, token["word"]))))
    told = rows.where(F.size("tokens") > 0).select("row", "held", F.slice(own, 1, scan.looked_up).alias("rarest"), "tokens")
    each = told.select("row", "held", "rarest", F.explode("tokens").alias("token"))
    each = each.select("row", "held", "rarest", "token.at", "token.word").join(table, "word")
    voted = each.groupBy("row", "template", (F.col("at") - F.col("place")).alias("shift")).agg(
        F.count_if(F.array_contains("rarest", F.col("rank"))).alias("votes"),
        F.count(F.lit(1)).alias("found"),
        F.first("held").alias("held"),
    )
    passed = voted.join(notices, "template").where(
        (F.col("votes") >= F.col("need")) & (F.size(F.array_except("phrases", "held")) == 0)
    )
    return passed.groupBy("row", "template", "label").agg((F.max("found") / F.first("size")).alias("score"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", using: Scan = Scan()) -> DataFrame:
    """Per row: ``key, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base`` counts the places of the naming phrases, overlapping ones too; ``first_word``
    and ``last_word`` are their smallest and largest start. ``labels`` adds those of the
    templates. ``score`` is the largest share of a passing template's indexed words that
    stand in line, 1 at most, 0 without a template. A null text is empty. Repeated rows and
    null keys stay, a row each; other columns are ignored.
    """
    index = postings(using, document_frequencies(docs, text, using.vocabulary))
    rows = _read(docs, key, text, using, sorted({entry[0] for entry in index}))
    passed = _templates(rows, using, index)
    best = passed.groupBy("row").agg(F.max("score").alias("score"), F.collect_set("label").alias("found"))
    names = [f"phrase{number}" for number in range(len(using.phrases))]
    starts = F.concat(*names)
    own = F.filter(
        F.array(*(F.when(F.size(name) > 0, F.lit(label)) for name, (_, label) in zip(names, using.phrases, strict=True))),
        lambda label: label.isNotNull(),
    )
    joined = rows.select("row", "key", "n_words", starts.alias("starts"), F.array_distinct(own).alias("base")).join(best, "row", "left")
    both = F.array_union("base", F.coalesce("found", F.array().cast("array<string>")))
    return joined.select(
        F.col("key").alias(key), F.col("n_words").cast("long").alias("n_words"), F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"), F.array_join(F.array_sort(both), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
