"""Licence scans on hand-made files."""

from lastro.llm import licences

HEADER = """# Copyright 2020 Someone
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
"""
FILES = {
    0: HEADER,
    1: HEADER.replace("Version 2.0", "Version 2.1"),
    2: "Permission is hereby granted, free of charge, to any person obtaining a copy of this thing, a work, "
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge",
    3: "Permission is hereby granted, in exchange for money, to any person obtaining a copy of this software and associated "
    "documentation files, to use, copy, modify, merge, publish, distribute, sublicense and sell copies of the Software",
    4: "GNU\n * General   Public-License! gnu general public license, and CC BY; CC_BY 4.0",
    5: "the apache licenses, a mit licensed thing, acc by gnu general publics license",
    6: "Released under the MIT License. Licensed under CC BY-NC 4.0. Not the MIT license.",
    7: "İ MIT LICENSE Ä",
}


def test_labels_of_files(spark):
    rows = {r.doc_id: r for r in licences.scan(spark.createDataFrame(list(FILES.items()), "doc_id long, text string")).collect()}
    assert rows[0].labels == "apache,apache-2.0" and rows[0].score == 1.0
    # The long notice stands but for one word, the short one lacks its phrase.
    assert rows[1].labels == "apache,apache-2.0"
    assert rows[2].labels == "mit" and rows[2].base_labels == "" and 0 < rows[2].score < 1
    assert rows[3].labels == "" and rows[3].score == 0
    assert (rows[4].n_base, rows[4].first_word, rows[4].last_word, rows[4].base_labels) == (4, 0, 11, "cc-by,gpl")
    assert rows[5].n_base == 0 and rows[5].first_word is None
    assert rows[6].labels == "cc-by,cc-by-nc-4.0,mit" and rows[6].n_base == 3
    assert (rows[7].n_words, rows[7].n_base, rows[7].first_word) == (4, 1, 1)


def test_rare_words_are_indexed_and_found_anywhere(spark):
    """A notice far inside a file of common words is found by its rare ones."""
    common = "the of to and in this software is under a any work version license " * 400
    files = [(n, common + ("Redistribution and use in source and binary forms, with or without modification, are permitted "
                           "provided that the following conditions are met:" if n % 3 == 0 else "") + common) for n in range(12)]
    rows = licences.scan(spark.createDataFrame(files, "doc_id long, text string")).collect()
    assert {r.doc_id for r in rows if r.labels == "bsd"} == {0, 3, 6, 9}
