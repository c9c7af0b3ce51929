import re
import textwrap
import time

import pytest

from stintlake.llm import licenses as L
from stintlake.llm.queries import QUERIES
from tests.llm.license_texts import NOTICES, TEXTS

SF = "/root/testdata/sf0.01"
# The notices planted in the given table, looked up by plain search.
PLANTED = {
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the MIT License.": "MIT",
}

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction.

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY. IN NO EVENT
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE."""


def test_query_on_given_table(spark):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    out = {r.doc_id: r for r in QUERIES["op6_licenses"](spark, SF).collect()}
    assert set(out) == set(texts)
    for doc_id, text in texts.items():
        places = sorted((m.start(), name) for line, name in PLANTED.items() for m in re.finditer(re.escape(line), text))
        assert out[doc_id].licenses == ",".join(name for _, name in places)
        assert out[doc_id].n_licenses == len(places)
    assert sum(r.n_licenses for r in out.values()) > 10


@pytest.mark.parametrize("text,names", [
    ("Copyright (c) 2020 A. Person\n\n" + MIT, ["MIT"]),
    ("SPDX-License-Identifier: BSD-3-Clause\nint main;", ["SPDX:bsd-3-clause"]),
    ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.", ["AGPL-3.0-or-later"]),
    ("# Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in compliance with the License.\n", ["Apache-2.0"]),
    ("The data are released under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0"]),
    ("a title\nReleased under the MIT License\nmore words", ["MIT"]),
    ("Released under the MIT License. Released under the MIT License.", ["MIT", "MIT"]),
    ("He was licensed to drive. The permission was lost.", []),
])
def test_rules(text, names):
    assert L.scan(text)["licenses"] == names


def test_left_over_and_unknown():
    got = L.scan("You may obtain a copy of the License at http://x.org/y. Ask for another license!")
    assert got["licenses"] == [] and got["unmatched"] == ["apache-copy"] and got["unknown"] == 1


def test_odd_rows(docs):
    text = "Released under the MIT License."
    df = docs(None, "", text, text, "word " * 100_000 + text, (None, text)).withColumnRenamed("lang", "spans")
    out = L.scan_licenses(df)
    assert out.columns == ["doc_id", "text", "source", "n_chars", *L._ADDED_ARROW]
    rows = out.collect()
    assert [r.licenses for r in rows] == [[], [], ["MIT"], ["MIT"], ["MIT"], ["MIT"]]
    s = rows[4].spans[0]
    assert rows[4].text[s["first"]:s["last"]].strip().endswith("MIT License")
    assert L.scan_licenses(docs()).count() == 0


APACHE = '''// Copyright 2020 Foo
//
// Licensed under the Apache License, Version 2.0 (the "License");
// you may not use this file except in compliance with the License.
'''


@pytest.mark.parametrize("text,names,copyrights", [
    (APACHE, ["Apache-2.0"], 1),
    (APACHE.replace("//\n", ""), ["Apache-2.0"], 1),
    ("Copyright 2020 Foo\nLicensed under the MIT License", ["MIT"], 1),
    ("(c) Foo\nLicensed under the MIT License", ["MIT"], 1),
    ("Copyright 2020 Foo, licensed under the MIT License", ["MIT"], 1),
    ("".join(f" * {line}\n" for line in ["Copyright (c) 2020 A. Person", "", *MIT.split("\n")]), ["MIT"], 1),
    ("Licensed under the Apache License, Version 2.0\nReleased under the MIT License", ["Apache-2.0", "MIT"], 0),
    ("Released under the MIT License and distributed under the GNU GPL, version 2 or later", ["MIT", "GPL-2.0-or-later"], 0),
    ("Licensed under either the MIT License or the Apache License, Version 2.0.", ["MIT", "Apache-2.0"], 0),
    ("title\nThis work is licensed\nunder the Apache License,\nVersion 2.0\nmore words", ["Apache-2.0"], 0),
])
def test_neighbours_are_not_swallowed(text, names, copyrights):
    got = L.scan(text)
    assert got["licenses"] == names and got["copyrights"] == copyrights


def test_holders_at_a_line_start_open_no_statement():
    text = "IN NO EVENT SHALL THE AUTHORS OR\nCOPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY."
    assert L.scan(text)["unmatched"] == ["mit-liability"]


def layouts(text):
    """A text on one line, wrapped, and as comments."""
    yield text
    for width in (12, 30, 50, 72):
        lines = textwrap.wrap(text, width, break_long_words=False, break_on_hyphens=False)
        yield "\n".join(lines)
        for sign in ("//", "#", " *"):
            yield "\n".join(f"{sign} {line}" for line in lines)


@pytest.mark.parametrize("name", TEXTS)
def test_published_texts_in_any_layout(name):
    for before in ("", "Copyright (c) 2020 A. Person\n", "Copyright 2020 A. Person "):
        for text in layouts(TEXTS[name]):
            # a text that is not a grant does not end the statement of a holder on its own line
            if before.endswith(" ") and (name not in ("MIT", "ISC") and not name.startswith("BSD")):
                continue
            got = L.scan(before + text)
            assert got["licenses"] == [name], (before, text, got)


@pytest.mark.parametrize("text", NOTICES)
def test_short_notices(text):
    assert L.scan(text)["licenses"] == NOTICES[text]
    assert L.scan(f"a title\n{text}\nmore words")["licenses"] == NOTICES[text]


def test_time_follows_length():
    def seconds(n):
        text = "Released under the MIT License\nand some words of licenses\n" * n
        start = time.perf_counter()
        assert len(L.scan(text)["licenses"]) == n
        return time.perf_counter() - start

    seconds(100)
    assert seconds(8000) < 20 * max(seconds(1000), 0.01)
