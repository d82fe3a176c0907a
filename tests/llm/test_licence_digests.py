from __future__ import annotations

import hashlib

import pytest
from oracle import differences
from pyspark.sql import functions as F
from tables import ODD, documents

from lustra.llm.licence_digests import KNOWN, canonical, known_digests, scan_licences, text_digests
from lustra.llm.queries import QUERIES


def test_query_matches_sql(spark):
    query = QUERIES["op9_licence_digests"]
    assert differences(spark, query.run, query.sql, "/root/testdata/sf0.001") is None


def wrapped(text, width):
    lines, line = [], ""
    for word in text.split():
        if len(line) + len(word) > width:
            lines.append(line)
            line = ""
        line = f"{line} {word}".strip()
    return "\n".join([*lines, line])


def test_whole_licences_in_other_dress(spark):
    rows, wanted = [], {}
    for i, (name, text) in enumerate(KNOWN):
        rows.append((i, "Copyright (c) 2019 Somebody\n\n" + wrapped(text, 61).upper().replace(",", " ,")))
        wanted[i] = name
    rows.append((500, KNOWN[0][1].replace("license", "licence").replace("sublicense", "sub-license")))
    rows.append((501, KNOWN[0][1] + " More."))
    out = {r.doc_id: r.licence for r in scan_licences(documents(spark, rows), known_digests(spark)).collect()}
    assert out == wanted | {500: "MIT", 501: None}


def test_notices_are_whole_lines(spark):
    rows = [
        (1, "Text.\nReleased under the MIT Licence\nSPDX-License-Identifier: GPL-3.0-only\nReleased under the MIT license!"),
        (2, "It is not released under the MIT License."),
        *ODD,
    ]
    out = {(r.doc_id, r.notices, r.licence) for r in scan_licences(documents(spark, rows), known_digests(spark)).collect()}
    assert {x for x in out if x[1] or x[2]} == {(1, "GPL-3.0,MIT", None)}
    found = scan_licences(documents(spark, ODD), known_digests(spark))
    assert found.count() == len(ODD)
    assert {r.doc_id for r in found.filter("digest IS NULL").collect()} == {1, 2, 3}


@pytest.mark.parametrize(
    "text, form",
    [
        ("A  b-C.", " a b c "),
        ("(c) 2020 X\nall Rights reserved.\nThe work", " the work "),
        ("copyright notice stays", " copyright notice stays "),
        ("Copyright © 1999-2001 Y\nz", " z "),
        ("Licence of an organisation", " license of an organization "),
        ("★", "  "),
    ],
)
def test_canonical_form(spark, text, form):
    row = spark.createDataFrame([(text,)], "t string").select(canonical(F.col("t")).alias("c")).first()
    assert row.c == form


def test_empty_table(spark):
    assert scan_licences(documents(spark, []), known_digests(spark)).collect() == []


def test_lines_of_a_whole_have_the_canonical_form_of_each(spark):
    """Line ends kept through the patterns: every line's form is that of the line alone, and so is the whole's."""
    texts = [
        "Copyright 2020 X\n(c) 2021 Y\r\n\n  The Licence,\nof  an-organisation \n\n",
        "non\ncommercial use\nnon commercial use",
        "all rights reserved\nplain copyright (c) line\n© 2020 Z\nend",
        "\n\n ★ \n",
        "one",
        "",
        "sub licence\nsub\nlicensed whilst\nwhilst  whilst",
        "licence licence per cent cent 𝄞licence\x0b\x1cé©x",
        "É(c) 2020\nÉcopyright 1\n©é\n* (C) all\nthe (c) 1\nCOPYRIGHT: 2020 by\ncopyright by\ncopyright of",
    ]
    alone = [(i, line) for i, text in enumerate(texts) for line in text.split("\n")]
    forms = spark.createDataFrame([(i, t, 0) for i, t in alone] + [(i, t, 1) for i, t in enumerate(texts)], "i int, t string, w int")
    want_lines, want = {i: set() for i in range(len(texts))}, {}
    for r in forms.select("i", "w", canonical(F.col("t")).alias("form")).collect():
        digest = hashlib.sha256(r.form.encode()).hexdigest() if len(r.form) > 2 else None
        if r.w:
            want[r.i] = digest
        elif digest:
            want_lines[r.i].add(digest)
    for i, text in enumerate(texts):
        assert text_digests(text.encode()) == (want[i], want_lines[i])


def test_many_known_texts_are_joined_by_shuffle(spark):
    rows = [(i, f"Text.\n{text}") for i, (_, text) in enumerate(KNOWN) if "\n" not in text]
    few, many = (
        {(r.doc_id, r.notices) for r in scan_licences(documents(spark, rows), known_digests(spark), n).collect()}
        for n in (100_000, 1)
    )
    assert few == many and all(notices for _, notices in few)
