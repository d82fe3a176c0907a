"""Benchmark passages: planted edits against full alignment."""

from __future__ import annotations

import random

import numpy as np
import pytest
from tables import ODD, documents

from lustra.llm.qgram_decontamination import Budget, clean_texts, contaminated, plain

SF = "/root/testdata/sf0.001"
BUDGET = Budget()


def normal(text):
    return plain(np.frombuffer(text.encode(), np.uint8))[0].tobytes()


def least_distance(passage, text):
    """Edits from the passage to the closest stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(passage, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(draw, text, edits):
    out = list(text)
    for _ in range(edits):
        at = draw.randrange(len(out))
        kind = draw.random()
        if kind < 0.4:
            out[at] = draw.choice("xyzqk")
        elif kind < 0.7:
            del out[at]
        else:
            out.insert(at, draw.choice("xyzqk"))
    return "".join(out)


@pytest.fixture(scope="module")
def items(spark):
    return [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]


def benchmark(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, doc_id string")


def test_edits_up_to_and_over_the_budget(spark, items):
    draw = random.Random(4)
    rows, wanted = [], {}
    for doc in range(60):
        item, text = draw.choice(items)
        edits = draw.randint(0, int(1.4 * BUDGET.edits(len(normal(text)))))
        around = ["Quelque chose. " * draw.randint(0, 3), " Other WORDS here" * draw.randint(0, 3)]
        whole = around[0] + edited(draw, text, edits) + around[1]
        rows.append((doc, whole))
        passage = normal(text).strip()
        distance = least_distance(passage, normal(whole))
        if distance <= BUDGET.edits(len(passage)):
            wanted[doc, item] = distance
    out = contaminated(documents(spark, rows).repartition(3), benchmark(spark, items)).collect()
    found = {(r.doc_id, r.item_id): r.distance for r in out}
    assert found == wanted and 20 < len(wanted) < 60
    texts = dict(rows)
    for r in out:
        raw = texts[r.doc_id].encode()[r.begin : r.end]
        assert raw.decode(errors="replace") == r.passage
        assert least_distance(normal(dict(items)[r.item_id]).strip(), normal(r.passage)) == r.distance


def test_given_documents(spark, items):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {(r.doc_id, r.item_id) for r in contaminated(docs, benchmark(spark, items)).collect()}
    texts = {r.doc_id: normal(r.text) for r in docs.collect()}
    exact = {(d, i) for d, t in texts.items() for i, p in items if normal(p).strip() in t}
    assert exact and exact <= found
    kept = {r.doc_id for r in clean_texts(docs, benchmark(spark, items)).collect()}
    assert kept == set(texts) - {d for d, _ in found}


def test_blocks_of_passages_and_short_ones(spark, items):
    rows = [(1, f"see: {items[0][1].upper()} end {items[0][1]}"), (2, "a tiny one here"), (3, "nothing"), (4, "é TINY")]
    short = [*items, (900, "tiny"), (901, ""), (902, None), (903, "É tiny"), (904, "   ")]
    docs = documents(spark, rows)
    whole = contaminated(docs, benchmark(spark, short)).collect()
    assert sorted((r.doc_id, r.item_id, r.distance) for r in whole) == [
        (1, items[0][0], 0), (1, items[0][0], 0), (2, 900, 0), (4, 900, 0), (4, 903, 0),
    ]
    assert sorted(contaminated(docs, benchmark(spark, short), block_bytes=600).collect()) == sorted(whole)
    assert [r.doc_id for r in clean_texts(docs, benchmark(spark, short), block_bytes=600).collect()] == [3]


def test_bound_is_never_below_one():
    for size in range(1, 500):
        assert BUDGET.shared(size) >= 1
        assert BUDGET.edits(size) <= 0.08 * size


def test_odd_rows(spark, items):
    docs = documents(spark, [*ODD, (50, items[1][1]), (50, items[1][1])])
    assert [(r.doc_id, r.item_id) for r in contaminated(docs, benchmark(spark, items)).collect()] == [(50, items[1][0])] * 2
    assert clean_texts(docs, benchmark(spark, items)).count() == len(ODD)
    assert contaminated(documents(spark, []), benchmark(spark, items)).collect() == []
    assert contaminated(docs, benchmark(spark, [])).collect() == []
    assert clean_texts(docs, benchmark(spark, [])).count() == docs.count()
