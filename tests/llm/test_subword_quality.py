"""Held-out accuracy, and training and scoring of odd tables."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tables import ODD, documents

from lustra.llm.queries import QUERIES
from lustra.llm.subword_quality import Subwords, fit_bags, score, train

SF = "/root/testdata/sf0.01"


def test_held_out_labels(spark):
    out = {r.doc_id: r for r in QUERIES["op10_subword_quality"].run(spark, SF).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for r in out.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1
    held = [(out[d].score, q) for d, q in labels.items() if out[d].held_out]
    good, bad = ([s for s, q in held if q == k] for k in (1, 0))
    wins = np.mean([[(a > b) + 0.5 * (a == b) for b in bad] for a in good])
    assert wins >= 0.97
    assert np.mean([(s >= 0.5) == q for s, q in held]) >= 0.93


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, "plain good words in a row" if i % 2 else "### *** bad $$$ %%%") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(40)], "doc_id long, quality int, text string")
    return train(documents(spark, rows), labels, "quality")


def test_odd_rows(spark, model):
    out = score(documents(spark, [*ODD, (70, "plain good words"), (71, "### $$$")]), model)
    assert out.columns == ["doc_id", "score"] and out.count() == len(ODD) + 2
    found = {r.doc_id: r.score for r in out.collect()}
    assert found[1] == found[2] == found[3] == pytest.approx(1 / (1 + np.exp(-model.bias)))
    assert found[7] == found[8] and found[70] > 0.5 > found[71]
    assert score(documents(spark, []), model).collect() == []


def test_labels_that_teach_nothing(spark):
    docs = documents(spark, [(1, "a"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int")
    ones = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (1, None)], "doc_id long, quality int")
    assert [r.score for r in score(docs, train(docs, none, "quality")).collect()] == [0.5, 0.5]
    assert [r.score for r in score(docs, train(docs, ones, "quality")).collect()] == pytest.approx([0.75, 0.75])


def test_sample_is_bounded_and_fixed(spark):
    docs = documents(spark, [(i, f"text number {i}") for i in range(50)])
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    spec = Subwords(sample_rows=10, buckets_log2=10, least_steps=5)
    one, two = (train(docs.repartition(n), labels.repartition(n), "quality", spec) for n in (1, 5))
    assert one.weights == pytest.approx(two.weights, abs=1e-4)


def test_words_said_again_are_seen():
    spec = Subwords(buckets_log2=8, least_steps=200)
    bags = [np.array([1, 9], np.int32), np.array([9], np.int32)] * 10
    counts = [np.ones(len(b), np.int32) for b in bags]
    fitted = fit_bags(np.array([0, 1] * 10), bags, counts, spec)
    assert fitted.weights[1] < fitted.weights[9]
