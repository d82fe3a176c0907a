"""Every stage of the corpus pipeline against brute force on what the one before kept."""

from __future__ import annotations

import numpy as np
import test_jaccard_regions as jaccard
import test_repeats as repeats
from tables import ODD, documents

import corpus_pipeline
from lustra.llm.qgram_decontamination import contaminated
from lustra.llm.queries import VOCABULARIES
from lustra.llm.token_fertility import token_quality

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if i < 4:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/{i}")
        kept.append((docs, docs := spark.read.parquet(f"{tmp_path}/{i}")))

    before, after = kept[0]
    good = {r.doc_id for r in token_quality(before, VOCABULARIES).collect() if r.kept}
    assert rows_of(after) == {d: t for d, t in rows_of(before).items() if d in good}

    before, after = kept[1]
    firsts = {d for d, _, c in jaccard.expected(list(rows_of(before).items())) if d == c}
    assert rows_of(after) == {d: t for d, t in rows_of(before).items() if d in firsts}

    before, after = kept[2]
    texts = [(d, t.encode()) for d, t in rows_of(before).items()]
    left = {
        doc: np.frombuffer(data, np.uint8)[~bad].tobytes().decode(errors="ignore")
        for (doc, data), bad in zip(texts, repeats.covered_by_earlier(texts, 50))
    }
    assert rows_of(after) == left
    assert all(r.n_chars == len(r.text) for r in after.collect())

    before, after = kept[3]
    bad = {r.doc_id for r in contaminated(before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert rows_of(after) == {d: t for d, t in rows_of(before).items() if d not in bad}

    before, after = kept[4]
    assert {r.doc_id for r in after.collect() if r.round_trip} == set(rows_of(before))

    whole = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF).collect()}
    assert whole == {r.doc_id: r.ids for r in after.collect()}


def test_odd_rows_and_empty_tables(spark):
    for rows in (ODD, []):
        docs = documents(spark, rows)
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            assert i == 4 or out.columns == docs.columns
            assert out.count() <= len(rows)
