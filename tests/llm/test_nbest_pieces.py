"""N-best paths against all paths, and exact round trips."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from tables import ODD, documents

import corpus_pipeline
from lustra.llm.nbest_pieces import Lattice, _encoded, decode, encode, path_of
from lustra.llm.queries import PIECES, op6_nbest_pieces

SF = "/root/testdata/sf0.001/documents.parquet"


@pytest.fixture(scope="module")
def lattice():
    return Lattice(PIECES)


def all_paths(lattice, unit, at=0):
    if at == len(unit):
        yield 0.0, ()
        return
    for end, score, ids in lattice.edges(unit, at):
        for rest, more in all_paths(lattice, unit, end):
            yield score + rest, ids + more


def ranked(lattice, unit, n):
    return sorted(all_paths(lattice, unit), key=lambda p: -p[0])[:n]


def test_search_finds_the_best_paths_in_order(lattice):
    draw = random.Random(1)
    for _ in range(150):
        unit = "".join(draw.choice("▁theanion☃éÉ") for _ in range(draw.randint(1, 9)))
        wanted = [s for s, _ in ranked(lattice, unit, 5)]
        assert [s for s, _ in lattice.best_paths(unit, 5)] == pytest.approx(wanted)
        score, loss, ids = lattice.viterbi([unit])
        assert score[0] == pytest.approx(wanted[0])
        if len(wanted) > 1:
            assert loss[0] == pytest.approx(wanted[0] - wanted[1])
        assert (wanted[0], tuple(ids[0].tolist())) in [(pytest.approx(s), p) for s, p in all_paths(lattice, unit)]


def test_whole_texts_against_all_paths(spark, lattice):
    """Short texts of several units: scores and paths of the whole lattice, cuts or not."""
    texts = ["a b", "the an", "  x", "an\nit", "☃ é", "on in", "a", " ", "\n\n"]
    out = {r.doc_id: r for r in encode(documents(spark, list(enumerate(texts))), PIECES, n=4, with_paths=True).collect()}
    for i, text in enumerate(texts):
        unit = "▁" + text.replace(" ", "▁")
        wanted = ranked(lattice, unit, 4)
        assert out[i].scores == pytest.approx([s for s, _ in wanted])
        scored = {p: s for s, p in all_paths(lattice, unit)}
        assert [scored[tuple(p)] for p in out[i].paths] == pytest.approx(out[i].scores)
        assert len({tuple(p) for p in out[i].paths}) == len(out[i].paths)
        assert out[i].ids == out[i].paths[0]


def test_round_trip_of_given_documents(spark):
    docs = spark.read.parquet(SF)
    coded = encode(docs, PIECES).cache()
    assert coded.filter("not round_trip").count() == 0
    assert coded.filter("n_pieces != size(ids)").count() == 0
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.text for r in decode(coded, PIECES).collect()} == texts
    assert all(a >= b for r in coded.collect() for a, b in zip(r.scores, r.scores[1:]))


def test_odd_rows(spark):
    rows = [*ODD, (60, "\x00\x01 control"), (61, "x" * 500), (62, "▁ mark")]
    coded = encode(documents(spark, rows), PIECES)
    found = sorted(((r.doc_id, r.text) for r in decode(coded, PIECES).collect()), key=repr)
    # the mark itself stands for a space in this vocabulary
    assert found == sorted(((d, (t or "").replace("▁", " ")) for d, t in rows), key=repr)
    assert {r.doc_id for r in coded.collect() if not r.round_trip} == {62}
    empty = [r for r in coded.collect() if r.doc_id in (1, 2)]
    assert all((r.n_pieces, r.ids, r.scores) == (0, [], [0.0]) for r in empty)
    assert encode(documents(spark, []), PIECES).collect() == []


def test_every_path_is_returned_and_decodes(spark):
    """The query's rows against the ids of all paths, and the pipeline's last stage alike."""
    docs = spark.read.parquet(SF)
    texts = {r.doc_id: r.text for r in docs.collect()}
    given = {r.doc_id: r for r in op6_nbest_pieces(spark, SF.rpartition("/")[0]).collect()}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF.rpartition("/")[0])
    whole = {r.doc_id: r for r in last.collect()}
    assert set(given) == set(whole) == set(texts)
    for d, row in given.items():
        paths = whole[d].paths
        assert len(paths) == len(row.scores) == len({tuple(p) for p in paths})
        assert row.path_pieces == [len(p) for p in paths]
        assert row.path_sha256 == [hashlib.sha256(np.array(p, "<i4").tobytes()).hexdigest() for p in paths]
        assert row.path_round_trips == [True] * len(paths)
        assert (row.n_pieces, row.ids_sha256) == (row.path_pieces[0], row.path_sha256[0])
    for rank in range(4):
        ranked = last.selectExpr("doc_id", f"get(paths, {rank}) ids").filter("ids is not null")
        found = {r.doc_id: r.text for r in decode(ranked, PIECES).collect()}
        assert found == {d: texts[d] for d in found} and len(found) > 100


def test_query_returns_the_segmentations_themselves(spark):
    """Ids of all paths, not only their digests: the edits give the pipeline's paths, and each decodes to its text."""
    docs = spark.read.parquet(SF)
    texts = {r.doc_id: r.text for r in docs.collect()}
    given = op6_nbest_pieces(spark, SF.rpartition("/")[0]).collect()
    whole = {r.doc_id: r.paths for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF.rpartition("/")[0]).collect()}
    paths = {r.doc_id: [path_of(r.ids, r.edits, rank) for rank in range(len(r.scores))] for r in given}
    assert paths == whole
    every = [(d, ids) for d, own in paths.items() for ids in own]
    found = decode(spark.createDataFrame(every, "doc_id long, ids array<int>"), PIECES).collect()
    assert len(found) == len(every) and all(r.text == texts[r.doc_id] for r in found)


def test_paths_of_odd_rows(spark):
    coded = encode(documents(spark, [*ODD, (62, "▁ mark"), (63, "é")]), PIECES, with_ids=False, with_paths=True).collect()
    assert all(r.ids is None and r.paths is None for r in coded)
    assert all(len(r.scores) == len(r.path_pieces) == len(r.path_sha256) == len(r.path_round_trips) for r in coded)
    assert {r.doc_id for r in coded if not all(r.path_round_trips)} == {62}
    assert all((r.path_pieces, r.path_round_trips) == ([0], [True]) for r in coded if r.doc_id in (1, 2))


@pytest.mark.parametrize("order", [(2, 8, 4), (8, 2, 4), (4, 1, 8)])
def test_lists_of_another_length_are_not_reused(lattice, order):
    """One process asked for lists of several lengths: each is that of the whole lattice."""
    texts = ["the an", "on the", "and then", "it in an"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    for n in order:
        rows = pa.Table.from_batches(_encoded(PIECES, n, True, True)(iter([batch]))).to_pylist()
        for text, row in zip(texts, rows):
            wanted = ranked(lattice, "▁" + text.replace(" ", "▁"), n)
            assert row["scores"] == pytest.approx([s for s, _ in wanted])
            assert len({tuple(p) for p in row["paths"]}) == len(wanted)
