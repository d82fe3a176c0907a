"""Workers keep neither tables nor freed memory once their partition is done."""

from __future__ import annotations

import tracemalloc

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from tables import documents

from lustra.llm import nbest_pieces, repeats, symbols, token_fertility
from lustra.llm.bucket_refinement import _cut
from lustra.llm.jaccard_regions import _sets, _shingles
from lustra.llm.memory import BATCH_BYTES, returning, small_batches
from lustra.llm.queries import PIECES, VOCABULARIES
from lustra.llm.repeats import Texts, byte_symbols, word_symbols
from lustra.llm.sketch import seen_twice


def test_tables_go_with_the_partition():
    cache = {"a": 1}
    assert list(returning(lambda batches: (b for b in batches), cache.clear)(iter([1, 2]))) == [1, 2]
    assert cache == {}


def test_good_texts_leave_no_encoders_in_workers(spark):
    docs = documents(spark, [(i, f"some plain words of text number {i} for the encoders to read here") for i in range(8)])
    token_fertility.good_texts(docs.repartition(8), VOCABULARIES).collect()

    def held(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(token_fertility._encoders)] * len(batch))], names=["n"])

    found = spark.range(64, numPartitions=16).mapInArrow(held, "n long").agg({"n": "max"}).first()[0]
    assert found == 0


def test_sets_leave_a_task_in_portions():
    class All:
        def twice(self, values):
            return np.ones(len(values), bool)

    texts = [" ".join(f"w{i}x{j}" for j in range(20_000)) for i in range(20)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(20)), pa.array([0] * 20), pa.array(texts)], names=["doc", "rid", "text"]
    )
    out = list(_sets(5, 75, All())(iter([batch])))
    assert len(out) > 1
    assert pa.Table.from_batches(out).column("doc").to_pylist() == list(range(20))


def test_powers_go_with_the_partition():
    def runs(batches):
        for _ in batches:
            symbols.Runs(np.ones(1 << 17, np.uint64), 0)
            yield len(symbols._POWERS[0]._up)

    held = returning(runs)
    assert list(held(iter([1]))) == [1 << 18]
    assert held.__name__ == "runs"
    assert all(len(powers._up) == len(powers._down) == 0 for powers in symbols._POWERS)


def test_texts_leave_a_task_in_portions():
    """Stages that return texts hold a megabyte of them at a time, not a batch."""
    texts = [" ".join(f"word{i}x{j}" for j in range(20_000)) for i in range(20)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array(texts), pa.array(["en"] * 20)], names=["doc_id", "text", "lang"])
    bands = {"*": {"*": token_fertility.Band(0, 1e9, 1, 0)}}
    good = list(token_fertility._good(VOCABULARIES[:1], bands, "lang")(iter([batch])))
    assert len(good) > 1
    kept = pa.Table.from_batches(good)
    once = pa.Table.from_batches(token_fertility._good(VOCABULARIES[:1], bands, "lang")(iter([batch.slice(i, 1) for i in range(20)])))
    assert kept.num_rows and kept.equals(once)

    none = pa.nulls(20, pa.list_(pa.struct([("lo", pa.int32()), ("n", pa.int32())])))
    cut = list(_cut(iter([pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array(texts), none], names=["row", "text", "ranges"])])))
    assert len(cut) > 1
    assert pa.Table.from_batches(cut).column("text").to_pylist() == texts


def test_searched_units_are_forgotten_without_a_change(monkeypatch):
    texts = [f"some words, {'abcdefghij'[i % 10] * (i % 7 + 1)} and others of text {i}" for i in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array(texts)], names=["doc_id", "text"])
    found = []
    for most in (1 << 20, 8):
        monkeypatch.setattr(nbest_pieces, "_SEARCHED", most)
        nbest_pieces._known.clear()
        found.append(pa.Table.from_batches(nbest_pieces._encoded(PIECES, 4, True, True)(iter([batch]))))
        assert most > 8 or len(nbest_pieces._worker(PIECES)[2][4]) <= most + 1
    assert found[0].equals(found[1])


class Some:
    """A sketch that shows some of the values as seen twice."""

    def __init__(self, of_16):
        self._of_16 = np.uint64(of_16)

    def twice(self, values):
        return symbols.mixed(values) % np.uint64(16) < self._of_16


def _texts(count, words):
    draw = np.random.default_rng(7)
    texts = [" ".join(f"w{x}" for x in draw.integers(0, 5000, words)) for _ in range(count)]
    texts = [t + " " + texts[i // 2][: len(t) // 3] for i, t in enumerate(texts)]
    return pa.RecordBatch.from_arrays(
        [pa.array(range(count)), pa.array([0] * count), pa.array(texts)], names=["doc", "rid", "text"]
    )


def _steps(kind):
    marked = repeats._marked(Some(12), Some(2))
    return {
        "anchors": repeats.anchors(kind),
        "candidates": repeats._candidates(kind, Some(12)),
        "asked": repeats._asked_windows(kind, marked),
        "expanded": repeats._expanded(kind, Some(2), marked),
        "shingles": _shingles(5),
        "sets": _sets(5, 75, Some(12)),
    }


@pytest.mark.parametrize("step", ["anchors", "candidates", "asked", "expanded", "shingles", "sets"])
def test_symbols_are_held_for_a_part_of_a_chunk(step):
    """Eight bytes a symbol, several times over, of a megabyte of text would be 80 MB and more in each worker."""
    batch = _texts(200, 1500)
    assert batch.column("text").nbytes > 1 << 21
    of = _steps(Texts(byte_symbols))[step]
    symbols.drop_powers()
    tracemalloc.start()
    for _ in of(iter([batch])):
        pass
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 40 << 20, f"{most >> 20} MB"


@pytest.mark.parametrize("symbols_of", [byte_symbols, word_symbols])
def test_parts_change_no_row(symbols_of):
    batch = _texts(60, 150)
    found = []
    for part in (1 << 20, 1 << 10):
        kind = Texts(symbols_of, chunk_bytes=1 << 14, part_bytes=part)
        steps = _steps(kind)
        found.append([pa.Table.from_batches(steps[s](iter([batch]))) for s in ("candidates", "expanded")])
        found[-1].append(sorted(np.concatenate(list(steps["asked"](iter([batch])))).tolist()))
        assert all(len(x) for x in found[-1])
    assert found[0] == found[1]


def test_pipeline_hands_rows_over_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    rows = spark.range(0, 4000, 1, 1).selectExpr("id", "repeat('abcdefgh', 250) text")
    try:
        for _, stage in corpus_pipeline.STAGES[:1]:
            stage(spark, documents(spark, [(1, "some text")]), "")
        most, n = rows.mapInArrow(sizes, "size long").selectExpr("max(size)", "count(*)").first()
        assert most < 1.1 * (1 << 20) and n > 4
        spark.conf.set(BATCH_BYTES, "100k")
        small_batches(spark)
        assert spark.conf.get(BATCH_BYTES) == "100k"
    finally:
        spark.conf.unset(BATCH_BYTES)


@pytest.mark.parametrize("levels", [False, True])
def test_the_driver_reads_a_wide_sketch_in_portions(spark, monkeypatch, levels):
    """8 or 10 MB of bits and levels would be in Spark's results, their buffers and Arrow at once."""
    kind = type(spark.range(1))
    sizes, whole = [], kind.toArrow

    def measured(df):
        table = whole(df)
        sizes.append(table.nbytes)
        return table

    monkeypatch.setattr(kind, "toArrow", measured)

    def values(batches):
        for batch in batches:
            yield symbols.mixed(batch.column("id").to_numpy().astype(np.uint64) // np.uint64(2))

    ids = spark.range(0, 40_000, 1, 4).filter("id < 30000 OR id % 2 = 0")
    seen = seen_twice([(ids, values)], 1 << 26, levels=levels)
    assert 0 < max(sizes) < 6 << 20 and sum(sizes) > 6 << 20
    twice = seen.twice(symbols.mixed(np.arange(20_000, dtype=np.uint64)))
    assert twice[:15_000].all() and not twice[15_000:].all()
    assert not levels or seen.level(symbols.mixed(np.arange(15_000, dtype=np.uint64))).all()
    nothing = seen_twice([(ids.filter("id < 0"), values)], 1 << 26)
    assert not nothing.twice(np.arange(9, dtype=np.uint64)).any()
    for sketch in (seen, nothing):
        sketch.release()
