"""Byte and word repeat removal against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from tables import ODD, documents

from lustra.llm import bucket_refinement, repeats
from lustra.llm.bucket_refinement import remove_repeats, repeat_digests
from lustra.llm.count_min_windows import remove_repeated_windows
from lustra.llm.repeats import Texts, byte_symbols, stretches
from lustra.llm.sketch import cells, seen_twice, sketch_width
from lustra.llm.symbols import Chunk, Runs, chunks

SF = "/root/testdata/sf0.001/documents.parquet"
LAST = float("inf")


def covered_by_earlier(rows, window):
    """Of every row a flag for each symbol: in a window that also starts in a row with a smaller id."""
    first = {}
    key = lambda s: s if isinstance(s, bytes) else tuple(s)
    for doc, symbols in rows:
        for i in range(len(symbols) - window + 1):
            w = key(symbols[i : i + window])
            first[w] = min(first.get(w, LAST), doc)
    out = []
    for doc, symbols in rows:
        bad = np.zeros(len(symbols), bool)
        for i in range(len(symbols) - window + 1):
            if first[key(symbols[i : i + window])] < doc:
                bad[i : i + window] = True
        out.append(bad)
    return out


def expected_bytes(rows):
    rows = [(LAST if d is None else d, (t or "").encode()) for d, t in rows]
    out = []
    for (doc, data), bad in zip(rows, covered_by_earlier(rows, 50)):
        kept = np.frombuffer(data, np.uint8)[~bad].tobytes()
        spans = int(np.sum(np.diff(np.r_[0, bad.astype(int)]) == 1))
        out.append((None if doc == LAST else doc, len(data), int(bad.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def expected_words(rows):
    rows = [(LAST if d is None else d, (t or "").encode().split()) for d, t in rows]
    out = []
    for (doc, words), bad in zip(rows, covered_by_earlier(rows, 50)):
        kept = b" ".join(w for w, b in zip(words, bad) if not b)
        out.append((None if doc == LAST else doc, len(words), int(bad.sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


BYTES = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
WORDS = ("doc_id", "n_words", "n_removed", "kept_sha256")


def random_rows(seed):
    """Texts that share passages, copies with edits, loops, and lines in all of them."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcd") for _ in range(draw.randint(1, 4)))
    passages = [" ".join(word() for _ in range(draw.choice((30, 60, 80)))) for _ in range(4)]
    rows = []
    for doc in range(60):
        parts = [" ".join(word() for _ in range(draw.randint(0, 40)))]
        parts += draw.choices(passages, k=draw.randint(0, 3))
        parts.append(draw.choice(["", "ab " * 70, "the one line that everyone has, and it is long enough to matter here"]))
        draw.shuffle(parts)
        text = draw.choice((" ", "\n", "")).join(parts)
        if text and draw.random() < 0.4:
            at = draw.randrange(len(text))
            text = text[:at] + "é" + text[at + 1 :]
        rows.append((doc, text))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts(spark, seed):
    rows = random_rows(seed)
    docs = documents(spark, rows).repartition(5)
    assert found(repeat_digests(docs), *BYTES) == expected_bytes(rows)
    assert found(remove_repeated_windows(docs), *WORDS) == expected_words(rows)


def test_given_documents(spark):
    docs = spark.read.parquet(SF)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(repeat_digests(docs), *BYTES) == expected_bytes(rows)
    assert found(remove_repeated_windows(docs), *WORDS) == expected_words(rows)


def test_odd_rows(spark):
    docs = documents(spark, ODD)
    assert found(repeat_digests(docs), *BYTES) == expected_bytes(ODD)
    assert found(remove_repeated_windows(docs), *WORDS) == expected_words(ODD)


def test_empty_table(spark):
    docs = documents(spark, [])
    assert repeat_digests(docs).collect() == []
    assert remove_repeated_windows(docs).collect() == []
    assert remove_repeats(docs).collect() == []


def test_tight_sketch_and_shuffled_joins_lose_nothing(spark):
    """A sketch that lets nearly everything through gives the same result."""
    rows = random_rows(3)
    docs = documents(spark, rows)
    assert found(repeat_digests(docs, largest_width=1 << 16), *BYTES) == expected_bytes(rows)
    assert found(remove_repeated_windows(docs, largest_width=1 << 16), *WORDS) == expected_words(rows)


def test_hot_passage(spark):
    """A passage in every text, each with neighbours of its own."""
    passage = " ".join(f"hot{i}" for i in range(60))
    rows = [(i, f"a{i} b{i} {passage} c{i} d{i}") for i in range(400)]
    docs = documents(spark, rows).repartition(7)
    assert found(remove_repeated_windows(docs), *WORDS) == expected_words(rows)
    assert found(repeat_digests(docs), *BYTES) == expected_bytes(rows)


def test_rows_keep_their_columns(spark):
    passage = "é" * 40
    docs = documents(spark, [(1, passage), (2, "before " + passage + " after"), (3, None)])
    out = {r.doc_id: r for r in remove_repeats(docs).collect()}
    assert remove_repeats(docs).columns == docs.columns
    assert (out[1].text, out[2].text, out[3].text) == (passage, "before  after", "")
    assert out[2].kept == "x"


def test_texts_returned_with_words(spark):
    words = " ".join(f"w{i}" for i in range(50))
    out = {r.doc_id: r.kept for r in remove_repeated_windows(documents(spark, [(1, words), (2, f"x {words} y")])).collect()}
    assert out == {1: words, 2: "x y"}


def test_sketch_never_misses(spark):
    draw = np.random.default_rng(5)
    values = draw.integers(0, 3000, 6000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    rows = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "v long").repartition(4)
    drawn = lambda batches: (b.column("v").to_numpy().view(np.uint64) for b in batches)
    for depth in (1, 2):
        width = sketch_width(3000)
        seen = seen_twice([(rows, drawn)], width, depth)
        distinct, counts = np.unique(values, return_counts=True)
        assert seen.twice(distinct)[counts > 1].all()
        assert seen.twice(distinct)[counts == 1].mean() < 0.2
    assert cells(values, width, 0).max() < width


def test_stretches_cover_every_window_once():
    draw = random.Random(9)
    texts = ["".join(draw.choice("ab") for _ in range(draw.randint(0, 300))) for _ in range(30)]
    kind = Texts(byte_symbols)
    chunk = next(chunks(pa.array(texts)))
    symbols, doc = byte_symbols(chunk)
    _, lo, n = stretches(kind, symbols, doc)
    covered = np.concatenate([np.arange(a, a + b) for a, b in zip(lo, n)])
    wanted = [a + i for a, t in zip(chunk.bounds, texts) for i in range(max(0, len(t) - 49))]
    assert covered.tolist() == wanted


def test_runs_depend_on_their_symbols_alone():
    symbols = np.array([5, 7, 9, 5, 7, 9], np.uint64)
    runs = Runs(symbols)
    assert runs.every(3)[0] == runs.every(3)[3]
    assert runs.of(np.array([0]), 3)[0] == runs.every(3)[0] != runs.every(3)[1]


def test_words_of_chunks():
    texts = ["one two", None, "", " three\x0bfour", "five"]
    for size in (1, 9, 1000):
        words = []
        for chunk in chunks(pa.array(texts), size):
            assert isinstance(chunk, Chunk)
            starts, ends, doc = chunk.words()
            raw = chunk.data.tobytes()
            words += [(chunk.first + d, raw[a:b].decode()) for a, b, d in zip(starts, ends, doc)]
        assert words == [(0, "one"), (0, "two"), (3, "three"), (3, "four"), (4, "five")]


def test_texts_meet_their_stretches_in_one_join(spark, monkeypatch):
    """Both passes over texts with stretches to compare read what one join has stored."""
    stores = []
    keep = repeats.stored
    monkeypatch.setattr(repeats, "stored", lambda df, purpose: stores.append((purpose, df.columns)) or keep(df, purpose))
    remove_repeats(documents(spark, [(1, "a" * 60), (2, "b" + "a" * 60)])).collect()
    assert ("asked-texts", ["doc", "rid", "text", "asked"]) in stores


@pytest.mark.parametrize("seed", [4, 5])
def test_marked_stretches_are_compared_without_a_join(spark, monkeypatch, seed):
    """More stretches than a list may be broadcast for: no text is joined or stored, and the result is the same."""
    stores = []
    keep, ranges = repeats.stored, repeats.repeated_ranges
    monkeypatch.setattr(repeats, "stored", lambda df, purpose: stores.append(purpose) or keep(df, purpose))
    monkeypatch.setattr(bucket_refinement, "repeated_ranges", lambda *a: ranges(*a, broadcast_bytes=0))
    rows = random_rows(seed) + [(7, "the same id, " + "ab " * 60), (None, "no id, " + "ab " * 60), (None, None)]
    assert found(repeat_digests(documents(spark, rows).repartition(5)), *BYTES) == expected_bytes(rows)
    assert "asked-texts" not in stores


def test_more_stretches_than_marks(spark, monkeypatch):
    ranges = repeats.repeated_ranges
    monkeypatch.setattr(bucket_refinement, "repeated_ranges", lambda *a: ranges(*a, broadcast_bytes=0, most_marks=1))
    rows = random_rows(6)
    assert found(repeat_digests(documents(spark, rows).repartition(5)), *BYTES) == expected_bytes(rows)


def test_steps_have_names_of_their_own():
    """Plans count the rows of a step by its name and columns; the two steps have the same columns."""
    kind = Texts(byte_symbols)
    steps = [f(kind, None) for f in (repeats._candidates, repeats._expanded)]
    assert [step.__name__ for step in steps] == ["candidates", "expanded"]


def test_many_stretches_go_one_way_at_any_size(spark, monkeypatch):
    """More stretches to compare than texts: marks, also where a list of them would be small."""
    stores = []
    keep = repeats.stored
    monkeypatch.setattr(repeats, "stored", lambda df, purpose: stores.append(purpose) or keep(df, purpose))
    monkeypatch.setattr(repeats, "_FEW_ASKED", 0, raising=False)
    rows = random_rows(7)
    assert found(repeat_digests(documents(spark, rows).repartition(5)), *BYTES) == expected_bytes(rows)
    assert "asked-texts" not in stores


def test_rows_sent_grow_with_the_texts():
    """Of one passage in ever more texts, each with another end, both steps send rows in proportion."""

    class All:
        def twice(self, values):
            return np.ones(len(values), bool)

    kind = Texts(byte_symbols, chunk_bytes=1 << 12)
    draw = random.Random(8)
    passage = "".join(draw.choices("abcdefgh", k=300))

    def sent(texts):
        rows = ["".join(draw.choices("abcdefgh", k=200)) + passage[: 300 - i % 100] + "z" * 60 for i in range(texts)]
        batch = pa.RecordBatch.from_arrays(
            [pa.array(range(texts)), pa.array([0] * texts), pa.array(rows)], names=["doc", "rid", "text"]
        )
        steps = (repeats._candidates(kind, All()), repeats._expanded(kind, All(), repeats._marked(All(), All())))
        return [sum(part.num_rows for part in step(iter([batch]))) for step in steps]

    few, many = sent(200), sent(1600)
    assert all(b < 9 * a for a, b in zip(few, many))
