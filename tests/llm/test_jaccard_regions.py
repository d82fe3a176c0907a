"""Near-duplicate components against brute force."""

from __future__ import annotations

import random
import string

import numpy as np
import pyarrow as pa
import pytest
from tables import ODD, documents

from lustra.llm import jaccard_regions
from lustra.llm.components import connected_components
from lustra.llm.jaccard_regions import _with_partner, near_duplicates, one_of_each_group
from lustra.llm.stored import stored

SF = "/root/testdata/sf0.001/documents.parquet"
_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())


def shingles(text):
    words = (text or "").encode().translate(_LOWER).split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def expected(rows):
    """Per row: doc_id, set size, component; every pair is compared."""
    sets = [(d, shingles(t)) for d, t in rows]
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (d, a) in enumerate(sets):
        for e, b in sets[:i]:
            if d is not None and e is not None and a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = root(d), root(e)
                parent[max(x, y)] = min(x, y)
    return sorted(((d, len(s), None if d is None else root(d)) for d, s in sets), key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def families(seed, sizes, edits, words=60):
    """Groups of copies of a text, each with some words changed."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(3))
    rows = []
    for size in sizes:
        base = [word() for _ in range(words)]
        for _ in range(size):
            own = list(base)
            for _ in range(draw.randint(0, edits)):
                own[draw.randrange(words)] = word()
            rows.append(" ".join(own))
    draw.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed, edits", [(1, 1), (2, 3), (3, 5)])
def test_families_of_copies(spark, seed, edits):
    """Up to and over the threshold, in groups small and large: chains, outliers and pivots that miss."""
    rows = families(seed, [1, 2, 3, 8, 40], edits)
    assert found(near_duplicates(documents(spark, rows).repartition(4), leaf=6)) == expected(rows)


def test_given_documents(spark):
    docs = spark.read.parquet(SF)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(near_duplicates(docs)) == expected(rows)


def test_odd_rows(spark):
    rows = [*ODD, (20, "A b C d"), (21, "a B c D"), (22, "a b c d e"), (9, "A b c d")]
    assert found(near_duplicates(documents(spark, rows))) == expected(rows)


def test_exact_threshold(spark):
    """Three of four shingles in common link; less does not."""
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g"), (3, "a b c d e f"), (4, "v w x y z")]
    assert found(near_duplicates(documents(spark, rows))) == expected(rows)


def test_tables_without_links_or_rows(spark):
    rows = [(1, "a b c d e f"), (2, "g h i j k l"), (3, None)]
    assert found(near_duplicates(documents(spark, rows))) == expected(rows)
    assert near_duplicates(documents(spark, [])).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_members_without_room_for_a_partner_go(spark, seed):
    """Whoever has room for a link with another, one of both a minor, stays; others go, but for minors with room for their own size."""
    draw = random.Random(seed)
    rows = []
    for i in range(120):
        n = draw.randint(4, 60)
        rows.append((draw.randrange(6), i, 0, n, draw.randint(0, n // 4), draw.random() < 0.3))
    placed = spark.createDataFrame(rows, "region long, doc long, rid long, n long, at long, minor boolean")

    def room(x, y):
        return x[0] == y[0] and (x[5] or y[5]) and 175 * min(x[3] - x[4], y[3] - y[4]) >= 75 * (x[3] + y[3])

    partnered = {x[1] for x in rows if any(x is not y and room(x, y) for y in rows)}
    own_size = {x[1] for x in rows if x[5] and room(x, x)}
    assert {r.doc for r in _with_partner(placed, 75).collect()} == partnered | own_size
    assert len(partnered | own_size) < len(rows)


def test_one_of_each_group_stays(spark):
    rows = [(5, "a b c d e f"), (3, "A b c d e f"), (7, "q r s t u v"), (None, "a b c d e f"), (7, "another text altogether"), (8, None), (9, "")]
    docs = documents(spark, rows)
    out = one_of_each_group(docs)
    assert out.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert kept == sorted(
        [(3, "A b c d e f"), (7, "another text altogether"), (None, "a b c d e f"), (8, None), (9, "")], key=repr
    )
    assert one_of_each_group(documents(spark, [])).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    pairs = [(draw.randrange(40), draw.randrange(40)) for _ in range(25)] + [(100 + i, 101 + i) for i in range(12)]
    parent = {x: x for p in pairs for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    links = spark.createDataFrame([*pairs, (None, 3)], "a long, b long")
    out = {r.node: r.component for r in connected_components(links).collect()}
    assert out == {x: root(x) for x in linked}


def unlike(count, words=300):
    draw = random.Random(5)
    return [" ".join("".join(draw.choices("abcdefgh", k=4)) for _ in range(words)) for _ in range(count)]


def test_a_full_sketch_keeps_rows_few(spark, monkeypatch):
    """Where the sketch shows every shingle as seen twice, neither whole sets nor shingles of one text alone are stored."""
    kept = {}

    def storing(df, purpose):
        now = stored(df, purpose)
        kept.setdefault(purpose, now)
        return now

    monkeypatch.setattr(jaccard_regions, "stored", storing)
    rows = [*families(4, [1, 2, 8], 2), *enumerate(unlike(400), 100)]
    out = found(near_duplicates(documents(spark, rows).repartition(4), largest_width=1 << 16))
    assert [x for x in out if x[0] < 100] == expected(rows[:11])
    assert all(x[0] == x[2] for x in out if x[0] >= 100) and len(out) == len(rows)
    assert not [p for p, df in kept.items() if "toks" in df.columns]
    assert kept["members"].groupBy("region").count().filter("count < 2").isEmpty()
    assert not kept["members"].isEmpty()


class All:
    """A full sketch."""

    def twice(self, values):
        return np.ones(len(values), bool)

    def level(self, values):
        return np.zeros(len(values), np.uint8)


@pytest.mark.parametrize("gathered, blocks", [(1 << 19, 16), (40, 16), (200, 64)])
def test_members_are_what_two_texts_share(monkeypatch, gathered, blocks):
    """However a task's rows are cut into portions, and whether a task or a block's owner meets a shingle twice."""
    monkeypatch.setattr(jaccard_regions, "_GATHERED", gathered)
    rows = [*families(6, [1, 2, 3, 12], 3), (18, ""), (19, None)]
    sets, members = {}, {}
    placed = []
    for part in (rows[:7], rows[7:]):
        doc, text = zip(*part)
        batch = pa.RecordBatch.from_arrays(
            [pa.array(doc, pa.int64()), pa.array([0] * len(doc), pa.int64()), pa.array(text)], names=["doc", "rid", "text"]
        )
        for b in jaccard_regions._shingles_of(5, All())(iter([batch])):
            sets |= dict(zip(b.column("doc").to_pylist(), b.column("toks").to_pylist()))
        placed += jaccard_regions._prefixes(5, 75, All(), All(), blocks)(iter([batch]))
    for doc, toks in sets.items():
        order = sorted(toks, key=lambda x: x % 2**64)[: len(toks) - (75 * len(toks) + 99) // 100 + 1 if toks else 0]
        for at, region in enumerate(order):
            members.setdefault(region, []).append((region, doc, 0, len(toks), at))
    met = pa.Table.from_batches(placed).sort_by("block").to_batches(max_chunksize=5)
    out = [r for b in jaccard_regions._members()(iter(met)) for r in zip(*(c.to_pylist() for c in b.columns))]
    assert sorted(out) == sorted(r for group in members.values() if len(group) > 1 for r in group)
    assert out and len(out) < sum(map(len, members.values()))


def test_whole_rows_that_repeat_are_one_text(spark):
    rows = [(i, t) for i, t in families(8, [3, 3, 9], 2)]
    rows += [rows[0], rows[0], rows[5], (4, rows[9][1]), (4, rows[9][1])]
    assert found(near_duplicates(documents(spark, rows).repartition(3))) == expected(rows)
