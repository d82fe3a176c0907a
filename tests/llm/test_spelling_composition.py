"""Compositions against comparing all pairs, vocabularies against plain counting, odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import combinations
from zlib import crc32

import pytest
from oracle import differences
from tables import ODD, documents

from lustra.llm.queries import op12_spelling_composition
from lustra.llm.spelling_composition import Acceptor, Composition, oracle_sql, spelling_groups, vocabulary


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def some_words(seed: int, letters: str, n: int, longest: int) -> list[str]:
    rng = random.Random(seed)
    return sorted({"".join(rng.choices(letters, k=rng.randint(1, longest))) for _ in range(n)})


@pytest.mark.parametrize("letters, n, longest", [("ab", 200, 7), ("abcdé", 400, 5), ("aÿ", 300, 12), ("a", 30, 40)])
def test_composition_accepts_each_pair_once(letters, n, longest):
    words = some_words(n, letters, n, longest)
    found = Counter(frozenset(p) for p in Composition(Acceptor(words)).pairs())
    assert found == Counter(frozenset(p) for p in combinations(words, 2) if one_edit(*p))


def test_acceptor_is_minimal():
    words = [a + b + "ing" for a in "bcdfg" for b in "aeiou"]
    acceptor = Acceptor(sorted(words))
    reached, todo = set(), [0]
    while todo:
        if (state := todo.pop()) not in reached:
            reached.add(state)
            todo += acceptor.arcs[state].values()
    assert len(reached) == 6


def groups_by_hand(counts: dict[str, int], times: int) -> set[tuple]:
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[word] = best if best is not None and counts[best] >= times * counts[word] else None
    rows = set()
    for word in counts:
        root = word
        while form[root] is not None:
            root = form[root]
        rows.add((word, counts[word], len(near[word]), form[word], counts.get(form[word]), root))
    return rows


@pytest.mark.parametrize("most", [1, 3, 20, 1000])
def test_groups_match_all_pairs(spark, most):
    """States are divided at every depth, at some, or not at all; long chains of forms."""
    rng = random.Random(most)
    words = {*some_words(1, "abc", 250, 6), *("x" * n for n in range(1, 12)), *("prefix" * 3 + c for c in "abcdef")}
    counts = {w: 5 ** rng.randint(0, 6) for w in sorted(words)} | {"x" * n: 5 ** (13 - n) for n in range(1, 12)}
    frame = spark.createDataFrame([(w, n, "x") for w, n in counts.items()] + [(None, 1, "x")], "word string, n long, near string")
    found = spelling_groups(frame, most=most)
    rows = [(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in found.collect()]
    assert len(rows) == len(counts) and set(rows) == groups_by_hand(counts, 5)


def test_query_matches_oracle(spark):
    assert differences(spark, op12_spelling_composition, oracle_sql(), "/root/testdata/sf0.001") is None


def test_vocabulary_matches_counting(spark):
    rows = [*ODD, (20, "Éclair ÉCLAIR éclair o'clock Straße naïve×÷ " * 9), (None, "nothing slips here " * 40), (21, "z" * 5000)]
    counts: Counter = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            if doc is not None and (h := crc32(f"{doc}:{run}".encode())) % 3 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 4:
                counts[run] += 1
    found = vocabulary(documents(spark, rows), shortest=4, least=2, slip_every=3)
    assert {r.word: r.n for r in found.collect()} == {w: n for w, n in counts.items() if n >= 2}


def test_no_words(spark):
    assert spelling_groups(vocabulary(documents(spark, []))).count() == 0
    assert spelling_groups(vocabulary(documents(spark, [(1, None), (2, "")]))).count() == 0
    with pytest.raises(ValueError):
        spelling_groups(vocabulary(documents(spark, [])), times=1)


def test_long_words_are_compared_as_wholes(spark):
    long = "qu" * 3000
    frame = spark.createDataFrame([(long, 50), (long[:2000] + "x" + long[2001:], 2), (long + "q", 3)], "word string, n long")
    found = {(r.n, r.n_near, r.form == long) for r in spelling_groups(frame).collect()}
    assert found == {(50, 2, False), (2, 1, True), (3, 1, True)}
