"""Draws against plain counting and sorting, selection against sorted keys, odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest
from oracle import differences
from pyspark.sql import functions as F
from tables import ODD, documents

from lustra.llm.importance_selection import Draw, cutoff_key, draw_like, oracle_sql
from lustra.llm.queries import op11_importance_selection

SHOWN = ("doc_id", "n_words", "n_features", "weight", "score", "rank")


def words(text: str | None) -> list[str]:
    small = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", small)


def runs(text: str | None, longest: int) -> list[str]:
    found = words(text)
    return [" ".join(found[i : i + n]) for n in range(1, longest + 1) for i in range(len(found) - n + 1)]


def by_hand(rows: list[tuple], target: list[str], draw: Draw) -> list[tuple]:
    def bucket(run):
        return crc32(run.encode()) % draw.buckets

    s = Counter(bucket(run) for _, text in rows for run in runs(text, draw.longest))
    t = Counter(bucket(run) for text in target for run in runs(text, draw.longest))
    n_s, n_t = sum(s.values()) + draw.buckets, sum(t.values()) + draw.buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * n_s / ((s[b] + 1) * n_t))) for b in range(draw.buckets)}
    out = []
    for at, (doc, text) in enumerate(rows):
        found = runs(text, draw.longest)
        weight = sum(gain[bucket(run)] for run in found)
        h = int(hashlib.sha256(f"{draw.seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([doc, len(words(text)), len(found), weight, score, None, at])
    able = [r for r in out if r[1] >= draw.least_words]
    able.sort(key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[6]))
    for place, row in enumerate(able[: draw.percent * len(able) // 100]):
        row[5] = place + 1
    return sorted((tuple(r[:6]) for r in out), key=str)


def test_query_matches_oracle(spark):
    assert differences(spark, op11_importance_selection, oracle_sql(), "/root/testdata/sf0.001") is None


@pytest.mark.parametrize("draw", [Draw(), Draw(longest=3, buckets=97, percent=50, least_words=2), Draw(percent=100, least_words=0)])
def test_odd_rows_match_counting_by_hand(spark, draw):
    rows = [*ODD, *((100 + i, f"Target words {i} ÄÖ x2 " * (i % 40)) for i in range(80))]
    target = ["target Words and more", "", "ÄÖ x2 x2"]
    found = draw_like(
        documents(spark, rows).repartition(1), spark.createDataFrame([(t, 1) for t in target], "text string, doc int"), draw
    )
    have = sorted(
        (tuple(r[c] for c in SHOWN) for r in found.collect()), key=str
    )
    want = by_hand(rows, target, draw)
    assert have == want


def test_no_rows_and_no_target(spark):
    none = documents(spark, [])
    empty = spark.createDataFrame([], "text string")
    assert draw_like(none, empty).count() == 0
    rows = [(i, "some words " * 15) for i in range(20)]
    assert draw_like(documents(spark, rows), empty).filter("rank IS NOT NULL").count() == 2


@pytest.mark.parametrize("scores", [1, 7, 1_000_000])
def test_cutoff_is_the_key_at_the_place(spark, scores):
    """More keys than are sorted at once, with few and with many ties."""
    rng = random.Random(scores)
    keys = [(rng.randrange(scores), rng.randrange(3000), i) for i in range(30_000)]
    frame = spark.createDataFrame(keys, "score long, doc long, rid long").repartition(7).cache()
    ordered = sorted((-s, d, r) for s, d, r in keys)
    for place in (1, 2, 4321, 15_000, 29_999, 30_000):
        assert cutoff_key(frame, place) == ordered[place - 1]
    with pytest.raises(ValueError):
        cutoff_key(frame, 30_001)
    frame.unpersist()


def test_nothing_is_sorted_as_a_whole(spark):
    drawn = op11_importance_selection(spark, "/root/testdata/sf0.001")
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
    assert drawn.filter(F.col("rank").isNotNull()).count() == drawn.select(F.max("rank")).first()[0]
