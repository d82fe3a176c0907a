"""As-of joins against looking every fact up, with whole and with cut keys; hot keys against counting."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F
from test_history import CUT, FIELDS, SPEC, random_changes

from lustra.operators.as_of import as_of_join
from lustra.operators.history import END, START, build_history
from lustra.operators.skew import SkewPolicy, candidates, hot_keys


def looked_up(facts, versions):
    out = []
    for f in facts:
        hit = [v for v in versions if v[0] == f[1] and f[2] is not None and v[3] <= f[2] and (v[4] is None or v[4] > f[2])]
        assert len(hit) <= 1
        out.append((*f, *(hit[0][1:] if hit else (None,) * 4)))
    return sorted(out, key=str)


@pytest.mark.parametrize("skew", [None, SkewPolicy(), CUT, SkewPolicy(hot_rows=5, range_rows=2)])
@pytest.mark.parametrize("seed", [1, 2])
def test_join_equals_lookups(spark, skew, seed):
    rng = random.Random(seed)
    changes = random_changes(seed=seed, n=250)
    history = build_history(spark.createDataFrame(changes, FIELDS), SPEC, skew=None)
    times = [c[1] for c in changes if c[1] is not None]
    facts = [
        (i, rng.choice([0, 1, 1, 1, 2, 3, 77, None]), rng.choice([*times, -5, max(times) + 9, None])) for i in range(300)
    ]
    facts += facts[:20]
    joined = as_of_join(spark.createDataFrame(facts, "id int, k int, at int"), history, ["k"], "at", skew=skew)
    versions = [tuple(v) for v in history.select("k", "a", "b", START, END).collect()]
    have = sorted((tuple(r) for r in joined.select("id", "k", "at", "a", "b", START, END).collect()), key=str)
    assert have == looked_up(facts, versions)


def test_many_facts_at_one_time_and_ranges_without_versions(spark):
    history = spark.createDataFrame([(1, "x", 0, 5), (1, "y", 5, None), (2, "z", 3, 4)], f"k int, v string, {START} int, {END} int")
    facts = [(i, 1, 5 if i % 2 else 4) for i in range(200)] + [(i, 2, i % 6) for i in range(60)]
    joined = as_of_join(
        spark.createDataFrame(facts, "id int, k int, at int"), history, ["k"], "at", "old_", SkewPolicy(10, 20)
    )
    have = {(r.k, r["at"], r.old_v) for r in joined.collect()}
    assert joined.count() == 260
    assert have == {(1, 5, "y"), (1, 4, "x"), (2, 3, "z"), *((2, t, None) for t in (0, 1, 2, 4, 5))}


def test_clashes_and_empty_tables(spark):
    history = spark.createDataFrame([], f"k int, id string, {START} int, {END} int")
    facts = spark.createDataFrame([(1, 1, 1)], "id int, k int, at int")
    with pytest.raises(ValueError, match="id"):
        as_of_join(facts, history, ["k"], "at")
    assert as_of_join(facts, history, ["k"], "at", "h_").select("id", "h_id").collect() == [(1, None)]
    assert as_of_join(facts.limit(0), history, ["k"], "at", "h_").isEmpty()


def test_one_exchange_one_sort_no_inequality(spark):
    history = spark.createDataFrame([(1, "x", 0, 5)], f"k int, v string, {START} int, {END} int")
    facts = spark.createDataFrame([(1, 1, 1)], "id int, k int, at int")
    plan = as_of_join(facts, history, ["k"], "at", skew=None)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and len(re.findall(r"\bSort \[", plan)) == 1
    assert "Join" not in plan


@pytest.mark.parametrize("share", [2, 3, 10])
def test_hot_keys_are_those_of_a_full_count(spark, share):
    """Two parts of a key, some keys of middling weight, many rare ones."""
    rows = spark.range(200_000).select(
        F.when(F.col("id") % share == 0, F.lit(-1)).when(F.col("id") % 50 == 1, F.lit(-2)).otherwise(F.col("id") % 60_007).alias("k"),
        F.lit("x").alias("part"),
    )
    for policy in (SkewPolicy(hot_rows=3000), SkewPolicy(hot_rows=50_000), SkewPolicy(hot_rows=1_000_000)):
        counts = rows.groupBy("k", "part").agg(F.count("*").alias("n"))
        want, n_want = hot_keys(rows, ["k", "part"], policy, counts)
        have, n_have = hot_keys(rows, ["k", "part"], policy)
        assert n_have == n_want
        assert (have is None) == (want is None)
        if have is not None:
            assert sorted(have.collect()) == sorted(want.collect())


def test_no_row_a_key_is_shuffled(spark):
    """Without hot keys there is one pass, which sends a sketch a task."""
    rows = spark.range(100_000).withColumnRenamed("id", "k")
    found, total = candidates(rows, ["k"], SkewPolicy(hot_rows=100))
    assert found == [] and total == 100_000
    assert hot_keys(rows, ["k"], SkewPolicy()) == (None, 0)
    assert hot_keys(rows.limit(0), ["k"], SkewPolicy()) == (None, 0)
