"""Merged states against the whole: counters exactly, sketches within their errors."""

from __future__ import annotations

import random
from bisect import bisect_left, bisect_right

import pytest
from pyspark.sql import functions as F

from lustra.operators.measures import MeasuredIncrements
from lustra.operators.quality import summarize_rules

RULES = {"small": lambda: F.col("v") < 500, "named": lambda: F.col("name").isNotNull()}
FIELDS = "v double, name string"


def increments(seed=1, n=6, size=3000):
    rng = random.Random(seed)
    return [
        [(rng.choice([None, float("nan"), *[rng.gauss(400 + 50 * b, 200)] * 8]), rng.choice([None, f"n{rng.randrange(4000)}"])) for _ in range(size)]
        for b in range(n)
    ]


def measured(spark, tmp_path, parts):
    measures = MeasuredIncrements(str(tmp_path / "m"), RULES, distinct=("name", "v"), quantiles=("v",))
    for i, part in enumerate(parts):
        measures.add(spark.createDataFrame(part, FIELDS), i)
    return measures


@pytest.mark.parametrize("first, last", [(None, None), (2, 4), (5, None), (None, 0), (9, 12)])
def test_any_span_equals_its_data(spark, tmp_path, first, last):
    parts = increments()
    measures = measured(spark, tmp_path, parts)
    chosen = [r for p in parts[first or 0 : None if last is None else last + 1] for r in p]
    whole = spark.createDataFrame(chosen, FIELDS)
    want = summarize_rules(whole, {name: rule() for name, rule in RULES.items()})
    assert sorted(map(str, measures.rule_summary(spark, first, last).collect())) == sorted(map(str, want.collect()))
    for row in measures.distinct_summary(spark, first, last).collect():
        true = whole.select(row["column"]).distinct().filter(f"{row['column']} IS NOT NULL").count()
        assert row.n_rows == len(chosen) and abs(row.n_distinct - true) <= 0.06 * true
        assert row.n_known == whole.filter(f"{row['column']} IS NOT NULL").count()
    numbers = sorted(v for v, _ in chosen if v is not None and v == v)
    shares = (0.0, 0.1, 0.5, 0.9, 1.0)
    (row,) = measures.quantile_summary(spark, shares, first, last).collect()
    assert row.n_numbers == len(numbers)
    if not numbers:
        assert row["values"] is None and row.least is None
        return
    assert (row.least, row.most) == (numbers[0], numbers[-1])
    for share, value in zip(shares, row["values"]):
        low, high = bisect_left(numbers, value) / len(numbers), bisect_right(numbers, value) / len(numbers)
        assert low - 0.03 <= share <= high + 0.03


def test_an_increment_measured_again_replaces_itself(spark, tmp_path):
    parts = increments(2, n=2, size=200)
    measures = measured(spark, tmp_path, parts)
    measures.add(spark.createDataFrame(parts[1], FIELDS), 1)
    assert {r.n_rows for r in measures.rule_summary(spark).collect()} == {400}


def test_nothing_measured_and_empty_increments(spark, tmp_path):
    none = MeasuredIncrements(str(tmp_path / "none"), RULES, ("name",), ("v",))
    assert [(r.n_rows, r.pass_rate) for r in none.rule_summary(spark).collect()] == [(0, None)] * 2
    assert none.distinct_summary(spark).collect()[0].n_distinct == 0
    none.add(spark.createDataFrame([], FIELDS), 0)
    none.add(spark.createDataFrame([(None, None), (float("nan"), None)], FIELDS), 1)
    assert [r.n_rows for r in none.rule_summary(spark).collect()] == [2, 2]
    assert none.quantile_summary(spark).collect()[0]["values"] is None
    with pytest.raises(ValueError):
        MeasuredIncrements("x").rule_summary(spark)


def test_measuring_sends_one_row_a_task(spark, tmp_path):
    measures = MeasuredIncrements(str(tmp_path / "m"), RULES, ("name",), ("v",))
    plan = measures.state(spark.createDataFrame([], FIELDS))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_" in plan
