"""The streamed quality flow: same as batch, quarantine, counters, replays."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from test_history import FIELDS, SPEC, random_changes

from lustra.operators.history import build_history
from lustra.operators.quality import summarize_rules
from lustra.operators.silver import SilverSpec, bound_rules, build_silver, clean_values
from lustra.streaming.quality_flow import QualityFlow

SILVER = SilverSpec().upper("a").check(a=lambda c: c.isin("X", "Y"), b=lambda c: c > 1)


def batches(spark, seed=5, n=4):
    rows = random_changes(seed=seed, n=200)
    return rows, [spark.createDataFrame(rows[i::n], FIELDS) for i in range(n)]


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    rows = [sorted(map(str, df.select(*columns).collect())) for df in (left, right)]
    assert rows[0] == rows[1]


@pytest.mark.parametrize("required", [(), ("a",), ("a", "b")])
def test_streamed_equals_batch(spark, tmp_path, required):
    rows, parts = batches(spark)
    spec = replace(SPEC, deletes="d")
    flow = QualityFlow(str(tmp_path / "flow"), spec, SILVER, required, buckets=3)
    for i, part in enumerate(parts):
        flow.apply(part, i)
    schema = parts[0].schema
    whole = build_silver(spark.createDataFrame(rows, FIELDS), SILVER)
    fit = F.lit(True)
    for name in required:
        fit = fit & F.coalesce(SILVER.rules[name](F.col(name)), F.lit(False))
    same(flow.read(spark, schema), build_history(whole.filter(fit), spec, skew=None))
    placed = F.col("k").isNotNull() & F.col("s").isNotNull()
    out = flow.quarantined(spark, schema)
    same(out.drop("batch_id", "quarantine_reasons"), whole.filter(~(fit & placed)))
    assert out.filter("quarantine_reasons IS NULL").isEmpty()
    cleaned = clean_values(spark.createDataFrame(rows, FIELDS), SILVER)
    counts = flow.rule_counts(spark).groupBy("rule").agg(
        *(F.sum(n).alias(n) for n in ("n_rows", "n_passed", "n_failed", "n_unknown"))
    )
    same(counts, summarize_rules(cleaned, bound_rules(cleaned, SILVER)).drop("pass_rate"))
    assert flow.rule_counts(spark).count() == 2 * len(parts)


def test_a_batch_replays_and_half_written_ones_stay_unseen(spark, tmp_path, monkeypatch):
    rows, parts = batches(spark, seed=6, n=2)
    flow = QualityFlow(str(tmp_path / "flow"), SPEC, SILVER, ("a",), buckets=2)
    schema = parts[0].schema
    flow.apply(parts[0], 0)
    before = [sorted(map(str, df.collect())) for df in (flow.read(spark, schema), flow.quarantined(spark, schema), flow.rule_counts(spark))]

    def lose(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        patched.setattr("lustra.streaming.history_stream.StreamedHistory.apply", lose)
        flow.apply(parts[1], 1)
    after = [sorted(map(str, df.collect())) for df in (flow.read(spark, schema), flow.quarantined(spark, schema), flow.rule_counts(spark))]
    assert before == after
    flow.apply(parts[1], 1)
    flow.apply(parts[1], 1)
    whole = build_silver(spark.createDataFrame(rows, FIELDS), SILVER).filter("a IN ('X', 'Y')")
    same(flow.read(spark, schema), build_history(whole, SPEC, skew=None))


def test_judging_is_narrow_and_reads_a_batch_once(spark, tmp_path):
    flow = QualityFlow(str(tmp_path / "flow"), SPEC, SILVER, ("a",))
    judged, _ = flow.judged(spark.createDataFrame(random_changes(seed=7, n=20), FIELDS))
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_unknown_rules_and_empty_batches(spark, tmp_path):
    with pytest.raises(ValueError):
        QualityFlow("x", SPEC, SILVER, ("nothing",))
    flow = QualityFlow(str(tmp_path / "flow"), SPEC, SILVER, ("a",), buckets=2)
    nothing = spark.createDataFrame([], FIELDS)
    flow.apply(nothing, 0)
    assert flow.read(spark, nothing.schema).isEmpty() and flow.quarantined(spark, nothing.schema).isEmpty()
    with pytest.raises(ValueError):
        flow.apply(nothing.drop("a"), 1)
