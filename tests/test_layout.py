"""The layout gives what plain lookups give, and reads the files it should."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F
from test_history import FIELDS, SPEC, random_changes

from lustra.operators.history import END, START, build_history, key_history, versions_as_of
from lustra.operators.layout import HistoryLayout


def files_read(df) -> int:
    """Files the scans of a frame opened, from their metrics."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    found, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            node = node.plan()
        metrics = node.metrics()
        if metrics.contains("numFiles"):
            found += metrics.apply("numFiles").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("eras, slots", [(1, 1), (4, 3), (50, 7)])
def test_lookups_equal_those_on_the_history(spark, tmp_path, eras, slots):
    history = build_history(spark.createDataFrame(random_changes(seed=3, n=300), FIELDS), SPEC, skew=None).cache()
    layout = HistoryLayout(str(tmp_path / "h"), ("k",), eras, slots)
    layout.write(history)
    assert rows(layout.read(spark)) == rows(history)
    borders = [r[0] for r in spark.read.parquet(f"{layout.root}/eras").select("begins").collect()]
    for when in [-1, *borders[:6], *(b - 1 for b in borders[:4]), 10**6, *random.Random(1).sample(range(200), 4)]:
        assert rows(layout.as_of(spark, when)) == rows(versions_as_of(history, when))
        assert rows(layout.as_of(spark, when, {"k": 2})) == rows(versions_as_of(history.filter("k = 2"), when))
    for key in (0, 1, 2, 999):
        found = layout.key_history(spark, {"k": key})
        assert found.collect() == key_history(history, {"k": key}).collect()
    history.unpersist()


def test_lookups_read_their_share_of_the_files(spark, tmp_path):
    history = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).alias("k"),
        F.col("id").cast("string").alias("v"),
        F.col("id").alias(START),
        F.when(F.col("id") % 10 > 0, F.col("id") + 1 + F.col("id") % 5000).alias(END),
    )
    layout = HistoryLayout(str(tmp_path / "h"), ("k",), eras=6, slots=10)
    layout.write(history)
    whole = files_read(layout.read(spark))
    assert whole >= 60
    key = layout.key_history(spark, {"k": 5})
    assert 0 < files_read(key) <= math.ceil(whole / 10) + 6
    at = layout.as_of(spark, 15_000)
    assert 0 < files_read(at) <= math.ceil(whole / 6) + 10
    both = layout.as_of(spark, 15_000, {"k": 5})
    assert 0 < files_read(both) <= 2
    assert rows(at) == rows(versions_as_of(history, 15_000))


def test_odd_histories(spark, tmp_path):
    fields = f"k int, v string, {START} timestamp_ntz, {END} timestamp_ntz"
    none = HistoryLayout(str(tmp_path / "none"), ("k",))
    none.write(spark.createDataFrame([], fields))
    assert spark.read.parquet(f"{none.root}/eras").isEmpty()
    with pytest.raises(ValueError):
        HistoryLayout("x", ())
    with pytest.raises(ValueError):
        HistoryLayout(str(tmp_path / "c"), ("k",)).write(spark.createDataFrame([], f"{fields}, era int"))
    one = spark.sql(f"SELECT 1 AS k, 'x' AS v, timestamp_ntz'2024-01-01' AS {START}, CAST(NULL AS timestamp_ntz) AS {END}")
    layout = HistoryLayout(str(tmp_path / "one"), ("k",))
    layout.write(one)
    assert layout.as_of(spark, "2024-01-01").count() == 1 and layout.as_of(spark, "2023-12-31").count() == 0
    with pytest.raises(ValueError):
        layout.key_history(spark, {"v": "x"})
    with pytest.raises(Exception, match="without a start"):
        HistoryLayout(str(tmp_path / "bad"), ("k",)).write(one.withColumn(START, F.lit(None).cast("timestamp_ntz")))
