"""History builds against a row-by-row model, with whole and with cut keys."""

from __future__ import annotations

import random
from collections import defaultdict
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lustra.operators import history as h
from lustra.sources.readers import read_table
from lustra.sources.sinks import create_table

FIELDS = "k int, s int, tie int, a string, b int, d boolean"
SPEC = h.history_of("t", ["k"], "s", track=("a",), tie_break=("tie",), transient=("tie", "d"))
CUT = h.SkewPolicy(hot_rows=20, range_rows=15)


def versions_of(rows, track=("a",), ignore_null=True, deletes=False):
    """Sequential model: walk each key's rows in order and keep one open version."""
    latest = defaultdict(dict)
    for k, s, tie, a, b, d in rows:
        if k is not None and s is not None and (s not in latest[k] or tie > latest[k][s][0]):
            latest[k][s] = (tie, a, b, d)
    out = []
    for k, by_seq in latest.items():
        version = None
        for s in sorted(by_seq):
            _, a, b, gone = by_seq[s]
            if deletes and gone:
                if version:
                    out.append((k, version["a"], version["b"], version["start"], s))
                version = None
                continue
            now = {"a": a, "b": b}
            if version and ignore_null:
                now = {c: version[c] if v is None else v for c, v in now.items()}
            if version and all(version[c] == now[c] for c in track):
                version.update(now)
                continue
            if version:
                out.append((k, version["a"], version["b"], version["start"], s))
            version = {**now, "start": s}
        if version:
            out.append((k, version["a"], version["b"], version["start"], None))
    return sorted(out, key=repr)


def built(df, spec, skew=None):
    shown = h.build_history(df, spec, skew).select("k", "a", "b", h.START, h.END)
    return sorted((tuple(r) for r in shown.collect()), key=repr)


def random_changes(seed, n=400):
    rnd = random.Random(seed)
    return [
        (
            rnd.choice([None, 1, 2, 3, 3, 3, 3]),
            rnd.choice([None, *range(120)]),
            i,
            rnd.choice([None, None, "x", "y"]),
            rnd.choice([None, 1, 2]),
            rnd.random() < 0.15,
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("skew", [None, CUT], ids=["whole", "cut"])
@pytest.mark.parametrize("track", [("a",), ("a", "b")])
@pytest.mark.parametrize("deletes", [None, "d"])
@pytest.mark.parametrize("ignore_null", [True, False])
def test_random_changes(spark, ignore_null, deletes, track, skew):
    rows = random_changes(seed=100 + 4 * ignore_null + 2 * (deletes is None) + len(track))
    spec = replace(SPEC, ignore_null=ignore_null, deletes=deletes, track=track)
    expected = versions_of(rows, track, ignore_null, deletes is not None)
    assert built(spark.createDataFrame(rows, FIELDS), spec, skew) == expected


def test_one_sequence_value_holds_a_third_of_all_rows(spark):
    rows = [(1, 5, i, "x" if i % 2 else "y", i, False) for i in range(300)]
    rows += [(1 + i % 40, i, 1000 + i, "xy"[i % 2], i, False) for i in range(600)]
    assert built(spark.createDataFrame(rows, FIELDS), SPEC, CUT) == versions_of(rows)


def test_every_row_under_one_key(spark):
    rows = [(1, i * 7919 % 1000, i, random.Random(i).choice(["x", "y", None]), None, False) for i in range(500)]
    assert built(spark.createDataFrame(rows, FIELDS), SPEC, CUT) == versions_of(rows)


def test_consecutive_deletes_and_reopening(spark):
    rows = [
        (1, 1, 0, None, None, True),
        (1, 2, 0, "x", 1, False),
        (1, 3, 0, None, None, True),
        (1, 4, 0, None, None, True),
        (1, 5, 0, None, 2, False),
        (1, 6, 0, "x", None, False),
    ]
    spec = replace(SPEC, deletes="d")
    expected = [(1, None, 2, 5, 6), (1, "x", 1, 2, 3), (1, "x", 2, 6, None)]
    assert built(spark.createDataFrame(rows, FIELDS), spec) == sorted(expected, key=repr)


def test_null_delete_predicate_is_no_delete(spark):
    rows = [(1, 1, 0, "x", 1, None)]
    assert built(spark.createDataFrame(rows, FIELDS), replace(SPEC, deletes="d")) == [(1, "x", 1, 1, None)]


def test_composite_keys_and_invariants(spark):
    rows = random_changes(seed=9, n=600)
    df = spark.createDataFrame(rows, FIELDS).withColumn("k2", F.col("tie") % 2)
    spec = h.history_of("t", ["k", "k2"], "s", track=("a",), tie_break=("tie",), transient=("tie", "d"), deletes="d")
    for skew in (None, CUT):
        spans = defaultdict(list)
        for row in h.build_history(df, spec, skew).collect():
            spans[row["k"], row["k2"]].append((row[h.START], row[h.END]))
        for versions in spans.values():
            versions.sort()
            assert sum(end is None for _, end in versions) <= 1
            for (_, end), (start, _) in zip(versions, versions[1:]):
                assert end is not None and end <= start
            assert all(end is None or start < end for start, end in versions)


def test_as_of_gives_one_version_per_key(spark):
    rows = random_changes(seed=4)
    history = h.build_history(spark.createDataFrame(rows, FIELDS), replace(SPEC, deletes="d")).cache()
    for at in (-1, 0, 30, 60, 119, 500):
        found = h.versions_as_of(history, at).groupBy("k").count().filter("count > 1")
        assert found.count() == 0
    open_now = h.current_versions(history)
    assert sorted(open_now.collect()) == sorted(h.versions_as_of(history, 10_000).collect())


def test_key_history_is_ordered(spark):
    history = h.build_history(spark.createDataFrame(random_changes(seed=6), FIELDS), SPEC)
    starts = [r[h.START] for r in h.key_history(history, {"k": 3}).collect()]
    assert starts == sorted(starts) and len(starts) > 5


def test_rejects_are_not_lost(spark):
    rows = random_changes(seed=2)
    df = spark.createDataFrame(rows, FIELDS)
    assert h.rejected_changes(df, SPEC).count() == sum(r[0] is None or r[1] is None for r in rows)


def test_stored_columns_include_the_sequence(spark):
    df = spark.createDataFrame([(1, 1, 0, "x", 1, False)], FIELDS)
    assert h.build_history(df, SPEC).columns == ["k", "s", "a", "b", h.START, h.END]


def test_tracking_lists():
    columns = ["k", "s", "tie", "a", "b", "d"]
    assert replace(SPEC, track=None).tracked(columns) == ["a", "b"]
    assert replace(SPEC, track=None, track_except=("a",)).tracked(columns) == ["b"]
    with pytest.raises(ValueError, match="not both"):
        replace(SPEC, track_except=("a",))
    with pytest.raises(ValueError, match="zip"):
        replace(SPEC, track=("zip",)).tracked(columns)
    assert replace(SPEC, track=("zip", "a"), lenient=True).tracked(columns) == ["a"]
    with pytest.raises(ValueError, match="s"):
        replace(SPEC, lenient=True).tracked(["k", "a"])
    with pytest.raises(ValueError, match="key"):
        replace(SPEC, keys=())


def test_explicitly_tracked_sequence_opens_every_row(spark):
    rows = [(1, i, 0, "x", 1, False) for i in range(40)]
    for skew in (None, CUT):
        assert len(built(spark.createDataFrame(rows, FIELDS), replace(SPEC, track=("s",)), skew)) == 40


def test_presets():
    customers = h.customer_history()
    assert (customers.target, customers.source) == ("customers_silver", "customers_silver_source")
    assert customers.keys == ("customer_id",) and customers.sequence_by == "silver_processed_ts"
    assert "quality_score" in customers.track_except and h.customer_history(track_all=True).track_except is None
    assert h.transaction_history().track is None
    assert h.transaction_history(status_only=True).track == ("status", "amount", "updated_at")
    assert h.product_history().track == ("price", "cost", "availability", "status")
    assert h.product_history(price_changes=False).track is None
    generic = h.history_of("staff", ["id"], track_except=("note",), deletes="gone")
    assert generic.sequence_by == "updated_at" and generic.deletes == "gone" and generic.ignore_null


def test_target_table_can_be_declared_first(spark, tmp_path):
    df = spark.createDataFrame([(1, 1, 0, "x", 1, False)], FIELDS)
    schema = h.history_schema(df.schema, SPEC)
    built_history = h.build_history(df, SPEC)
    assert schema.names == built_history.columns
    assert [f.dataType for f in schema] == [f.dataType for f in built_history.schema]
    create_table(spark, "t_silver", schema, path=str(tmp_path / "t"), comment="versions of t")
    try:
        assert read_table(spark, "t_silver").count() == 0
        built_history.write.mode("append").insertInto("t_silver")
        assert h.current_versions(read_table(spark, "t_silver")).count() == 1
        assert spark.catalog.getTable("t_silver").description == "versions of t"
    finally:
        spark.sql("DROP TABLE t_silver")
