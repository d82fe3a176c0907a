"""Streams: files once, same result as batch, replay changes nothing."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_history import CUT, FIELDS, SPEC, random_changes, versions_of
from dataclasses import replace

from lustra.catalog.histories import _in_three_batches
from lustra.operators.history import END, START
from lustra.operators.silver import silver_customers
from lustra.plans.fixtures import fixture
from lustra.sources.readers import stream_csv, stream_table
from lustra.sources.sinks import write_stream_table
from lustra.sources.workspace import fresh_folder
from lustra.streaming.history_stream import StreamedHistory

SF_DIR = "/root/testdata/sf0.001"


def shown(target, spark, schema):
    rows = target.read(spark, schema).select("k", "a", "b", START, END).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def batches_of(rows, how, n=4):
    """Cut rows into batches: by time, by time with a little disorder, or at random."""
    rnd = random.Random(1)
    if how == "in order":
        placed = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0))
    elif how == "nearly":
        placed = sorted(rows, key=lambda r: (r[1] or 0) + rnd.uniform(0, 25))
    else:
        placed = rnd.sample(rows, len(rows))
    size = -(-len(placed) // n)
    return [placed[i : i + size] for i in range(0, len(placed), size)]


@pytest.mark.parametrize(
    "how, n, lookback, ignore_null",
    [("in order", 4, 8, True), ("in order", 4, 8, False), ("nearly", 6, 2, True), ("nearly", 5, 1, False),
     ("shuffled", 4, 8, True), ("shuffled", 5, 2, True), ("shuffled", 4, 1, False)],
)
def test_batches_add_up_to_one_build(spark, tmp_path, how, n, lookback, ignore_null):
    rows = random_changes(seed=11, n=240)
    spec = replace(SPEC, deletes="d", ignore_null=ignore_null)
    skew = CUT if (how, n) == ("shuffled", 4) else None
    target = StreamedHistory(str(tmp_path / "t"), spec, buckets=3, lookback=lookback, skew=skew)
    seen = []
    for i, batch in enumerate(batches_of(rows, how, n)):
        seen += batch
        df = spark.createDataFrame(batch, FIELDS)
        target.apply(df, i)
        if i == 1:
            target.apply(df, i)
        if i >= n - 3:
            assert shown(target, spark, df.schema) == versions_of(seen, ignore_null=ignore_null, deletes=True)
    rejects = target.rejects(spark, df.schema)
    assert rejects.count() == sum(r[0] is None or r[1] is None for r in rows)


def test_slightly_late_rows_replay_recent_batches_only(spark, tmp_path, monkeypatch):
    """One key is a little late in every batch, and is never rebuilt from all its changes."""
    rows = [(1 + i % 3, i, i, "xy"[i // 7 % 2], i % 5, False) for i in range(140)]
    target = StreamedHistory(str(tmp_path / "t"), SPEC, buckets=2, lookback=3)
    reads = []
    log = StreamedHistory._log
    monkeypatch.setattr(StreamedHistory, "_log", lambda self, *a: reads.append(a[2:4]) or log(self, *a))
    late = [r for r in rows if r[0] == 1 and 12 <= r[1] % 20 <= 14]
    batches = [[r for r in rows if r[1] // 20 == b and r not in late] for b in range(7)]
    for row in late[:-1]:
        batches[row[1] // 20 + 1].append(row)
    batches[-1].append(late[-1])
    for i, batch in enumerate(batches):
        target.apply(spark.createDataFrame(batch, FIELDS), i)
    assert shown(target, spark, spark.createDataFrame(rows, FIELDS).schema) == versions_of(rows)
    assert reads == [(max(b - 3, -1), b) for b in range(1, 7)]


def test_half_written_batch_is_invisible_and_repaired(spark, tmp_path, monkeypatch):
    spec = replace(SPEC, deletes="d")
    rows = random_changes(seed=21, n=200)
    first, second = batches_of(rows, "shuffled", n=2)
    target = StreamedHistory(str(tmp_path / "t"), spec, buckets=3)
    target.apply(spark.createDataFrame(first, FIELDS), 0)
    schema = spark.createDataFrame(first, FIELDS).schema
    before = shown(target, spark, schema)
    nothing = spark.createDataFrame([], FIELDS)

    class Lost(Exception):
        pass

    def lose(*_):
        raise Lost

    with monkeypatch.context() as patched, pytest.raises(Lost):
        patched.setattr(type(nothing.coalesce(1)), "coalesce", lose)
        target.apply(spark.createDataFrame(second, FIELDS), 1)
    assert spark.read.parquet(f"{target.root}/versions").filter("batch_id = 1").count() > 0
    assert shown(target, spark, schema) == before
    target.apply(spark.createDataFrame(second, FIELDS), 1)
    assert shown(target, spark, schema) == versions_of(rows, deletes=True)


def test_empty_history_and_empty_batch(spark, tmp_path):
    target = StreamedHistory(str(tmp_path / "t"), SPEC, buckets=3)
    nothing = spark.createDataFrame([], FIELDS)
    assert shown(target, spark, nothing.schema) == []
    target.apply(nothing, 0)
    assert shown(target, spark, nothing.schema) == []
    target.apply(spark.createDataFrame([(1, 1, 0, "x", 1, False)], FIELDS), 1)
    target.apply(nothing, 2)
    assert shown(target, spark, nothing.schema) == [(1, "x", 1, 1, None)]


def test_stream_feeds_history(spark, tmp_path):
    rows = random_changes(seed=31, n=200)
    df = spark.createDataFrame(rows, FIELDS)
    df.repartition(3, "tie").write.parquet(str(tmp_path / "in"))
    target = StreamedHistory(str(tmp_path / "t"), replace(SPEC, deletes="d"), buckets=3)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    target.start(stream, str(tmp_path / "cp")).awaitTermination()
    assert shown(target, spark, df.schema) == versions_of(rows, deletes=True)


def test_csv_files_are_ingested_once(spark, tmp_path):
    landing, bronze, checkpoint = (str(tmp_path / n) for n in ("landing", "bronze", "cp"))
    spark.createDataFrame([(1, "a"), (2, "b")], [" The ID", "Full  Name"]).write.option("header", True).csv(landing)
    write_stream_table(stream_csv(spark, landing), bronze, checkpoint).awaitTermination()
    more = spark.createDataFrame([(3, "c")], [" The ID", "Full  Name"])
    more.write.mode("append").option("header", True).csv(landing)
    write_stream_table(stream_csv(spark, landing), bronze, checkpoint).awaitTermination()
    write_stream_table(stream_csv(spark, landing), bronze, checkpoint).awaitTermination()
    stored = spark.read.parquet(bronze)
    assert sorted(r["the_id"] for r in stored.collect()) == [1, 2, 3]
    assert set(stored.columns) == {"the_id", "full_name", "misfit_line", "ingested_file", "ingestion_ts"}
    assert stored.filter(F.col("ingested_file").contains("landing") & F.col("ingestion_ts").isNotNull()).count() == 3


def test_silver_is_the_same_on_a_stream(spark, tmp_path):
    bronze = fixture(spark, SF_DIR, "crm_customers")
    bronze.write.parquet(str(tmp_path / "bronze"))
    at = F.lit("2024-01-01").cast("timestamp_ntz")
    stream = silver_customers(stream_table(spark, str(tmp_path / "bronze")), at)
    write_stream_table(stream, str(tmp_path / "silver"), str(tmp_path / "cp")).awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "silver"))
    batch = silver_customers(bronze, at)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_lines_that_do_not_fit_are_kept(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text("The ID,Name\n1,a\nx,b\n")
    schema = T.StructType.fromDDL("`The ID` int, Name string")
    stream = stream_csv(spark, str(landing), schema, misfits="misfit")
    write_stream_table(stream, str(tmp_path / "bronze"), str(tmp_path / "cp")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "bronze")).select("the_id", "name", "misfit").collect()
    assert sorted(rows, key=str) == [(1, "a", None), (None, "b", "x,b")]


def test_state_of_unknown_size_is_not_broadcast(spark, tmp_path, monkeypatch):
    """Keys' latest rows and voids may unfold to any size: they meet the batch by shuffle, not on the driver."""
    plans = []
    frame = type(spark.range(1))
    checkpoint = frame.checkpoint
    monkeypatch.setattr(frame, "checkpoint", lambda df, *a: plans.append(plan_of(df)) or checkpoint(df, *a))
    target = StreamedHistory(str(tmp_path / "t"), SPEC, buckets=2, skew=None)
    rows = [(1 + i % 9, i * 37 % 60, i, "xy"[i // 7 % 2], i % 5, False) for i in range(60)]
    for i in range(3):
        df = spark.createDataFrame(rows[i::3], FIELDS)
        target.apply(df, i)
    # the late keys of a batch are counted: only these may be broadcast, to the log and the stored states
    arrived = [p for p in plans if "late" in p and "deep" not in p]
    assert len(arrived) == 3
    assert all("Broadcast" not in p for p in [*arrived, plan_of(target.read(spark, df.schema))])
    assert "SortMergeJoin" in arrived[-1]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_three_batches_of_a_file_a_core(spark):
    changes = fixture(spark, SF_DIR, "user_changes")
    stream = _in_three_batches(spark, changes, "batches", "event_id")
    files, rows = [], []
    stream = stream.select("*", "_metadata.file_path").withColumnRenamed("file_path", "source_file")
    take = lambda batch, _: (files.append(batch.select("source_file").distinct().count()), rows.append(batch.count()))
    checkpoint = fresh_folder(spark, "batches-checkpoint")
    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query.start().awaitTermination()
    assert files == [spark.sparkContext.defaultParallelism] * 3
    assert sum(rows) == changes.count()
