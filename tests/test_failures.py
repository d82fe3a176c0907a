"""What fails must say so and lose nothing."""

from __future__ import annotations

import random
from dataclasses import replace

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_history import CUT, FIELDS, SPEC, built

from lustra.functions import masks
from lustra.operators import history as h
from lustra.operators.grants import level_of, level_with_default
from lustra.operators.silver import SilverSpec
from lustra.plans.many import TableJob, TablesFailed, run_silver
from lustra.sources.readers import stream_csv
from lustra.sources.sinks import store, write_stream_table
from lustra.streaming.history_stream import StreamedHistory


def failing(df):
    return df.withColumn("x", F.raise_error(F.lit("no")).cast("int"))


def test_a_failed_refresh_leaves_the_old_result(spark, tmp_path):
    path = str(tmp_path / "result")
    assert store(spark.range(5), path).count() == 5
    with pytest.raises(Exception, match="no"):
        store(failing(spark.range(7)), path)
    assert spark.read.parquet(path).count() == 5
    assert store(spark.read.parquet(path).filter("id < 3"), path).count() == 3


def csv_rows(spark, tmp_path, text, ddl="ID int, Amount int"):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text(text)
    stream = stream_csv(spark, str(landing), T.StructType.fromDDL(ddl))
    write_stream_table(stream, str(tmp_path / "bronze"), str(tmp_path / "cp")).awaitTermination()
    return sorted(spark.read.parquet(str(tmp_path / "bronze")).select("id", "amount", "misfit_line").collect(), key=str)


def test_csv_misfits_are_kept_by_default(spark, tmp_path):
    rows = csv_rows(spark, tmp_path, "ID,Amount\n1,2\n3,12.5\n4,5,6\n")
    assert [tuple(r) for r in rows] == [(1, 2, None), (3, None, "3,12.5"), (4, 5, "4,5,6")]


def test_csv_columns_never_land_under_another_name(spark, tmp_path):
    with pytest.raises(StreamingQueryException):
        csv_rows(spark, tmp_path, "Amount,ID\n77,5\n")


@pytest.mark.parametrize("skew", [None, CUT])
def test_ties_of_a_tie_column_are_settled_alike_in_any_order(spark, skew):
    draw = random.Random(2)
    rows = [(1, s, 0, draw.choice("abc"), draw.randint(0, 3), False) for s in range(20) for _ in range(4)]
    results = []
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        results.append(built(spark.createDataFrame(rows, FIELDS).repartition(3), SPEC, skew))
    assert results[0] == results[1] == results[2]


def test_presets_that_track_nothing_raise(spark):
    with pytest.raises(ValueError, match="price"):
        h.product_history().tracked(["product_id", "updated_at", "unit_price"])
    with pytest.warns(UserWarning, match="cost"):
        assert h.product_history().tracked(["product_id", "updated_at", "price", "status"]) == ["price", "status"]


def test_every_failing_table_is_named(spark):
    done = []

    def write(name, df):
        if name in ("t3", "t7"):
            raise ValueError(f"bad {name}")
        done.append(name)

    jobs = [TableJob(f"t{i}", SilverSpec()) for i in range(10)]
    with pytest.raises(TablesFailed, match="t3: bad t3; t7: bad t7") as raised:
        run_silver(jobs, lambda name: spark.range(1), write, at_once=3)
    assert sorted(raised.value.errors) == ["t3", "t7"]
    assert len(done) == 8


def test_a_replay_that_fails_leaves_the_committed_batch(spark, tmp_path):
    target = StreamedHistory(str(tmp_path / "t"), replace(SPEC, deletes="d"), buckets=2)
    df = spark.createDataFrame([(1, 1, 0, "a", 1, False), (2, 1, 0, "b", 1, False)], FIELDS)
    target.apply(df, 0)
    before = sorted(target.read(spark, df.schema).collect())
    target.apply(df.withColumn("b", F.raise_error(F.lit("no")).cast("int")), 0)
    assert sorted(target.read(spark, df.schema).collect()) == before


@pytest.mark.parametrize(
    "mask, value, shown",
    [
        (masks.mask_nric, "S1234567D", "S****67D"),
        (masks.mask_nric, "S123D", "***"),
        (masks.mask_ssn, "123-45-6789", "***-**-6789"),
        (masks.mask_ssn, "123456789", "***-**-6789"),
        (masks.mask_ssn, "12345", "***"),
    ],
)
def test_strict_masks_hide_what_has_not_the_whole_shape(spark, mask, value, shown):
    row = spark.createDataFrame([(value,)], "v string").select(mask(F.col("v"), F.lit("partial_access"))).first()
    assert row[0] == shown


def test_level_with_a_default(spark):
    grants = spark.createDataFrame(
        [("p", "partial_access", True), ("f", "full_access", True), ("f", "masked_only", True), ("off", "full_access", False)],
        "user_email string, access_level string, is_active boolean",
    ).withColumns({"expires_at": F.lit(None).cast("timestamp"), "granted_at": F.lit(None).cast("timestamp")})
    for user, level in (("p", "partial_access"), ("f", "full_access"), ("off", "masked_only"), ("none", "masked_only")):
        got = spark.range(1).select(level_with_default(grants, F.lit(user)), level_of(grants, F.lit(user))).first()
        assert tuple(got) == (level, level)
    higher = level_with_default(grants, F.lit("none"), default="partial_access")
    assert spark.range(1).select(higher).first()[0] == "partial_access"
