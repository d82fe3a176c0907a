"""Packs against one job for each table: same rows, few writes, and faults stay with their tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_history import FIELDS, SPEC, random_changes

from lustra.functions import standardize, validate
from lustra.operators.history import build_history
from lustra.operators.silver import SilverSpec, build_silver
from lustra.plans.many import TableJob, TablesFailed
from lustra.plans.packed import HistoryJob, history_packed, packs_of, silver_packed, write_packed

RECIPE = SilverSpec().transform(country=standardize.country).check(country=validate.is_country).upper("name")


def small_table(spark, i):
    """Sixty tables of five shapes; some are empty."""
    df = spark.range(0 if i % 17 == 3 else 5 + i).select(
        F.col("id"), F.concat(F.lit(" n"), "id").alias("name"), F.lit("usa" if i % 2 else "x").alias("country")
    )
    return df.withColumn(f"extra {i % 5}.x", F.lit(i).cast("double" if i % 5 == 0 else "int"))


def rows(df):
    return sorted(map(str, df.collect()))


def test_sixty_tables_in_under_six_writes(spark):
    names = [f"table-{i} é" for i in range(60)]
    tables = {name: small_table(spark, i) for i, name in enumerate(names)}

    def read(name):
        if name == names[7]:
            raise OSError("not there")
        df = tables[name]
        return df.withColumn("country", F.col("nothing")) if name == names[9] else df

    run = silver_packed(spark, [TableJob(name, RECIPE) for name in names], read)
    assert set(run.failed) == {names[7], names[9]} and run.writes < 6
    for name in names[:7] + names[20:25]:
        have, want = run.tables[name].read(spark), build_silver(tables[name], RECIPE)
        assert have.columns == want.columns and rows(have) == rows(want)
    with pytest.raises(TablesFailed, match="table-7"):
        run.raise_failed()


def test_a_table_that_fails_while_it_runs_is_alone(spark):
    tables = {f"t{i}": small_table(spark, i) for i in range(12)}
    tables["t5"] = tables["t5"].withColumn("id", F.raise_error(F.lit("broken row")).cast("bigint"))
    run = write_packed(spark, tables, packs=2)
    assert set(run.failed) == {"t5"} and "broken row" in str(run.failed["t5"])
    assert set(run.tables) == set(tables) - {"t5"}
    assert rows(run.tables["t4"].read(spark)) == rows(tables["t4"])


def test_histories_of_alike_tables_are_one_build(spark):
    changes = {f"k{i}": spark.createDataFrame(random_changes(seed=i, n=60), FIELDS) for i in range(8)}
    changes["other"] = changes["k1"].withColumn("more", F.lit(1))
    jobs = [HistoryJob(name, SPEC) for name in changes]
    run = history_packed(spark, jobs, changes.__getitem__, packs=2)
    assert not run.failed and run.writes <= 2
    for name in ("k0", "k3", "other"):
        assert rows(run.tables[name].read(spark)) == rows(build_history(changes[name], SPEC, skew=None))


def test_faulty_histories_stay_alone(spark):
    changes = {f"k{i}": spark.createDataFrame(random_changes(seed=i, n=40), FIELDS) for i in range(4)}
    changes["k2"] = changes["k2"].withColumn("a", F.raise_error(F.lit("broken row")).cast("string"))
    changes["short"] = changes["k1"].drop("s")
    run = history_packed(spark, [HistoryJob(name, SPEC) for name in changes], changes.__getitem__)
    assert set(run.failed) == {"k2", "short"}
    assert rows(run.tables["k3"].read(spark)) == rows(build_history(changes["k3"], SPEC, skew=None))


def test_packs_are_even_and_large_tables_alone():
    sizes = {f"t{i}": 10 + i for i in range(40)} | {"huge": 10_000}
    packs = packs_of(sizes, 4, 5_000)
    assert packs[0] == ["huge"] and len(packs) == 5
    weights = [sum(sizes[n] for n in names) for names in packs[1:]]
    assert max(weights) - min(weights) <= 50
    assert sorted(n for names in packs for n in names) == sorted(sizes)
    assert packs_of({}, 4, 1) == []
