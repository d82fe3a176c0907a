"""Physical plans: shuffles, pushdown, code generation."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from lustra.catalog import all_queries
from lustra.catalog.histories import USERS
from lustra.operators.history import build_history, current_versions, versions_as_of
from lustra.plans.fixtures import fixture

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry_points.queries()


def plan_of(df) -> str:
    """The plan before execution, without the subplans of subqueries."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_history_needs_one_exchange_and_one_sort(spark):
    plan = plan_of(build_history(fixture(spark, SF_DIR, "user_changes"), USERS, skew=None))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert len(re.findall(r"\bSort \[", plan)) == 1


@pytest.mark.parametrize("name", ["silver_customer", "silver_source", "mask_all", "mask_policy", "dq_flags_and_score"])
def test_cleansing_is_narrow(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "Exchange" not in plan and "Sort" not in plan


#: Queries that end by reading what they wrote: their plans are a scan.
STORED = {"scd2_stream", "src_csv_stream", "src_csv_by_header", "silver_many", "silver_many_packed", "scd2_many"}
_PYTHON = r"PythonUDF|ArrowEval|MapInPandas|MapInArrow|FlatMapGroups|BatchEvalPython"


@pytest.mark.parametrize("name", sorted(set(all_queries()) - STORED))
def test_no_python_and_no_cross_join(spark, name):
    """Everything outside the subpackage for texts is built from Spark's own expressions."""
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert not re.search(_PYTHON, plan)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_gold_resolves_the_level_once(spark):
    gold = QUERIES["mask_gold"](spark, SF_DIR)
    logical = gold._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Aggregate \[", logical)) == 1


def test_version_lookups_reach_the_scan(spark, tmp_path):
    build_history(fixture(spark, SF_DIR, "user_changes"), USERS).write.parquet(str(tmp_path / "h"))
    history = spark.read.parquet(str(tmp_path / "h"))
    assert "PushedFilters: [IsNull(__END_AT)]" in plan_of(current_versions(history))
    as_of = plan_of(versions_as_of(history, "2024-01-10 00:00:00"))
    assert "LessThanOrEqual(__START_AT" in as_of and "GreaterThan(__END_AT" in as_of


def test_scan_reads_only_what_is_needed(spark):
    plan = plan_of(QUERIES["std_country"](spark, SF_DIR).select("result"))
    assert re.search(r"ReadSchema: struct<c_custkey:bigint>", plan)


def test_summary_shuffles_one_row_per_task(spark):
    plan = plan_of(QUERIES["dq_summary"](spark, SF_DIR))
    assert len(re.findall(r"Exchange", plan)) == 1
    assert "partial_count" in plan


def test_hot_keys_are_broadcast_and_ranges_are_joined(spark):
    df = QUERIES["scd2_build_hot_key"](spark, "/root/testdata/sf0.01")
    assert df.filter(F.col("user_id") == 0).count() > 0
    assert "BroadcastHashJoin" in plan_of(df)
