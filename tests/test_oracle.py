"""Every registered query against independent SQL, over whole tables."""

from __future__ import annotations

import pytest
from oracle import differences

import __spark_entry__ as entry_points
from lustra.catalog import all_queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = all_queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    assert differences(spark, QUERIES[name].run, QUERIES[name].sql, SF_DIR) is None


def test_entry_returns_rows(spark):
    flagship = entry_points.entry(spark)
    assert flagship.count() > 0
    assert {"data_quality_flags", "quality_score"} <= set(flagship.columns)
