"""Which operators run Python, and that none multiplies all rows with all."""

from __future__ import annotations

import re

import pytest

from lustra.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
#: Built of DataFrame operations only, by contract or by choice.
NATIVE = {"op8_redirect_filter", "op13_warc_revisits"}


@pytest.mark.parametrize("name", sorted(NATIVE))
def test_native_operators_run_no_python(spark, name):
    plan = QUERIES[name].run(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"PythonUDF|ArrowEval|MapInPandas|MapInArrow|FlatMapGroups|BatchEvalPython", plan)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)
