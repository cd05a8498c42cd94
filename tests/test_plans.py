"""Plan guards over every registered batch query: no Python on the row path, no pairwise joins,
each envelope parsed once."""

import pytest

from postwave.plans.catalog import BATCH_QUERIES
from tests.conftest import SF_SMALL

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "CartesianProduct",
             "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(BATCH_QUERIES))
def test_plan_shape(spark, name):
    df = BATCH_QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"
    assert plan.count("from_json(StructField(data,MapType") <= 1
