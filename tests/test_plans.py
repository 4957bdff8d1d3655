"""Scale properties of every registered plan (the pytest form of tools/plan_audit.py)."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

STREAMS = {"stream_ingest", "stream_monitoring"}
NAMES = sorted(n for n in E.queries() if n not in STREAMS)


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_join_or_global_sort(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line and i > 0:
            assert re.search(r"HashAggregate|SortAggregate|TakeOrderedAndProject|GlobalLimit|CollectLimit",
                             lines[i - 1]), f"single-partition exchange under {lines[i - 1].strip()}"


def test_topk_limits_before_shuffle(spark):
    plan = E.queries()["search_cosine"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "MapInPandas" in plan
