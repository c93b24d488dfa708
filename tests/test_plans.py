"""Plan checks over every registered query: no cross joins, no Python in the plan."""

from __future__ import annotations

import contextlib
import io

import pytest

from ledgerlens.plans.catalogue import QUERIES

from conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_plan_has_no_cross_join_or_python(spark, key):
    plan = plan_of(QUERIES[key](spark, SF_SMALL))
    bad = [op for op in FORBIDDEN if op in plan]
    assert not bad, f"{key}: {bad}"


def test_filters_and_projections_reach_the_scan(spark):
    plan = plan_of(QUERIES["category_unreturned_top"](spark, SF_SMALL))
    assert "EqualTo(p_type,PROMO)" in plan
    lineitem_schema = [ln for ln in plan.splitlines() if "ReadSchema: struct<l_orderkey" in ln]
    assert lineitem_schema and "l_tax" not in lineitem_schema[0]
