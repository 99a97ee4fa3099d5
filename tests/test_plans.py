"""Plan properties every registered query must keep (scale regressions)."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as E
from alertscope.plans.queries import QUERIES

from conftest import SF_SMALL

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
             "SortAggregate")

# Spark's bitmap aggregates have a sort-based form only; their input is a row for each
# bucket of a group, not the alerts.
BITMAPS = ("rolled_", "streamed_")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_slow_paths(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        if op == "SortAggregate" and name.startswith(BITMAPS):
            continue
        assert re.search(rf"\b{op}\b", plan) is None, f"{name}: {op}"
    # each text is parsed once per row: no parse expression appears twice
    assert plan.count("parseJson") <= 1, name
    parses = _calls(plan, "from_json(")
    assert len(parses) == len(set(parses)), (name, parses)


def _calls(plan: str, head: str) -> list[str]:
    """Every full ``head…)`` expression in the plan text (balanced parentheses)."""
    found, start = [], plan.find(head)
    while start >= 0:
        depth, i = 0, start + len(head) - 1
        while i < len(plan):
            depth += {"(": 1, ")": -1}.get(plan[i], 0)
            if depth == 0:
                break
            i += 1
        found.append(plan[start : i + 1])
        start = plan.find(head, i)
    return found


def test_call_extraction_sees_each_parse(spark):
    df = E.queries()["page_unnest"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    parses = _calls(plan, "from_json(")
    # the page envelope as texts and as values, then the alert
    assert len(parses) == 3 and len(set(parses)) == 3
