"""Plan checks over every registered query (smallest driver data): the
physical plans hold no operator that breaks at scale — no cartesian or
nested-loop join (all pairs), no Python evaluation in the hot path, no
collection of a whole group into one value — and scans read only the
columns a query uses."""

import re

import pytest

from conftest import SF_SMALL
from strideframe.plans.registry import QUERIES

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "collect_list", "collect_set", "localCheckpoint"]

# Queries that profile whole tables read every column on purpose.
ALL_COLUMNS = {"table_profile", "tracking_profile"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_unscalable_operator(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad} in plan"


def test_lineitem_scans_are_pruned(spark):
    """Every lineitem scan reads a column subset (16 columns in the table)."""
    checked = 0
    for name in sorted(set(QUERIES) - ALL_COLUMNS):
        plan = _plan(QUERIES[name](spark, SF_SMALL))
        for cols in re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*lineitem\.parquet", plan):
            assert len(cols.split(",")) < 16, f"{name} reads all lineitem columns"
            checked += 1
    assert checked > 20


@pytest.mark.parametrize("name", ["distance_per_entity", "possession_per_entity", "dedupe_first"])
def test_dedupe_without_sorted_aggregates(spark, name):
    """A key's copies are cut down before the exchange, by a group limit."""
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "SortAggregate" not in plan and "WindowGroupLimit" in plan
