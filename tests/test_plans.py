"""Scale guards on every registered plan (sf0.001): no pair-producing joins,
no Python evaluation, aggregates with a map-side partial stage, and windows
only over rollup output."""

import re

import pytest

from hebdo.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")
# queries whose only window is A4a on the output of a rollup over the same keys
WINDOW_AFTER_ROLLUP = {"group_size_label"}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    plan = physical(QUERIES[name](spark, SF))
    for node in FORBIDDEN:
        assert node not in plan, f"{name} uses {node}"
    if "Window" in plan:
        assert name in WINDOW_AFTER_ROLLUP, f"{name} has an unexpected window"
    # every aggregate is planned as a map-side partial stage plus a final stage
    aggregates = re.findall(r"\b(HashAggregate|SortAggregate|ObjectHashAggregate)\(", plan)
    assert len(aggregates) % 2 == 0, f"{name}: unpaired aggregate {aggregates}"


def test_top1_and_merges_combine_map_side(spark):
    for name in ("top1_per_group", "two_measure_outer_merge", "full_join_on_values"):
        plan = physical(QUERIES[name](spark, SF))
        assert "partial_" in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan


WIDE = {"lineitem": 11, "orders": 6, "events": 6}
READS_EVERY_COLUMN = {("clean_names", "orders")}     # renames every column by design


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_scans_read_only_needed_columns(spark, name):
    """Column pruning reaches the Parquet scans of the wide tables."""
    plan = physical(QUERIES[name](spark, SF))
    for cols, table in re.findall(r"FileScan parquet \[([^\]]*)\].*?/(\w+)\.parquet", plan):
        if table in WIDE and (name, table) not in READS_EVERY_COLUMN:
            assert len(cols.split(",")) < WIDE[table], f"{name} reads every column of {table}"
