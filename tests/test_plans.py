"""Plan-shape guards for every registered query (what must hold at scale)."""

import re

import pytest

import __spark_entry__ as E
from catalytics.plans.registry import QUERIES
from tests.conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")
# ML queries run MLlib jobs while being built; their own plans are simple projections.
SKIP = {"feature_importance", "forest_metrics", "prepare_ml", "build_features"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_no_cross_joins(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


def test_scan_reads_only_used_columns(spark):
    plan = _plan(E.queries()["top_groups_by_mean"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all(s == "p_brand:string,p_retailprice:double" for s in schemas)


def test_filter_pushed_to_scan(spark):
    plan = _plan(E.queries()["numeric_summary"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_tax), IsNotNull(l_extendedprice)]" in plan


def test_top_k_is_take_ordered(spark):
    for name in ("top_groups_by_mean", "top_groups_min_size", "best_subgroup_per_group", "top_groups_by_total"):
        assert "TakeOrderedAndProject" in _plan(E.queries()[name](spark, SF_SMALL)), name


def test_best_row_per_group_uses_group_limit(spark):
    plan = _plan(E.queries()["best_subgroup_per_group"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan


def test_grouping_is_partial_then_final(spark):
    plan = _plan(E.queries()["mean_by_flag"](spark, SF_SMALL))
    assert "partial_count" in plan and "partial_avg" in plan
