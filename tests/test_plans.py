"""Plan properties of the scale-critical queries: no cartesian or
nested-loop joins and no row-at-a-time Python in the physical plan."""

import pytest

import __spark_entry__ as E

from conftest import SMALL

FORBIDDEN = ["FlatMapGroupsInPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]
QUERIES = ["class_balance_flagship", "distinct_rows", "unseen_level_fallback", "stratified_folds",
           "hand_till_auc", "ordered_quantile", "profile_numeric", "impute_knn", "nearmiss",
           "partitioned_rows", "lesion_max_site", "one_hot"]


@pytest.mark.parametrize("name", QUERIES)
def test_no_forbidden_operators(spark, name):
    df = E.queries()[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in FORBIDDEN if op in plan], plan[:2000]


def test_column_pruning_reaches_the_scan(spark):
    df = E.queries()["lesion_count"](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<p_partkey:bigint>" in plan
