"""Physical-plan properties the design relies on (checked on sf0.001)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["similar_pairs_docs", "predict_item_based", "knn_users", "rmse_item_based"])
def test_no_python_in_plans(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert not any(node in plan for node in PYTHON_NODES)


def test_topk_uses_window_group_limit(spark):
    plan = _plan(entry.queries()["knn_items"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_no_forced_hash_joins_and_pruned_scans(spark):
    plan = _plan(entry.queries()["similar_pairs_docs"](spark, SF_SMALL))
    assert "shuffle_hash" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for line in plan.splitlines():
        if "FileScan parquet" in line and "corate-coded" in line:
            assert "ReadSchema: struct<item_id:bigint,user_id:bigint>" in line or "ReadSchema: struct<item_id:bigint>" in line


def test_rating_joins_deal_heavy_keys(spark):
    query = entry.queries()["predict_item_based"](spark, SF_SMALL)
    query.write.format("noop").mode("overwrite").save()
    assert "_bucket" in query._jdf.queryExecution().optimizedPlan().toString()
