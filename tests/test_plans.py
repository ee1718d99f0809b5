"""Physical-plan checks: the plans we rely on for scale are the ones Spark picks."""

import pytest

import __spark_entry__ as entry
from scales import SF_SMALL

QUERIES = entry.queries()
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def plan(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_items_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(spark, "top_items")


def test_dictionary_join_is_broadcast(spark):
    assert "BroadcastHashJoin" in plan(spark, "item_popularity_named")


def test_filter_pushed_to_scan(spark):
    p = plan(spark, "min_reading_by_station")
    assert "EqualTo(event_type,purchase)" in p.split("PushedFilters:")[1].split("]")[0]


def test_column_pruning(spark):
    p = plan(spark, "spend_by_customer")
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in p


@pytest.mark.parametrize("name", ["top_items", "tag_popularity", "word_count_regex", "node_degree",
                                  "similar_items", "rating_summary", "mean_baseline_rmse"])
def test_no_python_in_plan(spark, name):
    p = plan(spark, name)
    assert not any(n in p for n in PYTHON_NODES), p


def test_similarity_python_only_in_block_products(spark):
    from rankfold.operators import similarity
    from rankfold.plans import testmap as tm

    p = similarity.item_similarity(tm.ratings_unique_df(spark, SF_SMALL), light_user=0)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" in p and "BatchEvalPython" not in p
