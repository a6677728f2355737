"""Physical-plan properties: pushdown and pruning reach the scan, per-group top-k is limited
before the shuffle, and no query plans a cross or nested-loop join."""

import pytest

from tessera.registry import all_queries

SF = "/root/testdata/sf0.001"


def _plan(spark, name):
    return all_queries()[name].fn(spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark):
    plan = _plan(spark, "filter_range")
    assert "LessThan(l_discount,0.05)" in plan
    assert "ReadSchema: struct<l_extendedprice:double,l_discount:double,l_returnflag:string,l_linestatus:string>" in plan


def test_topk_per_group_is_limited_before_the_shuffle(spark):
    plan = _plan(spark, "doc_top_words")
    assert plan.count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", ["tfidf_cosine", "knn_euclid", "lsh_query", "knn_regression",
                                  "popularity_recommend", "item_recommend", "rank_position",
                                  "knn_cosine", "lsh_query", "frequent_items", "word_list_counts", "item_recommend_all"])
def test_no_cross_or_nested_loop_join(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
