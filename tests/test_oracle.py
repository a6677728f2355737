"""Registered queries against their DuckDB oracles on the smallest scale factor."""

import duckdb
import pytest

from tessera.registry import all_queries
from tessera.sources.tables import TABLES
from tools.oracle_check import close, rows_of

SF = "/root/testdata/sf0.001"

SAMPLE = ["tfidf_cosine", "group_sum_sorted", "grouped_quartiles", "moving_average", "kfold_assign",
          "word_counts", "docs_with_all_words", "knn_euclid", "lsh_query", "linreg_multi",
          "lasso_path", "ridge_kfold", "pr_curve", "roc_curve", "logistic_ga", "sgd_epoch",
          "tree_levelwise", "adaboost", "kmeans_lloyd", "gmm_em_step", "popularity_recommend",
          "item_recommend", "topic_cdf_count", "knn_choose_k", "word_list_counts", "vec_elementwise",
          "kmeans_text", "em_text_step", "lsh_text_radius", "lsh_precision", "adaboost_staged", "gbt_stumps",
          "frequent_items", "csv_table", "online_events", "scored_events", "function_surfaces"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_rows_tag():
    qs = all_queries()
    assert len(qs) >= 140
    assert all(q.rows for q in qs.values())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, duck, name):
    q = all_queries()[name]
    sdf = q.fn(spark, SF)
    scols = sdf.columns
    srecs = [tuple(r) for r in sdf.collect()]
    res = duck.execute(q.oracle)
    ocols = [d[0] for d in res.description]
    orecs = res.fetchall()
    assert sorted(scols) == sorted(ocols)
    assert len(srecs) == len(orecs)
    a, b = rows_of(scols, srecs), rows_of(ocols, orecs)
    assert all(close(x, y) for ra, rb in zip(a, b) for x, y in zip(ra, rb))
