"""Registered queries against their SQL twins on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests import check

DIR = "/root/testdata/sf0.001"
QUICK = [
    "featured_items", "item_stats_full", "dataset_summary", "activity_quantiles", "user_profile", "popularity_rank", "long_tail",
    "id_mapping", "browse_items", "item_detail", "user_directory", "json_extract_metadata", "feat_tags", "feat_genre_tfidf_poly", "feat_V1",
    "theme_features", "sim_pearson", "sim_adjusted_cosine", "user_knn_cosine_hot", "item_knn_basic", "user_knn_itr", "content_knn_tiles",
    "fcp", "ndcg_at_k", "novelty_rank", "user_ridge_chunks", "explain", "recommend", "recommend_group", "recommend_group_surprise",
    "top_n_unseen", "load_library", "upsert_registered_user",
]
NAMES = [n for n in entry.oracle_sql()] if os.environ.get("ALL_QUERIES") else QUICK

pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="shared tables not present")


@pytest.fixture(scope="module")
def con():
    return check.connect(DIR)


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    ok, note = check.compare(spark, con, name, DIR)
    assert ok, note
