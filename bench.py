"""Headline queries, timed one by one on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tasteframe.plans import catalog  # noqa: E402
from tasteframe.shipping import ship  # noqa: E402

HEADLINE = [
    "featured_items", "item_stats_full", "dataset_summary", "activity_quantiles", "popularity_rank", "long_tail",
    "top_genre_combinations", "user_profile", "item_detail", "feat_genre_tfidf_poly", "feat_tags", "feat_V3",
    "sim_cosine", "sim_pearson", "corated_pairs", "user_knn_cosine", "user_knn_itr", "item_knn_basic", "content_knn",
    "user_ridge", "content_predict", "user_explanation", "latent_factor", "hybrid_blend", "top_n_unseen",
    "fcp", "ndcg_at_k", "intra_list_diversity", "novelty_rank", "hit_rate",
    "recommend", "recommend_group", "recommend_group_surprise",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    ship(spark)
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    times = {}
    for name in names:
        t0 = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
