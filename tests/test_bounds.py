"""No caps, no machine-local folders, no cells that depend on how the values lie."""

from __future__ import annotations

import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe import scratch
from tasteframe.operators import baselines, catalogue, latent, ranking, recommend, stats, surprise, topics, trees
from tasteframe.plans import jobs, queries_recommend
from tasteframe.sources import sinks, tables


def fresh(spark, name):
    return f"{spark.conf.get('spark.checkpoint.dir')}/{name}-{os.urandom(4).hex()}.csv"


TITLES = ['"Great Performances" Cats, the (1998)', 'Two\nlines, "quoted"', "Plain", 'a "b", c']


def test_csv_round_trips_of_odd_titles(spark):
    items = spark.createDataFrame([(i, t, "Action|Comedy") for i, t in enumerate(TITLES)], C.ITEMS_SCHEMA)
    ratings = spark.createDataFrame([(u, i, 4.5) for u in range(3) for i in range(4)], f"{C.USER} long, {C.ITEM} long, {C.RATING} double")
    path = fresh(spark, "template")
    sinks.write_library_template(ratings, items, path)
    rows = {r.movieId: r for r in tables.load_library(spark, path).collect()}
    assert [rows[i].title for i in range(4)] == TITLES and all(r.genres == "Action|Comedy" and r.n_watched == 0 for r in rows.values())
    path = fresh(spark, "items")
    sinks.write_csv(items, path)
    assert {(r.movieId, r.title) for r in tables.load_items(spark, path).collect()} == set(enumerate(TITLES))
    report = spark.createDataFrame([(t, 0.5) for t in TITLES], "model string, rmse double")
    path = sinks.write_report(report, fresh(spark, "reports"))
    back = spark.read.schema("model string, rmse double").options(**C.CSV, multiLine=True).csv(path)
    assert sorted(r.model for r in back.collect()) == sorted(TITLES)


def test_ranks_do_not_depend_on_how_ids_lie(spark):
    ids = [*range(20_000), 2**60]
    df = spark.createDataFrame([(i,) for i in ids], "x long")
    got = [r["rank"] for r in ranking.global_rank(df, "x").orderBy("x").collect()]
    assert got == list(range(1, len(ids) + 1))
    parts = ranking.in_ranges(df, F.col("x")).groupBy("_part").count().collect()
    assert max(r["count"] for r in parts) <= 0.5 * len(ids)


def test_quantiles_with_an_outlier(spark):
    x = np.concatenate([np.random.default_rng(1).normal(size=5000), [1e9]])
    (row,) = stats.wide_quantiles(spark.createDataFrame([(float(v),) for v in x], "x double"), "x", [0.0, 0.1, 0.5, 0.99, 1.0]).collect()
    assert row.q == pytest.approx(np.quantile(x, [0.0, 0.1, 0.5, 0.99, 1.0]), rel=1e-9)


def test_factors_of_large_ids(spark):
    rng = np.random.default_rng(2)
    rows = [(2**40 + u, 2**41 + i, float(rng.integers(1, 11)) / 2) for u in range(30) for i in range(12) if (u + i) % 3]
    train = spark.createDataFrame(rows, f"{C.USER} long, {C.ITEM} long, {C.RATING} double")
    model = latent.latent_factor(train, rank=2, max_iter=2)
    assert model.users.count() == 30 and model.predict(train).filter("est is null").count() == 0


def test_own_random_rating_reaches_every_position(spark):
    train = spark.range(3000).select(F.lit(1).cast("long").alias(C.USER), F.col("id").alias(C.ITEM), F.when(F.col("id") < 2700, 1.0).otherwise(5.0).alias(C.RATING))
    targets = spark.range(4000).select(F.lit(1).cast("long").alias(C.USER), (F.col("id") + 10**7).alias(C.ITEM))
    share = baselines.predict_random_sample(train, targets).agg(F.avg((F.col("est") == 5.0).cast("int"))).first()[0]
    assert share == pytest.approx(0.1, abs=0.02)
    top = spark.range(5000).select(ranking.seeded_number("id").alias("h")).agg(F.max("h")).first()[0]
    assert 2**59 < top < 2**60


def test_pairs_of_a_table_of_users(spark, monkeypatch, ratings, items):
    monkeypatch.setattr(catalogue, "BLOCK", 7)
    users = spark.range(50).select(F.col("id").alias(C.USER))
    assert catalogue.user_item_pairs(users, items).distinct().count() == 50 * items.count()
    assert recommend.candidates(items, ratings, users).count() == 50 * items.count() - ratings.count()
    listed, table = (catalogue.anti_testset(ratings, u) for u in (list(range(50)), users))
    assert sorted(map(str, listed.collect())) == sorted(map(str, table.collect()))


def test_a_participant_needs_an_id(spark, ratings):
    schema = "name string, user_id long, liked array<struct<id: long, title: string>>, wishlist array<struct<id: long, title: string>>"
    group = spark.createDataFrame([("a", 1, [], []), ("b", None, [], [])], schema)
    with pytest.raises(Exception, match="no user_id"):
        recommend.group_candidates(ratings, group).collect()
    assert recommend.group_candidates(ratings, group.filter("name = 'a'")).count() == 5


def test_every_wish_counts(spark, ratings):
    vectors = spark.createDataFrame([(10, [1.0, 0.0]), (20, [0.0, 1.0]), (30, [1.0, 1.0])], f"{C.ITEM} long, features array<double>")
    wished = spark.createDataFrame([(10,), (10,), (10,), (20,)], f"{C.ITEM} long")
    (row,) = surprise.surprise_scores(vectors, wished, wished, ratings).collect()
    assert row.group_score == pytest.approx((0.75 + 0.25) / (np.sqrt(2) * np.hypot(0.75, 0.25)) / np.log1p(3))


def test_test_sets_keep_their_order(spark, ratings):
    keys = spark.createDataFrame([(0, 3, 50), (1, 1, 40), (2, 3, 50), (3, 2, 30)], f"at long, {C.USER} long, {C.ITEM} long")
    rows = recommend.predict_test_set(baselines.predict_bias, ratings, keys, position="at").collect()
    assert [(r["at"], r.userId, r.movieId) for r in rows] == [(0, 3, 50), (1, 1, 40), (2, 3, 50), (3, 2, 30)]
    assert rows[0].rating == rows[2].rating and all(r.rating is not None for r in rows)


def test_a_cluster_needs_a_shared_folder():
    class Session:
        class conf:
            @staticmethod
            def get(name, default):
                return default

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_dir(Session)


# queries do the operators' whole job


class Called(Exception):
    pass


@pytest.mark.parametrize(("name", "module", "operator"), [
    ("latent_factor", latent, "latent_factor"), ("hybrid_with_latent_factor", latent, "latent_factor"), ("tune_latent_factor", latent, "tune_latent_factor"),
    ("pooled_random_forest", trees, "pooled_random_forest"), ("stacked_meta_model", trees, "stacked_meta_model"), ("cluster_tag_themes", topics, "cluster_tag_themes"),
    ("feat_V4", topics, "lda_topics"), ("full_top_n", jobs, "full_top_n"), ("train_all", jobs, "train_all"),
])
def test_learned_models_are_registered_with_their_defaults(spark, monkeypatch, name, module, operator):
    def called(*args, **given):
        raise Called(given)

    monkeypatch.setattr(module, operator, called)
    with pytest.raises(Called) as e:
        queries_recommend.query.__globals__["QUERIES"][name](spark, "/root/testdata/sf0.001")
    assert not {"rank", "max_iter", "trials", "trees", "k", "topics", "passes", "latent"} & set(e.value.args[0])


def test_tiers_are_registered_with_their_defaults(monkeypatch):
    fits = []
    monkeypatch.setattr(queries_recommend.linear, "training_rows", lambda *_: None)
    monkeypatch.setattr(queries_recommend.linear, "content_predict", lambda models, *_: models)
    monkeypatch.setattr(queries_recommend, "v1_arrays", lambda t: None)
    monkeypatch.setattr(queries_recommend, "keys", lambda t: None)

    def seen(frame, event, arg):
        if event == "call" and frame.f_code.co_name in ("user_elasticnet_tiered", "user_linear_svr_tiered"):
            fits.append(frame.f_locals["tiers"])

    for name in ("user_elasticnet_tiered", "user_linear_svr_tiered"):
        run = queries_recommend.query.__globals__["QUERIES"][name]
        monkeypatch.setattr(queries_recommend.query.__globals__["Tables"], "train", lambda self: None)
        sys.setprofile(seen)
        try:
            run(None, "/nowhere")
        except Exception:  # noqa: BLE001, S110 - there are no rows to fit
            pass
        finally:
            sys.setprofile(None)
    assert fits == [(200, 700, 1300), (200, 700)]
