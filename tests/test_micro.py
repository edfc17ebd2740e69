"""Hand-computed values on a small table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.functions import scalars as S
from tasteframe.functions import vectors as V
from tasteframe.operators import baselines, catalogue, evaluate, features, filters, linear, neighbours, ranking, similarity, stats, text


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_item_statistics(ratings, items):
    got = by(stats.item_stats_full(ratings, items), C.ITEM)
    want = {10: (3, 3.333333, 2.081666, 3.343195), 20: (3, 3.166667, 1.258306, 3.304734), 40: (3, 4.0, 1.0, 3.497041), 50: (1, 2.0, 0.0, 3.223776)}
    for i, (n, m, s, b) in want.items():
        r = got[i]
        assert r.movie_n_ratings == n
        assert (r.movie_mean_rating, r.movie_std_rating, r.movie_bayesian_mean) == pytest.approx((m, s, b), abs=1e-6)
    assert got[60].movie_n_ratings == 0 and got[60].movie_mean_rating == pytest.approx(3.346154, abs=1e-6)
    assert got[60].movie_inverse_popularity == 1.0


def test_featured_order_breaks_ties_by_id(ratings, items):
    rows = stats.featured_items(ratings, items).collect()
    assert [r.movieId for r in rows] == [40, 10, 30, 20, 50]
    assert rows[0].weighted_score == pytest.approx(3.383164, abs=1e-6)


@pytest.mark.parametrize("fn,want", [
    (similarity.sim_msd, [0.5, 0.090909, 0.470588, 0.166667, 0.163265, 0.285714]),
    (similarity.sim_jaccard, [0.5, 0.5, 0.4, 0.5, 0.4, 0.4]),
    (similarity.sim_cosine, [0.997054, 0.907959, 0.979937, 0.909065, 0.824042, 0.894427]),
    (similarity.sim_pearson, [1.0, -1.0, -1.0, 1.0, -1.0, -1.0]),
    (similarity.sim_itr, [0.243274, 0.139134, 0.262518, 0.312119, 0.241714, 0.223915]),
])
def test_similarities(ratings, fn, want):
    got = by(fn(ratings, ordered=True), "u", "v")
    pairs = [(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4)]
    assert [got[p].sim for p in pairs] == pytest.approx(want, abs=1e-6)
    assert all(got[p].support == 2 for p in pairs)


@pytest.mark.parametrize("sim,want", [
    ("msd", [(4.505051, 2), (4.0, 1), (2.429825, 2)]), ("jaccard", [(5.5, 2), (4.0, 1), (1.0, 2)]),
    ("cosine", [(4.486562, 2), (4.0, 1), (0.999797, 2)]), ("pearson", [(4.0, 1), (4.0, 0), (2.333333, 1)]),
    ("itr", [(4.446668, 2), (4.0, 1), (1.832817, 2)]),
])
def test_neighbour_predictions(spark, ratings, sim, want):
    targets = spark.createDataFrame([(1, 40), (1, 50), (3, 20)], f"{C.USER} long, {C.ITEM} long")
    if sim == "itr":
        p = neighbours.user_knn_itr(ratings, targets, k=2, min_k=2, clip=False)
    else:
        p = neighbours.knn_predict(ratings, targets, sim=sim, k=2, min_k=2, clip=False)
    got = by(p, C.USER, C.ITEM)
    for key, (est, k) in zip([(1, 40), (1, 50), (3, 20)], want):
        assert got[key].est == pytest.approx(est, abs=1e-6)
        assert got[key].actual_k == k


def test_unknown_users_and_items_take_the_global_mean(spark, ratings):
    targets = spark.createDataFrame([(99, 10), (1, 99)], f"{C.USER} long, {C.ITEM} long")
    for p in (neighbours.knn_predict(ratings, targets), neighbours.item_knn_basic(ratings, targets)):
        assert all(r.was_impossible and r.est == pytest.approx(3.346154, abs=1e-6) for r in p.collect())
    itr = by(neighbours.user_knn_itr(ratings, targets), C.USER)
    assert itr[99].was_impossible and not itr[1].was_impossible and itr[1].est == 4.0


@pytest.fixture(scope="module")
def predictions(spark):
    rows = [(1, 10, 4.5, 5.0), (1, 20, 4.0, 3.0), (1, 30, 3.5, 4.0), (2, 10, 3.0, 4.0), (2, 20, 3.2, 2.0), (2, 40, 2.5, 5.0)]
    return spark.createDataFrame(rows, f"{C.USER} long, {C.ITEM} long, est double, {C.RATING} double")


def test_metrics(predictions, ratings, items):
    e = evaluate.errors(predictions).first()
    assert (e.rmse, e.mae) == pytest.approx((1.303201, 1.116667), abs=1e-6)
    n = by(evaluate.ndcg_per_user(predictions, k=2), C.USER)
    assert (n[1].ndcg, n[2].ndcg) == pytest.approx((0.613147, 0.386853), abs=1e-6)
    top = ranking.top_n_per_user(predictions, 2)
    assert {(r.userId, r.movieId, r.rank) for r in top.collect()} == {(1, 10, 1), (1, 20, 2), (2, 20, 1), (2, 10, 2)}
    assert evaluate.intra_list_diversity(top, items).first()[0] == pytest.approx(0.666667, abs=1e-6)
    assert evaluate.novelty_log2(top, stats.item_popularity(ratings)).first()[0] == pytest.approx(0.415037, abs=1e-6)
    assert evaluate.fcp(predictions).first()[0] == pytest.approx(1 / 3)
    assert evaluate.fcp(predictions, mode="mean").first()[0] == pytest.approx(0.5)


def test_fcp_with_equal_estimates_counts_them_as_discordant(spark):
    rows = [(1, 1, 3.0, 5.0), (1, 2, 3.0, 2.0), (1, 3, 1.0, 1.0)]
    p = spark.createDataFrame(rows, f"{C.USER} long, {C.ITEM} long, est double, {C.RATING} double")
    assert evaluate.fcp(p).first()[0] == pytest.approx(2 / 3)


def test_implicit_rating(spark):
    rows = [(1, 0, 0, 0, 1.3), (0, 1, 0, 0, 1.4), (1, 0, 0, 1, 2.8), (2, 0, 0, 1, 3.6), (5, 0, 0, 1, 5.0), (20, 1, 1, 1, 5.0)]
    df = spark.createDataFrame(rows, "n int, w int, r int, t int, want double")
    assert all(r.got == r.want for r in df.select(S.implicit_rating("n", "w", "r", "t").alias("got"), "want").collect())


def test_idle_library_rows_are_dropped(spark):
    lib = spark.createDataFrame([(1, "a", "g", None, None, None, None), (2, "b", "g", 1.0, None, None, 1.0)],
                                f"{C.ITEM} long, title string, genres string, n_watched double, wishlist double, recent double, top10 double")
    from tasteframe.sources.tables import clean_library

    rows = stats.implicit_ratings(clean_library(lib)).collect()
    assert [(r.userId, r.movieId, r.rating) for r in rows] == [(-1, 2, 2.8)]
    assert rows[0].timestamp > 1_600_000_000


def test_texts_and_years(items):
    got = by(items.select(C.ITEM, S.extract_year(C.TITLE).alias("y"), S.n_genres(C.GENRES).alias("n"), S.title_length(C.TITLE).alias("l")), C.ITEM)
    assert [got[i].y for i in (10, 30, 50)] == [1994, None, 1908]
    assert [got[i].n for i in (10, 30, 50, 60)] == [2, 1, 0, 0]
    years = by(features.item_years(items), C.ITEM)
    assert years[30].year == 1999.0
    decades = {r.feature for r in features.feat_decade_onehot(items).collect()}
    assert "decade_1900" not in decades and "decade_1990" in decades


def test_genre_words_drop_short_ones(items):
    words = {(r.movieId, r.token) for r in text.tokens_of(items.withColumn("s", S.genres_as_sentence(C.GENRES)), "s").collect()}
    assert {(40, "sci"), (40, "fi"), (50, "no"), (50, "genres"), (50, "listed")} <= words
    rows = [r.tfidf for r in text.genre_tfidf(items).collect() if r.movieId == 40]
    assert sum(x * x for x in rows) == pytest.approx(1.0)


def test_constant_and_negative_features(spark, items):
    block = spark.createDataFrame([(10, "c", 2.0), (20, "c", 2.0), (10, "neg", -1.0), (20, "neg", 3.0)], f"{C.ITEM} long, feature string, value double")
    two = items.where(F.col(C.ITEM).isin(10, 20))
    x, names = features.assemble(block, two)
    assert {r.movieId: list(r.features) for r in x.collect()} == {10: [0.0, 0.0], 20: [0.0, 1.0]}
    x, names = features.assemble(block, items)
    got = {r.movieId: list(r.features) for r in x.collect()}
    assert [r.feature for r in names.orderBy("position").collect()] == ["c", "neg"]
    assert got[30] == [0.0, 0.25] and got[10] == [1.0, 0.0]


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<double>, z array<double>")
    r = df.select(V.cosine(F.col("a"), F.col("a")).alias("one"), V.cosine(F.col("a"), F.col("z")).alias("none"),
                  V.l2_normalise(F.col("z")).alias("z"), V.l2_normalise(F.col("a")).alias("u")).first()
    assert r.one == pytest.approx(1.0) and r.none is None and list(r.z) == [0.0, 0.0] and list(r.u) == pytest.approx([0.6, 0.8])


def test_browse_and_filter(items):
    assert [r.movieId for r in filters.browse_items(items, query=" FOUR ", genres=["Action"], mood="Escape").collect()] == [40]
    assert filters.browse_items(items).count() == 6
    assert {r.movieId for r in filters.browse_items(items, mood="Feel Good").collect()} == {10, 20}
    with pytest.raises(ValueError):
        filters.browse_items(items, mood="Sleepy")
    assert {r.movieId for r in filters.filter_items(items, genre="All", year_min=1994, year_max=1999).collect()} == {10, 20}


def test_validate_columns():
    filters.validate_columns(["a", "b"], ["a", "b"], ordered=True)
    with pytest.raises(ValueError, match="missing columns"):
        filters.validate_columns(["a"], ["a", "b"])
    with pytest.raises(ValueError, match="must start"):
        filters.validate_columns(["b", "a"], ["a", "b"], ordered=True)


def test_user_input(spark):
    raw = spark.createDataFrame([("1", "9"), ("2", "0"), ("x", "3"), ("3", "y"), ("4", "nan"), ("5", "3.5")], "item string, value string")
    assert {(r.movieId, r.rating) for r in filters.clean_user_input_ratings(raw).collect()} == {(1, 5.0), (2, 0.5), (5, 3.5)}


def test_missing_files_give_empty_tables_or_defaults(spark, tmp_path):
    from tasteframe.sources import tables

    assert tables.load_item_metadata(spark, str(tmp_path / "none")).count() == 0
    assert tables.load_registered_users(spark, str(tmp_path / "none")).count() == 0
    p = tables.load_params(spark, str(tmp_path / "none"), {"rank": 35, "max_iter": 10, "reg": 0.0934}).first()
    assert (p["rank"], p.max_iter, p.reg, p.tuned) == (35, 10, 0.0934, False)
    (tmp_path / "users.json").write_text('[{"user_id": 7, "name": "Ann", "ratings": {"10": 4.5, "x": 1}}]')
    users = tables.load_registered_users(spark, str(tmp_path / "users.json"), multi_line=True)
    got = tables.registered_ratings(users).collect()
    assert {(r.userId, r.movieId, r.rating) for r in got} == {(7, 10, 4.5), (7, None, 1.0)}


def test_metadata_payload(spark):
    rows = [(1, 2.0, '{"title": "A", "poster_path": "/a.jpg"}'), (2, None, None), (3, 4.0, '{"title": "B"}')]
    df = spark.createDataFrame(rows, f"{C.ITEM} long, tmdbId double, payload string")
    got = by(catalogue.json_extract_metadata(df), C.ITEM)
    assert got[1].poster_url.endswith("/w500/a.jpg") and got[3].poster_url == "" and got[2].poster_url is None
    assert got[2].tmdb_found == 0 and got[1].tmdb_found is None


def test_explanations(spark, ratings, items):
    x, names = features.assemble(features.block_v1(items), items)
    models = linear.user_ridge(linear.training_rows(ratings, x))
    pairs = spark.createDataFrame([(1, 20), (1, 77), (99, 20)], f"{C.USER} long, {C.ITEM} long")
    got = by(linear.explain(models, names, items, pairs), C.USER, C.ITEM)
    assert got[1, 77].explanation == C.EXPLAIN_UNKNOWN_ITEM
    assert got[99, 20].explanation == "'Two (1999)' is recommended based on your content profile. Genres: Comedy|Drama."
    assert got[1, 20].explanation.startswith("'Two (1999)' is recommended because your profile values ")
    shares = linear.feature_importances(models, names).groupBy(C.USER).agg(F.sum("importance").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) for r in shares)
    scores = linear.explanation_rows(linear.user_explanation(linear.training_rows(ratings, x)), names).collect()
    assert all(0 <= r.score <= 1 for r in scores) and max(r.score for r in scores) == 1.0


def test_random_predictions_repeat_and_stay_on_the_scale(ratings):
    a = baselines.predict_random_uniform(ratings, seed=3).collect()
    assert a == baselines.predict_random_uniform(ratings, seed=3).collect()
    assert all(0.5 <= r.est <= 5 for r in a)
    own = by(baselines.predict_random_sample(ratings, ratings), C.USER, C.ITEM)
    mine = {u: {r.rating for r in ratings.where(F.col(C.USER) == u).collect()} for u in (1, 2, 3, 4)}
    assert all(r.est in mine[u] for (u, _), r in own.items())
