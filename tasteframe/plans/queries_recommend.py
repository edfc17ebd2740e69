"""Queries: linear content models, explanations, recommendations, learned models and jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.functions import scalars as S
from tasteframe.operators import baselines as B
from tasteframe.operators import features as FT
from tasteframe.operators import blocks, filters, latent, linear, ranking, scoring, stats, topics, trees
from tasteframe.operators import neighbours as N
from tasteframe.operators import recommend as RC
from tasteframe.operators import surprise
from tasteframe.plans import jobs
from tasteframe.plans.queries_basic import GROUP
from tasteframe.plans.queries_eval import keys
from tasteframe.plans.queries_features import dense_sql, v1_block, v3_block, v5_arrays
from tasteframe.plans.queries_models import CLIP, COS, PEARSON, itr_knn_sql, knn_sql, sims_of, v1_arrays
from tasteframe.plans.registry import dec, query, relation, snap
from tasteframe.scratch import fresh_path, materialise
from tasteframe.sources.sinks import union_ratings
from tasteframe.sources.tables import clean_library

R = S.fixed_round
#: Ridge penalty of the content model on V3.
C_ALPHA = 1.0

# --- per-user linear models -----------------------------------------------------------------------

relation("x1", "SELECT movieId AS mid, value AS x FROM v1 WHERE feature = 'year'")
relation("sums1", """
    SELECT userId, count(*) AS n, avg(x) AS mx, avg(rating) AS my, sum(x * x) - count(*) * avg(x) * avg(x) AS sxx,
           sum(x * rating) - count(*) * avg(x) * avg(rating) AS sxy FROM train JOIN x1 ON movieId = mid GROUP BY userId""")
relation("x2", """
    SELECT i.movieId AS mid, coalesce(a.value, 0) AS xa, b.value AS xb FROM items i
    LEFT JOIN v1 a ON a.movieId = i.movieId AND a.feature = 'ECONOMY' LEFT JOIN v1 b ON b.movieId = i.movieId AND b.feature = 'year'""")


def sums2_sql(rows: str) -> str:
    return f"""
        SELECT userId, ma, mb, my, ((gbb + 24) * ca - gab * cb) / ((gaa + 24) * (gbb + 24) - gab * gab) AS wa,
               ((gaa + 24) * cb - gab * ca) / ((gaa + 24) * (gbb + 24) - gab * gab) AS wb FROM (
          SELECT userId, avg(xa) AS ma, avg(xb) AS mb, avg(rating) AS my,
                 sum(xa * xa) - count(*) * avg(xa) * avg(xa) AS gaa, sum(xb * xb) - count(*) * avg(xb) * avg(xb) AS gbb,
                 sum(xa * xb) - count(*) * avg(xa) * avg(xb) AS gab, sum(xa * rating) - count(*) * avg(xa) * avg(rating) AS ca,
                 sum(xb * rating) - count(*) * avg(xb) * avg(rating) AS cb FROM {rows} JOIN x2 ON movieId = mid GROUP BY userId) s"""


relation("ridge2", sums2_sql("train"))


def some_features(t, *names):
    """Scaled V1 columns by name, as arrays, with their positions."""
    block = v1_block(t).where(F.col("feature").isin(list(names)))
    return FT.assemble(block, t.items())


def flat(models, *names):
    return models.select(C.USER, R("intercept", 6).alias("intercept"), *[R(F.col("coef")[i], 6).alias(n) for i, n in enumerate(names)])


def one_feature(name, fit, slope):
    sql = f"SELECT userId, {dec(f'my - mx * ({slope})', 6)} AS intercept, {dec(slope, 6)} AS w FROM sums1"

    @query(name, sql)
    def _(t):
        x, _names = some_features(t, "year")
        return flat(fit(linear.training_rows(t.train(), x)), "w")


one_feature("user_linear", linear.user_linear, "CASE WHEN sxx > 1e-9 THEN sxy / sxx ELSE 0 END")
one_feature("user_lasso", lambda rows: linear.user_lasso(rows, alpha=0.1),
            "CASE WHEN sxx > 1e-9 THEN sign(sxy) * greatest(abs(sxy) - 0.1 * n, 0) / sxx ELSE 0 END")
one_feature("user_elasticnet", lambda rows: linear.user_elasticnet(rows, alpha=0.01, l1_ratio=0.2),
            "sign(sxy) * greatest(abs(sxy) - n * 0.002, 0) / (sxx + n * 0.008)")
one_feature("user_elasticnet_strong", linear.user_elasticnet, "sign(sxy) * greatest(abs(sxy) - n * 5.0, 0) / (sxx + n * 5.0)")
one_feature("user_ridge_one_feature", lambda rows: linear.user_ridge(rows, alpha=10.0), "sxy / (sxx + 10)")


def ridge2(t, ratings=None, **kw):
    x, names = some_features(t, "ECONOMY", "year")
    return linear.user_ridge(linear.training_rows(t.train() if ratings is None else ratings, x), alpha=24.0, **kw), x, names


_RIDGE2 = f"SELECT userId, {dec('my - ma * wa - mb * wb', 6)} AS intercept, {dec('wa', 6)} AS w_genre, {dec('wb', 6)} AS w_year FROM ridge2"


@query("user_ridge", _RIDGE2)
def _(t):
    return flat(ridge2(t)[0], "w_genre", "w_year")


@query("user_ridge_chunks", _RIDGE2)
def _(t):
    """Every user with more than 20 ratings takes the chunked path."""
    return flat(ridge2(t, limit=20)[0], "w_genre", "w_year")


@query("content_predict", f"""
    SELECT t.userId, t.movieId, {dec(CLIP.format('my - ma * wa - mb * wb + wa * xa + wb * xb'), 6)} AS est, false AS was_impossible
    FROM test t JOIN ridge2 r ON t.userId = r.userId JOIN x2 ON t.movieId = mid""")
def _(t):
    models, x, _names = ridge2(t)
    return linear.content_predict(models, keys(t), x, t.train()).withColumn("est", R("est", 6))


@query("coef_importance", " UNION ALL ".join(
    f"SELECT '{n}' AS feature, {dec(f'avg(abs({w}))', 6)} AS mean_abs_coef, {dec(f'avg({w})', 6)} AS mean_coef, {dec(f'stddev_samp({w})', 6)} AS std_coef, "
    f"{dec(f'stddev_samp({w}) / (avg(abs({w})) + 1e-8)', 6)} AS cv_coef FROM ridge2" for n, w in (("ECONOMY", "wa"), ("year", "wb"))))
def _(t):
    models, _x, names = ridge2(t)
    out = linear.coef_importance(models, names)
    return out.select("feature", *[R(c, 6).alias(c) for c in out.columns[1:]])


relation("importances", """
    SELECT *, row_number() OVER (PARTITION BY userId ORDER BY importance DESC, feature) AS rank FROM (
      SELECT userId, 'ECONOMY' AS feature, abs(wa) / (abs(wa) + abs(wb)) AS importance FROM ridge2 WHERE abs(wa) + abs(wb) > 0
      UNION ALL SELECT userId, 'year', abs(wb) / (abs(wa) + abs(wb)) FROM ridge2 WHERE abs(wa) + abs(wb) > 0) x""")


@query("feature_importances", f"SELECT userId, feature, {dec('importance', 6)} AS importance, rank FROM importances")
def _(t):
    models, _x, names = ridge2(t)
    return linear.feature_importances(models, names).withColumn("importance", R("importance", 6))


@query("explain", """
    SELECT t.userId, t.movieId, CASE
        WHEN r.userId IS NULL THEN concat('''', title, ''' is recommended based on your content profile. Genres: ', genres, '.')
        WHEN words IS NULL OR words = '' THEN concat('''', title, ''' matches your content profile. Genres: ', genres, '.')
        ELSE concat('''', title, ''' is recommended because your profile values ', words, '. Genres: ', genres, '.') END AS explanation
    FROM test t JOIN items i ON t.movieId = i.movieId LEFT JOIN ridge2 r ON r.userId = t.userId
    LEFT JOIN (SELECT t.userId, t.movieId, string_agg(label, ', ' ORDER BY rank) AS words FROM (
        SELECT t.userId, t.movieId, m.rank, CASE WHEN feature = 'year' THEN 'release year' WHEN list_contains(string_split(genres, '|'), feature) THEN feature END AS label
        FROM test t JOIN items i ON t.movieId = i.movieId JOIN importances m ON m.userId = t.userId) t WHERE label IS NOT NULL GROUP BY t.userId, t.movieId) w
    ON w.userId = t.userId AND w.movieId = t.movieId""")
def _(t):
    models, _x, names = ridge2(t)
    return linear.explain(models, names, t.items(), keys(t))


@query("explain_without_model", """
    SELECT userId, t.movieId, concat('''', title, ''' matches your taste profile. Genres: ', genres, '.') AS explanation
    FROM test t JOIN items i ON t.movieId = i.movieId""")
def _(t):
    return linear.explain_without_model(t.items(), keys(t))


relation("explained", """
    SELECT userId, feature, CASE WHEN max(m) OVER (PARTITION BY userId) > min(m) OVER (PARTITION BY userId)
        THEN (m - min(m) OVER (PARTITION BY userId)) / (max(m) OVER (PARTITION BY userId) - min(m) OVER (PARTITION BY userId)) ELSE m END AS score FROM (
      SELECT u.userId, s.feature, coalesce(sum(w.w * v.value), 0) / max(u.total) AS m FROM
        (SELECT userId, sum(rating - lo + 1e-8) AS total FROM (SELECT *, min(rating) OVER (PARTITION BY userId) AS lo FROM train) a GROUP BY userId) u
        JOIN v1_space s ON true
        JOIN (SELECT userId, movieId, rating - lo + 1e-8 AS w FROM (SELECT *, min(rating) OVER (PARTITION BY userId) AS lo FROM train) b) w ON w.userId = u.userId
        LEFT JOIN v1 v ON v.movieId = w.movieId AND v.feature = s.feature GROUP BY u.userId, s.feature) c""")


def explained(t):
    x, names = FT.assemble(v1_block(t), t.items())
    return linear.user_explanation(linear.training_rows(t.train(), x)), names


@query("user_explanation", f"SELECT userId, feature, {dec('score', 6)} AS score FROM explained")
def _(t):
    scores, names = explained(t)
    return linear.explanation_rows(scores, names).withColumn("score", R("score", 6))


@query("explanation_topk", f"""
    SELECT userId, feature, {dec('s', 6)} AS score, rank FROM (SELECT userId, feature, s, row_number() OVER (PARTITION BY userId ORDER BY s DESC, feature) AS rank
      FROM (SELECT userId, feature, floor(score * 1e9 + 0.5) / 1e9 AS s FROM explained) y) x WHERE rank <= 20""")
def _(t):
    scores, names = explained(t)
    snapped = scores.withColumn("scores", F.transform("scores", lambda x: S.snap(x)))
    return linear.explanation_topk(snapped, names).select(C.USER, "feature", R("score", 6).alias("score"), "rank")


def predictions_of(fit):
    def run(t):
        x = v1_arrays(t)
        models = fit(linear.training_rows(t.train(), x))
        return linear.content_predict(models, keys(t), x, t.train())

    return run


def ridge_v3(t, ratings=None):
    """(models, feature arrays, names): ridge models on all of V3, the content model of the hybrid."""
    x, names = FT.assemble(v3_block(t), t.items())
    x = materialise(x, "v3")
    rows = linear.training_rows(t.train() if ratings is None else ratings, x)
    return materialise(linear.user_ridge(rows, alpha=C_ALPHA), "ridge-v3"), x, names


@query("user_ridge_v3")
def _(t):
    return ridge_v3(t)[0]


@query("content_predict_v3")
def _(t):
    models, x, _names = ridge_v3(t)
    return linear.content_predict(models, keys(t), x, t.train())


@query("coef_importance_v3")
def _(t):
    models, _x, names = ridge_v3(t)
    return linear.coef_importance(models, names)


@query("feature_importances_v3")
def _(t):
    models, _x, names = ridge_v3(t)
    return linear.feature_importances(models, names)


@query("explain_v3")
def _(t):
    """Words, tags, genres, years, and the families of the other features."""
    models, _x, names = ridge_v3(t)
    return linear.explain(models, names, t.items(), keys(t))


@query("recommend_new_user_v3")
def _(t):
    cols = [C.USER, C.ITEM, C.RATING]
    both = union_ratings(t.train().select(*cols), stats.implicit_ratings(clean_library(t.library())).select(*cols))
    models, x, _names = ridge_v3(t, both)
    return RC.recommend_new_user(models, x, both, t.items(), named(t))


@query("ratings_with_features_v3")
def _(t):
    from tasteframe.operators.catalogue import ratings_with_features

    return ratings_with_features(t.train(), FT.assemble(v3_block(t), t.items())[0])


for _name, _fit in (("user_linear", linear.user_linear), ("user_lasso", linear.user_lasso), ("user_elasticnet", linear.user_elasticnet), ("user_ridge", linear.user_ridge)):
    query(f"{_name}_all_features")(predictions_of(_fit))
query("user_elasticnet_tiered")(predictions_of(linear.user_elasticnet_tiered))
query("user_linear_svr")(predictions_of(linear.user_linear_svr))
query("user_linear_svr_tiered")(predictions_of(linear.user_linear_svr_tiered))


@query("ratings_with_features", f"SELECT userId, movieId, rating, {dec('xa', 6)} AS xa, {dec('xb', 6)} AS xb FROM train LEFT JOIN x2 ON movieId = mid")
def _(t):
    from tasteframe.operators.catalogue import ratings_with_features

    x, _names = some_features(t, "ECONOMY", "year")
    f = F.col("features")
    return ratings_with_features(t.train(), x).select(C.USER, C.ITEM, C.RATING, R(f[0], 6).alias("xa"), R(f[1], 6).alias("xb"))


# --- learned models ---------------------------------------------------------------------------------

@query("latent_factor")
def _(t):
    return latent.latent_factor(t.train()).predict(keys(t))


@query("hybrid_with_latent_factor")
def _(t):
    from tasteframe.operators.hybrid import hybrid_blend

    train = t.train()
    return hybrid_blend(train, keys(t), {
        "svd": latent.latent_factor(train).predict(keys(t)),
        "content": linear.content_predict(linear.user_ridge(linear.training_rows(train, v1_arrays(t))), keys(t), v1_arrays(t), train),
        "itr": N.user_knn_itr(train, keys(t), **C.ITR_PARAMS),
    })


@query("tune_latent_factor")
def _(t):
    return latent.tune_latent_factor(t.ratings())


@query("pooled_random_forest")
def _(t):
    return trees.pooled_random_forest(t.train(), keys(t), v1_arrays(t), select_k=20)


@query("select_k_best", f"""
    SELECT feature, {dec('f', 4)} AS f_score FROM (
      SELECT feature, CASE WHEN r IS NULL OR isnan(r) THEN 0 ELSE r * r / (1 - r * r) * (n - 2) END AS f FROM (
        SELECT feature, corr(x, rating) AS r, count(*) AS n FROM (
          SELECT s.feature, coalesce(v.value, 0) AS x, t.rating FROM train t JOIN v1_space s ON true LEFT JOIN v1 v ON v.movieId = t.movieId AND v.feature = s.feature) a
        GROUP BY feature) b) c ORDER BY f DESC, feature LIMIT 20""")
def _(t):
    x, names = FT.assemble(v1_block(t), t.items())
    return trees.select_k_best(t.train(), x, names, 20).withColumn("f_score", R("f_score", 4))


@query("stacked_meta_model")
def _(t):
    return trees.stacked_meta_model(t.train(), keys(t), v1_arrays(t))


@query("cluster_tag_themes")
def _(t):
    return topics.cluster_tag_themes(t.tag_vectors())


@query("feat_V4")
def _(t):
    """V3 with topics of the texts and metadata numbers, scaled again."""
    found = topics.lda_topics(t.metadata(), t.items())
    extra = FT.vector_block(found, t.items(), "topics", "lda_topic_")
    return FT.min_max_scale(FT.extend_with(v3_block(t), t.items(), extra, t.metadata()), t.items())


# --- recommendations ----------------------------------------------------------------------------------

relation("rec_targets", """
    SELECT u.userId, i.movieId FROM (SELECT unnest([1, 2, 3]) AS userId) u JOIN items i ON true
    WHERE NOT EXISTS (SELECT 1 FROM train r WHERE r.userId = u.userId AND r.movieId = i.movieId)""")
relation("mentioned", "SELECT DISTINCT event_id % 200 AS mid FROM events WHERE user_id IN (1, 2, 3) AND event_type IN ('purchase', 'click')")
relation("group_targets", """
    SELECT u.userId, i.movieId FROM (SELECT unnest([1, 2, 3]) AS userId) u JOIN (SELECT DISTINCT movieId FROM train) i ON true
    WHERE i.movieId NOT IN (SELECT mid FROM mentioned)""")


def two_model_sql(targets: str) -> str:
    svd = CLIP.format("g + coalesce(bu, 0) + coalesce(bi, 0)")
    return f"""
        SELECT t.userId, t.movieId, {svd} AS svd, i.est AS itr, 0.6 * {svd} + 0.4 * i.est AS final
        FROM {targets} t LEFT JOIN bias_i ON t.movieId = mid LEFT JOIN bias_u ON t.userId = uid
        JOIN ({itr_knn_sql(targets, 60, 5, rounded=False)}) i ON i.userId = t.userId AND i.movieId = t.movieId, train_gm"""


def two_models():
    return {"svd": B.predict_bias, "itr": lambda train, want: N.user_knn_itr(train, want, **C.ITR_PARAMS)}


relation("rec_scores", two_model_sql("rec_targets"))
relation("group_scores", two_model_sql("group_targets"))
relation("recommended", f"""
    SELECT userId, rank, x.movieId, title, genres, final_score, svd_score, itr_score, CAST(0 AS DOUBLE) AS content_score FROM (
      SELECT *, row_number() OVER (PARTITION BY userId ORDER BY final_score DESC, movieId) AS rank FROM (
        SELECT userId, movieId, {dec('final', 3)} AS final_score, {dec('svd', 3)} AS svd_score, {dec('itr', 3)} AS itr_score FROM rec_scores) s) x
    JOIN items i ON i.movieId = x.movieId WHERE rank <= 10""")


def recommended(t):
    return RC.recommend(t.train(), t.items(), GROUP, two_models())


@query("recommend", "SELECT * FROM recommended")
def _(t):
    return recommended(t)


@query("recommendation_table", f"""
    SELECT userId, rank, r.movieId, r.title, r.genres, {dec('final_score', 2)} AS final_score, {dec('svd_score', 2)} AS svd_score, {dec('itr_score', 2)} AS itr_score,
      concat('''', r.title, ''' matches your taste profile. Genres: ', r.genres, '.') AS explanation,
      coalesce(poster_url, '') AS poster_url, coalesce(overview, '') AS overview, coalesce(CAST(runtime AS VARCHAR), '') AS runtime, coalesce(CAST(vote_average AS VARCHAR), '') AS vote_average
    FROM recommended r LEFT JOIN metadata m ON m.movieId = r.movieId""")
def _(t):
    return RC.recommendation_table(recommended(t), t.metadata(), t.items())


def group_sql(merge: str) -> str:
    return f"""
        SELECT x.movieId, title, genres, group_score, n_users FROM (
          SELECT movieId, {dec(f'{merge}(final)', 4)} AS group_score, count(*) AS n_users FROM group_scores GROUP BY movieId) x
        JOIN items i ON i.movieId = x.movieId ORDER BY group_score DESC, x.movieId LIMIT 8"""


def group_query(name, strategy, merge):
    @query(name, group_sql(merge))
    def _(t):
        return RC.recommend_group(t.train(), t.items(), t.participants(GROUP), two_models(), strategy=strategy)


group_query("recommend_group", "average", "avg")
group_query("recommend_group_least_misery", "least_misery", "min")


@query("group_recommendation_table", f"""
    SELECT g.movieId, g.title, g.genres, {dec('group_score', 2)} AS group_score, n_users, coalesce(poster_url, '') AS poster_url,
      coalesce(overview, '') AS overview, coalesce(CAST(vote_average AS VARCHAR), '') AS vote_average
    FROM ({group_sql('avg')}) g LEFT JOIN metadata m ON m.movieId = g.movieId""")
def _(t):
    recs = RC.recommend_group(t.train(), t.items(), t.participants(GROUP), two_models())
    return RC.group_recommendation_table(recs, t.metadata())


@query("group_candidates", "SELECT * FROM group_targets")
def _(t):
    return RC.group_candidates(t.train(), t.participants(GROUP))


# The items a new user names: those tagged by event user 4.
relation("named", "SELECT DISTINCT movieId AS mid FROM tags WHERE userId = 4")


def named(t):
    return t.tags().where(F.col(C.USER) == 4).select(C.ITEM).distinct()


relation("profile_ratings", """
    SELECT CAST(-1 AS BIGINT) AS userId, movieId,
      CAST(round(CAST(greatest(0.5, least(5.0, 0.5 + 0.8 * least(n_watched, 5) + 0.9 * wishlist + 0.5 * recent + 1.5 * top10)) AS DECIMAL(18,6)), 2) AS DOUBLE) AS rating
    FROM library WHERE n_watched > 0 OR wishlist = 1 OR recent = 1 OR top10 = 1""")
relation("profile_ridge", sums2_sql("profile_ratings"))


@query("recommend_new_user", f"""
    SELECT CAST(-1 AS BIGINT) AS userId, rank, x.movieId, title, genres, s AS final_score, CAST(0 AS DOUBLE) AS svd_score, CAST(0 AS DOUBLE) AS itr_score, s AS content_score FROM (
      SELECT movieId, s, row_number() OVER (ORDER BY s DESC, movieId) AS rank FROM (
        SELECT i.movieId, {dec(CLIP.format('my - ma * wa - mb * wb + wa * xa + wb * xb'), 3)} AS s FROM items i JOIN x2 ON i.movieId = mid, profile_ridge
        WHERE i.movieId NOT IN (SELECT mid FROM named)) y) x JOIN items i ON i.movieId = x.movieId WHERE rank <= 10""")
def _(t):
    cols = [C.USER, C.ITEM, C.RATING]
    both = union_ratings(t.train().select(*cols), stats.implicit_ratings(clean_library(t.library())).select(*cols))
    models, x, _names = ridge2(t, both)
    return RC.recommend_new_user(models, x, both, t.items(), named(t))


@query("popular_fallback", f"""
    SELECT p.movieId, title, genres, {dec('m', 3)} AS final_score, 0 AS svd_score, 0 AS itr_score, 0 AS content_score FROM (
      SELECT movieId, m FROM istats WHERE movieId NOT IN (SELECT mid FROM named) ORDER BY m DESC, movieId LIMIT 10) p LEFT JOIN items i ON p.movieId = i.movieId""")
def _(t):
    return RC.popular_fallback(t.ratings(), t.items(), named(t))


@query("popular_unseen", f"SELECT movieId, {dec('m', 6)} AS score FROM istats WHERE movieId NOT IN (SELECT mid FROM named) ORDER BY m DESC, movieId LIMIT 50")
def _(t):
    return RC.popular_unseen(t.ratings(), named(t), 50).withColumn("score", R("score", 6))


relation("v5_dense", dense_sql("v5_raw"))
relation("wish_centre", """
    SELECT feature, avg(value) AS c FROM v5_dense JOIN (
      SELECT DISTINCT user_id, event_id % 200 AS wish FROM events WHERE user_id IN (1, 2, 3) AND event_type = 'click') w ON movieId = wish GROUP BY feature""")
relation("surprise", """
    SELECT v.movieId, v.cos / ln(1 + coalesce(s.n, 1)) AS score FROM (
      SELECT movieId, sum(value * c) / (sqrt(sum(value * value)) * sqrt(sum(c * c))) AS cos FROM v5_dense d JOIN wish_centre w ON d.feature = w.feature GROUP BY movieId) v
    LEFT JOIN istats s ON s.movieId = v.movieId WHERE v.movieId NOT IN (SELECT mid FROM mentioned)""")


def vectors(t):
    return v5_arrays(t)[0]


@query("surprise_scores", f"SELECT movieId, {dec('score', 6)} AS group_score FROM surprise")
def _(t):
    p = t.participants(GROUP)
    wished = p.select(F.explode(F.transform("wishlist", lambda x: x["id"])).alias(C.ITEM))
    out = surprise.surprise_scores(vectors(t), wished, filters.mentioned_items(p), t.ratings())
    return out.withColumn("group_score", R("group_score", 6))


@query("recommend_group_surprise", f"""
    SELECT s.movieId, title, genres, {dec('score', 6)} AS group_score, 3 AS n_users FROM (
      SELECT * FROM (SELECT * FROM surprise ORDER BY score DESC, movieId LIMIT 50) b ORDER BY CAST('0x' || substr(md5(concat(movieId, ' 0')), 1, 15) AS BIGINT), movieId LIMIT 8) s
    JOIN items i ON i.movieId = s.movieId""")
def _(t):
    return RC.recommend_group_surprise(vectors(t), t.items(), t.ratings(), t.participants(GROUP))


relation("all_targets", "SELECT u.userId, i.movieId FROM (SELECT DISTINCT userId FROM train) u JOIN items i ON true WHERE NOT EXISTS (SELECT 1 FROM train r WHERE r.userId = u.userId AND r.movieId = i.movieId)")
relation("all_scores", two_model_sql("all_targets"))


@query("recommend_all", f"""
    SELECT userId, rank, x.movieId, title, genres, final_score, svd_score, itr_score, CAST(0 AS DOUBLE) AS content_score FROM (
      SELECT *, row_number() OVER (PARTITION BY userId ORDER BY final_score DESC, movieId) AS rank FROM (
        SELECT userId, movieId, {dec('final', 3)} AS final_score, {dec('svd', 3)} AS svd_score, {dec('itr', 3)} AS itr_score FROM all_scores) s) x
    JOIN items i ON i.movieId = x.movieId WHERE rank <= 10""")
def _(t):
    """``recommend`` for every user, by a threshold search."""
    return RC.recommend_all(t.train(), t.items(), two_models(), {"svd": blocks.bias_source})


@query("recommend_all_content")
def _(t):
    """With the weights of three models: ridge models on V3 in the content slot."""
    x = FT.assemble(v3_block(t), t.items())[0]
    train = t.train()
    models = linear.user_ridge(linear.training_rows(train, x), alpha=C_ALPHA)
    models, x = materialise(models, "ridge-v3"), materialise(x, "v3")
    content = lambda some, want: linear.content_predict(models, want, x, some)
    source = lambda some, users, items, weight: blocks.content_source(models, x, some, weight)
    return RC.recommend_all(train, t.items(), two_models() | {"content": content}, {"svd": blocks.bias_source, "content": source})


@query("surprise_me_all")
def _(t):
    """``surprise_me`` for every user."""
    x = materialise(vectors(t), "v5")
    models = materialise(linear.user_ridge(linear.training_rows(t.train(), x), alpha=25.0), "ridge-v5")
    return RC.surprise_me_all(models, x, t.train(), t.items())


@query("surprise_me")
def _(t):
    """Ridge models on V5."""
    x = vectors(t)
    models = linear.user_ridge(linear.training_rows(t.train(), x), alpha=25.0)
    return RC.surprise_me(models, x, t.train(), t.items(), GROUP)


@query("top_n_unseen", f"""
    SELECT userId, movieId, {dec('est', 6)} AS est, rank FROM (
      SELECT userId, movieId, est, row_number() OVER (PARTITION BY userId ORDER BY est DESC, movieId) AS rank FROM (
        SELECT uid AS userId, mid AS movieId, floor({CLIP.format('g + bu + bi')} * 1e9 + 0.5) / 1e9 AS est FROM bias_u JOIN bias_i ON true, train_gm
        WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.userId = uid AND t.movieId = mid)) x) y WHERE rank <= 10""")
def _(t):
    train = materialise(t.train().select(C.USER, C.ITEM, C.RATING), "train")
    items, users = (materialise(b, "biases") for b in B.bias_model(train))
    gm = stats.global_mean_value(train)
    u = users.select(C.USER, F.array(gm + F.col("b_u"), F.lit(1.0)).alias("vec"))
    i = items.select(C.ITEM, F.array(F.lit(1.0), F.col("b_i")).alias("vec"))
    out = scoring.top_n_unseen(u, i, train)
    return out.withColumn("est", R("est", 6))


@query("full_top_n")
def _(t):
    return jobs.full_top_n(t.train())


# --- jobs ------------------------------------------------------------------------------------------------

def grid_sql() -> str:
    """Every setting of the neighbourhood families by the twin of its own model."""
    exprs = {"user_cosine": (COS, "user"), "user_pearson": (snap(PEARSON), "user"), "item_cosine": (COS, "item")}
    parts = []
    for family, sets in jobs.config_grid().items():
        for setting in sets if family in jobs.GRID_FAMILIES else []:
            full = {"min_k": 1, "min_support": 1} | setting
            if family == "user_itr":
                model = itr_knn_sql("test", full["k"], full["min_k"])
            else:
                expr, axis = exprs[family]
                model = knn_sql(sims_of(expr, full["min_support"], axis), axis=axis, k=full["k"], min_k=full["min_k"])
            parts.append(f"""SELECT '{jobs.setting_name(family, setting)}' AS model, count(*) AS n, count(CASE WHEN was_impossible THEN 1 END) AS impossible,
                {dec('sqrt(avg((q.rating - p.est) * (q.rating - p.est)))', 4)} AS rmse
                FROM ({model}) p JOIN (SELECT userId AS tu, movieId AS tm, rating FROM test) q ON p.userId = q.tu AND p.movieId = q.tm""")
    return " UNION ALL ".join(parts)


@query("config_grid", grid_sql())
def _(t):
    """The whole grid of the neighbourhood families, one search for each."""
    return jobs.grid_report(t.train(), t.test())


@query("train_all")
def _(t):
    paths = jobs.train_all(t.train(), v1_arrays(t), fresh_path(t.spark, "models"))
    out = None
    for name, path in paths.items():
        row = t.spark.read.parquet(path).agg(F.count("*").alias("n_rows")).withColumn("model", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


@query("top50_then_sample", f"""
    SELECT movieId, {dec('m', 6)} AS score FROM (SELECT movieId, m FROM istats ORDER BY m DESC, movieId LIMIT 50) b
    ORDER BY CAST('0x' || substr(md5(concat(movieId, ' 5')), 1, 15) AS BIGINT), movieId LIMIT 8""")
def _(t):
    s = stats.item_stats(t.ratings()).select(C.ITEM, F.col("rating_mean").alias("score"))
    return ranking.top50_then_sample(s, 8, score="score", seed=5).withColumn("score", R("score", 6))


@query("recs_topn", f"SELECT movieId, {dec('weighted_score', 6)} AS final_score FROM scored ORDER BY weighted_score DESC, movieId LIMIT 25")
def _(t):
    s = stats.scored_items(t.ratings(), t.items()).select(C.ITEM, F.col("weighted_score").alias("final_score"))
    return ranking.recs_topn(s, 25).withColumn("final_score", R("final_score", 6))


@query("predict_test_set", f"SELECT pos, t.userId, t.movieId, {dec('est', 6)} AS rating FROM (SELECT userId, movieId, row_number() OVER (ORDER BY movieId, userId) AS pos FROM test) t JOIN bias_pred b ON t.userId = b.userId AND t.movieId = b.movieId")
def _(t):
    """Hidden keys scored in their own order, kept as a position column."""
    positions = ranking.global_rank(keys(t), C.ITEM, C.USER, name="pos")
    out = RC.predict_test_set(B.predict_bias, t.train(), positions, position="pos")
    return out.withColumn(C.RATING, R(C.RATING, 6))


