"""Queries: item features, TF-IDF, relevance scores, scaling and feature sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.functions import scalars as S
from tasteframe.functions import vectors as V
from tasteframe.operators import features as FT
from tasteframe.operators import filters, text
from tasteframe.plans.registry import RELATIONS, dec, query, relation
from tasteframe.sources.tables import lower_tags

R = S.fixed_round


def tfidf_sql(tokens: str, n_docs: str, *, min_df: int = 1, max_df: str = "1e18", max_features: int = 10**9) -> str:
    """SQL twin of ``text.tfidf`` over a relation (movieId, token)."""
    return f"""
        SELECT movieId, token, w / sqrt(sum(w * w) OVER (PARTITION BY movieId)) AS tfidf FROM (
          SELECT t.movieId, t.token, t.tf * (ln((1 + {n_docs}) / (1 + CAST(v.df AS DOUBLE))) + 1) AS w FROM
            (SELECT movieId, token, count(*) AS tf FROM {tokens} GROUP BY movieId, token) t
            JOIN (SELECT token, df FROM (SELECT token, count(DISTINCT movieId) AS df, count(*) AS total FROM {tokens} GROUP BY token) d
                  WHERE df >= {min_df} AND df <= {max_df} ORDER BY total DESC, token LIMIT {max_features}) v
            ON t.token = v.token) x"""


N_ITEMS = "(SELECT count(*) FROM part)"
relation("years", r"""
    SELECT movieId, coalesce(CAST(y AS DOUBLE), quantile_cont(CAST(y AS DOUBLE), 0.5) OVER ()) AS year FROM
      (SELECT movieId, TRY_CAST(nullif(regexp_extract(title, '\((\d{4})\)', 1), '') AS INT) AS y FROM items) x""")
relation("genre_tokens", r"""
    SELECT movieId, unnest(regexp_extract_all(lower(replace(genres, '|', ' ')), '\b\w\w+\b')) AS token FROM items""")
relation("genre_weights", tfidf_sql("genre_tokens", N_ITEMS))
relation("tag_tokens", r"""
    SELECT movieId, unnest(regexp_extract_all(tag, '\b\w\w+\b')) AS token FROM lower_tags WHERE movieId IN (SELECT movieId FROM items)""")
relation("tag_weights", tfidf_sql("tag_tokens", N_ITEMS, min_df=2, max_features=150))
relation("wide_tags", RELATIONS["tags"].replace("% 200", "% 5000"))
relation("whole_tag_tokens", r"""
    SELECT movieId, unnest(regexp_extract_all(replace(tag, ' ', '_'), '\b\w\w+\b')) AS token FROM
      (SELECT DISTINCT movieId, trim(lower(coalesce(tag, 'nan'))) AS tag FROM wide_tags) w""")
relation("b_year", "SELECT movieId, 'year' AS feature, year AS value FROM years")
relation("b_decade", "SELECT movieId, concat('decade_', CAST(CAST(floor(year / 10) * 10 AS BIGINT) AS VARCHAR)) AS feature, CAST(1 AS DOUBLE) AS value FROM years")
relation("b_genres", "SELECT movieId, genre AS feature, CAST(1 AS DOUBLE) AS value FROM item_genres WHERE genre <> ''")
relation("b_genre_tfidf", "SELECT movieId, concat('genre_', token) AS feature, tfidf AS value FROM genre_weights")
relation("b_n_genres", "SELECT movieId, 'n_genres' AS feature, CAST(CASE WHEN genres IN ('', '(no genres listed)') THEN 0 ELSE len(string_split(genres, '|')) END AS DOUBLE) AS value FROM items")
relation("b_genre_pop", f"""
    SELECT g.movieId, 'genre_popularity_mean' AS feature, sum(f) / max(k.value) AS value
    FROM b_genres g JOIN (SELECT feature, CAST(count(*) AS DOUBLE) / {N_ITEMS} AS f FROM b_genres GROUP BY feature) q ON g.feature = q.feature
    JOIN b_n_genres k ON g.movieId = k.movieId GROUP BY g.movieId""")
relation("b_tag_words", "SELECT movieId, concat('tag_', token) AS feature, tfidf AS value FROM tag_weights")
relation("b_tag_meta", """
    SELECT i.movieId, 'n_tags' AS feature, CAST(count(t.userId) AS DOUBLE) AS value FROM items i LEFT JOIN lower_tags t ON i.movieId = t.movieId GROUP BY i.movieId
    UNION ALL
    SELECT i.movieId, 'avg_tag_frequency', coalesce(avg(f), 0) FROM items i LEFT JOIN
      (SELECT movieId, count(*) OVER (PARTITION BY tag) AS f FROM lower_tags) t ON i.movieId = t.movieId GROUP BY i.movieId""")
relation("known_genome", "SELECT * FROM genome WHERE movieId IN (SELECT movieId FROM items)")
relation("b_genome", "SELECT movieId, concat('genome_', CAST(tagId AS VARCHAR)) AS feature, relevance AS value FROM known_genome")
relation("genome_table", """
    SELECT movieId, avg(relevance) AS genome_mean, coalesce(stddev_samp(relevance), 0) AS genome_std, max(relevance) AS genome_max,
           min(relevance) AS genome_min, count(CASE WHEN relevance > 0.8 THEN 1 END) AS genome_n_strong FROM genome GROUP BY movieId""")
relation("b_genome_stats", "\nUNION ALL ".join(
    f"SELECT movieId, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM genome_table WHERE movieId IN (SELECT movieId FROM items)" for c in FT.GENOME_COLUMNS))
relation("visual_wide", """
    SELECT movieId, f1 AS visual_f1, f2 AS visual_f2, f3 AS visual_f3, f4 AS visual_f4, f5 AS visual_f5, f6 AS visual_f6, f7 AS visual_f7,
           f4 / (f1 + 1e-6) AS visual_fast_paced, f4 + f7 AS visual_action_intensity, f2 + f3 AS visual_color_complexity,
           f4 + f5 AS visual_motion_complexity, 1 - f6 AS visual_dark_score FROM visuals WHERE movieId IN (SELECT movieId FROM items)""")
_VIS = [f"visual_f{i}" for i in range(1, 8)] + [
    "visual_fast_paced", "visual_action_intensity", "visual_color_complexity", "visual_motion_complexity", "visual_dark_score"]
relation("b_visual7", "\nUNION ALL ".join(f"SELECT movieId, '{c}' AS feature, {c} AS value FROM visual_wide" for c in _VIS[:7]))
relation("b_visual", "\nUNION ALL ".join(f"SELECT movieId, '{c}' AS feature, {c} AS value FROM visual_wide" for c in _VIS))
relation("full_stats", """
    SELECT i.movieId, coalesce(n, 0) AS movie_n_ratings, coalesce(m, g) AS movie_mean_rating, coalesce(s, 0) AS movie_std_rating,
           (coalesce(n, 0) * coalesce(m, g) + 10 * g) / (coalesce(n, 0) + 10) AS movie_bayesian_mean,
           1.0 / (coalesce(n, 0) + 1) AS movie_inverse_popularity, n IS NOT NULL AS rated
    FROM items i LEFT JOIN istats s ON i.movieId = s.movieId, gm""")
relation("b_ratings", "\nUNION ALL ".join(
    f"SELECT movieId, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM full_stats WHERE rated" for c in FT.RATING_COLUMNS))
relation("v1_raw", "SELECT * FROM b_year UNION ALL SELECT * FROM b_genres")
relation("v2_raw", "SELECT * FROM v1_raw UNION ALL SELECT * FROM b_tag_words UNION ALL SELECT * FROM b_genome UNION ALL SELECT * FROM b_visual7")
relation("v3_raw", "\nUNION ALL ".join(f"SELECT * FROM {b}" for b in (
    "v1_raw", "b_decade", "b_n_genres", "b_genre_pop", "b_tag_words", "b_tag_meta", "b_genome", "b_genome_stats", "b_visual", "b_ratings")))


def scaled_sql(raw: str) -> str:
    return f"""
        SELECT b.movieId, b.feature, CASE WHEN hi > lo THEN (value - lo) / (hi - lo) ELSE 0 END AS value FROM {raw} b JOIN (
          SELECT feature, CASE WHEN count(*) < {N_ITEMS} THEN least(min(value), 0) ELSE min(value) END AS lo,
                 CASE WHEN count(*) < {N_ITEMS} THEN greatest(max(value), 0) ELSE max(value) END AS hi FROM {raw} GROUP BY feature) r
        ON b.feature = r.feature"""


def dense_sql(raw: str) -> str:
    """All entries of all items: absent ones are 0 before scaling."""
    return f"""
        SELECT i.movieId, r.feature, CASE WHEN hi > lo THEN (coalesce(value, 0) - lo) / (hi - lo) ELSE 0 END AS value FROM items i JOIN (
          SELECT feature, CASE WHEN count(*) < {N_ITEMS} THEN least(min(value), 0) ELSE min(value) END AS lo,
                 CASE WHEN count(*) < {N_ITEMS} THEN greatest(max(value), 0) ELSE max(value) END AS hi FROM {raw} GROUP BY feature) r ON true
        LEFT JOIN {raw} b ON b.movieId = i.movieId AND b.feature = r.feature"""


relation("v1", scaled_sql("v1_raw"))
relation("v2", scaled_sql("v2_raw"))
relation("v3", scaled_sql("v3_raw"))

relation("v5_raw", """
    SELECT * FROM v3 UNION ALL
    SELECT vec_id AS movieId, concat('sbert_', CAST(p AS VARCHAR)) AS feature, x AS value FROM (
      SELECT vec_id, unnest(range(len(embedding))) AS p, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) e WHERE vec_id IN (SELECT movieId FROM items)
    """ + "".join(
    f" UNION ALL SELECT movieId, 'tmdb_{c}', CAST(coalesce({c}, 0) AS DOUBLE) FROM metadata WHERE movieId IN (SELECT movieId FROM items)"
    for c in ("vote_average", "vote_count", "popularity", "runtime")))

BLOCK = f"SELECT movieId, feature, {dec('value', 6)} AS value FROM "


def rounded(block):
    return block.select(C.ITEM, "feature", R("value", 6).alias("value"))


def v1_block(t):
    return FT.block_v1(t.items())


def v2_block(t):
    return FT.block_v2(t.items(), lower_tags(t.tags()), t.genome_scores(), t.visuals())


def v3_block(t, ratings=None):
    return FT.block_v3(t.items(), lower_tags(t.tags()), t.genome_scores(), t.visuals(), t.ratings() if ratings is None else ratings)


@query("feat_title_length", "SELECT movieId, 'n_character_title' AS feature, length(title) AS value FROM items")
def _(t):
    return FT.feat_title_length(t.items())


@query("feat_year", "SELECT * FROM b_year")
def _(t):
    return FT.feat_year(t.items())


@query("feat_decade_onehot", "SELECT * FROM b_decade WHERE feature NOT IN ('decade_1900', 'decade_1910')")
def _(t):
    return FT.feat_decade_onehot(t.items())


@query("drop_sentinel_features", """
    SELECT movieId, feature, value FROM (SELECT movieId, unnest(string_split(genres, '|')) AS feature, 1 AS value FROM items
      UNION ALL SELECT movieId, feature, value FROM b_decade) x WHERE feature NOT IN ('(no genres listed)', 'decade_1900', 'decade_1910')""")
def _(t):
    raw = t.items().select(C.ITEM, F.explode(S.split_genres(C.GENRES)).alias("feature"), F.lit(1.0).alias("value"))
    return filters.drop_sentinel_features(raw.unionByName(FT.feat_decade_onehot(t.items(), drop_early=False)), decades=True)


@query("feat_genre_onehot", "SELECT * FROM b_genres")
def _(t):
    return FT.feat_genre_onehot(t.items())


@query("feat_genre_interactions", """
    SELECT * FROM b_decade WHERE feature NOT IN ('decade_1900', 'decade_1910') UNION ALL SELECT * FROM b_genres
    UNION ALL SELECT a.movieId, 'small_ring' AS feature, 1 AS value FROM b_genres a JOIN b_genres b ON a.movieId = b.movieId AND a.feature = 'small' AND b.feature = 'ring'
    UNION ALL SELECT a.movieId, 'PROMO_small_ring' AS feature, 1 AS value FROM b_genres a JOIN b_genres b ON a.movieId = b.movieId AND a.feature = 'small' AND b.feature = 'ring'
      JOIN b_genres c ON a.movieId = c.movieId AND c.feature = 'PROMO'""")
def _(t):
    return FT.feat_genre_interactions(t.items(), (("small", "ring"), ("PROMO", "small", "ring")))


@query("n_genres", "SELECT * FROM b_n_genres")
def _(t):
    return FT.n_genres(t.items())


@query("genre_popularity_mean", BLOCK + "b_genre_pop")
def _(t):
    return rounded(FT.genre_popularity_mean(t.items()))


@query("feat_genre_tfidf", BLOCK + "b_genre_tfidf")
def _(t):
    return rounded(FT.feat_genre_tfidf(t.items()))


@query("feat_genre_tfidf_poly", BLOCK + """(SELECT * FROM b_genre_tfidf UNION ALL
    SELECT a.movieId, concat('genre_', a.token, '_', b.token), a.tfidf * b.tfidf FROM genre_weights a JOIN genre_weights b ON a.movieId = b.movieId AND a.token < b.token) x""")
def _(t):
    return rounded(FT.feat_genre_tfidf_poly(t.items()))


@query("feat_tags", BLOCK + "(SELECT movieId, concat('user_', feature) AS feature, value FROM b_tag_words UNION ALL "
       "SELECT movieId, concat('user_', feature), value FROM (" + scaled_sql("b_tag_meta") + ") m) x")
def _(t):
    return rounded(FT.feat_tags(lower_tags(t.tags()), t.items()))


@query("tfidf_tags_analytics", "SELECT movieId, token, " + dec("tfidf", 6) + " AS tfidf FROM (" + tfidf_sql(
    "whole_tag_tokens", "(SELECT count(DISTINCT movieId) FROM wide_tags)", min_df=5, max_df="0.5 * (SELECT count(DISTINCT movieId) FROM wide_tags)") + ") y")
def _(t):
    return text.tfidf_tags_analytics(t.tags(items=5000)).withColumn("tfidf", R("tfidf", 6))


@query("feat_ratings", "SELECT movieId, feature, " + dec("value", 6) + " AS value FROM (" + " UNION ALL ".join(
    f"SELECT movieId, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM full_stats" for c in FT.RATING_COLUMNS) + ") x")
def _(t):
    return rounded(FT.feat_ratings(t.ratings(), t.items()))


@query("genome_pivot", f"SELECT movieId, tagId, {dec('relevance', 6)} AS relevance FROM genome")
def _(t):
    p = FT.genome_pivot(t.genome_scores())
    return p.select(C.ITEM, F.posexplode("relevance").alias("tagId", "x")).select(C.ITEM, F.col("tagId").cast("long").alias("tagId"), R("x", 6).alias("relevance"))


@query("genome_stats", "SELECT movieId, genome_n_strong, " + ", ".join(f"{dec(c, 6)} AS {c}" for c in FT.GENOME_COLUMNS[:4]) + " FROM genome_table")
def _(t):
    g = FT.genome_stats_table(t.genome_scores())
    return g.select(C.ITEM, "genome_n_strong", *[R(c, 6).alias(c) for c in FT.GENOME_COLUMNS[:4]])


@query("feat_genome", BLOCK + "(SELECT movieId, replace(feature, 'genome_', 'tag_') AS feature, value FROM b_genome UNION ALL SELECT * FROM b_genome_stats) x")
def _(t):
    return rounded(FT.feat_genome(t.genome_scores(), t.items()))


@query("scores_with_themes", "SELECT g.movieId, g.tagId, relevance, theme_id FROM genome g JOIN tag_themes h ON g.tagId = h.tagId")
def _(t):
    return FT.scores_with_themes(t.genome_scores(), t.tag_themes())


@query("theme_features", f"SELECT movieId, theme_id, {dec('avg(relevance)', 6)} AS value FROM genome g JOIN tag_themes h ON g.tagId = h.tagId GROUP BY movieId, theme_id")
def _(t):
    return FT.theme_features(t.genome_scores(), t.tag_themes()).withColumn("value", R("value", 6))


_TOPVAR = "SELECT tagId, var_samp(relevance) AS variance FROM genome GROUP BY tagId ORDER BY variance DESC, tagId LIMIT 200"


@query("top_variance_tags", f"SELECT tagId, {dec('variance', 6)} AS variance FROM ({_TOPVAR}) x")
def _(t):
    return FT.top_variance_tags(t.genome_scores()).withColumn("variance", R("variance", 6))


@query("feat_genome_themes", BLOCK + f"""(
    SELECT movieId, concat('bert_theme_', CAST(theme_id AS VARCHAR)) AS feature, avg(relevance) AS value FROM known_genome g JOIN tag_themes h ON g.tagId = h.tagId GROUP BY movieId, theme_id
    UNION ALL SELECT movieId, concat('raw_tag_', CAST(tagId AS VARCHAR)), relevance FROM known_genome WHERE tagId IN (SELECT tagId FROM ({_TOPVAR}) v)) x""")
def _(t):
    themes = FT.theme_features(t.genome_scores(), t.tag_themes())
    return rounded(FT.feat_genome_themes(t.genome_scores(), themes, t.items()))


@query("feat_visual", BLOCK + "b_visual")
def _(t):
    return rounded(FT.feat_visual(t.visuals(), t.items()))


@query("min_max_scale", BLOCK + "(" + scaled_sql("b_visual") + ") x")
def _(t):
    return rounded(FT.min_max_scale(FT.feat_visual(t.visuals(), t.items()), t.items()))


@query("feat_V1", BLOCK + "v1")
def _(t):
    return rounded(FT.min_max_scale(v1_block(t), t.items()))


@query("feat_V2", BLOCK + "v2")
def _(t):
    return rounded(FT.min_max_scale(v2_block(t), t.items()))


@query("feat_V3", BLOCK + "v3")
def _(t):
    return rounded(FT.min_max_scale(v3_block(t), t.items()))


_COEF = "SELECT feature, avg(value) AS mean_abs_coef, coalesce(stddev_samp(value), 0) / (avg(value) + 1e-8) AS cv_coef FROM v1 GROUP BY feature"


def spread_as_coefficients(block):
    """A coefficient table in the report's shape, from the spread of the scaled features."""
    mean = F.avg("value")
    return block.groupBy("feature").agg(
        mean.alias("mean_abs_coef"), (F.coalesce(F.stddev_samp("value"), F.lit(0.0)) / (mean + 1e-8)).alias("cv_coef"))


@query("select_features_by_coef", BLOCK + f"v1 WHERE feature IN (SELECT feature FROM ({_COEF}) c WHERE mean_abs_coef > 0.02 AND cv_coef < 1.35)")
def _(t):
    v1 = FT.min_max_scale(v1_block(t), t.items())
    return rounded(filters.select_features_by_coef(v1, spread_as_coefficients(v1)))


relation("all_v1", """
    SELECT * FROM b_decade WHERE feature NOT IN ('decade_1900', 'decade_1910')
    UNION ALL SELECT movieId, replace(feature, 'genome_', 'tag_') AS feature, value FROM b_genome UNION ALL SELECT * FROM b_genome_stats
    UNION ALL """ + " UNION ALL ".join(f"SELECT movieId, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM full_stats" for c in FT.RATING_COLUMNS) + """
    UNION ALL SELECT * FROM b_visual UNION ALL SELECT movieId, concat('user_', feature) AS feature, value FROM b_tag_words
    UNION ALL SELECT movieId, concat('user_', feature), value FROM (""" + scaled_sql("b_tag_meta") + """) m
    UNION ALL SELECT * FROM b_genre_tfidf""")


@query("feat_all_v1", BLOCK + "all_v1")
def _(t):
    """All blocks of the first set, kept by a coefficient table that names every feature."""
    block = FT.block_all_v1(t.items(), lower_tags(t.tags()), t.genome_scores(), t.visuals(), t.ratings())
    names = block.select("feature").distinct()
    coefs = names.select("feature", F.lit(1.0).alias("mean_abs_coef"), F.lit(0.1).alias("cv_coef"))
    return rounded(filters.select_features_by_coef(block, coefs))


def cells(arrays, names):
    return rounded(arrays.select(C.ITEM, F.posexplode("features").alias("position", "value")).join(names, "position"))


@query("assemble_feature_blocks", BLOCK + "(" + dense_sql("v3_raw") + ") x")
def _(t):
    """V3 as one array per item, shown entry by entry."""
    return cells(*FT.assemble(v3_block(t), t.items()))


def v5_arrays(t):
    """V3 with text vectors and metadata numbers, scaled again: an array per item, and the names of its entries."""
    extra = FT.vector_block(t.item_vectors(), t.items(), "embedding", "sbert_")
    return FT.assemble(FT.extend_with(v3_block(t), t.items(), extra, t.metadata()), t.items())


@query("feat_V5", BLOCK + "(" + dense_sql("v5_raw") + ") x")
def _(t):
    return cells(*v5_arrays(t))


@query("vector_maths", f"""
    SELECT vec_id AS movieId, {dec('list_inner_product(e, n)', 6)} AS dot, {dec('sqrt(list_inner_product(e, e))', 6)} AS norm,
           {dec('list_inner_product(e, n) / sqrt(list_inner_product(e, e) * list_inner_product(n, n))', 6)} AS cosine
    FROM (SELECT a.vec_id, CAST(a.embedding AS DOUBLE[]) AS e, CAST(b.embedding AS DOUBLE[]) AS n FROM embeddings a JOIN embeddings b ON a.vec_id = b.vec_id - 1) x""")
def _(t):
    a = t.item_vectors()
    b = a.select((F.col(C.ITEM) - 1).alias(C.ITEM), F.col("embedding").alias("next"))
    e, n = F.col("embedding"), F.col("next")
    return a.join(b, C.ITEM).select(C.ITEM, R(V.dot(e, n), 6).alias("dot"), R(V.norm(e), 6).alias("norm"), R(V.cosine(e, n), 6).alias("cosine"))


@query("l2_normalise", f"""
    SELECT vec_id AS movieId, CAST(p AS INT) AS position, {dec('x / s', 6)} AS value FROM (
      SELECT vec_id, unnest(range(len(embedding))) AS p, CAST(unnest(embedding) AS DOUBLE) AS x,
             sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS s FROM embeddings) y""")
def _(t):
    unit = t.item_vectors().select(C.ITEM, V.l2_normalise(F.col("embedding")).alias("u"))
    return unit.select(C.ITEM, F.posexplode("u").alias("position", "value")).withColumn("value", R("value", 6))


@query("mean_vector", f"""
    SELECT label, CAST(p AS INT) AS position, {dec('avg(x)', 6)} AS value FROM (
      SELECT label, unnest(range(len(embedding))) AS p, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) y GROUP BY label, p""")
def _(t):
    from tasteframe.operators.surprise import mean_vector

    v = t.read("embeddings").select("label", F.col("embedding").cast("array<double>").alias("embedding"))
    means = mean_vector(v, "embedding", by="label")
    return means.select("label", F.posexplode("mean").alias("position", "value")).withColumn("value", R("value", 6))
