"""Queries: projections, filters, statistics, ranks, sets and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.functions import scalars as S
from tasteframe.operators import catalogue, filters, ranking, stats
from tasteframe.plans.registry import dec, query
from tasteframe.sources import sinks
from tasteframe.sources.tables import clean_library, lower_tags

R = S.fixed_round


# --- projections, filters, predicates ---------------------------------------------------------

@query("project_user_item_rating", "SELECT userId, movieId, rating FROM ratings")
def _(t):
    return filters.project_user_item_rating(t.ratings())


@query("rename_and_prefix_columns", f"""
    SELECT movieId, {dec('f1', 6)} AS visual_f1, {dec('f4', 6)} AS visual_f4, {dec('f6', 6)} AS visual_f6 FROM visuals""")
def _(t):
    v = t.visuals().select(F.col(C.ITEM).alias("ML_Id"), *[R(f"f{i}", 6).alias(f"f{i}") for i in (1, 4, 6)])
    return filters.rename_and_prefix_columns(v, renames={"ML_Id": C.ITEM}, prefix="visual_")


@query("fill_missing", f"""
    SELECT i.movieId, coalesce(n, 0) AS n, {dec('coalesce(m, g)', 6)} AS m
    FROM items i LEFT JOIN istats s ON i.movieId = s.movieId, gm""")
def _(t):
    agg = t.ratings().groupBy(C.ITEM).agg(F.count("*").alias("n"), F.avg(C.RATING).alias("m"))
    joined = t.items().select(C.ITEM).join(agg, C.ITEM, "left")
    out = filters.fill_missing(joined, {"n": 0, "m": stats.global_mean_value(t.ratings())})
    return out.select(C.ITEM, "n", R("m", 6).alias("m"))


@query("filter_items", r"""
    SELECT * FROM (SELECT *, TRY_CAST(nullif(regexp_extract(title, '\((\d{4})\)', 1), '') AS INT) AS year FROM items) x
    WHERE contains(genres, 'ECONOMY') AND year >= 1960 AND year <= 1985""")
def _(t):
    return filters.filter_items(t.items(), genre="ECONOMY", year_min=1960, year_max=1985)


@query("browse_items", """
    SELECT * FROM items WHERE contains(lower(title), 'ring') AND contains(genres, 'small')
      AND (contains(genres, 'ECONOMY') OR contains(genres, 'PROMO'))""")
def _(t):
    return filters.browse_items(t.items(), query=" Ring ", genres=["small"], mood=["ECONOMY", "PROMO"])


@query("mood_genres", """
    WITH moods(mood, names) AS (VALUES
      ('Action', ['Action', 'Adventure', 'Thriller']), ('Feel Good', ['Comedy', 'Romance']),
      ('Drama', ['Drama']), ('Dark', ['Horror', 'Mystery', 'Thriller']),
      ('Escape', ['Sci-Fi', 'Fantasy', 'Animation']), ('Learn', ['Documentary', 'History', 'Biography']))
    SELECT mood, count(*) AS n_items FROM (
      SELECT DISTINCT movieId, mood, name_list.genres FROM (
        SELECT p_partkey AS movieId,
          concat(CASE p_type WHEN 'ECONOMY' THEN 'Action' WHEN 'PROMO' THEN 'Comedy' WHEN 'STANDARD' THEN 'Drama' ELSE 'Sci-Fi' END,
                 '|', CASE WHEN p_size % 3 = 0 THEN 'Thriller' ELSE 'History' END) AS genres FROM part) name_list,
        (SELECT mood, unnest(names) AS g FROM moods) m WHERE contains(name_list.genres, m.g)) x
    GROUP BY mood""")
def _(t):
    named = t.read("part").select(
        F.col("p_partkey").alias(C.ITEM),
        F.concat(
            F.when(F.col("p_type") == "ECONOMY", "Action").when(F.col("p_type") == "PROMO", "Comedy")
            .when(F.col("p_type") == "STANDARD", "Drama").otherwise("Sci-Fi"),
            F.lit("|"), F.when(F.col("p_size") % 3 == 0, "Thriller").otherwise("History"),
        ).alias(C.GENRES),
    )
    return filters.items_by_mood(named)


@query("seen_items", "SELECT userId, count(*) AS n_seen FROM (SELECT DISTINCT userId, movieId FROM ratings) x GROUP BY userId")
def _(t):
    return filters.seen_items(t.ratings()).groupBy(C.USER).agg(F.count("*").alias("n_seen"))


@query("exclude_seen", "SELECT DISTINCT userId, movieId FROM tags t WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.userId = t.userId AND r.movieId = t.movieId)")
def _(t):
    return filters.exclude_seen(t.tags().select(C.USER, C.ITEM).distinct(), t.ratings())


GROUP = (1, 2, 3)


@query("exclude_mentioned", """
    SELECT movieId, title FROM items WHERE movieId NOT IN (
      SELECT event_id % 200 FROM events WHERE user_id IN (1, 2, 3) AND event_type IN ('purchase', 'click'))""")
def _(t):
    return filters.exclude_mentioned(t.items(), t.participants(GROUP)).select(C.ITEM, C.TITLE)


@query("active_library", "SELECT * FROM library WHERE n_watched > 0 OR wishlist = 1 OR recent = 1 OR top10 = 1")
def _(t):
    return filters.active_library(clean_library(t.library()))


@query("extreme_ratings", """
    SELECT CASE WHEN rating = (SELECT max(rating) FROM ratings) THEN 'max' ELSE 'min' END AS extreme, rating, count(*) AS n
    FROM ratings WHERE rating IN (SELECT max(rating) FROM ratings UNION ALL SELECT min(rating) FROM ratings) GROUP BY 1, 2""")
def _(t):
    return filters.extreme_rating_counts(t.ratings())


@query("extreme_rating_rows", """
    SELECT userId, movieId, rating, CASE WHEN rating = (SELECT max(rating) FROM ratings) THEN 'max' ELSE 'min' END AS extreme
    FROM ratings WHERE rating IN (SELECT max(rating) FROM ratings UNION ALL SELECT min(rating) FROM ratings)""")
def _(t):
    return filters.extreme_ratings(t.ratings())


@query("power_users", """
    SELECT userId, n FROM ustats WHERE n >= (SELECT quantile_cont(n, 0.98) FROM ustats)""")
def _(t):
    return stats.power_users(t.ratings())


@query("multi_valued_only", "SELECT movieId, genres FROM items WHERE len(string_split(genres, '|')) >= 3 - 1")
def _(t):
    split = t.items().select(C.ITEM, C.GENRES, S.split_genres(C.GENRES).alias("g"))
    return filters.multi_valued_only(split, "g").drop("g")


@query("exclude_implicit_user", "SELECT userId, count(*) AS n FROM ratings WHERE userId <> -1 GROUP BY userId")
def _(t):
    implicit = stats.implicit_ratings(clean_library(t.library()))
    both = sinks.union_ratings(t.ratings(), implicit)
    return filters.exclude_implicit_user(both).groupBy(C.USER).agg(F.count("*").alias("n"))


@query("prediction_quality_check", f"""
    SELECT count(*) AS n_rows, 4 AS n_columns, 0 AS "null_userId", 0 AS "null_movieId", 0 AS null_rating,
           count(*) - count(m) AS null_est, {dec('min(m)', 6)} AS min_est, {dec('max(m)', 6)} AS max_est
    FROM test t LEFT JOIN (SELECT movieId AS mid, avg(rating) AS m FROM train GROUP BY movieId) a ON t.movieId = a.mid""")
def _(t):
    means = t.train().groupBy(C.ITEM).agg(F.avg(C.RATING).alias("est"))
    p = filters.project_user_item_rating(t.test()).join(means, C.ITEM, "left")
    p = p.select(C.USER, C.ITEM, C.RATING, R("est", 6).alias("est"))
    filters.validate_columns(p, [C.USER, C.ITEM, C.RATING, "est"], ordered=True)
    return filters.prediction_quality_check(p)


@query("validate_columns", "SELECT userId, movieId, rating FROM test")
def _(t):
    out = filters.project_user_item_rating(t.test())
    filters.validate_columns(out, [C.USER, C.ITEM, C.RATING], ordered=True)
    return out


@query("clean_user_input_ratings", """
    SELECT user_id AS userId, event_id AS movieId, greatest(0.5, least(5.0, value)) AS rating
    FROM events WHERE event_id % 10 <> 0 AND value IS NOT NULL""")
def _(t):
    raw = t.read("events").select(
        F.col("user_id").alias(C.USER),
        F.when(F.col("event_id") % 20 == 0, F.lit("movie")).otherwise(F.col("event_id").cast("string")).alias("item"),
        F.when(F.col("event_id") % 20 == 10, F.lit("five")).otherwise(F.col("value").cast("string")).alias("value"),
    )
    return filters.clean_user_input_ratings(raw)


# --- aggregations and statistics ---------------------------------------------------------------

@query("item_stats", f"SELECT movieId, n AS rating_count, {dec('m', 6)} AS rating_mean FROM istats")
def _(t):
    return stats.item_stats(t.ratings()).withColumn("rating_mean", R("rating_mean", 6))


@query("stats_with_items", f"SELECT s.movieId, n AS rating_count, {dec('m', 6)} AS rating_mean, title, genres FROM istats s LEFT JOIN items i ON s.movieId = i.movieId")
def _(t):
    return stats.stats_with_items(t.ratings(), t.items()).withColumn("rating_mean", R("rating_mean", 6))


@query("item_stats_full", f"""
    SELECT i.movieId, coalesce(n, 0) AS movie_n_ratings, {dec('coalesce(m, g)', 6)} AS movie_mean_rating,
           {dec('coalesce(s, 0)', 6)} AS movie_std_rating,
           {dec('(coalesce(n, 0) * coalesce(m, g) + 10 * g) / (coalesce(n, 0) + 10)', 6)} AS movie_bayesian_mean,
           {dec('1.0 / (coalesce(n, 0) + 1)', 6)} AS movie_inverse_popularity
    FROM items i LEFT JOIN istats s ON i.movieId = s.movieId, gm""")
def _(t):
    out = stats.item_stats_full(t.ratings(), t.items())
    return out.select(C.ITEM, "movie_n_ratings", *[R(c, 6).alias(c) for c in out.columns[2:]])


@query("weighted_score", f"SELECT movieId, {dec('weighted_score', 6)} AS weighted_score FROM scored")
def _(t):
    return stats.scored_items(t.ratings(), t.items()).select(C.ITEM, R("weighted_score", 6).alias("weighted_score"))


@query("bayesian_mean", f"SELECT movieId, {dec('(n * m + 10 * g) / (n + 10)', 6)} AS bayesian_mean FROM istats, gm")
def _(t):
    s = stats.item_stats(t.ratings())
    b = stats.bayesian_mean("rating_count", "rating_mean", stats.global_mean_value(t.ratings()))
    return s.select(C.ITEM, R(b, 6).alias("bayesian_mean"))


@query("inverse_popularity", f"SELECT movieId, {dec('1.0 / (n + 1)', 6)} AS inverse_popularity FROM istats")
def _(t):
    return stats.item_stats(t.ratings()).select(C.ITEM, R(stats.inverse_popularity("rating_count"), 6).alias("inverse_popularity"))


@query("featured_items", f"""
    SELECT movieId, title, genres, rating_count, {dec('rating_mean', 6)} AS rating_mean, {dec('weighted_score', 6)} AS weighted_score
    FROM scored ORDER BY scored.weighted_score DESC, rating_count DESC, movieId LIMIT 100""")
def _(t):
    out = stats.featured_items(t.ratings(), t.items(), 100)
    return out.select(C.ITEM, C.TITLE, C.GENRES, "rating_count", R("rating_mean", 6).alias("rating_mean"), R("weighted_score", 6).alias("weighted_score"))


@query("dataset_summary", """
    SELECT count(*) AS n_ratings, count(DISTINCT userId) AS n_users, count(DISTINCT movieId) AS n_items,
           (SELECT string_agg(printf('%.2f', rating), ',' ORDER BY rating) FROM (SELECT DISTINCT rating FROM ratings) d) AS rating_values
    FROM ratings""")
def _(t):
    return stats.dataset_summary(t.ratings())


@query("sparsity", f"""
    SELECT count(*) AS n_ratings, count(DISTINCT userId) AS n_users, count(DISTINCT movieId) AS n_items,
           {dec('1 - count(*) / (CAST(count(DISTINCT userId) AS DOUBLE) * count(DISTINCT movieId))', 6)} AS sparsity FROM ratings""")
def _(t):
    return stats.sparsity(t.ratings()).withColumn("sparsity", R("sparsity", 6))


@query("ratings_per_user", "SELECT userId, n FROM ustats")
def _(t):
    return stats.ratings_per_user(t.ratings())


@query("activity_quantiles", "SELECT " + ", ".join(
    f"quantile_cont(CAST(n AS DOUBLE), {p}) AS {name}" for name, p in stats.ACTIVITY_POINTS.items()) + " FROM ustats")
def _(t):
    return stats.activity_quantiles(t.ratings())


@query("describe", f"""
    SELECT count(rating) AS count, {dec('avg(rating)', 6)} AS mean, {dec('stddev_samp(rating)', 6)} AS std, min(rating) AS min,
           quantile_cont(rating, 0.25) AS p25, quantile_cont(rating, 0.5) AS p50, quantile_cont(rating, 0.75) AS p75, max(rating) AS max
    FROM ratings""")
def _(t):
    d = stats.describe(t.ratings(), C.RATING)
    return d.withColumns({"mean": R("mean", 6), "std": R("std", 6)})


@query("power_user_stats", f"""
    SELECT userId, {dec('avg(rating)', 6)} AS mean, {dec('var_samp(rating)', 6)} AS var, {dec('stddev_samp(rating)', 6)} AS std
    FROM ratings WHERE userId IN (SELECT userId FROM ustats WHERE n >= (SELECT quantile_cont(n, 0.98) FROM ustats)) GROUP BY userId""")
def _(t):
    out = stats.power_user_stats(t.ratings())
    return out.select(C.USER, *[R(c, 6).alias(c) for c in ("mean", "var", "std")])


@query("power_user_stats_describe", f"""
    SELECT count(m) AS count, {dec('avg(m)', 6)} AS mean, {dec('stddev_samp(m)', 6)} AS std, {dec('min(m)', 6)} AS min,
           {dec('quantile_cont(m, 0.25)', 6)} AS p25, {dec('quantile_cont(m, 0.5)', 6)} AS p50,
           {dec('quantile_cont(m, 0.75)', 6)} AS p75, {dec('max(m)', 6)} AS max
    FROM ustats WHERE n >= (SELECT quantile_cont(n, 0.98) FROM ustats)""")
def _(t):
    d = stats.describe(stats.power_user_stats(t.ratings()), "mean")
    return d.select("count", *[R(c, 6).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


@query("predictions_per_user", "SELECT userId, count(*) AS n_predictions FROM test GROUP BY userId")
def _(t):
    return stats.predictions_per_user(t.test())


_COMBO = "SELECT combination, count(*) AS n FROM (SELECT list_aggregate(list_sort(string_split(genres, '|')), 'string_agg', '|') AS combination, len(string_split(genres, '|')) AS k FROM items) x WHERE k >= {k} GROUP BY combination ORDER BY n DESC, combination LIMIT 5"


@query("top_genre_combinations", _COMBO.format(k=1))
def _(t):
    return stats.top_genre_combinations(t.items())


@query("top_genre_combinations_multi", _COMBO.format(k=2))
def _(t):
    return stats.top_genre_combinations(t.items(), min_size=2)


@query("top_tag_combinations", """
    SELECT combination, count(*) AS n FROM (
      SELECT movieId, string_agg(tag, '|' ORDER BY tag) AS combination FROM clean_tags GROUP BY movieId HAVING count(*) >= 2) x
    GROUP BY combination ORDER BY n DESC, combination LIMIT 5""")
def _(t):
    return stats.top_tag_combinations(t.tags())


@query("tags_per_item", "SELECT movieId, string_agg(tag, '|' ORDER BY tag) AS tags FROM clean_tags GROUP BY movieId")
def _(t):
    return stats.tags_per_item(t.tags()).withColumn("tags", F.array_join("tags", "|"))


@query("available_genres", "SELECT DISTINCT genre FROM item_genres WHERE genre <> ''")
def _(t):
    return stats.available_genres(t.items())


@query("tag_counts", "SELECT i.movieId, count(t.userId) AS n_tags FROM items i LEFT JOIN tags t ON i.movieId = t.movieId GROUP BY i.movieId")
def _(t):
    return stats.tag_counts(t.tags(), t.items())


@query("tag_frequency_lookup", 'SELECT tag, "userId", "movieId", count(*) OVER (PARTITION BY tag) AS tag_frequency FROM lower_tags')
def _(t):
    return stats.tag_frequency_lookup(lower_tags(t.tags()))


@query("avg_tag_frequency", f"""
    SELECT i.movieId, {dec('coalesce(a, 0)', 6)} AS avg_tag_frequency FROM items i LEFT JOIN (
      SELECT movieId, avg(f) AS a FROM (SELECT movieId, count(*) OVER (PARTITION BY tag) AS f FROM lower_tags) x GROUP BY movieId) y
    ON i.movieId = y.movieId""")
def _(t):
    out = stats.avg_tag_frequency(lower_tags(t.tags()), t.items())
    return out.withColumn("avg_tag_frequency", R("avg_tag_frequency", 6))


@query("user_stats", f"SELECT userId, n AS u_count, {dec('m', 6)} AS u_mean, {dec('s', 6)} AS u_std FROM ustats")
def _(t):
    return stats.user_stats(t.ratings()).withColumns({"u_mean": R("u_mean", 6), "u_std": R("u_std", 6)})


@query("global_mean", f"SELECT {dec('g', 6)} AS global_mean FROM gm")
def _(t):
    return stats.global_mean(t.ratings()).withColumn("global_mean", R("global_mean", 6))


@query("item_popularity", f"SELECT movieId, {dec('CAST(n AS DOUBLE) / (SELECT count(*) FROM ustats)', 6)} AS popularity FROM istats")
def _(t):
    return stats.item_popularity(t.ratings()).withColumn("popularity", R("popularity", 6))


@query("implicit_rating", """
    SELECT userId, movieId, CAST(round(CAST(greatest(0.5, least(5.0, 0.5 + 0.8 * least(n_watched, 5) + 0.9 * wishlist + 0.5 * recent + 1.5 * top10)) AS DECIMAL(18,6)), 2) AS DOUBLE) AS rating
    FROM behaviour""")
def _(t):
    b = t.behaviour()
    return b.select(C.USER, C.ITEM, S.implicit_rating("n_watched", "wishlist", "recent", "top10").alias(C.RATING))


_IMPLICIT = """
    SELECT CAST(-1 AS BIGINT) AS userId, movieId,
      CAST(round(CAST(greatest(0.5, least(5.0, 0.5 + 0.8 * least(n_watched, 5) + 0.9 * wishlist + 0.5 * recent + 1.5 * top10)) AS DECIMAL(18,6)), 2) AS DOUBLE) AS rating
    FROM library WHERE n_watched > 0 OR wishlist = 1 OR recent = 1 OR top10 = 1"""


@query("implicit_ratings", _IMPLICIT)
def _(t):
    return stats.implicit_ratings(clean_library(t.library())).drop(C.TIMESTAMP)


@query("popular_library", f"""
    SELECT s.movieId, title, genres, n AS rating_count, {dec('m', 6)} AS rating_mean
    FROM istats s LEFT JOIN items i ON s.movieId = i.movieId ORDER BY n DESC, m DESC, s.movieId LIMIT 100""")
def _(t):
    return stats.popular_library(t.ratings(), t.items()).withColumn("rating_mean", R("rating_mean", 6))


@query("user_profile", f"""
    SELECT u.userId, n AS n_ratings, {dec('m', 2)} AS avg_rating, top_genres, top_items FROM ustats u
    LEFT JOIN (SELECT userId, string_agg(genre, '|' ORDER BY r) AS top_genres FROM (
        SELECT userId, genre, row_number() OVER (PARTITION BY userId ORDER BY count(*) DESC, genre) AS r
        FROM ratings JOIN item_genres USING (movieId) GROUP BY userId, genre) g WHERE r <= 3 GROUP BY userId) a ON u.userId = a.userId
    LEFT JOIN (SELECT userId, string_agg(CAST(movieId AS VARCHAR), '|' ORDER BY r) AS top_items FROM (
        SELECT userId, movieId, row_number() OVER (PARTITION BY userId ORDER BY rating DESC, movieId) AS r FROM ratings) i
        WHERE r <= 5 GROUP BY userId) b ON u.userId = b.userId""")
def _(t):
    return stats.user_profile(t.ratings(), t.items())


# --- ranks, top-k, sorts -----------------------------------------------------------------------

@query("popularity_rank", "SELECT movieId, n, rank FROM popular")
def _(t):
    return ranking.popularity_rank(t.ratings())


@query("long_tail", f"""
    SELECT movieId, n AS frequency, rank, {dec('CAST(sum(n) OVER (ORDER BY rank) AS DOUBLE) / (SELECT count(*) FROM ratings)', 6)} AS cumulative_share FROM popular""")
def _(t):
    return ranking.long_tail(t.ratings()).withColumn("cumulative_share", R("cumulative_share", 6))


@query("id_mapping", "SELECT userId, row_number() OVER (ORDER BY userId) - 1 AS position FROM ustats")
def _(t):
    return ranking.id_mapping(t.ratings(), C.USER)


@query("id_mapping_items", "SELECT movieId, row_number() OVER (ORDER BY movieId) - 1 AS position FROM istats")
def _(t):
    return ranking.id_mapping(t.ratings(), C.ITEM)


@query("sort_multi_key", f"""
    SELECT movieId, rating_count, {dec('weighted_score', 6)} AS weighted_score FROM scored""")
def _(t):
    s = stats.scored_items(t.ratings(), t.items()).select(C.ITEM, "rating_count", R("weighted_score", 6).alias("weighted_score"))
    return ranking.sort_multi_key(s, [("weighted_score", True), ("rating_count", True), (C.ITEM, False)])


@query("head_tail", "SELECT userId, n FROM ustats ORDER BY n, userId DESC LIMIT 100")
def _(t):
    counts = t.ratings().groupBy(C.USER).agg(F.count("*").alias("n"))
    return ranking.head_tail(counts, 100, keys=[("n", True), (C.USER, False)], tail=True)


@query("pick_one_per_user", """
    SELECT userId, movieId, rating FROM (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY
      CAST('0x' || substr(md5(concat(userId, ' ', movieId, ' 0')), 1, 15) AS BIGINT), movieId) AS r FROM ratings) x WHERE r = 1""")
def _(t):
    return ranking.pick_one_per_user(t.ratings())


# --- sets ---------------------------------------------------------------------------------------

@query("union_ratings", f"SELECT userId, movieId, rating FROM ratings UNION ALL ({_IMPLICIT})")
def _(t):
    implicit = stats.implicit_ratings(clean_library(t.library()))
    return sinks.union_ratings(t.ratings(), implicit).drop(C.TIMESTAMP)


@query("distinct_values", "SELECT DISTINCT rating FROM ratings")
def _(t):
    return stats.distinct_values(t.ratings(), C.RATING)


@query("genre_set_algebra", """
    SELECT a.movieId, list_aggregate(list_sort(list_distinct(list_concat(x, y))), 'string_agg', '|') AS either,
           coalesce(list_aggregate(list_sort(list_intersect(x, y)), 'string_agg', '|'), '') AS both
    FROM (SELECT movieId, string_split(genres, '|') AS x FROM items) a
    JOIN (SELECT movieId, string_split(genres, '|') AS y FROM items) b ON a.movieId = b.movieId - 1""")
def _(t):
    a = t.items().select(C.ITEM, S.split_genres(C.GENRES).alias("x"))
    b = t.items().select((F.col(C.ITEM) - 1).alias(C.ITEM), S.split_genres(C.GENRES).alias("y"))
    return a.join(b, C.ITEM).select(
        C.ITEM, S.sorted_set(F.array_union("x", "y")).alias("either"), S.sorted_set(F.array_intersect("x", "y")).alias("both"))


# --- joins ---------------------------------------------------------------------------------------

@query("align_to_items", "SELECT i.movieId, coalesce(n, 0) AS n FROM items i LEFT JOIN (SELECT movieId, count(*) AS n FROM tags GROUP BY movieId) t ON i.movieId = t.movieId")
def _(t):
    n = t.tags().groupBy(C.ITEM).agg(F.count("*").alias("n"))
    return catalogue.align_to_items(t.items(), n, {"n": 0})


@query("unrated_items", "SELECT movieId, title, genres FROM items WHERE movieId NOT IN (SELECT movieId FROM ratings WHERE rating = 5)")
def _(t):
    return stats.unrated_items(t.items(), t.ratings().where(F.col(C.RATING) == C.RATING_MAX))


@query("ratings_of_selected_users", "SELECT userId, movieId, rating FROM ratings WHERE userId IN (SELECT user_id FROM events)")
def _(t):
    users = t.read("events").select(F.col("user_id").alias(C.USER)).distinct()
    return filters.project_user_item_rating(stats.ratings_of_selected_users(t.ratings(), users))


@query("enrich_with_metadata", """
    SELECT i.movieId, i.title, coalesce(poster_url, '') AS poster_url, coalesce(overview, '') AS overview,
           coalesce(CAST(runtime AS VARCHAR), '') AS runtime, coalesce(CAST(vote_average AS VARCHAR), '') AS vote_average
    FROM items i LEFT JOIN metadata m ON i.movieId = m.movieId""")
def _(t):
    return catalogue.enrich_with_metadata(t.items().select(C.ITEM, C.TITLE), t.metadata())


@query("item_detail", f"""
    SELECT i.movieId, i.title, i.genres, coalesce(poster_url, '') AS poster_url, coalesce(overview, '') AS overview,
           coalesce(CAST(runtime AS VARCHAR), '') AS runtime, coalesce(CAST(vote_average AS VARCHAR), '') AS vote_average,
           coalesce(CAST(vote_count AS VARCHAR), '') AS vote_count, coalesce(CAST(m.popularity AS VARCHAR), '') AS popularity,
           coalesce(release_date, '') AS release_date, {dec('s.m', 2)} AS rating_mean, coalesce(n, 0) AS rating_count
    FROM items i LEFT JOIN metadata m ON i.movieId = m.movieId LEFT JOIN istats s ON i.movieId = s.movieId""")
def _(t):
    return catalogue.item_detail(t.items(), t.metadata(), t.ratings())


@query("user_directory", """
    SELECT coalesce(userId, c_custkey) AS user_id, coalesce(c_name, concat('User ', CAST(userId AS VARCHAR))) AS name
    FROM (SELECT DISTINCT userId FROM ratings) r
    FULL JOIN customer c ON userId = c_custkey""")
def _(t):
    return catalogue.user_directory(t.ratings(), t.registered_users())


@query("featured_table", f"""
    SELECT s.movieId, s.title, rating_count, {dec('weighted_score', 6)} AS weighted_score, coalesce(poster_url, '') AS poster_url,
           coalesce(overview, '') AS overview, coalesce(g.names, '') AS listed_genres
    FROM scored s LEFT JOIN metadata m ON s.movieId = m.movieId LEFT JOIN (
      SELECT movieId, list_aggregate(list_distinct(string_split(genres, '|')), 'count') AS k, NULL AS names FROM items) g0 ON s.movieId = g0.movieId
    LEFT JOIN (SELECT movieId, string_agg(genre, '|' ORDER BY p) AS names FROM (
      SELECT movieId, genre, min(p) AS p FROM (SELECT movieId, unnest(string_split(genres, '|')) AS genre, unnest(range(len(string_split(genres, '|')))) AS p
        FROM items WHERE genres <> '(no genres listed)') a GROUP BY movieId, genre) b GROUP BY movieId) g ON s.movieId = g.movieId""")
def _(t):
    out = catalogue.featured_table(t.ratings(), t.items(), t.metadata())
    return out.select(C.ITEM, C.TITLE, "rating_count", R("weighted_score", 6).alias("weighted_score"), "poster_url", "overview", "listed_genres")


@query("anti_testset", f"""
    SELECT u.userId, i.movieId, {dec('g', 6)} AS fill FROM (SELECT DISTINCT userId FROM ratings WHERE userId IN (1, 2, 3)) u
    JOIN (SELECT DISTINCT movieId FROM ratings) i ON true
    LEFT JOIN ratings r ON r.userId = u.userId AND r.movieId = i.movieId, gm WHERE r.userId IS NULL""")
def _(t):
    return catalogue.anti_testset(t.ratings(), GROUP).withColumn("fill", R("fill", 6))


# --- scalar functions ---------------------------------------------------------------------------

@query("extract_year", r"SELECT movieId, TRY_CAST(nullif(regexp_extract(title, '\((\d{4})\)', 1), '') AS INT) AS year FROM items")
def _(t):
    return t.items().select(C.ITEM, S.extract_year(C.TITLE).alias("year"))


@query("title_length", "SELECT movieId, length(title) AS n FROM items")
def _(t):
    return t.items().select(C.ITEM, S.title_length(C.TITLE).alias("n"))


@query("decade", r"SELECT movieId, CAST(floor(TRY_CAST(nullif(regexp_extract(title, '\((\d{4})\)', 1), '') AS INT) / 10) * 10 AS BIGINT) AS decade FROM items")
def _(t):
    return t.items().select(C.ITEM, S.decade(S.extract_year(C.TITLE)).alias("decade"))


@query("genre_texts", """
    SELECT movieId, replace(genres, '|', ' ') AS sentence, CAST(CASE WHEN genres IN ('', '(no genres listed)') THEN 0 ELSE len(string_split(genres, '|')) END AS INT) AS n_genres,
      starts_with(genres, 'PROMO') AS promo, contains(genres, 'small') AS small FROM items""")
def _(t):
    return t.items().select(
        C.ITEM, S.genres_as_sentence(C.GENRES).alias("sentence"), S.n_genres(C.GENRES).alias("n_genres"),
        F.col(C.GENRES).startswith("PROMO").alias("promo"), F.col(C.GENRES).contains("small").alias("small"))


@query("split_genres", "SELECT movieId, unnest(string_split(genres, '|')) AS genre FROM items")
def _(t):
    return t.items().select(C.ITEM, F.explode(S.split_genres(C.GENRES)).alias("genre"))


@query("sorted_tuple", "SELECT movieId, list_aggregate(list_sort(string_split(genres, '|')), 'string_agg', '|') AS genres FROM items")
def _(t):
    return t.items().select(C.ITEM, S.sorted_set(S.split_genres(C.GENRES)).alias(C.GENRES))


@query("clean_tag", "SELECT DISTINCT trim(lower(tag)) AS tag, replace(trim(lower(tag)), ' ', '_') AS token FROM tags WHERE tag IS NOT NULL")
def _(t):
    tag = S.clean_tag("tag")
    return t.tags().where(F.col("tag").isNotNull()).select(tag.alias("tag"), S.tag_to_token(tag).alias("token")).distinct()


@query("preview_texts", """
    SELECT movieId, CASE WHEN length(overview) > 150 THEN concat(substr(overview, 1, 150), '…') ELSE overview END AS preview,
           substr(release_date, 1, 4) AS release_year FROM metadata""")
def _(t):
    return catalogue.preview_texts(t.metadata())


@query("json_extract_metadata", "SELECT * FROM extracted")
def _(t):
    return catalogue.json_extract_metadata(t.payloads())


@query("scalar_maths", f"""
    SELECT movieId, {dec('log2(n)', 6)} AS log2n, {dec('ln(1 + n)', 6)} AS ln1p, {dec('sqrt(m)', 6)} AS root, {dec('exp(-abs(m - g))', 6)} AS decay,
           greatest(0.5, least(5.0, {dec('m * 1.5', 4)})) AS clipped, {dec('m', 3)} AS m3 FROM istats, gm""")
def _(t):
    gm = stats.global_mean_value(t.ratings())
    m, n = F.col("rating_mean"), F.col("rating_count")
    return stats.item_stats(t.ratings()).select(
        C.ITEM, R(F.log2(n.cast("double")), 6).alias("log2n"), R(F.log1p(n.cast("double")), 6).alias("ln1p"), R(F.sqrt(m), 6).alias("root"),
        R(F.exp(-F.abs(m - gm)), 6).alias("decay"), S.clip(R(m * 1.5, 4)).alias("clipped"), R(m, 3).alias("m3"))
