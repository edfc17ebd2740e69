"""Queries: tables written to the shared folder and read back by the loaders."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.functions import scalars as S
from tasteframe.operators import features as FT
from tasteframe.operators import stats
from tasteframe.plans.queries_basic import _IMPLICIT
from tasteframe.plans.queries_features import spread_as_coefficients, v1_block
from tasteframe.plans.registry import dec, query, relation
from tasteframe.scratch import fresh_path
from tasteframe.sources import sinks
from tasteframe.sources import tables as L
from tasteframe.sources.tables import clean_library

R = S.fixed_round


def csv(t, df, name):
    path = fresh_path(t.spark, name) + ".csv"
    sinks.write_csv(df, path)
    return path


def parquet(t, df, name):
    path = fresh_path(t.spark, name)
    df.write.parquet(path)
    return path


@query("load_ratings", "SELECT userId, movieId, rating, timestamp FROM ratings")
def _(t):
    return L.load_ratings(t.spark, csv(t, t.ratings(), "ratings"))


@query("load_ratings_with_implicit", f"SELECT userId, movieId, rating FROM ratings UNION ALL ({_IMPLICIT})")
def _(t):
    path = fresh_path(t.spark, "ratings-with-implicit")
    sinks.append_implicit_ratings(t.ratings(), stats.implicit_ratings(clean_library(t.library())), path)
    return L.load_ratings(t.spark, "no-explicit-file", path, use_implicit=True).drop(C.TIMESTAMP)


@query("load_items", "SELECT movieId, title, genres FROM items")
def _(t):
    return L.load_items(t.spark, csv(t, t.items(), "items"))


@query("load_item_metadata", "SELECT movieId, title, overview, release_date, runtime, vote_average, vote_count, popularity, poster_path, poster_url FROM metadata")
def _(t):
    from tasteframe.operators.catalogue import json_extract_metadata

    raw = json_extract_metadata(t.payloads()).select([f.name for f in C.METADATA_SCHEMA.fields])
    path = fresh_path(t.spark, "metadata")
    sinks.write_metadata_features(raw.withColumns({C.ITEM: F.col(C.ITEM).cast("double"), "vote_count": F.col("vote_count").cast("double")}), path)
    return L.load_item_metadata(t.spark, path)


@query("load_tags", "SELECT userId, movieId, tag FROM lower_tags")
def _(t):
    return L.load_tags(t.spark, csv(t, t.tags(), "tags"))


@query("load_genome_scores", f"SELECT movieId, tagId, {dec('relevance', 6)} AS relevance FROM genome")
def _(t):
    return L.load_genome_scores(t.spark, parquet(t, t.genome_scores(), "genome")).withColumn("relevance", R("relevance", 6))


@query("load_genome_tags", "SELECT DISTINCT tagId, concat('tag ', CAST(tagId AS VARCHAR)) AS tag FROM genome")
def _(t):
    return L.load_genome_tags(t.spark, csv(t, t.genome_tags(), "genome-tags"))


@query("load_visuals", "SELECT movieId, " + ", ".join(f"{dec(f'f{i}', 6)} AS f{i}" for i in range(1, 8)) + " FROM visuals")
def _(t):
    root = fresh_path(t.spark, "visuals")
    sinks.write_csv(t.visuals().withColumnRenamed(C.ITEM, "ML_ID"), f"{root}/LLVisualFeatures13K_Log.csv")
    v = L.load_visuals(t.spark, root, "log")
    return v.select(C.ITEM, *[R(f"f{i}", 6).alias(f"f{i}") for i in range(1, 8)])


@query("load_precomputed_theme_features", f"SELECT movieId, theme_id, {dec('avg(relevance)', 6)} AS value FROM genome g JOIN tag_themes h ON g.tagId = h.tagId GROUP BY movieId, theme_id")
def _(t):
    path = fresh_path(t.spark, "themes")
    sinks.write_theme_features(FT.theme_features(t.genome_scores(), t.tag_themes()), path)
    return L.load_precomputed_theme_features(t.spark, path).withColumn("value", R("value", 6))


@query("write_embeddings", "SELECT vec_id AS tagId, len(embedding) AS dims FROM embeddings")
def _(t):
    path = fresh_path(t.spark, "embeddings")
    sinks.write_embeddings(t.tag_vectors(), path)
    return t.spark.read.parquet(path).select("tagId", F.size("embedding").alias("dims"))


@query("load_test_keys", "SELECT userId, movieId FROM test")
def _(t):
    return L.load_test_keys(t.spark, csv(t, t.test().select(C.USER, C.ITEM, C.RATING), "test-keys"))


@query("load_links", "SELECT movieId, tmdbId FROM extracted")
def _(t):
    return L.load_links(t.spark, csv(t, t.payloads().select(C.ITEM, "tmdbId"), "links"))


@query("load_library", "SELECT movieId, title, genres, n_watched, wishlist, recent, top10 FROM library")
def _(t):
    path = csv(t, t.library().select(C.ITEM, C.TITLE, C.GENRES, *C.LIBRARY_SIGNALS), "library")
    return L.load_library(t.spark, path)


relation("signed_up", "SELECT c_custkey AS user_id, c_name AS name FROM customer")


@query("load_registered_users", """
    SELECT user_id AS userId, name, movieId, rating FROM signed_up JOIN ratings ON user_id = userId""")
def _(t):
    path = fresh_path(t.spark, "users")
    sinks.write_registered_users(t.registered_users(), path)
    users = L.load_registered_users(t.spark, path)
    return L.registered_ratings(users).join(users.select(F.col("user_id").alias(C.USER), "name"), C.USER)


@query("upsert_registered_user", """
    SELECT coalesce(s_suppkey, user_id) AS user_id, coalesce(s_name || ' (new)', name) AS name
    FROM signed_up FULL JOIN (SELECT s_suppkey + 100 AS s_suppkey, s_name FROM supplier) s ON s_suppkey = user_id""")
def _(t):
    """Suppliers sign up with ids that partly exist: those users are replaced, the others are added."""
    users = t.registered_users()
    changes = t.read("supplier").select(
        (F.col("s_suppkey") + 100).alias("user_id"), F.concat("s_name", F.lit(" (new)")).alias("name"),
        F.lit(None).cast("map<string,double>").alias("ratings"))
    path = fresh_path(t.spark, "upserted")
    sinks.write_registered_users(sinks.upsert_registered_user(users, changes), path)
    return L.load_registered_users(t.spark, path).select("user_id", "name")


@query("next_user_id", "SELECT greatest((SELECT max(userId) FROM ratings), (SELECT max(user_id) FROM signed_up), 0) + 1 AS user_id")
def _(t):
    return sinks.next_user_id(t.ratings(), t.registered_users())


_COEF = "SELECT feature, avg(value) AS mean_abs_coef, coalesce(stddev_samp(value), 0) / (avg(value) + 1e-8) AS cv_coef FROM v1 GROUP BY feature"


@query("write_coefficients", f"SELECT feature, {dec('mean_abs_coef', 6)} AS mean_abs_coef, {dec('cv_coef', 6)} AS cv_coef FROM ({_COEF}) c")
def _(t):
    """The first table written stays; a second write changes nothing."""
    v1 = FT.min_max_scale(v1_block(t), t.items())
    c = spread_as_coefficients(v1).select(
        "feature", "mean_abs_coef", F.col("mean_abs_coef").alias("mean_coef"), F.lit(0.0).alias("std_coef"), "cv_coef")
    path = fresh_path(t.spark, "coefficients") + ".csv"
    sinks.write_coefficients(c, path)
    sinks.write_coefficients(c.withColumn("mean_abs_coef", F.lit(0.0)), path)
    out = L.load_coefficients(t.spark, path)
    return out.select("feature", R("mean_abs_coef", 6).alias("mean_abs_coef"), R("cv_coef", 6).alias("cv_coef"))


@query("load_params", f"SELECT CAST(count(*) % 50 AS INT) AS rank, 10 AS max_iter, 0.05 AS reg, true AS tuned, {dec('stddev_pop(rating)', 6)} AS rmse FROM ratings")
def _(t):
    row = t.ratings().agg(F.count("*").alias("n"), F.stddev_pop(C.RATING).alias("rmse")).first()
    path = fresh_path(t.spark, "params")
    sinks.write_params(t.spark, {"rank": row["n"] % 50, "max_iter": 10, "reg": 0.05}, row["rmse"], path)
    return L.load_params(t.spark, path, {"rank": 35, "max_iter": 10, "reg": 0.0934}).withColumn("rmse", R("rmse", 6))


@query("write_report", f"SELECT 'global mean' AS model, {dec('stddev_pop(rating)', 4)} AS rmse FROM ratings")
def _(t):
    report = t.ratings().agg(F.stddev_pop(C.RATING).alias("s")).select(F.lit("global mean").alias("model"), R("s", 4).alias("rmse"))
    path = sinks.write_report(report, fresh_path(t.spark, "reports"), datetime.date(2024, 1, 31))
    return t.spark.read.schema("model string, rmse double").csv(path, header=True)


@query("write_implicit_ratings", _IMPLICIT)
def _(t):
    path = fresh_path(t.spark, "implicit") + ".csv"
    sinks.write_implicit_ratings(stats.implicit_ratings(clean_library(t.library())), path)
    return L.load_ratings(t.spark, path).drop(C.TIMESTAMP)


@query("write_library_template", f"""
    SELECT s.movieId, title, genres, n AS rating_count, {dec('m', 6)} AS rating_mean, 0 AS n_watched, 0 AS wishlist, 0 AS recent, 0 AS top10
    FROM istats s JOIN items i ON s.movieId = i.movieId ORDER BY n DESC, m DESC, s.movieId LIMIT 100""")
def _(t):
    path = fresh_path(t.spark, "template") + ".csv"
    sinks.write_library_template(t.ratings(), t.items(), path)
    return L.load_library(t.spark, path).withColumn("rating_mean", R("rating_mean", 6))
