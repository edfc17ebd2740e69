"""Joins around the catalogue: alignment, metadata, details, directories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.functions import scalars as S
from tasteframe.operators import stats


def align_to_items(items: DataFrame, values: DataFrame, fill: dict[str, float | int | str]) -> DataFrame:
    """One row per catalogue item; missing values get the given fill."""
    out = items.select(C.ITEM).join(values, C.ITEM, "left")
    return out.fillna(fill)


def json_extract_metadata(payloads: DataFrame) -> DataFrame:
    """Raw payload texts as columns; an absent payload gives a row with ``tmdb_found`` 0."""
    p = F.from_json("payload", C.PAYLOAD_SCHEMA)
    poster = F.col("p.poster_path")
    return payloads.withColumn("p", p).select(
        C.ITEM, "tmdbId", "p.*",
        F.when(F.col("payload").isNotNull(), F.when(F.length(poster) > 0, F.concat(F.lit(C.POSTER_PREFIX), poster)).otherwise("")).alias("poster_url"),
        F.when(F.col("payload").isNull(), 0).alias("tmdb_found"),
    )


def enrich_with_metadata(df: DataFrame, metadata: DataFrame, columns: Sequence[str] = ("poster_url", "overview", "runtime", "vote_average")) -> DataFrame:
    """Add metadata columns as text; "" where the item has none."""
    m = metadata.select(C.ITEM, *columns)
    return df.join(m, C.ITEM, "left").withColumns({
        c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns
    })


def item_detail(
    items: DataFrame, metadata: DataFrame, ratings: DataFrame, movie_id: int | None = None
) -> DataFrame:
    """Catalogue row with metadata, rating mean and count: one item, or all of them."""
    if movie_id is not None:
        items, metadata, ratings = (d.where(F.col(C.ITEM) == int(movie_id)) for d in (items, metadata, ratings))
    agg = ratings.groupBy(C.ITEM).agg(
        S.fixed_round(F.avg(C.RATING), 2).alias("rating_mean"), F.count("*").alias("rating_count")
    )
    wanted = ("poster_url", "overview", "runtime", "vote_average", "vote_count", "popularity", "release_date")
    out = enrich_with_metadata(items.select(C.ITEM, C.TITLE, C.GENRES), metadata, wanted)
    return out.join(agg, C.ITEM, "left").withColumn("rating_count", F.coalesce("rating_count", F.lit(0)))


def user_directory(ratings: DataFrame, users: DataFrame) -> DataFrame:
    """Rating users and registered users, each once, with a display name."""
    ids = ratings.where(F.col(C.USER) != C.IMPLICIT_USER).select(F.col(C.USER).alias("user_id")).distinct()
    named = users.select("user_id", "name")
    return ids.join(named, "user_id", "full").select(
        "user_id", F.coalesce("name", F.concat(F.lit("User "), F.col("user_id").cast("string"))).alias("name")
    ).orderBy("user_id")


def featured_table(ratings: DataFrame, items: DataFrame, metadata: DataFrame) -> DataFrame:
    """Featured items with metadata, best first, and each item's listed genres."""
    scored = enrich_with_metadata(stats.scored_items(ratings, items), metadata)
    return scored.withColumn("listed_genres", F.array_join(S.listed_genres(C.GENRES), "|")).orderBy(
        F.col("weighted_score").desc(), F.col("rating_count").desc(), C.ITEM
    )


def preview_texts(metadata: DataFrame, n: int = 150) -> DataFrame:
    return metadata.select(
        C.ITEM, S.truncate_with_ellipsis("overview", n).alias("preview"), S.release_year("release_date").alias("release_year")
    )


#: Users that an item meets in one row of ``user_item_pairs``.
BLOCK = 1000


def ratings_with_features(ratings: DataFrame, features: DataFrame) -> DataFrame:
    """Each rating with its item's feature array (null where the item is not in the catalogue)."""
    return ratings.select(C.USER, C.ITEM, C.RATING).join(features, C.ITEM, "left")


def user_item_pairs(users: Sequence[int] | DataFrame, items: DataFrame) -> DataFrame:
    """(userId, movieId) of all given users and items: the list that was asked for, as large as their product.

    Users are dealt into blocks of about BLOCK ids; an item meets each block once, so no join row holds more than a block. To get
    only the best items of very many users, ``scoring.top_n_unseen`` lists no pairs.
    """
    spark = items.sparkSession
    if not isinstance(users, DataFrame):
        users = spark.createDataFrame([(int(u),) for u in users], f"{C.USER} long")
    users = users.select(F.col(C.USER).cast("long").alias(C.USER)).dropna().distinct()
    blocks = max(1, -(-users.count() // BLOCK))
    dealt = users.groupBy(F.pmod(F.xxhash64(C.USER), F.lit(blocks)).alias("_block")).agg(F.collect_list(C.USER).alias("_users"))
    spread = items.select(C.ITEM, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("_block"))
    return spread.join(dealt, "_block").select(F.explode("_users").alias(C.USER), C.ITEM)


def anti_testset(ratings: DataFrame, users: Sequence[int] | DataFrame) -> DataFrame:
    """Every rated-by-someone item the given users (a list, or a table) have not rated, filled with the global mean.

    Users without ratings are left out. The pairs are (number of users) x (number of items); see ``user_item_pairs``.
    """
    if not isinstance(users, DataFrame):
        users = ratings.sparkSession.createDataFrame([(int(u),) for u in users], f"{C.USER} long")
    asked = users.select(F.col(C.USER).cast("long").alias(C.USER)).distinct()
    known = ratings.select(C.USER, C.ITEM).join(asked, C.USER, "left_semi")
    pairs = user_item_pairs(known.select(C.USER).distinct(), ratings.select(C.ITEM).distinct())
    return pairs.join(known, [C.USER, C.ITEM], "left_anti").withColumn(
        "fill", stats.global_mean_value(ratings)
    )
