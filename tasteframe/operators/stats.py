"""Descriptive statistics over ratings, items, genres and tags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.functions import scalars as S
from tasteframe.operators import ranking
from tasteframe.operators.filters import active_library
from tasteframe.scratch import materialise


def global_mean(ratings: DataFrame) -> DataFrame:
    return ratings.agg(F.avg(C.RATING).alias("global_mean"))


def global_mean_value(ratings: DataFrame) -> Column:
    """The global mean as a scalar subquery."""
    return global_mean(ratings).scalar()


def item_stats(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy(C.ITEM).agg(
        F.count(C.RATING).alias("rating_count"), F.avg(C.RATING).alias("rating_mean")
    )


def item_stats_full(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, Bayesian mean and inverse popularity of every item.

    Eager: the sums per item are written, so that the ratings are read once.
    """
    agg = materialise(ratings.groupBy(C.ITEM).agg(
        F.count(C.RATING).alias("n"), F.sum(C.RATING).alias("t"), F.stddev_samp(C.RATING).alias("s")
    ), "item-sums").withColumn("m", F.col("t") / F.col("n"))
    gm = agg.agg(F.sum("t") / F.sum("n")).scalar()
    base = items.select(C.ITEM).join(agg, C.ITEM, "left").select(
        C.ITEM,
        F.coalesce("n", F.lit(0)).alias("movie_n_ratings"),
        F.coalesce("m", gm).alias("movie_mean_rating"),
        F.coalesce("s", F.lit(0.0)).alias("movie_std_rating"),
    )
    return base.select(
        "*",
        bayesian_mean("movie_n_ratings", "movie_mean_rating", gm).alias("movie_bayesian_mean"),
        inverse_popularity("movie_n_ratings").alias("movie_inverse_popularity"),
    )


def weighted_score(n: str, mean: str, prior: Column, min_votes: int = C.FEATURED_MIN_VOTES) -> Column:
    total = F.col(n) + min_votes
    return F.col(n) / total * F.col(mean) + min_votes / total * prior


def bayesian_mean(n: str, mean: str, prior: Column, m: int = C.BAYESIAN_M) -> Column:
    return S.shrunk_mean(n, mean, prior, m)


def inverse_popularity(n: str) -> Column:
    return 1 / (F.col(n) + 1)


def stats_with_items(ratings: DataFrame, items: DataFrame) -> DataFrame:
    return item_stats(ratings).join(items, C.ITEM, "left")


def scored_items(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """Item statistics with the score. The global mean comes from the sums per item, not from a second
    pass over the ratings: both uses of the sums share one shuffle.
    """
    sums = ratings.groupBy(C.ITEM).agg(F.count(C.RATING).alias("rating_count"), F.sum(C.RATING).alias("_sum"))
    prior = sums.agg(F.sum("_sum") / F.sum("rating_count")).scalar()
    means = sums.select(C.ITEM, "rating_count", (F.col("_sum") / F.col("rating_count")).alias("rating_mean"))
    return means.join(items, C.ITEM, "left").withColumn(
        "weighted_score", weighted_score("rating_count", "rating_mean", prior)
    )


def featured_items(ratings: DataFrame, items: DataFrame, limit: int | None = None) -> DataFrame:
    """Items by weighted score, then count, then id."""
    out = scored_items(ratings, items).orderBy(
        F.col("weighted_score").desc(), F.col("rating_count").desc(), C.ITEM
    )
    return out if limit is None else out.limit(limit)


def popular_library(ratings: DataFrame, items: DataFrame, n: int = C.LIBRARY_TEMPLATE_SIZE) -> DataFrame:
    top = item_stats(ratings).orderBy(F.col("rating_count").desc(), F.col("rating_mean").desc(), C.ITEM).limit(n)
    return top.join(items, C.ITEM, "left").select(C.ITEM, C.TITLE, C.GENRES, "rating_count", "rating_mean")


def dataset_summary(ratings: DataFrame) -> DataFrame:
    """Counts of ratings, users and items, and the rating values in order.

    Users and items are counted from their own distinct lists, each partially aggregated first. Eager: the ratings are written
    once, whatever they are derived from, and read per list.
    """
    ratings = materialise(ratings.select(C.USER, C.ITEM, C.RATING), "summary")
    users = ratings.select(C.USER).distinct().agg(F.count("*")).scalar()
    items = ratings.select(C.ITEM).distinct().agg(F.count("*")).scalar()
    levels = F.array_join(F.transform(F.array_sort(F.collect_set(C.RATING)), lambda x: F.format_number(x, 2)), ",")
    return ratings.agg(F.count("*").alias("n_ratings"), levels.alias("rating_values")).select(
        "n_ratings", users.alias("n_users"), items.alias("n_items"), "rating_values"
    )


def sparsity(ratings: DataFrame) -> DataFrame:
    s = dataset_summary(ratings)
    return s.select(
        "n_ratings", "n_users", "n_items",
        (1 - F.col("n_ratings") / (F.col("n_users").cast("double") * F.col("n_items"))).alias("sparsity"),
    )


def distinct_values(ratings: DataFrame, column: str) -> DataFrame:
    return ratings.select(column).distinct()


def ratings_per_user(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy(C.USER).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), C.USER)


def predictions_per_user(test: DataFrame) -> DataFrame:
    return test.groupBy(C.USER).agg(F.count("*").alias("n_predictions")).orderBy(
        F.col("n_predictions").desc(), C.USER
    )


def exact_quantiles(df: DataFrame, column: str, points: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation: one row, one array in the order of ``points``.

    For columns with few distinct values (counts, years, ratings): equal values are counted first and
    the final step holds the distinct ones. ``wide_quantiles`` takes any column.
    """
    hist = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("freq"))
    return hist.agg(
        F.percentile(F.col(column), F.array(*[F.lit(float(p)) for p in points]), F.col("freq")).alias("q")
    )


def wide_quantiles(df: DataFrame, column: str, points: Sequence[float]) -> DataFrame:
    """Exact quantiles of a column with any number of distinct values, in the form of ``exact_quantiles``.

    Counted values are dealt into sampled ranges. Only range totals are summed up in one task; positions inside a
    range are summed range by range, and the values at the wanted positions are picked by an aggregate.
    Eager: the counted values are written once, being read several times.
    """
    v = F.col(column).cast("double")
    hist = df.where(F.col(column).isNotNull()).groupBy(v.alias("v")).agg(F.count("*").alias("freq"))
    hist = ranking.in_ranges(hist, F.col("v"), name="bin")
    n = hist.agg(F.sum("freq")).scalar()
    totals = hist.groupBy("bin").agg(F.sum("freq").alias("t"))
    before = totals.select("bin", (F.sum("t").over(W.orderBy("bin")) - F.col("t")).alias("before"))
    upto = F.sum("freq").over(W.partitionBy("bin").orderBy("v"))
    placed = hist.withColumn("upto", upto).join(before, "bin").select(
        "v", (F.col("before") + F.col("upto") - F.col("freq")).alias("first"), (F.col("before") + F.col("upto")).alias("end"))

    def at(position: Column) -> Column:
        return F.max(F.when((F.col("first") <= position) & (position < F.col("end")), F.col("v")))

    values = []
    for p in points:
        h = (n - 1) * F.lit(float(p))
        low, high = at(F.floor(h)), at(F.ceil(h))
        values.append(low + (high - low) * F.max(h - F.floor(h)))
    return placed.agg(F.array(*values).alias("q"))


ACTIVITY_POINTS = {"median": 0.5, "q10": 0.1, "q20": 0.2, "q70": 0.7, "q90": 0.9, "q95": 0.95, "q98": 0.98}


def activity_quantiles(ratings: DataFrame) -> DataFrame:
    counts = ratings.groupBy(C.USER).agg(F.count("*").alias("n"))
    q = exact_quantiles(counts, "n", list(ACTIVITY_POINTS.values()))
    return q.select(*[F.col("q")[i].alias(name) for i, name in enumerate(ACTIVITY_POINTS)])


def describe(df: DataFrame, column: str) -> DataFrame:
    """count, mean, sample std, min, quartiles, max: one row."""
    quartiles = wide_quantiles(df, column, [0.25, 0.5, 0.75]).scalar()
    c = F.col(column)
    return df.agg(
        F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
        F.min(c).alias("min"), F.max(c).alias("max"),
    ).withColumn("_q", quartiles).select(
        "count", "mean", "std", "min",
        F.col("_q")[0].alias("p25"), F.col("_q")[1].alias("p50"), F.col("_q")[2].alias("p75"), "max",
    )


def power_users(ratings: DataFrame, q: float = 0.98) -> DataFrame:
    counts = ratings.groupBy(C.USER).agg(F.count("*").alias("n"))
    threshold = exact_quantiles(counts, "n", [q]).select(F.col("q")[0]).scalar()
    return counts.where(F.col("n") >= threshold)


def ratings_of_selected_users(ratings: DataFrame, users: DataFrame) -> DataFrame:
    return ratings.join(users.select(C.USER), C.USER, "left_semi")


def power_user_stats(ratings: DataFrame, q: float = 0.98) -> DataFrame:
    """Mean, variance and deviation (sample) of each power user's ratings."""
    return ratings_of_selected_users(ratings, power_users(ratings, q)).groupBy(C.USER).agg(
        F.avg(C.RATING).alias("mean"), F.var_samp(C.RATING).alias("var"), F.stddev_samp(C.RATING).alias("std")
    )


def user_stats(ratings: DataFrame) -> DataFrame:
    """Count, mean and population deviation per user (0 for a single rating)."""
    return ratings.groupBy(C.USER).agg(
        F.count("*").alias("u_count"), F.avg(C.RATING).alias("u_mean"), F.stddev_pop(C.RATING).alias("u_std")
    )


def item_popularity(ratings: DataFrame) -> DataFrame:
    """Share of users who rated the item."""
    n_users = ratings.select(C.USER).distinct().agg(F.count("*")).scalar()
    return ratings.groupBy(C.ITEM).agg((F.count("*") / n_users).alias("popularity"))


def unrated_items(items: DataFrame, ratings: DataFrame) -> DataFrame:
    return items.join(ratings.select(C.ITEM).distinct(), C.ITEM, "left_anti")


def top_genre_combinations(items: DataFrame, k: int = 5, *, min_size: int = 1) -> DataFrame:
    genres = S.split_genres(C.GENRES)
    return (
        items.where(F.size(genres) >= min_size)
        .groupBy(S.sorted_set(genres).alias("combination"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), "combination")
        .limit(k)
    )


def clean_tags(tags: DataFrame) -> DataFrame:
    """Distinct cleaned tags of the items, a row each."""
    return tags.select(C.ITEM, S.clean_tag(F.coalesce("tag", F.lit("nan"))).alias("tag")).distinct()


def tags_per_item(tags: DataFrame) -> DataFrame:
    """Distinct cleaned tags per item, in order. Copies are removed before tags are gathered."""
    return clean_tags(tags).groupBy(C.ITEM).agg(F.array_sort(F.collect_list("tag")).alias("tags"))


def top_tag_combinations(tags: DataFrame, k: int = 5) -> DataFrame:
    return (
        tags_per_item(tags).where(F.size("tags") >= 2)
        .groupBy(F.array_join("tags", "|").alias("combination"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), "combination")
        .limit(k)
    )


def available_genres(items: DataFrame) -> DataFrame:
    return items.select(F.explode(S.listed_genres(C.GENRES)).alias("genre")).distinct().orderBy("genre")


def tag_counts(tags: DataFrame, items: DataFrame) -> DataFrame:
    n = tags.groupBy(C.ITEM).agg(F.count("*").alias("n_tags"))
    return items.select(C.ITEM).join(n, C.ITEM, "left").select(C.ITEM, F.coalesce("n_tags", F.lit(0)).alias("n_tags"))


def tag_frequency_lookup(tags: DataFrame) -> DataFrame:
    """Every tag row with the number of rows that carry the same tag."""
    freq = tags.groupBy("tag").agg(F.count("*").alias("tag_frequency"))
    return tags.join(freq, "tag")


def avg_tag_frequency(tags: DataFrame, items: DataFrame) -> DataFrame:
    """Mean global tag frequency over an item's tag rows; rows are counted per (item, tag) first."""
    cells = tags.groupBy(C.ITEM, "tag").agg(F.count("*").alias("c"))
    freq = cells.groupBy("tag").agg(F.sum("c").alias("f"))
    per_item = cells.join(freq, "tag").groupBy(C.ITEM).agg(
        (F.sum(F.col("c") * F.col("f")) / F.sum("c")).alias("a")
    )
    return items.select(C.ITEM).join(per_item, C.ITEM, "left").select(
        C.ITEM, F.coalesce("a", F.lit(0.0)).alias("avg_tag_frequency")
    )


def implicit_ratings(library: DataFrame, *, user_id: int = C.IMPLICIT_USER) -> DataFrame:
    """Active library rows as ratings, stamped with the time of the run.

    A library that names its users keeps them; otherwise all rows belong to ``user_id``.
    """
    user = F.col(C.USER) if C.USER in library.columns else F.lit(user_id).cast("long")
    return active_library(library).select(
        user.alias(C.USER), C.ITEM,
        S.implicit_rating("n_watched", "wishlist", "recent", "top10").alias(C.RATING),
        F.unix_timestamp().alias(C.TIMESTAMP),
    )


def user_profile(ratings: DataFrame, items: DataFrame, *, n_genres: int = 3, n_items: int = 5) -> DataFrame:
    """Rating count, mean, favourite genres and best rated titles per user. Eager: the ratings are written once."""
    ratings = materialise(ratings.select(C.USER, C.ITEM, C.RATING), "profile")
    rated = ratings.join(items, C.ITEM, "left")
    base = ratings.groupBy(C.USER).agg(
        F.count("*").alias("n_ratings"), S.fixed_round(F.avg(C.RATING), 2).alias("avg_rating")
    )
    genres = rated.select(C.USER, C.RATING, F.explode(S.listed_genres(C.GENRES)).alias("genre")).groupBy(
        C.USER, "genre"
    ).agg(F.count("*").alias("n"))
    by_count = W.partitionBy(C.USER).orderBy(F.col("n").desc(), "genre")
    top_genres = genres.withColumn("r", F.row_number().over(by_count)).where(F.col("r") <= n_genres).groupBy(
        C.USER
    ).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "genre"))), lambda x: x["genre"]), "|").alias("top_genres"))
    by_rating = W.partitionBy(C.USER).orderBy(F.col(C.RATING).desc(), C.ITEM)
    top_items = rated.withColumn("r", F.row_number().over(by_rating)).where(F.col("r") <= n_items).groupBy(
        C.USER
    ).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", C.ITEM))), lambda x: x[C.ITEM].cast("string")), "|").alias("top_items"))
    return base.join(top_genres, C.USER, "left").join(top_items, C.USER, "left")
