"""Recommendation queries for individuals, new users and groups.

A model is a function (train, targets) -> predictions with est; impossible predictions already hold
the global mean. Users asked about are a parameter list or a table; batch forms rank per user.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.functions import scalars as S
from tasteframe.operators import blocks, hybrid, ranking
from tasteframe.operators.catalogue import enrich_with_metadata, user_item_pairs
from tasteframe.operators.filters import exclude_seen, mentioned_items
from tasteframe.operators.linear import content_predict, explain, explain_without_model
from tasteframe.operators.surprise import surprise_scores
from tasteframe.scratch import materialise

Model = Callable[[DataFrame, DataFrame], DataFrame]
Users = Sequence[int] | DataFrame


def candidates(items: DataFrame, train: DataFrame, users: Users) -> DataFrame:
    """Every catalogue item the given users have not rated: a list of ids, or a table of any length with their column."""
    return exclude_seen(user_item_pairs(users, items), train)


def predict_test_set(model: Model, train: DataFrame, keys: DataFrame, *, position: str) -> DataFrame:
    """(position, userId, movieId, rating): a row per row of ``keys`` in the order of their position column.

    Keys may repeat and stand in any order; each pair is scored once.
    """
    wanted = keys.select(C.USER, C.ITEM).distinct()
    scored = model(train, wanted).select(C.USER, C.ITEM, F.col("est").alias(C.RATING))
    return keys.select(position, C.USER, C.ITEM).join(scored, [C.USER, C.ITEM], "left").select(position, C.USER, C.ITEM, C.RATING).orderBy(position)


def _weights(models: dict[str, Model], weights: dict[str, float] | None) -> dict[str, float]:
    return weights or (C.HYBRID_WEIGHTS if "content" in models else C.HYBRID_WEIGHTS_NO_CONTENT)


def hybrid_scores(train: DataFrame, targets: DataFrame, models: dict[str, Model], weights: dict[str, float] | None = None) -> DataFrame:
    """(userId, movieId, final_score, one column per model): the fixed-weight sum of the model estimates."""
    w = _weights(models, weights)
    joined = hybrid.join_scores(targets, {f"{n}_score": m(train, targets).select(C.USER, C.ITEM, "est") for n, m in models.items()})
    total = sum((F.col(f"{n}_score") * w[n] for n in models), F.lit(0.0))
    return joined.withColumn("final_score", total)


def _present(scored: DataFrame, items: DataFrame, n: int, *, columns: Sequence[str]) -> DataFrame:
    """Rounded scores, the n best per user, titles and genres."""
    rounded = scored.withColumns({c: S.fixed_round(c, 3) for c in columns})
    top = ranking.top_n_per_user(rounded, n, est="final_score")
    return top.join(items.select(C.ITEM, C.TITLE, C.GENRES), C.ITEM, "left").select(
        C.USER, "rank", C.ITEM, C.TITLE, C.GENRES, *columns)


def recommend(
    train: DataFrame, items: DataFrame, users: Users, models: dict[str, Model], *,
    n: int = C.TOP_N, weights: dict[str, float] | None = None,
) -> DataFrame:
    """The n best unseen items of each given user by the weighted models."""
    scored = hybrid_scores(train, candidates(items, train, users), models, weights)
    if "content" not in models:
        scored = scored.withColumn("content_score", F.lit(0.0))
    return _present(scored, items, n, columns=["final_score", "svd_score", "itr_score", "content_score"])


#: Scores are shown with three digits: candidates may lie this much below the score to beat.
SLACK = 2e-3
MakeSource = Callable[[DataFrame, DataFrame, DataFrame, float], blocks.Source]


def recommend_all(
    train: DataFrame, items: DataFrame, models: dict[str, Model], sources: dict[str, MakeSource], *, users: DataFrame | None = None,
    n: int = C.TOP_N, weights: dict[str, float] | None = None, itr: dict | None = None, first: int = 4, report: dict | None = None,
) -> DataFrame:
    """The rows of ``recommend`` for all users of ``train`` (or a table of them), without a row per user and item.

    A threshold search. ``sources`` makes, for each model but "itr", the vectors whose dot product is its estimate; the itr model
    (parameters ``itr``) is known by bounds from the deviations and traits of an item's raters. Blocks of items give the candidates
    whose upper bound reaches the n-th best lower bound; the ``first`` x n best of them are scored by the models; of the rest only those
    whose upper bound reaches the n-th best score. The result is exact. ``report`` receives counts. Eager.
    """
    w = _weights(models, weights)
    train = materialise(train.select(C.USER, C.ITEM, C.RATING), "train")
    users = materialise((train if users is None else users).select(F.col(C.USER).cast("long").alias(C.USER)).dropna().distinct(), "users")
    linear = [make(train, users, items, w[name]) for name, make in sources.items()]
    near = blocks.itr_bounds(train, w["itr"], **(itr or C.ITR_PARAMS)) if "itr" in models else None
    found = blocks.best_unseen(users, items, train, linear, n, neighbours=near, slack=SLACK, report=report)
    place = F.row_number().over(W.partitionBy(C.USER).orderBy(F.col("upper").desc(), C.ITEM))
    found = materialise(found.withColumn("place", place), "candidates")
    scored = materialise(hybrid_scores(train, found.where(F.col("place") <= first * n).select(C.USER, C.ITEM), models, w), "scored")
    by_score = F.row_number().over(W.partitionBy(C.USER).orderBy(F.col("final_score").desc(), C.ITEM))
    least = scored.withColumn("r", by_score).where(F.col("r") == n).select(C.USER, F.col("final_score").alias("least"))
    rest = found.where(F.col("place") > first * n).join(least, C.USER).where(F.col("upper") >= F.col("least") - SLACK)
    rest = materialise(rest.select(C.USER, C.ITEM), "candidates")
    if report is not None:
        report |= {"candidates": found.count(), "scored": scored.count() + rest.count()}
    scored = scored.unionByName(hybrid_scores(train, rest, models, w))
    if "content" not in models:
        scored = scored.withColumn("content_score", F.lit(0.0))
    return _present(scored, items, n, columns=["final_score", "svd_score", "itr_score", "content_score"])


def surprise_me_all(
    models: DataFrame, features: DataFrame, train: DataFrame, items: DataFrame, *, users: DataFrame | None = None, n: int = C.TOP_N, report: dict | None = None,
) -> DataFrame:
    """The rows of ``surprise_me`` for all users with a model (or a table of users), in blocks. Eager."""
    users = (models if users is None else users).select(C.USER).distinct()
    source = blocks.content_source(models, features, train)
    top = blocks.best_unseen(users, items, train, [source], n, digits=3, report=report)
    return _single_source(top.select(C.USER, C.ITEM, "est"), items, n)


def _single_source(scored: DataFrame, items: DataFrame, n: int) -> DataFrame:
    rows = scored.withColumns({
        "final_score": F.col("est"), "svd_score": F.lit(0.0), "itr_score": F.lit(0.0), "content_score": F.col("est"),
    })
    return _present(rows, items, n, columns=["final_score", "svd_score", "itr_score", "content_score"])


def recommend_new_user(
    models: DataFrame | None, features: DataFrame | None, train: DataFrame, items: DataFrame, given: DataFrame, *, n: int = C.TOP_N,
) -> DataFrame:
    """Items a new user did not name, by the content model of the implicit profile (user -1).

    Without a content model for that profile: popular items. ``given`` (movieId) are the named items;
    their rating values are not used.
    """
    if models is None or features is None:
        return popular_fallback(train, items, given, n=n)
    wanted = items.select(F.lit(C.IMPLICIT_USER).cast("long").alias(C.USER), C.ITEM).join(given.select(C.ITEM), C.ITEM, "left_anti")
    return _single_source(content_predict(models, wanted, features, train), items, n)


def popular_unseen(ratings: DataFrame, seen: DataFrame, n: int) -> DataFrame:
    means = ratings.groupBy(C.ITEM).agg(F.avg(C.RATING).alias("score"))
    return means.join(seen.select(C.ITEM), C.ITEM, "left_anti").orderBy(F.col("score").desc(), C.ITEM).limit(n)


def popular_fallback(ratings: DataFrame, items: DataFrame, seen: DataFrame, *, n: int = C.TOP_N) -> DataFrame:
    """The n best rated items that were not seen."""
    top = popular_unseen(ratings, seen, n).join(items.select(C.ITEM, C.TITLE, C.GENRES), C.ITEM, "left")
    zero = F.lit(0.0)
    return top.select(
        C.ITEM, C.TITLE, C.GENRES, S.fixed_round("score", 3).alias("final_score"),
        zero.alias("svd_score"), zero.alias("itr_score"), zero.alias("content_score"))


def group_candidates(train: DataFrame, participants: DataFrame) -> DataFrame:
    """Participants x rated items, without the items anyone mentioned. Every participant must have a user_id."""
    ids = participants.select(F.coalesce(F.col("user_id").cast("long"), F.raise_error("a participant has no user_id").cast("long")).alias(C.USER))
    pool = train.select(C.ITEM).distinct().join(mentioned_items(participants), C.ITEM, "left_anti")
    return user_item_pairs(ids.distinct(), pool)


def recommend_group(
    train: DataFrame, items: DataFrame, participants: DataFrame, models: dict[str, Model], *,
    n: int = 8, strategy: str = "average", weights: dict[str, float] | None = None,
) -> DataFrame:
    """Items by the mean (``average``) or the smallest (``least_misery``) of the participants' scores."""
    if strategy not in ("average", "least_misery"):
        raise ValueError("strategy must be 'average' or 'least_misery'")
    scored = hybrid_scores(train, group_candidates(train, participants), models, weights)
    merge = F.min if strategy == "least_misery" else F.avg
    groups = scored.groupBy(C.ITEM).agg(
        S.fixed_round(merge("final_score"), 4).alias("group_score"), F.count("final_score").alias("n_users"))
    return _group_rows(groups, items, n)


def _group_rows(groups: DataFrame, items: DataFrame, n: int) -> DataFrame:
    top = ranking.recs_topn(groups, n, score="group_score")
    return top.join(items.select(C.ITEM, C.TITLE, C.GENRES), C.ITEM, "left").select(
        C.ITEM, F.coalesce(C.TITLE, F.col(C.ITEM).cast("string")).alias(C.TITLE), F.coalesce(C.GENRES, F.lit("")).alias(C.GENRES),
        "group_score", "n_users")


def recommend_group_surprise(
    vectors: DataFrame, items: DataFrame, ratings: DataFrame, participants: DataFrame, *, n: int = 8, seed: int = 0,
) -> DataFrame:
    """n of the 50 items that are close to the group's mean wishlist vector and little known."""
    wished = participants.select(F.explode(F.transform("wishlist", lambda x: x["id"])).alias(C.ITEM))
    scored = surprise_scores(vectors, wished, mentioned_items(participants), ratings)
    size = participants.agg(F.count("*")).scalar()
    drawn = ranking.top50_then_sample(scored, n, score="group_score", seed=seed)
    rows = drawn.select(C.ITEM, S.fixed_round("group_score", 6).alias("group_score")).withColumn("n_users", size)
    return _group_rows(rows, items, n)


def surprise_me(models: DataFrame, features: DataFrame, train: DataFrame, items: DataFrame, users: Users, *, n: int = C.TOP_N) -> DataFrame:
    """Unseen items by the content model on text vectors."""
    return _single_source(content_predict(models, candidates(items, train, users), features, train), items, n)


def recommendation_table(
    recs: DataFrame, metadata: DataFrame, items: DataFrame, *, models: DataFrame | None = None, names: DataFrame | None = None,
) -> DataFrame:
    """Shown rows: scores to two digits, a sentence per row, metadata."""
    pairs = recs.select(C.USER, C.ITEM)
    texts = explain_without_model(items, pairs) if models is None else explain(models, names, items, pairs)
    out = recs.withColumns({c: S.fixed_round(c, 2) for c in ("final_score", "svd_score", "itr_score")}).drop("content_score")
    return enrich_with_metadata(out.join(texts, [C.USER, C.ITEM]), metadata)


def group_recommendation_table(recs: DataFrame, metadata: DataFrame) -> DataFrame:
    out = recs.withColumn("group_score", S.fixed_round("group_score", 2))
    return enrich_with_metadata(out, metadata, ("poster_url", "overview", "vote_average"))
