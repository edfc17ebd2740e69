"""Splits, protocols and metrics.

Predictions carry userId, movieId, rating (the true one) and est. Every metric is one row; none
collects a user's rows into one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.functions import scalars as S
from tasteframe.operators import ranking, stats


def is_test_row(share: float, seed: int) -> Column:
    """A row split by a hash of the ids: the same rows in every run and plan."""
    return ranking.seeded_number(C.USER, C.ITEM, seed=seed) % 10_000 < int(share * 10_000)


def split_train_test(ratings: DataFrame, *, share: float = 0.20, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    test = is_test_row(share, seed)
    return ratings.where(~test), ratings.where(test)


def leave_one_out(ratings: DataFrame, *, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """One rating per user to the test side, the rest to the train side."""
    held = ranking.pick_one_per_user(ratings, seed=seed)
    return ratings.join(held.select(C.USER, C.ITEM), [C.USER, C.ITEM], "left_anti"), held


def errors(predictions: DataFrame) -> DataFrame:
    d = F.col(C.RATING) - F.col("est")
    mse = F.avg(d * d)
    return predictions.agg(F.sqrt(mse).alias("rmse"), F.avg(F.abs(d)).alias("mae"), mse.alias("mse"))


def estimate_ranges(cells: DataFrame, *, buckets: int = 256, large: int = 10_000) -> DataFrame:
    """``cells`` with ``b``, the range their estimate falls in: ranges ascend, and equal estimates share one.

    Users of more than ``large`` cells get up to ``buckets`` ranges of about equally many of their own cells, cut at
    approximate quantiles, so estimates that lie close together are spread as well; others get one range.
    """
    many = cells.groupBy(C.USER).agg(F.count("*").alias("n")).where(F.col("n") > large).select(C.USER)
    steps = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    cuts = cells.join(many, C.USER, "left_semi").groupBy(C.USER).agg(F.percentile_approx("est", steps, 10 * buckets).alias("cuts"))
    place = F.size(F.filter("cuts", lambda c: c < F.col("est")))
    return cells.join(cuts, C.USER, "left").withColumn("b", F.when(F.col("cuts").isNotNull(), place).otherwise(0)).drop("cuts")


def fcp(predictions: DataFrame, *, mode: str = "sum", buckets: int = 256, large: int = 10_000) -> DataFrame:
    """Fraction of concordant pairs, counted without listing pairs.

    A pair of one user's rows with r_i > r_j is concordant when est_i > est_j, else discordant. Rows
    are counted per (user, rating, est) first. For every rating level below, the number of rows with
    a smaller estimate is a running sum: over ranges of the user's estimates, and inside a range. A large
    user's rows are therefore spread over (level, range) groups, however close the estimates are.

    ``sum`` adds the counts over users; ``mean`` averages each count over the users that have one.
    """
    cells = predictions.groupBy(C.USER, C.RATING, "est").agg(F.count("*").alias("c"))
    cells = estimate_ranges(cells, buckets=buckets, large=large)
    levels = cells.groupBy(C.USER, C.RATING).agg(F.sum("c").alias("n"))
    below = levels.select(C.USER, F.col(C.RATING).alias("level"), F.col("n").alias("n_level"))
    # Every cell asks each lower level of its user; there are as many levels as rating values.
    asks = cells.join(below, C.USER).where(F.col("level") < F.col(C.RATING)).select(
        C.USER, "level", "b", "est", F.col("c").alias("ask"), "n_level", F.lit(0).cast("long").alias("have"))
    rows = asks.unionByName(cells.select(
        C.USER, F.col(C.RATING).alias("level"), "b", "est", F.lit(0).cast("long").alias("ask"),
        F.lit(0).cast("long").alias("n_level"), F.col("c").alias("have")))
    per_bucket = rows.groupBy(C.USER, "level", "b").agg(F.sum("have").alias("h"))
    w_bucket = W.partitionBy(C.USER, "level").orderBy("b")
    per_bucket = per_bucket.select(C.USER, "level", "b", (F.sum("h").over(w_bucket) - F.col("h")).alias("before"))
    w_in = W.partitionBy(C.USER, "level", "b").orderBy("est")
    at_or_below = F.sum("have").over(w_in.rangeBetween(W.unboundedPreceding, W.currentRow))
    same = F.sum("have").over(w_in.rangeBetween(W.currentRow, W.currentRow))
    counted = rows.withColumn("smaller", at_or_below - same).where(F.col("ask") > 0)
    counted = counted.join(per_bucket, [C.USER, "level", "b"])
    good = F.col("ask") * (F.col("smaller") + F.col("before"))
    per_user = counted.groupBy(C.USER).agg(
        F.sum(good).alias("nc"), F.sum(F.col("ask") * F.col("n_level") - good).alias("nd"))
    if mode == "mean":
        nc = F.avg(F.when(F.col("nc") > 0, F.col("nc")))
        nd = F.avg(F.when(F.col("nd") > 0, F.col("nd")))
    else:
        nc, nd = F.sum("nc").cast("double"), F.sum("nd").cast("double")
    nc, nd = F.coalesce(nc, F.lit(0.0)), F.coalesce(nd, F.lit(0.0))
    return per_user.agg((nc / F.nullif(nc + nd, F.lit(0.0))).alias("fcp"))


def _discount(position: Column) -> Column:
    return 1 / F.log2((position + 1).cast("double"))


def ndcg_per_user(predictions: DataFrame, *, k: int = C.TOP_N, threshold: float = C.RELEVANCE_THRESHOLD) -> DataFrame:
    """Binary-relevance nDCG@k per user; 0 where nothing is relevant.

    The ideal list starts with all relevant rows, so its gain depends only on how many there are.
    """
    hit = F.when(F.col(C.RATING) >= threshold, _discount(F.col("predicted_rank"))).otherwise(0.0)
    dcg = ranking.predicted_rank(predictions, k).groupBy(C.USER).agg(F.sum(hit).alias("dcg"))
    relevant = predictions.groupBy(C.USER).agg(F.count_if(F.col(C.RATING) >= threshold).alias("rel"))
    steps = F.sequence(F.lit(1).cast("long"), F.least(F.col("rel"), F.lit(k)))
    ideal = F.when(F.col("rel") > 0, F.aggregate(steps, F.lit(0.0), lambda s, p: s + _discount(p))).otherwise(0.0)
    return dcg.join(relevant.select(C.USER, ideal.alias("idcg")), C.USER).select(
        C.USER, F.when(F.col("idcg") > 0, F.col("dcg") / F.col("idcg")).otherwise(0.0).alias("ndcg"))


def ndcg_at_k(predictions: DataFrame, *, k: int = C.TOP_N, threshold: float = C.RELEVANCE_THRESHOLD) -> DataFrame:
    return ndcg_per_user(predictions, k=k, threshold=threshold).agg(F.coalesce(F.avg("ndcg"), F.lit(0.0)).alias("ndcg"))


def intra_list_pairs(top_n: DataFrame, items: DataFrame) -> DataFrame:
    """Item pairs of each user's list with their genre distance. Lists hold n items, n being small."""
    lists = top_n.join(items.select(C.ITEM, C.GENRES), C.ITEM).groupBy(C.USER).agg(
        F.array_sort(F.collect_list(F.struct("rank", C.ITEM, C.GENRES))).alias("l"))
    first = lists.select(C.USER, "l", F.posexplode("l").alias("p", "a"))
    both = first.select(C.USER, "a", F.explode(F.slice("l", F.col("p") + 2, F.size("l"))).alias("b"))
    return both.select(
        C.USER, F.col(f"a.{C.ITEM}").alias("item_a"), F.col(f"b.{C.ITEM}").alias("item_b"),
        S.genre_jaccard_distance(F.col(f"a.{C.GENRES}"), F.col(f"b.{C.GENRES}")).alias("distance"))


def intra_list_diversity(top_n: DataFrame, items: DataFrame) -> DataFrame:
    per_user = intra_list_pairs(top_n, items).groupBy(C.USER).agg(F.avg("distance").alias("d"))
    return per_user.agg(F.coalesce(F.avg("d"), F.lit(0.0)).alias("diversity"))


def novelty_log2(top_n: DataFrame, popularity: DataFrame) -> DataFrame:
    """Mean over users of the mean -log2(popularity) of their lists; unknown items count 1e-10."""
    score = -F.log2(F.coalesce("popularity", F.lit(1e-10)))
    per_user = top_n.join(popularity, C.ITEM, "left").groupBy(C.USER).agg(F.avg(score).alias("s"))
    return per_user.agg(F.coalesce(F.avg("s"), F.lit(0.0)).alias("novelty"))


def novelty_rank(top_n: DataFrame, ranks: DataFrame) -> DataFrame:
    """Mean over users of the summed popularity ranks of their lists; unknown items take the last rank."""
    last = ranks.agg(F.count("*")).scalar()
    joined = top_n.select(C.USER, C.ITEM).join(ranks.select(C.ITEM, F.col("rank").alias("pop_rank")), C.ITEM, "left")
    per_user = joined.groupBy(C.USER).agg(F.sum(F.coalesce("pop_rank", last)).alias("s"))
    return per_user.agg(F.avg("s").alias("novelty_rank"))


def recs_vs_holdout(top_n: DataFrame, held: DataFrame) -> DataFrame:
    """Every held-out row with a flag: is the item in its user's list?"""
    found = top_n.select(C.USER, C.ITEM, F.lit(1).alias("f"))
    return held.select(C.USER, C.ITEM).join(found, [C.USER, C.ITEM], "left").select(
        C.USER, C.ITEM, F.coalesce("f", F.lit(0)).alias("hit"))


def hit_rate(top_n: DataFrame, held: DataFrame) -> DataFrame:
    return recs_vs_holdout(top_n, held).agg(F.coalesce(F.avg("hit"), F.lit(0.0)).alias("hit_rate"))


def compare_predictions(a: DataFrame, b: DataFrame, *, digits: int = 6) -> DataFrame:
    """Two prediction sets side by side with their agreement to the given digits."""
    x = a.select(C.USER, C.ITEM, F.col("est").alias("est_a"))
    y = b.select(C.USER, C.ITEM, F.col("est").alias("est_b"))
    return x.join(y, [C.USER, C.ITEM]).withColumn("equal", F.abs(F.col("est_a") - F.col("est_b")) < 0.5 * 10**-digits)


def report_row(name: str, predictions: DataFrame, items: DataFrame, ratings: DataFrame, *, n: int = C.TOP_N) -> DataFrame:
    """model, rmse, mae, ndcg, diversity, novelty, rounded to 4 digits."""
    top = ranking.top_n_per_user(predictions, n)
    e = errors(predictions)
    return e.select(
        F.lit(name).alias("model"), S.fixed_round("rmse", 4).alias("rmse"), S.fixed_round("mae", 4).alias("mae"),
        S.fixed_round(ndcg_at_k(predictions, k=n).scalar(), 4).alias(f"ndcg_{n}"),
        S.fixed_round(intra_list_diversity(top, items).scalar(), 4).alias("diversity"),
        S.fixed_round(novelty_log2(top, stats.item_popularity(ratings)).scalar(), 4).alias("novelty"),
    )
