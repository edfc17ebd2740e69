"""Constant, random and mean predictions, and what happens to impossible ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.functions import scalars as S
from tasteframe.operators import ranking, stats

SPAN = C.RATING_MAX - C.RATING_MIN


def predict_constant(targets: DataFrame, value: float = 2.0) -> DataFrame:
    return targets.withColumn("est", F.lit(float(value)))


def predict_random_uniform(targets: DataFrame, *, seed: int = 0) -> DataFrame:
    """Uniform on the scale, the same value for the same (user, item, seed)."""
    u = ranking.seeded_number(C.USER, C.ITEM, seed=seed) / float(1 << 60)
    return targets.withColumn("est", F.lit(C.RATING_MIN) + u * SPAN)


def predict_random_score(targets: DataFrame) -> DataFrame:
    """Uniform on the scale, different in every run."""
    return targets.withColumn("est", F.lit(C.RATING_MIN) + F.rand() * SPAN)


def predict_global_mean(train: DataFrame, targets: DataFrame) -> DataFrame:
    return targets.withColumn("est", stats.global_mean_value(train))


def predict_item_mean(train: DataFrame, targets: DataFrame) -> DataFrame:
    means = train.groupBy(C.ITEM).agg(F.avg(C.RATING).alias("est"))
    return prediction_fallback(targets.join(means, C.ITEM, "left"), train)


def predict_random_sample(train: DataFrame, targets: DataFrame, *, seed: int = 0) -> DataFrame:
    """One of the user's own train ratings.

    Ratings are counted per (user, value); a seeded position in the user's count picks the value, so
    every rating is equally likely and no user's rows are gathered.
    """
    counts = train.groupBy(C.USER, C.RATING).agg(F.count("*").alias("c"))
    upto = F.sum("c").over(W.partitionBy(C.USER).orderBy(C.RATING))
    total = F.sum("c").over(W.partitionBy(C.USER))
    bands = counts.select(C.USER, F.col(C.RATING).alias("est"), (upto - F.col("c")).alias("lo"), upto.alias("hi"), total.alias("n"))
    at = ranking.seeded_number(C.USER, C.ITEM, seed=seed) % F.col("n")
    keys = targets.select(C.USER, C.ITEM)
    picked = keys.join(bands, C.USER).where((at >= F.col("lo")) & (at < F.col("hi"))).select(C.USER, C.ITEM, "est")
    return prediction_fallback(targets.join(picked, [C.USER, C.ITEM], "left"), train)


def prediction_fallback(predictions: DataFrame, train: DataFrame) -> DataFrame:
    """Missing estimates become the global mean and are flagged; the rest is bounded to the scale."""
    return predictions.withColumns({
        "was_impossible": F.col("est").isNull(),
        "est": F.coalesce(S.clip("est"), stats.global_mean_value(train)),
    })


def bias_model(train: DataFrame, *, reg_item: float = 10.0, reg_user: float = 15.0) -> tuple[DataFrame, DataFrame]:
    """Shrunk item and user biases around the global mean: (movieId, b_i), (userId, b_u)."""
    gm = stats.global_mean_value(train)
    items = train.groupBy(C.ITEM).agg(
        (F.sum(F.col(C.RATING)) - F.count("*") * gm).alias("s"), F.count("*").alias("n")
    ).select(C.ITEM, (F.col("s") / (reg_item + F.col("n"))).alias("b_i"))
    users = train.join(items, C.ITEM).groupBy(C.USER).agg(
        (F.sum(F.col(C.RATING) - F.col("b_i")) - F.count("*") * gm).alias("s"), F.count("*").alias("n")
    ).select(C.USER, (F.col("s") / (reg_user + F.col("n"))).alias("b_u"))
    return items, users


def predict_bias(train: DataFrame, targets: DataFrame) -> DataFrame:
    """mu + b_u + b_i, bounded; an unknown user or item adds nothing."""
    items, users = bias_model(train)
    est = stats.global_mean_value(train) + F.coalesce("b_u", F.lit(0.0)) + F.coalesce("b_i", F.lit(0.0))
    return targets.join(items, C.ITEM, "left").join(users, C.USER, "left").withColumn("est", S.clip(est)).drop("b_i", "b_u")
