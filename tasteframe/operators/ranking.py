"""Ranks, top-k and ordered selections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.scratch import materialise


def in_ranges(df: DataFrame, *order: Column, name: str = "_part") -> DataFrame:
    """Rows dealt into ranges of an order whose bounds Spark samples from the rows: even, however the values lie.

    Written once, as later steps must see the same ranges. Eager.
    """
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)
    return materialise(df.repartitionByRange(n, *order).withColumn(name, F.spark_partition_id()), "ranges")


def global_rank(df: DataFrame, *tie: str, value: str | None = None, name: str = "rank") -> DataFrame:
    """Unique ranks 1..N by (value descending, tie columns ascending) without sorting in one task.

    Rows are numbered inside sampled ranges of the order; only the row counts of the ranges are summed up. The tie
    columns make a key: rows that agree in all of them may be numbered in any order. Eager.
    """
    order = [F.col(value).desc(), *map(F.col, tie)] if value else [F.col(c) for c in tie]
    dealt = in_ranges(df, *order)
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    local = F.row_number().over(W.partitionBy("_part").orderBy(*order))
    ranked = dealt.withColumn("_r", local).join(before, "_part")
    return ranked.withColumn(name, F.col("_before") + F.col("_r")).drop("_part", "_r", "_before")


def popularity_rank(ratings: DataFrame) -> DataFrame:
    """Items ranked by rating count, ties by id: rank 1 is the most rated."""
    counts = ratings.groupBy(C.ITEM).agg(F.count("*").alias("n"))
    return global_rank(counts, C.ITEM, value="n")


def long_tail(ratings: DataFrame) -> DataFrame:
    """Rating frequency by rank, with the share of all ratings up to that rank.

    The running share comes from counts per distinct frequency: all items before rank r in the
    same frequency class add the same amount.
    """
    ranked = popularity_rank(ratings).withColumnRenamed("n", "frequency")
    classes = ranked.groupBy("frequency").agg(
        F.count("*").alias("_items"), F.min("rank").alias("_first")
    )
    # One row per distinct frequency (at most sqrt(2R)).
    mass = F.sum(F.col("frequency") * F.col("_items")).over(W.orderBy(F.col("frequency").desc()))
    total = classes.agg(F.sum(F.col("frequency") * F.col("_items"))).scalar()
    classes = classes.withColumn("_before", mass - F.col("frequency") * F.col("_items")).drop("_items")
    share = (F.col("_before") + F.col("frequency") * (F.col("rank") - F.col("_first") + 1)) / total
    return ranked.join(classes, "frequency").select(
        C.ITEM, "frequency", "rank", share.alias("cumulative_share")
    )


def id_mapping(ratings: DataFrame, column: str) -> DataFrame:
    """Raw id <-> contiguous index from 0, in id order."""
    ids = ratings.select(column).distinct()
    return global_rank(ids, column, name="position").select(
        column, (F.col("position") - 1).alias("position")
    )


def top_n_per_user(
    predictions: DataFrame, n: int = C.TOP_N, *, ties: str = "stable", seed: int = 0, est: str = "est"
) -> DataFrame:
    """The n best estimates per user. Ties: smallest item id, or a seeded random order.

    The rank filter is pushed below the shuffle (window group limit), so a user with very many
    rows is cut to n rows per map task first.
    """
    if ties not in ("stable", "random"):
        raise ValueError("ties must be 'stable' or 'random'")
    tie: list[Column] = [F.col(C.ITEM)]
    if ties == "random":
        tie = [F.xxhash64(F.lit(seed), C.USER, C.ITEM), F.col(C.ITEM)]
    w = W.partitionBy(C.USER).orderBy(F.col(est).desc(), *tie)
    return predictions.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def top_k_neighbours(sims: DataFrame, k: int, *, keys: Sequence[str] = ("u",), other: str = "v") -> DataFrame:
    """The k most similar per key, ties by the smallest id."""
    w = W.partitionBy(*keys).orderBy(F.col("sim").desc(), F.col(other))
    return sims.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def recs_topn(scored: DataFrame, n: int = C.TOP_N, *, score: str = "final_score") -> DataFrame:
    return scored.orderBy(F.col(score).desc(), C.ITEM).limit(n)


def sort_multi_key(df: DataFrame, keys: Sequence[tuple[str, bool]]) -> DataFrame:
    """Sort by (column, descending) pairs."""
    return df.orderBy(*[F.col(c).desc() if d else F.col(c).asc() for c, d in keys])


def predicted_rank(predictions: DataFrame, k: int) -> DataFrame:
    """First k positions per user by estimate."""
    w = W.partitionBy(C.USER).orderBy(F.col("est").desc(), C.ITEM)
    return predictions.withColumn("predicted_rank", F.row_number().over(w)).where(F.col("predicted_rank") <= k)


def ideal_rank(predictions: DataFrame, k: int) -> DataFrame:
    """First k positions per user by true rating."""
    w = W.partitionBy(C.USER).orderBy(F.col(C.RATING).desc(), C.ITEM)
    return predictions.withColumn("ideal_rank", F.row_number().over(w)).where(F.col("ideal_rank") <= k)


def seeded_number(*columns: str, seed: int = 0) -> Column:
    """A repeatable random-looking number of 60 bits: as a remainder it reaches every position of any table."""
    text = F.concat_ws(" ", *[F.col(c).cast("string") for c in columns], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def pick_one_per_user(ratings: DataFrame, *, seed: int = 0) -> DataFrame:
    """One seeded random rating per user, by an ordinary aggregate (no sort of a user's rows)."""
    pick = F.min_by(
        F.struct(C.ITEM, C.RATING), F.struct(seeded_number(C.USER, C.ITEM, seed=seed).alias("h"), F.col(C.ITEM))
    )
    return ratings.groupBy(C.USER).agg(pick.alias("p")).select(C.USER, "p.*")


def top50_then_sample(scored: DataFrame, n: int, *, score: str, seed: int = 0, pool: int = 50) -> DataFrame:
    """The best ``pool`` rows, n of them drawn without replacement, best first."""
    best = scored.orderBy(F.col(score).desc(), C.ITEM).limit(pool)
    return (
        best.orderBy(seeded_number(C.ITEM, seed=seed), C.ITEM).limit(n).orderBy(F.col(score).desc(), C.ITEM)
    )


def head_tail(df: DataFrame, n: int, *, keys: Sequence[tuple[str, bool]], tail: bool = False) -> DataFrame:
    """First or last n rows of an ordering."""
    flipped = [(c, d != tail) for c, d in keys]
    return sort_multi_key(df, flipped).limit(n)
