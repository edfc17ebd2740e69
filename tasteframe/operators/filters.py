"""Projections, filters and checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.functions import scalars as S
from tasteframe.scratch import materialise


def project_user_item_rating(ratings: DataFrame) -> DataFrame:
    return ratings.select(C.USER, C.ITEM, C.RATING)


def rename_and_prefix_columns(
    df: DataFrame, *, renames: dict[str, str], prefix: str, keep: Sequence[str] = (C.ITEM,)
) -> DataFrame:
    """Rename keys, then prefix every other column that does not carry the prefix yet."""
    df = df.withColumnsRenamed(renames)
    return df.withColumnsRenamed({
        c: f"{prefix}{c}" for c in df.columns if c not in keep and not c.startswith(prefix)
    })


def fill_missing(df: DataFrame, values: dict[str, Column | str | float | int]) -> DataFrame:
    """Replace nulls per column; a value may be a constant or a scalar column."""
    return df.withColumns({
        c: F.coalesce(F.col(c), v if isinstance(v, Column) else F.lit(v)) for c, v in values.items()
    })


def filter_items(
    items: DataFrame, *, genre: str | None = None, year_min: int | None = None, year_max: int | None = None
) -> DataFrame:
    """Catalogue with its year; optional genre and inclusive year bounds."""
    out = items.withColumn("year", S.extract_year(C.TITLE))
    if genre and genre != "All":
        out = out.where(F.coalesce(F.col(C.GENRES).contains(genre), F.lit(False)))
    if year_min:
        out = out.where(F.col("year") >= int(year_min))
    if year_max:
        out = out.where(F.col("year") <= int(year_max))
    return out


def browse_items(
    items: DataFrame, *, query: str = "", genres: Sequence[str] = (), mood: str | Sequence[str] | None = None
) -> DataFrame:
    """Title search, every chosen genre, any genre of the mood."""
    q = query.lower().strip()
    out = items
    if q:
        out = out.where(F.contains(F.lower(C.TITLE), F.lit(q)))
    for g in genres:
        out = out.where(F.col(C.GENRES).contains(g))
    wanted = C.MOODS[mood] if isinstance(mood, str) and mood in C.MOODS else (mood or ())
    if isinstance(wanted, str):
        raise ValueError(f"unknown mood {wanted!r}; known: {sorted(C.MOODS)}")
    if wanted:
        any_of = F.lit(False)
        for g in wanted:
            any_of = any_of | F.col(C.GENRES).contains(g)
        out = out.where(any_of)
    return out


def items_by_mood(items: DataFrame) -> DataFrame:
    """How many catalogue items each mood keeps."""
    moods = F.array(*[
        F.struct(F.lit(m).alias("mood"), F.array(*[F.lit(g) for g in gs]).alias("names"))
        for m, gs in C.MOODS.items()
    ])
    hits = items.select(C.ITEM, C.GENRES, F.inline(moods)).where(
        F.exists("names", lambda g: F.contains(F.col(C.GENRES), g))
    )
    return hits.groupBy("mood").agg(F.count("*").alias("n_items"))


def seen_items(ratings: DataFrame, users: Sequence[int] | None = None) -> DataFrame:
    out = ratings.select(C.USER, C.ITEM)
    return out if users is None else out.where(F.col(C.USER).isin([int(u) for u in users]))


def exclude_seen(candidates: DataFrame, ratings: DataFrame) -> DataFrame:
    return candidates.join(ratings.select(C.USER, C.ITEM), [C.USER, C.ITEM], "left_anti")


def mentioned_items(participants: DataFrame) -> DataFrame:
    """Items liked or wished for by anyone in the group."""
    both = F.array_union(
        F.coalesce(F.transform("liked", lambda x: x["id"]), F.array().cast("array<bigint>")),
        F.coalesce(F.transform("wishlist", lambda x: x["id"]), F.array().cast("array<bigint>")),
    )
    return participants.select(F.explode(both).alias(C.ITEM)).distinct()


def exclude_mentioned(items: DataFrame, participants: DataFrame) -> DataFrame:
    return items.join(mentioned_items(participants), C.ITEM, "left_anti")


def active_library(library: DataFrame) -> DataFrame:
    return library.where(
        (F.col("n_watched") > 0) | (F.col("wishlist") == 1) | (F.col("recent") == 1) | (F.col("top10") == 1)
    )


def extreme_ratings(ratings: DataFrame) -> DataFrame:
    """Rows that hold the largest or the smallest rating. Eager: the ratings are written once."""
    ratings = materialise(ratings.select(C.USER, C.ITEM, C.RATING), "extremes")
    hi, lo = ratings.agg(F.max(C.RATING)).scalar(), ratings.agg(F.min(C.RATING)).scalar()
    kind = F.when(F.col(C.RATING) == hi, "max").when(F.col(C.RATING) == lo, "min")
    return ratings.select(C.USER, C.ITEM, C.RATING, kind.alias("extreme")).where(F.col("extreme").isNotNull())


def extreme_rating_counts(ratings: DataFrame) -> DataFrame:
    return extreme_ratings(ratings).groupBy("extreme", C.RATING).agg(F.count("*").alias("n"))


def select_features_by_coef(
    features: DataFrame, coefficients: DataFrame, *,
    importance: float = C.COEF_IMPORTANCE, cv: float = C.COEF_STABILITY,
) -> DataFrame:
    """Long feature rows whose coefficient is important and stable over users."""
    keep = coefficients.where(F.col("mean_abs_coef") > importance)
    if "cv_coef" in coefficients.columns:
        keep = keep.where(F.col("cv_coef") < cv)
    return features.join(keep.select("feature"), "feature", "left_semi")


def drop_sentinel_features(features: DataFrame, *, decades: bool = False) -> DataFrame:
    """Drop the no-genre column and, on request, the decades 1900 and 1910."""
    out = features.where(~F.col("feature").isin(C.NO_GENRES, f"genre_{C.NO_GENRES}"))
    if decades:
        out = out.where(~F.col("feature").isin([f"decade_{d}" for d in C.DROPPED_DECADES]))
    return out


def multi_valued_only(df: DataFrame, values: str) -> DataFrame:
    return df.where(F.size(values) >= 2)


def positive_similarity_only(sims: DataFrame) -> DataFrame:
    return sims.where(F.col("sim") > 0)


def exclude_implicit_user(ratings: DataFrame) -> DataFrame:
    return ratings.where(F.col(C.USER) != C.IMPLICIT_USER)


def validate_columns(df: DataFrame | Sequence[str], required: Sequence[str], *, ordered: bool = False) -> None:
    """Raise with the missing columns, or where the order must match, with the order found."""
    have = df.columns if isinstance(df, DataFrame) else list(df)
    missing = [c for c in required if c not in have]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    if ordered and have[: len(required)] != list(required):
        raise ValueError(f"columns must start with {list(required)}, found {have}")


def prediction_quality_check(predictions: DataFrame, est: str = "est") -> DataFrame:
    """Row count, column count, nulls per column, range of the estimates: one row, one pass."""
    return predictions.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(predictions.columns)).alias("n_columns"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in predictions.columns],
        F.min(est).alias("min_est"),
        F.max(est).alias("max_est"),
    )


def clean_user_input_ratings(raw: DataFrame, *, item: str = "item", value: str = "value") -> DataFrame:
    """Parse text ratings, bound them to the scale, drop what does not parse."""
    out = raw.select(
        *[c for c in raw.columns if c not in (item, value)],
        F.expr(f"try_cast({item} AS BIGINT)").alias(C.ITEM),
        F.expr(f"try_cast({value} AS DOUBLE)").alias(C.RATING),
    )
    valid = F.col(C.ITEM).isNotNull() & F.col(C.RATING).isNotNull() & ~F.isnan(C.RATING)
    return out.where(valid).withColumn(C.RATING, S.clip(C.RATING))
