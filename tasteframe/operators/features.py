"""Item features as long blocks (movieId, feature, value) and as arrays.

A block holds the entries that exist; everything else is 0. Blocks are put side by side by union,
so a thousand features never become a thousand columns.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.functions import scalars as S
from tasteframe.operators import stats, text
from tasteframe.scratch import materialise


def _block(df: DataFrame, feature: Column, value: Column) -> DataFrame:
    return df.select(C.ITEM, feature.alias("feature"), value.cast("double").alias("value"))


def _columns_to_block(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Wide columns (column -> feature name) as long rows, in one pass."""
    cells = F.array(*[
        F.struct(F.lit(name).alias("feature"), F.col(c).cast("double").alias("value"))
        for c, name in columns.items()
    ])
    return df.select(C.ITEM, F.inline(cells))


def union_blocks(*blocks: DataFrame) -> DataFrame:
    out = blocks[0]
    for b in blocks[1:]:
        out = out.unionByName(b)
    return out


# --- single blocks -----------------------------------------------------------------------------

def feat_title_length(items: DataFrame) -> DataFrame:
    return _block(items, F.lit("n_character_title"), S.title_length(C.TITLE))


def item_years(items: DataFrame) -> DataFrame:
    """Year per item; items without one get the median of the others."""
    years = items.select(C.ITEM, S.extract_year(C.TITLE).alias("year"))
    median = stats.exact_quantiles(years, "year", [0.5]).select(F.col("q")[0]).scalar()
    return years.select(C.ITEM, F.coalesce(F.col("year").cast("double"), median).alias("year"))


def feat_year(items: DataFrame) -> DataFrame:
    return _block(item_years(items), F.lit("year"), F.col("year"))


def feat_decade_onehot(items: DataFrame, *, drop_early: bool = True) -> DataFrame:
    d = S.decade("year")
    out = item_years(items)
    if drop_early:
        out = out.where(~d.isin(list(C.DROPPED_DECADES)))
    return _block(out, F.concat(F.lit("decade_"), d.cast("string")), F.lit(1.0))


def feat_genre_onehot(items: DataFrame) -> DataFrame:
    return _block(items.select(C.ITEM, F.explode(S.listed_genres(C.GENRES)).alias("g")), F.col("g"), F.lit(1.0))


def feat_genre_interactions(items: DataFrame, products=tuple(C.GENRE_PRODUCTS)) -> DataFrame:
    """Genres, the products of named genres, and the decades."""
    listed = S.listed_genres(C.GENRES)
    cells = F.array(*[
        F.struct(
            F.lit("_".join(p)).alias("feature"),
            F.forall(F.array(*[F.lit(g) for g in p]), lambda g: F.array_contains(F.col("g"), g)).alias("on"),
        ) for p in products
    ])
    crossed = items.select(C.ITEM, listed.alias("g")).select(C.ITEM, F.inline(cells)).where("on")
    return union_blocks(
        feat_decade_onehot(items), feat_genre_onehot(items), _block(crossed, F.col("feature"), F.lit(1.0))
    )


def feat_genre_tfidf(items: DataFrame) -> DataFrame:
    return _block(text.genre_tfidf(items), F.concat(F.lit("genre_"), "token"), F.col("tfidf"))


def feat_genre_tfidf_poly(items: DataFrame) -> DataFrame:
    pairs = text.genre_tfidf_products(items)
    return union_blocks(
        feat_genre_tfidf(items), _block(pairs, F.concat(F.lit("genre_"), "token"), F.col("tfidf"))
    )


def n_genres(items: DataFrame) -> DataFrame:
    return _block(items, F.lit("n_genres"), S.n_genres(C.GENRES))


def genre_popularity_mean(items: DataFrame) -> DataFrame:
    """Mean catalogue frequency of an item's genres; items without genres have no entry."""
    n_items = items.agg(F.count("*")).scalar()
    listed = items.select(C.ITEM, S.n_genres(C.GENRES).alias("k"), F.explode(S.listed_genres(C.GENRES)).alias("g"))
    freq = listed.groupBy("g").agg((F.count("*") / n_items).alias("f"))
    per_item = listed.join(freq, "g").groupBy(C.ITEM).agg((F.sum("f") / F.first("k")).alias("v"))
    return _block(per_item, F.lit("genre_popularity_mean"), F.col("v"))


def tag_meta(tags: DataFrame, items: DataFrame, *, prefix: str = "") -> DataFrame:
    """Number of tags and mean global tag frequency per item."""
    n = stats.tag_counts(tags, items)
    a = stats.avg_tag_frequency(tags, items)
    return union_blocks(
        _block(n, F.lit(f"{prefix}n_tags"), F.col("n_tags")),
        _block(a, F.lit(f"{prefix}avg_tag_frequency"), F.col("avg_tag_frequency")),
    )


def feat_tags(tags: DataFrame, items: DataFrame, *, max_features: int = 150) -> DataFrame:
    """Tag words by TF-IDF, and the two tag counts scaled to [0, 1]."""
    words = _block(text.tag_tfidf(tags, items, max_features=max_features), F.concat(F.lit("user_tag_"), "token"), F.col("tfidf"))
    return union_blocks(words, min_max_scale(tag_meta(tags, items, prefix="user_"), items))


def tag_words(tags: DataFrame, items: DataFrame, *, max_features: int = 150) -> DataFrame:
    return _block(text.tag_tfidf(tags, items, max_features=max_features), F.concat(F.lit("tag_"), "token"), F.col("tfidf"))


RATING_COLUMNS = (
    "movie_n_ratings", "movie_mean_rating", "movie_std_rating", "movie_bayesian_mean", "movie_inverse_popularity"
)


def feat_ratings(ratings: DataFrame, items: DataFrame) -> DataFrame:
    return _columns_to_block(stats.item_stats_full(ratings, items), {c: c for c in RATING_COLUMNS})


def rated_item_stats(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """The same five statistics for rated items only; unrated items stay 0."""
    full = stats.item_stats_full(ratings, items).where(F.col("movie_n_ratings") > 0)
    return _columns_to_block(full, {c: c for c in RATING_COLUMNS})


def genome_vectors(scores: DataFrame, *, prefix: str) -> DataFrame:
    return _block(scores, F.concat(F.lit(prefix), F.col("tagId").cast("string")), F.col("relevance"))


def genome_pivot(scores: DataFrame) -> DataFrame:
    """Relevance by tag in tag order, one array per item (instead of one column per tag)."""
    return scores.groupBy(C.ITEM).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("tagId", "relevance"))), lambda x: x["relevance"]).alias("relevance")
    )


def genome_stats_table(scores: DataFrame, *, strong: float = C.STRONG_TAG) -> DataFrame:
    r = F.col("relevance")
    return scores.groupBy(C.ITEM).agg(
        F.avg(r).alias("genome_mean"), F.stddev_samp(r).alias("genome_std"), F.max(r).alias("genome_max"),
        F.min(r).alias("genome_min"), F.count_if(r > strong).alias("genome_n_strong"),
    )


GENOME_COLUMNS = ("genome_mean", "genome_std", "genome_max", "genome_min", "genome_n_strong")


def genome_stats(scores: DataFrame, *, strong: float = C.STRONG_TAG) -> DataFrame:
    table = genome_stats_table(scores, strong=strong).withColumn("genome_std", F.coalesce("genome_std", F.lit(0.0)))
    return _columns_to_block(table, {c: c for c in GENOME_COLUMNS})


def feat_genome(scores: DataFrame, items: DataFrame, *, strong: float = C.STRONG_TAG) -> DataFrame:
    known = scores.join(items.select(C.ITEM), C.ITEM, "left_semi")
    return union_blocks(genome_vectors(known, prefix="tag_"), genome_stats(known, strong=strong))


def scores_with_themes(scores: DataFrame, themes: DataFrame) -> DataFrame:
    return scores.join(themes.select("tagId", "theme_id"), "tagId")


def theme_features(scores: DataFrame, themes: DataFrame) -> DataFrame:
    """Mean relevance per (item, theme)."""
    return scores_with_themes(scores, themes).groupBy(C.ITEM, "theme_id").agg(F.avg("relevance").alias("value"))


def top_variance_tags(scores: DataFrame, k: int = C.TOP_VARIANCE_TAGS) -> DataFrame:
    v = scores.groupBy("tagId").agg(F.var_samp("relevance").alias("variance"))
    return v.orderBy(F.col("variance").desc_nulls_last(), "tagId").limit(k)


def feat_genome_themes(scores: DataFrame, theme_table: DataFrame, items: DataFrame, *, k: int = C.TOP_VARIANCE_TAGS) -> DataFrame:
    """Theme means and the raw scores of the tags that vary most over items."""
    known = items.select(C.ITEM)
    raw = scores.join(top_variance_tags(scores, k).select("tagId"), "tagId", "left_semi")
    return union_blocks(
        _block(theme_table.join(known, C.ITEM, "left_semi"), F.concat(F.lit("bert_theme_"), F.col("theme_id").cast("string")), F.col("value")),
        genome_vectors(raw.join(known, C.ITEM, "left_semi"), prefix="raw_tag_"),
    )


def visual_table(visuals: DataFrame) -> DataFrame:
    """The seven descriptors and five derived ones."""
    f = {i: F.col(f"f{i}") for i in range(1, 8)}
    return visuals.select(
        C.ITEM, *[f[i].alias(f"visual_f{i}") for i in f],
        (f[4] / (f[1] + 1e-6)).alias("visual_fast_paced"),
        (f[4] + f[7]).alias("visual_action_intensity"),
        (f[2] + f[3]).alias("visual_color_complexity"),
        (f[4] + f[5]).alias("visual_motion_complexity"),
        (1 - f[6]).alias("visual_dark_score"),
    )


def feat_visual(visuals: DataFrame, items: DataFrame, *, derived: bool = True) -> DataFrame:
    table = visual_table(visuals.join(items.select(C.ITEM), C.ITEM, "left_semi"))
    names = [c for c in table.columns if c != C.ITEM]
    if not derived:
        names = names[:7]
    return _columns_to_block(table, {c: c for c in names})


def metadata_numbers(metadata: DataFrame, items: DataFrame) -> DataFrame:
    known = metadata.join(items.select(C.ITEM), C.ITEM, "left_semi").fillna(
        0, ["vote_average", "vote_count", "popularity", "runtime"])
    return _columns_to_block(known, {c: f"tmdb_{c}" for c in ("vote_average", "vote_count", "popularity", "runtime")})


def vector_block(vectors: DataFrame, items: DataFrame, column: str, prefix: str) -> DataFrame:
    known = vectors.join(items.select(C.ITEM), C.ITEM, "left_semi")
    cells = known.select(C.ITEM, F.posexplode(column).alias("p", "x"))
    return _block(cells, F.concat(F.lit(prefix), F.col("p").cast("string")), F.col("x"))


# --- scaling and assembly ------------------------------------------------------------------------

def feature_ranges(block: DataFrame, items: DataFrame) -> DataFrame:
    """Per feature: its position by name, its range over all items, its value where absent (0)."""
    n_items = items.agg(F.count("*")).scalar()
    stats_ = block.groupBy("feature").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("*").alias("n")
    )
    partial = F.col("n") < n_items
    return stats_.select(
        "feature",
        F.when(partial, F.least("lo", F.lit(0.0))).otherwise(F.col("lo")).alias("lo"),
        F.when(partial, F.greatest("hi", F.lit(0.0))).otherwise(F.col("hi")).alias("hi"),
    )


def _scaled(value: Column) -> Column:
    return F.when(F.col("hi") > F.col("lo"), (value - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(0.0)


def min_max_scale(block: DataFrame, items: DataFrame) -> DataFrame:
    """Entries scaled to [0, 1] over all items, absent ones counted as 0; constant features give 0.

    Absent entries of a feature with negative values are not 0 after scaling; ``assemble`` fills them.
    """
    return block.join(feature_ranges(block, items), "feature").select(C.ITEM, "feature", _scaled(F.col("value")).alias("value"))


def feature_names(block: DataFrame) -> DataFrame:
    """(feature, position): names in order. There are as many rows as features, not as items."""
    from pyspark.sql import Window as W

    names = block.select("feature").distinct()
    return names.select("feature", (F.row_number().over(W.orderBy("feature")) - 1).alias("position"))


def assemble(block: DataFrame, items: DataFrame, *, scale: bool = True) -> tuple[DataFrame, DataFrame]:
    """(movieId, features array<double>) for every item, and (feature, position).

    The block is written once to the shared folder (it is read three times: ranges, names, cells).
    Sparse entries travel through the shuffle; each item's array is filled where it ends up.
    """
    block = materialise(block, "features")
    ranges = feature_ranges(block, items)
    names = feature_names(block).join(ranges, "feature")
    default = _scaled(F.lit(0.0)) if scale else F.lit(0.0)
    names = names.withColumn("default", default)
    base = names.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", "default"))), lambda x: x["default"])
    ).scalar()
    value = _scaled(F.col("value")) if scale else F.col("value")
    cells = block.join(names, "feature").select(C.ITEM, "position", value.alias("value"))
    sparse = cells.groupBy(C.ITEM).agg(
        F.collect_list("position").alias("p"), F.collect_list("value").alias("v")
    )
    rows = items.select(C.ITEM).join(sparse, C.ITEM, "left").withColumn("base", base)

    @F.pandas_udf("array<double>")
    def fill(base: pd.Series, p: pd.Series, v: pd.Series) -> pd.Series:
        out = []
        for b, pos, val in zip(base, p, v):
            x = np.array(b, dtype=float)
            if pos is not None and len(pos):
                x[np.asarray(pos)] = val
            out.append(x)
        return pd.Series(out)

    return rows.select(C.ITEM, fill("base", "p", "v").alias("features")), names.select("feature", "position")


# --- feature sets --------------------------------------------------------------------------------

def block_v1(items: DataFrame) -> DataFrame:
    return union_blocks(feat_year(items), feat_genre_onehot(items))


def block_v2(items: DataFrame, tags: DataFrame, scores: DataFrame, visuals: DataFrame, *, max_features: int = 150) -> DataFrame:
    known = scores.join(items.select(C.ITEM), C.ITEM, "left_semi")
    return union_blocks(
        block_v1(items), tag_words(tags, items, max_features=max_features),
        genome_vectors(known, prefix="genome_"), feat_visual(visuals, items, derived=False),
    )


def block_v3(
    items: DataFrame, tags: DataFrame, scores: DataFrame, visuals: DataFrame, ratings: DataFrame, *,
    max_features: int = 150,
) -> DataFrame:
    known = scores.join(items.select(C.ITEM), C.ITEM, "left_semi")
    return union_blocks(
        block_v1(items), feat_decade_onehot(items, drop_early=False), n_genres(items), genre_popularity_mean(items),
        tag_words(tags, items, max_features=max_features), tag_meta(tags, items),
        genome_vectors(known, prefix="genome_"), genome_stats(known),
        feat_visual(visuals, items), rated_item_stats(ratings, items),
    )


def block_all_v1(
    items: DataFrame, tags: DataFrame, scores: DataFrame, visuals: DataFrame, ratings: DataFrame,
    coefficients: DataFrame | None = None,
) -> DataFrame:
    """Decades, relevance, ratings, visuals, tags and genre words; kept by coefficient if given."""
    from tasteframe.operators.filters import select_features_by_coef

    block = union_blocks(
        feat_decade_onehot(items), feat_genome(scores, items), feat_ratings(ratings, items),
        feat_visual(visuals, items), feat_tags(tags, items), feat_genre_tfidf(items),
    )
    return block if coefficients is None else select_features_by_coef(block, coefficients).select(C.ITEM, "feature", "value")


def extend_with(v3: DataFrame, items: DataFrame, extra: DataFrame, metadata: DataFrame) -> DataFrame:
    """The scaled V3 block with another block and the metadata numbers; scale again when assembling."""
    return union_blocks(min_max_scale(v3, items), extra, metadata_numbers(metadata, items))
