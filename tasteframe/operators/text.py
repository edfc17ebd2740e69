"""Smoothed, length-normed TF-IDF over token rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.functions import scalars as S
from tasteframe.operators import stats


def tokens_of(df: DataFrame, text: str) -> DataFrame:
    """(movieId, token), one row per occurrence. Rows are split on their own; no text is joined."""
    return df.select(C.ITEM, F.explode(S.word_tokens(text)).alias("token"))


def tfidf(
    tokens: DataFrame, documents: DataFrame, *,
    min_df: int = 1, max_df: float | None = None, max_features: int | None = None,
) -> DataFrame:
    """(movieId, token, tfidf) for the kept vocabulary.

    tf is the raw count, idf = ln((1 + N) / (1 + df)) + 1, rows are scaled to unit length.
    ``documents`` gives N, documents without tokens included. ``max_features`` keeps the tokens with
    the highest corpus count after the df bounds, ties alphabetical.
    """
    n_docs = documents.select(C.ITEM).distinct().agg(F.count("*")).scalar()
    tf = tokens.groupBy(C.ITEM, "token").agg(F.count("*").alias("tf"))
    vocabulary = tf.groupBy("token").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))
    vocabulary = vocabulary.where(F.col("df") >= min_df)
    if max_df is not None:
        vocabulary = vocabulary.where(F.col("df") <= F.lit(max_df) * n_docs)
    if max_features is not None:
        vocabulary = vocabulary.orderBy(F.col("total").desc(), "token").limit(max_features)
    idf = F.log((1 + n_docs) / (1 + F.col("df"))) + 1
    weighted = tf.join(vocabulary.select("token", idf.alias("idf")), "token").select(
        C.ITEM, "token", (F.col("tf") * F.col("idf")).alias("w")
    )
    norms = weighted.groupBy(C.ITEM).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighted.join(norms, C.ITEM).select(C.ITEM, "token", (F.col("w") / F.col("norm")).alias("tfidf"))


def tag_tfidf(tags: DataFrame, items: DataFrame, *, max_features: int = 150, min_df: int = 2) -> DataFrame:
    """Words of an item's tags, weighted over all catalogue items.

    Only tags of catalogue items count: the documents are the catalogue rows.
    """
    known = tags.join(items.select(C.ITEM), C.ITEM, "left_semi")
    return tfidf(tokens_of(known, "tag"), items, min_df=min_df, max_features=max_features)


def tfidf_tags_analytics(tags: DataFrame, *, min_df: int = 5, max_df: float = 0.5) -> DataFrame:
    """Whole tags (spaces as underscores), each once per item, over tagged items."""
    tokens = tokens_of(stats.clean_tags(tags).withColumn("tag", S.tag_to_token("tag")), "tag")
    return tfidf(tokens, tags.select(C.ITEM), min_df=min_df, max_df=max_df)


def genre_tfidf(items: DataFrame) -> DataFrame:
    return tfidf(tokens_of(items.withColumn("s", S.genres_as_sentence(C.GENRES)), "s"), items)


def genre_tfidf_products(items: DataFrame) -> DataFrame:
    """Products of the weights of two different tokens of one item, named in token order.

    The tokens of an item are one short list (its distinct genre words), expanded in place.
    """
    per_item = genre_tfidf(items).groupBy(C.ITEM).agg(
        F.array_sort(F.collect_list(F.struct("token", "tfidf"))).alias("t")
    )
    left = per_item.select(C.ITEM, "t", F.posexplode("t").alias("i", "a"))
    pairs = left.select(C.ITEM, "a", F.explode(F.slice("t", F.col("i") + 2, F.size("t"))).alias("b"))
    return pairs.select(
        C.ITEM, F.concat_ws("_", "a.token", "b.token").alias("token"), (F.col("a.tfidf") * F.col("b.tfidf")).alias("tfidf")
    )
