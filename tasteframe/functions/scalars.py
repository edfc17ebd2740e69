"""Text, number and rating expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tasteframe import constants as C


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_year(title: Column | str) -> Column:
    """First four-digit year in parentheses, or null."""
    found = F.regexp_extract(_col(title), r"\((\d{4})\)", 1)
    return F.nullif(found, F.lit("")).cast("int")


def decade(year: Column | str) -> Column:
    return (F.floor(_col(year) / 10) * 10).cast("long")


def title_length(title: Column | str) -> Column:
    return F.length(_col(title))


def split_genres(genres: Column | str) -> Column:
    return F.split(_col(genres), r"\|")


def listed_genres(genres: Column | str) -> Column:
    """Distinct genres without the sentinel and empty names; null gives an empty array."""
    names = F.array_distinct(split_genres(F.coalesce(_col(genres), F.lit(""))))
    return F.filter(names, lambda g: (g != "") & (g != C.NO_GENRES))


def n_genres(genres: Column | str) -> Column:
    """Number of listed genres; the sentinel, an empty text and null count 0."""
    g = F.coalesce(_col(genres), F.lit(""))
    return F.when((g == "") | (g == C.NO_GENRES), F.lit(0)).otherwise(F.size(split_genres(g)))


def genres_as_sentence(genres: Column | str) -> Column:
    return F.translate(_col(genres), "|", " ")


def clean_tag(tag: Column | str) -> Column:
    return F.trim(F.lower(_col(tag)))


def tag_to_token(tag: Column | str) -> Column:
    return F.replace(_col(tag), F.lit(" "), F.lit("_"))


def sorted_set(values: Column | str) -> Column:
    """Canonical form of a list of names: sorted and joined by the pipe character."""
    return F.array_join(F.array_sort(_col(values)), "|")


def word_tokens(text: Column | str) -> Column:
    """Lower-cased words of at least two word characters."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))


def truncate_with_ellipsis(text: Column | str, n: int) -> Column:
    t = _col(text)
    return F.when(F.length(t) > n, F.concat(F.substring(t, 1, n), F.lit("…"))).otherwise(t)


def release_year(date: Column | str) -> Column:
    return F.substring(_col(date), 1, 4)


def clip(x: Column | str, lo: float = C.RATING_MIN, hi: float = C.RATING_MAX) -> Column:
    """Bound a prediction to the rating scale; null stays null."""
    c = _col(x)
    return F.when(c.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), c)))


def fixed_round(x: Column | str, digits: int) -> Column:
    """Half-up rounding of the decimal value, free of binary noise past 12 digits."""
    return F.round(_col(x).cast("decimal(38,12)"), digits).cast("double")


def snap(x: Column | str, digits: int = 9) -> Column:
    """Cheap rounding used before ranking, so that equal values tie in every plan."""
    scale = float(10**digits)
    return F.floor(_col(x) * scale + 0.5) / scale


def genre_jaccard_distance(a: Column | str, b: Column | str) -> Column:
    """1 - |A n B| / |A u B| over the genre names of two pipe-separated texts."""
    x, y = split_genres(a), split_genres(b)
    return 1 - F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))


def implicit_rating(
    n_watched: Column | str, wishlist: Column | str, recent: Column | str, top10: Column | str
) -> Column:
    """Behaviour signals as a rating on the scale, two decimals."""
    score = (
        F.lit(C.IMPLICIT_BASE)
        + C.IMPLICIT_PER_VIEW * F.least(_col(n_watched), F.lit(C.IMPLICIT_MAX_VIEWS))
        + C.IMPLICIT_WISHLIST * _col(wishlist)
        + C.IMPLICIT_RECENT * _col(recent)
        + C.IMPLICIT_TOP10 * _col(top10)
    )
    return F.round(clip(score), 2)


def weighted_blend(scores: Sequence[tuple[Column | str, float]]) -> Column:
    """Weighted mean over the scores that are present; null when none is."""
    num, den = F.lit(0.0), F.lit(0.0)
    for score, weight in scores:
        c = _col(score)
        num = num + F.coalesce(c * weight, F.lit(0.0))
        den = den + F.when(c.isNotNull(), F.lit(weight)).otherwise(F.lit(0.0))
    return num / F.nullif(den, F.lit(0.0))


def shrunk_mean(n: Column | str, mean: Column | str, prior: Column, m: float) -> Column:
    """(n * mean + m * prior) / (n + m)."""
    return (_col(n) * _col(mean) + m * prior) / (_col(n) + m)
