"""Query registry: a Spark callable per name and, where plain SQL can say it, the SQL text."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tasteframe.sources.adapters import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Shared input relations in SQL, the twins of tasteframe.sources.adapters.
RELATIONS: dict[str, str] = {
    "ratings": """
        SELECT o_custkey AS userId, l_partkey AS movieId,
               CAST(ceil(avg(l_quantity) / 5.0) * 0.5 AS DOUBLE) AS rating,
               CAST(date_diff('day', DATE '1970-01-01', CAST(max(o_orderdate) AS DATE)) AS BIGINT) * 86400 AS timestamp
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        GROUP BY o_custkey, l_partkey""",
    "train": "SELECT * FROM ratings WHERE NOT ((userId * 31 + movieId * 17) % 100 < 20)",
    "test": "SELECT * FROM ratings WHERE (userId * 31 + movieId * 17) % 100 < 20",
    "items": """
        SELECT p_partkey AS movieId,
               CASE WHEN p_partkey % 17 = 0 THEN p_name
                    ELSE concat(p_name, ' (', CAST(1950 + p_size AS VARCHAR), ')') END AS title,
               CASE WHEN p_partkey % 23 = 0 THEN '(no genres listed)'
                    ELSE concat(p_type, '|', replace(p_name, ' ', '|')) END AS genres
        FROM part""",
    "tags": """
        SELECT user_id AS userId, event_id % 200 AS movieId,
               CASE WHEN event_id % 19 <> 0 THEN concat(event_type, ' ',
                    CAST(CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 10 AS VARCHAR)) END AS tag
        FROM events""",
    "lower_tags": "SELECT userId, movieId, lower(coalesce(tag, '')) AS tag FROM tags",
    "clean_tags": "SELECT DISTINCT movieId, trim(lower(coalesce(tag, 'nan'))) AS tag FROM tags",
    "behaviour": """
        SELECT user_id AS userId, event_id % 20 AS movieId,
               CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS INT) AS n_watched,
               max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS wishlist,
               max(CASE WHEN ts >= TIMESTAMP '2024-01-24 00:00:00' THEN 1 ELSE 0 END) AS recent,
               max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS top10
        FROM events GROUP BY user_id, event_id % 20""",
    "library": """
        SELECT i.movieId, title, genres, n_watched, wishlist, recent, coalesce(top10, 0) AS top10
        FROM items i JOIN (
            SELECT event_id % 200 AS movieId,
                   count(CASE WHEN event_type = 'view' THEN 1 END) % 7 AS n_watched,
                   count(CASE WHEN event_type = 'click' THEN 1 END) % 2 AS wishlist,
                   count(CASE WHEN event_type = 'error' THEN 1 END) % 2 AS recent,
                   count(CASE WHEN event_type = 'purchase' THEN 1 END) % 2 AS top10
            FROM events GROUP BY event_id % 200) s ON i.movieId = s.movieId""",
    "genome": """
        SELECT vec_id AS movieId, CAST(unnest(range(len(embedding))) AS BIGINT) AS tagId,
               (CAST(unnest(embedding) AS DOUBLE) + 1) / 2 AS relevance
        FROM embeddings""",
    "tag_themes": "SELECT DISTINCT tagId, CAST(tagId % 8 AS INT) AS theme_id FROM genome",
    "visuals": """
        SELECT l_partkey AS movieId, avg(l_quantity) AS f1,
               coalesce(stddev_samp(l_quantity), 0) AS f2, avg(l_extendedprice) / 1000 AS f3,
               avg(l_discount) AS f4, coalesce(stddev_samp(l_discount), 0) AS f5,
               avg(l_tax) AS f6, coalesce(stddev_samp(l_tax), 0) AS f7
        FROM lineitem GROUP BY l_partkey""",
    "raw_metadata": """
        SELECT doc_id AS movieId, CAST(doc_id + 100000 AS DOUBLE) AS tmdbId, doc_id % 13 <> 0 AS found,
               concat('Title ', CAST(doc_id AS VARCHAR)) AS title,
               CASE WHEN doc_id % 11 <> 0 THEN text END AS overview,
               concat(CAST(1950 + doc_id % 70 AS VARCHAR), '-06-01') AS release_date,
               CAST(n_chars % 180 AS DOUBLE) AS runtime,
               (doc_id % 100) / 10.0 AS vote_average, n_chars AS vote_count,
               n_chars / 100.0 AS popularity,
               CASE WHEN doc_id % 7 <> 0 THEN concat('/', CAST(doc_id AS VARCHAR), '.jpg') END AS poster_path
        FROM documents""",
    "extracted": """
        SELECT movieId, tmdbId, CASE WHEN found THEN title END AS title,
               CASE WHEN found THEN overview END AS overview,
               CASE WHEN found THEN release_date END AS release_date,
               CASE WHEN found THEN runtime END AS runtime,
               CASE WHEN found THEN vote_average END AS vote_average,
               CASE WHEN found THEN vote_count END AS vote_count,
               CASE WHEN found THEN popularity END AS popularity,
               CASE WHEN found THEN poster_path END AS poster_path,
               CASE WHEN found THEN CASE WHEN poster_path IS NOT NULL
                    THEN concat('https://image.tmdb.org/t/p/w500', poster_path) ELSE '' END END AS poster_url,
               CASE WHEN NOT found THEN 0 END AS tmdb_found
        FROM raw_metadata""",
    "metadata": """
        SELECT movieId, title, coalesce(overview, '') AS overview, release_date, runtime, vote_average,
               vote_count, popularity, poster_path, coalesce(poster_url, '') AS poster_url
        FROM extracted""",
    "item_genres": """
        SELECT DISTINCT movieId, unnest(string_split(genres, '|')) AS genre
        FROM items WHERE genres <> '(no genres listed)' AND genres <> ''""",
    "istats": "SELECT movieId, count(rating) AS n, avg(rating) AS m, stddev_samp(rating) AS s FROM ratings GROUP BY movieId",
    "gm": "SELECT avg(rating) AS g FROM ratings",
    "ustats": "SELECT userId, count(*) AS n, avg(rating) AS m, stddev_pop(rating) AS s FROM ratings GROUP BY userId",
    "popular": "SELECT movieId, n, row_number() OVER (ORDER BY n DESC, movieId) AS rank FROM istats",
    "scored": """
        SELECT i.movieId, title, genres, n AS rating_count, m AS rating_mean,
               n / (n + 50.0) * m + 50 / (n + 50.0) * g AS weighted_score
        FROM istats s LEFT JOIN items i ON s.movieId = i.movieId, gm""",
}


def relation(name: str, sql: str) -> None:
    if name in RELATIONS:
        raise ValueError(f"relation {name} exists")
    RELATIONS[name] = sql


def _uses(sql: str) -> list[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", re.sub(r"'[^']*'", "", sql)))
    return [n for n in RELATIONS if n in words]


def with_relations(body: str) -> str:
    """Prefix the body with the shared relations it uses, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dep in _uses(RELATIONS[name]):
            if dep != name:
                visit(dep)
        if name not in ordered:
            ordered.append(name)

    for name in _uses(body):
        visit(name)
    if not ordered:
        return body
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({RELATIONS[n]})" for n in ordered)
    return f"WITH {ctes}\n{body}"


def dec(x: str, digits: int) -> str:
    """SQL twin of ``scalars.fixed_round``."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def snap(x: str, digits: int = 9) -> str:
    """SQL twin of ``scalars.snap``."""
    return f"(floor({x} * 1e{digits} + 0.5) / 1e{digits})"


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables``; ``sql`` may use the shared relations by name."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_relations(sql)
        return fn

    return register
