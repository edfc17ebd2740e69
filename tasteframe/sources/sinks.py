"""Writers and keyed updates."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.operators import stats
from tasteframe.scratch import tidy


def report_path(root: str, day: datetime.date | None = None) -> str:
    day = day or datetime.date.today()
    return f"{root.rstrip('/')}/report_{day:%Y_%m_%d}.csv"


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """CSV as the readers expect it: header, quotes doubled inside quotes, empty texts apart from nulls."""
    df.write.mode(mode).options(**C.CSV).csv(path)


def write_report(report: DataFrame, root: str, day: datetime.date | None = None) -> str:
    path = report_path(root, day)
    write_csv(report, path)
    return path


def union_ratings(explicit: DataFrame, implicit: DataFrame) -> DataFrame:
    return explicit.unionByName(implicit)


def append_implicit_ratings(explicit: DataFrame, implicit: DataFrame, path: str) -> DataFrame:
    """Write explicit and implicit rows as one table and return it."""
    both = union_ratings(explicit, implicit)
    both.write.mode("overwrite").parquet(path)
    return both.sparkSession.read.schema(both.schema).parquet(path)


def write_implicit_ratings(implicit: DataFrame, path: str) -> None:
    write_csv(implicit.select(C.USER, C.ITEM, C.RATING, C.TIMESTAMP), path)


def library_template(ratings: DataFrame, items: DataFrame, n: int = C.LIBRARY_TEMPLATE_SIZE) -> DataFrame:
    """The most rated items with empty signal columns to fill in."""
    popular = stats.popular_library(ratings, items, n)
    return popular.withColumns({c: F.lit(None).cast("string") for c in C.LIBRARY_SIGNALS})


def write_library_template(ratings: DataFrame, items: DataFrame, path: str) -> None:
    write_csv(library_template(ratings, items), path)


def write_metadata_features(metadata: DataFrame, path: str) -> None:
    metadata.write.mode("overwrite").parquet(path)


def write_theme_features(themes: DataFrame, path: str) -> None:
    themes.write.mode("overwrite").parquet(path)


def write_embeddings(vectors: DataFrame, path: str) -> None:
    vectors.write.mode("overwrite").parquet(path)


def write_coefficients(coefficients: DataFrame, path: str) -> None:
    """Keep an existing reference table; write only where there is none."""
    write_csv(coefficients, path, mode="ignore")


def write_params(spark: SparkSession, params: dict, rmse: float, path: str) -> None:
    row = spark.createDataFrame([((params["rank"], params["max_iter"], params["reg"]), rmse)], C.PARAMS_SCHEMA)
    row.write.mode("overwrite").json(path)


def write_registered_users(users: DataFrame, path: str) -> None:
    users.write.mode("overwrite").json(path)


def upsert_registered_user(users: DataFrame, changes: DataFrame) -> DataFrame:
    """Replace the users present in ``changes`` and add the new ones."""
    return users.join(changes.select("user_id"), "user_id", "left_anti").unionByName(changes)


def next_user_id(ratings: DataFrame, users: DataFrame) -> DataFrame:
    """One row: the largest known id plus one; the implicit user does not count."""
    known = ratings.where(F.col(C.USER) != C.IMPLICIT_USER).agg(F.max(C.USER).alias("id"))
    known = known.union(users.agg(F.max("user_id")))
    return known.agg((F.greatest(F.coalesce(F.max("id"), F.lit(0)), F.lit(0)) + 1).alias("user_id"))


def save_models(tables: dict[str, DataFrame], root: str) -> dict[str, str]:
    """One Parquet table per fitted model part."""
    paths = {name: f"{root.rstrip('/')}/{name}" for name in tables}
    for name, df in tables.items():
        with tidy(df.sparkSession):
            df.write.mode("overwrite").parquet(paths[name])
    return paths
