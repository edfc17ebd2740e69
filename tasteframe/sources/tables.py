"""Readers. Every file is read with a declared schema; nothing is inferred."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tasteframe import constants as C
from tasteframe.operators.filters import validate_columns


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str | None) -> DataFrame:
    kind = fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")
    if kind == "csv":
        # Numbers have no line breaks: such files may be split; texts may hold them in quotes.
        text = any(isinstance(f.dataType, T.StringType) for f in schema.fields)
        return spark.read.schema(schema).options(**C.CSV, multiLine=text).csv(path)
    if kind == "json":
        return spark.read.schema(schema).json(path)
    return spark.read.schema(schema).parquet(path)


def _read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str | None) -> DataFrame:
    try:
        return _read(spark, path, schema, fmt)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def load_ratings(
    spark: SparkSession, explicit_path: str, implicit_path: str | None = None,
    *, use_implicit: bool = False, fmt: str | None = None,
) -> DataFrame:
    """Explicit ratings, or the table that also holds the implicit rows."""
    path = implicit_path if use_implicit and implicit_path else explicit_path
    return _read(spark, path, C.RATINGS_SCHEMA, fmt)


def load_items(spark: SparkSession, path: str, *, fmt: str | None = None) -> DataFrame:
    return _read(spark, path, C.ITEMS_SCHEMA, fmt)


def load_item_metadata(spark: SparkSession, path: str, *, fmt: str | None = None) -> DataFrame:
    """Item metadata; whole-number ids, missing texts as "", an absent file as an empty table."""
    raw = _read_or_empty(spark, path, C.METADATA_SCHEMA, fmt)
    return clean_metadata(raw)


def clean_metadata(raw: DataFrame) -> DataFrame:
    return raw.withColumn(C.ITEM, F.col(C.ITEM).cast("long")).fillna("", ["overview", "poster_url"])


def load_tags(spark: SparkSession, path: str, *, fmt: str | None = None) -> DataFrame:
    return lower_tags(_read(spark, path, C.TAGS_SCHEMA, fmt))


def lower_tags(tags: DataFrame) -> DataFrame:
    return tags.withColumn("tag", F.lower(F.coalesce("tag", F.lit(""))))


def load_genome_scores(spark: SparkSession, path: str, *, fmt: str | None = None) -> DataFrame:
    return _read(spark, path, C.GENOME_SCORES_SCHEMA, fmt)


def load_genome_tags(spark: SparkSession, path: str, *, fmt: str | None = None) -> DataFrame:
    return _read(spark, path, C.GENOME_TAGS_SCHEMA, fmt)


def load_visuals(spark: SparkSession, root: str, variant: str, *, fmt: str = "csv") -> DataFrame:
    """One of the three normalisations of the visual descriptors."""
    names = {"log": "Log", "quantile": "Quantile", "quantilelog": "QuantileLog"}
    if variant not in names:
        raise ValueError(f"variant must be one of {sorted(names)}, not {variant!r}")
    ext = ".csv" if fmt == "csv" else ".parquet"
    path = f"{root.rstrip('/')}/LLVisualFeatures13K_{names[variant]}{ext}"
    if fmt == "csv":
        # Header names differ in case between files; the position decides.
        return _read(spark, path, C.VISUALS_SCHEMA, fmt).withColumnRenamed("ML_Id", C.ITEM)
    df = spark.read.parquet(path)
    return df.withColumnsRenamed({"ML_Id": C.ITEM, "ML_ID": C.ITEM})


def load_precomputed_theme_features(spark: SparkSession, path: str) -> DataFrame:
    """Theme table (movieId, theme_id, value) written by ``write_theme_features``."""
    schema = T.StructType([
        T.StructField(C.ITEM, T.LongType()),
        T.StructField("theme_id", T.IntegerType()),
        T.StructField("value", T.DoubleType()),
    ])
    return spark.read.schema(schema).parquet(path)


def load_test_keys(spark: SparkSession, path: str, *, fmt: str | None = None) -> DataFrame:
    return _read(spark, path, C.TEST_KEYS_SCHEMA, fmt).select(C.USER, C.ITEM)


def load_links(
    spark: SparkSession, path: str, *, limit: int | None = None, fmt: str | None = None
) -> DataFrame:
    links = _read(spark, path, C.LINKS_SCHEMA, fmt)
    return links if limit is None else links.limit(limit)


def load_library(spark: SparkSession, path: str, *, fmt: str | None = None) -> DataFrame:
    """Behavioural library with required columns checked and empty signals read as 0."""
    kind = fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")
    if kind == "csv":
        header = spark.read.csv(path, header=True).columns
        validate_columns(header, [C.ITEM, C.TITLE, C.GENRES, *C.LIBRARY_SIGNALS])
        known = {f.name: f for f in C.LIBRARY_SCHEMA.fields}
        schema = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in header])
        return clean_library(_read(spark, path, schema, "csv"))
    return clean_library(spark.read.parquet(path))


def clean_library(library: DataFrame) -> DataFrame:
    validate_columns(library, [C.ITEM, C.TITLE, C.GENRES, *C.LIBRARY_SIGNALS])
    return library.withColumns({
        c: F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in C.LIBRARY_SIGNALS
    })


def load_registered_users(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    """Registered users; an absent file gives an empty table, broken rows are dropped.

    The default is one user per line, which splits over tasks. ``multi_line`` reads a file that
    is a single JSON array.
    """
    try:
        users = spark.read.schema(C.REGISTERED_USERS_SCHEMA).json(
            path, multiLine=multi_line, mode="DROPMALFORMED"
        )
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        users = spark.createDataFrame([], C.REGISTERED_USERS_SCHEMA)
    return users.where(F.col("user_id").isNotNull())


def registered_ratings(users: DataFrame) -> DataFrame:
    """Registered users' rating maps as rating rows."""
    return users.select(
        F.col("user_id").alias(C.USER), F.explode("ratings").alias("item", C.RATING)
    ).select(C.USER, F.expr("try_cast(item AS BIGINT)").alias(C.ITEM), C.RATING)


def load_params(spark: SparkSession, path: str, defaults: dict) -> DataFrame:
    """One row of tuned parameters; the defaults where the file is absent or a field is missing."""
    saved = _read_or_empty(spark, path, C.PARAMS_SCHEMA, "json").select("params.*", "rmse").limit(1)
    base = spark.range(1).select(
        F.lit(defaults["rank"]).cast("int").alias("d_rank"),
        F.lit(defaults["max_iter"]).cast("int").alias("d_max_iter"),
        F.lit(defaults["reg"]).cast("double").alias("d_reg"),
    )
    return base.join(saved, F.lit(True), "left").select(
        *[F.coalesce(F.col(c), F.col(f"d_{c}")).alias(c) for c in ("rank", "max_iter", "reg")],
        F.col("rank").isNotNull().alias("tuned"), "rmse",
    )


def load_coefficients(spark: SparkSession, path: str, *, fmt: str | None = None) -> DataFrame:
    return _read(spark, path, C.COEFFICIENTS_SCHEMA, fmt)
