"""Column names, table schemas and the values results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names (fixed values).
USER = "userId"
ITEM = "movieId"
RATING = "rating"
TIMESTAMP = "timestamp"
TITLE = "title"
GENRES = "genres"

# One set of CSV options for all readers and writers: quotes are doubled inside quotes.
CSV = {"header": True, "quote": '"', "escape": '"'}

# Rating scale and special ids (fixed values).
RATING_MIN = 0.5
RATING_MAX = 5.0
IMPLICIT_USER = -1
NO_GENRES = "(no genres listed)"

# Popularity and shrinkage parameters (fixed values).
FEATURED_MIN_VOTES = 50
BAYESIAN_M = 10
STRONG_TAG = 0.8
TOP_VARIANCE_TAGS = 200
LIBRARY_TEMPLATE_SIZE = 100

# Implicit rating formula (fixed values).
IMPLICIT_BASE = 0.5
IMPLICIT_PER_VIEW = 0.8
IMPLICIT_MAX_VIEWS = 5
IMPLICIT_WISHLIST = 0.9
IMPLICIT_RECENT = 0.5
IMPLICIT_TOP10 = 1.5

# Hybrid weights with and without the content model (fixed values).
HYBRID_WEIGHTS = {"svd": 0.45, "content": 0.30, "itr": 0.25}
HYBRID_WEIGHTS_NO_CONTENT = {"svd": 0.60, "itr": 0.40}

# Default model parameters (fixed values).
LATENT_PARAMS = {"rank": 35, "reg": 0.0934}
ITR_PARAMS = {"k": 60, "min_k": 5}
USER_COSINE_PARAMS = {"k": 80, "min_k": 5, "min_support": 3}
USER_PEARSON_PARAMS = {"k": 20, "min_k": 5, "min_support": 3}
ITEM_KNN_PARAMS = {"k": 60, "min_k": 3}
ITEM_COSINE_PARAMS = {"k": 40, "min_k": 3}
CONTENT_KNN_K = 20
RELEVANCE_THRESHOLD = 4.0
TOP_N = 10

# Feature selection thresholds (fixed values).
COEF_IMPORTANCE = 0.02
COEF_STABILITY = 1.35

# Mood buttons and the genres behind them (fixed values).
MOODS = {
    "Action": ["Action", "Adventure", "Thriller"],
    "Feel Good": ["Comedy", "Romance"],
    "Drama": ["Drama"],
    "Dark": ["Horror", "Mystery", "Thriller"],
    "Escape": ["Sci-Fi", "Fantasy", "Animation"],
    "Learn": ["Documentary", "History", "Biography"],
}

# Genre products of the interaction features (fixed values).
GENRE_PRODUCTS = [
    ("Comedy", "Drama"),
    ("Drama", "Romance"),
    ("Comedy", "Romance"),
    ("Comedy", "Drama", "Romance"),
    ("Drama", "Thriller"),
]

# Decades dropped by the stand-alone decade features (fixed values).
DROPPED_DECADES = (1900, 1910)

# Poster address prefix of the metadata service (fixed value).
POSTER_PREFIX = "https://image.tmdb.org/t/p/w500"

# Explanation sentences and labels (fixed values).
EXPLAIN_UNKNOWN_ITEM = "This recommendation is based on your content profile."
EXPLAIN_HISTORY = "Recommended based on your viewing history."
EXPLAIN_LABELS = {
    "year": "release year",
    "genome_": "semantic profile",
    "visual_": "visual style",
    "movie_": "popularity",
}

RATINGS_SCHEMA = T.StructType([
    T.StructField(USER, T.LongType()),
    T.StructField(ITEM, T.LongType()),
    T.StructField(RATING, T.DoubleType()),
    T.StructField(TIMESTAMP, T.LongType()),
])

TEST_KEYS_SCHEMA = T.StructType([
    T.StructField(USER, T.LongType()),
    T.StructField(ITEM, T.LongType()),
    T.StructField(RATING, T.DoubleType()),
])

ITEMS_SCHEMA = T.StructType([
    T.StructField(ITEM, T.LongType()),
    T.StructField(TITLE, T.StringType()),
    T.StructField(GENRES, T.StringType()),
])

TAGS_SCHEMA = T.StructType([
    T.StructField(USER, T.LongType()),
    T.StructField(ITEM, T.LongType()),
    T.StructField("tag", T.StringType()),
])

GENOME_SCORES_SCHEMA = T.StructType([
    T.StructField(ITEM, T.LongType()),
    T.StructField("tagId", T.LongType()),
    T.StructField("relevance", T.DoubleType()),
])

GENOME_TAGS_SCHEMA = T.StructType([
    T.StructField("tagId", T.LongType()),
    T.StructField("tag", T.StringType()),
])

VISUALS_SCHEMA = T.StructType(
    [T.StructField("ML_Id", T.LongType())]
    + [T.StructField(f"f{i}", T.DoubleType()) for i in range(1, 8)]
)

LINKS_SCHEMA = T.StructType([
    T.StructField(ITEM, T.LongType()),
    T.StructField("tmdbId", T.DoubleType()),
])

METADATA_SCHEMA = T.StructType([
    T.StructField(ITEM, T.DoubleType()),
    T.StructField(TITLE, T.StringType()),
    T.StructField("overview", T.StringType()),
    T.StructField("release_date", T.StringType()),
    T.StructField("runtime", T.DoubleType()),
    T.StructField("vote_average", T.DoubleType()),
    T.StructField("vote_count", T.DoubleType()),
    T.StructField("popularity", T.DoubleType()),
    T.StructField("poster_path", T.StringType()),
    T.StructField("poster_url", T.StringType()),
])

# Fields read from one metadata payload.
PAYLOAD_SCHEMA = T.StructType([
    T.StructField(TITLE, T.StringType()),
    T.StructField("overview", T.StringType()),
    T.StructField("release_date", T.StringType()),
    T.StructField("runtime", T.DoubleType()),
    T.StructField("vote_average", T.DoubleType()),
    T.StructField("vote_count", T.LongType()),
    T.StructField("popularity", T.DoubleType()),
    T.StructField("poster_path", T.StringType()),
])

LIBRARY_SIGNALS = ["n_watched", "wishlist", "recent", "top10"]

LIBRARY_SCHEMA = T.StructType([
    T.StructField(ITEM, T.LongType()),
    T.StructField(TITLE, T.StringType()),
    T.StructField(GENRES, T.StringType()),
    T.StructField("rating_count", T.LongType()),
    T.StructField("rating_mean", T.DoubleType()),
    T.StructField("n_watched", T.DoubleType()),
    T.StructField("wishlist", T.DoubleType()),
    T.StructField("recent", T.DoubleType()),
    T.StructField("top10", T.DoubleType()),
])

REGISTERED_USERS_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("ratings", T.MapType(T.StringType(), T.DoubleType())),
])

COEFFICIENTS_SCHEMA = T.StructType([
    T.StructField("feature", T.StringType()),
    T.StructField("mean_abs_coef", T.DoubleType()),
    T.StructField("mean_coef", T.DoubleType()),
    T.StructField("std_coef", T.DoubleType()),
    T.StructField("cv_coef", T.DoubleType()),
])

PARAMS_SCHEMA = T.StructType([
    T.StructField("params", T.StructType([
        T.StructField("rank", T.IntegerType()),
        T.StructField("max_iter", T.IntegerType()),
        T.StructField("reg", T.DoubleType()),
    ])),
    T.StructField("rmse", T.DoubleType()),
])
