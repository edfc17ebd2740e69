from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tasteframe import constants as C  # noqa: E402
from tasteframe.shipping import ship  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tasteframe-tests-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("OFF")
    ship(s)
    yield s
    s.stop()


MICRO = [
    (1, 10, 5.0), (1, 20, 3.0), (1, 30, 4.0), (2, 10, 4.0), (2, 20, 2.0), (2, 40, 5.0), (3, 10, 1.0),
    (3, 30, 2.0), (3, 40, 4.0), (4, 20, 4.5), (4, 30, 4.0), (4, 40, 3.0), (4, 50, 2.0),
]


@pytest.fixture(scope="session")
def ratings(spark):
    return spark.createDataFrame(MICRO, f"{C.USER} long, {C.ITEM} long, {C.RATING} double").cache()


@pytest.fixture(scope="session")
def items(spark):
    rows = [
        (10, "One (1994)", "Action|Comedy"), (20, "Two (1999)", "Comedy|Drama"), (30, "Three", "Drama"),
        (40, "Four (2008)", "Action|Sci-Fi"), (50, "Five (1908)", C.NO_GENRES), (60, "Six (2001)", None),
    ]
    return spark.createDataFrame(rows, C.ITEMS_SCHEMA).cache()


@pytest.fixture(scope="session")
def skewed(spark):
    """400 users, 120 items, item 0 with a third of all ratings, user 0 with all items."""
    import numpy as np

    rng = np.random.default_rng(3)
    seen = {}
    for u in range(400):
        seen[u, 0] = 0
        for i in rng.choice(np.arange(1, 120), size=2 if u else 119, replace=False):
            seen[u, int(i)] = 0
    rows = [(u, i, float(rng.integers(1, 11)) / 2) for u, i in seen]
    return spark.createDataFrame(rows, f"{C.USER} long, {C.ITEM} long, {C.RATING} double").cache()
