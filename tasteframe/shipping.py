"""Makes the package importable on the workers, wherever the session was started."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the workers once per application (Spark copies the archive to every executor)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="tasteframe-"), "tasteframe"), "zip", os.path.dirname(package), os.path.basename(package)
    )
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def shipped(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``fn(spark, ...)``, with the package sent to the workers first."""

    @wraps(fn)
    def run(spark: SparkSession, *args, **kwargs) -> DataFrame:
        ship(spark)
        return fn(spark, *args, **kwargs)

    return run
