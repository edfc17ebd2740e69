"""Where jobs keep written tables that cut a long lineage, and how many tasks heavy groups get."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: While this is on, Spark drops the shuffle files of a step when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The tables written by the innermost ``passing``.
_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where none is set: a fresh one on a single machine, an error on a cluster,
    whose executors would each write to a disk of their own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="tasteframe-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tasteframe/{name}-{uuid.uuid4().hex}"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """For steps that write tables: their shuffle files go when a write has ended, those of finished steps that nothing refers to with them.

    Else a long job holds the shuffle files of all its steps on disk, until the driver happens to collect garbage.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
        spark.sparkContext._jvm.System.gc()


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: a short lineage that survives lost executors, without the shuffle files of the steps before."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    written = _WRITTEN.get()
    if written is not None:
        written.append(path)
    with tidy(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """For a step of a long job: the tables that ``materialise`` writes inside are deleted at its end. What is to stay is written by the function it gives.

    Nothing else may be read afterwards: a lazy table over the others has lost its input.
    """
    outer, mine = _WRITTEN.get(), []
    token = _WRITTEN.set(mine)

    def keep(df: DataFrame, name: str) -> DataFrame:
        inside = _WRITTEN.set(outer)
        try:
            return materialise(df, name)
        finally:
            _WRITTEN.reset(inside)

    try:
        yield keep
    finally:
        _WRITTEN.reset(token)
        for path in mine:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def in_passes(rows: DataFrame, key: str, n: int, run: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """``run`` of all rows: at once for n = 1, else written in n passes over hashes of ``key``, so that the shuffles of one pass lie on disk at a time. Eager for n > 1.

    ``run`` must give, for a table that has all rows of some keys, the rows of these keys alone.
    """
    if n <= 1:
        return run(rows)
    out = None
    for p in range(n):
        with passing(rows.sparkSession) as keep:
            part = materialise(rows.where(F.pmod(F.xxhash64(F.lit(n), F.col(key)), F.lit(n)) == p), f"{name}-pass")
            done = keep(run(part), name)
        out = done if out is None else out.unionByName(done)
    return out


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by the keys into the session's number of shuffle partitions.

    For steps whose work is far larger than their input (pair joins, grouped Python calls): adaptive
    coalescing looks at input bytes and would put them into a few tasks. The following join or group
    on the same keys needs no further shuffle.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(n, *[F.col(k) for k in keys])
