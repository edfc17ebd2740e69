"""Long jobs on little disk: passes give the rows of one step, and what a step shuffled and wrote for itself is gone when it ends."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.operators import latent, neighbours, similarity
from tasteframe.plans import jobs
from tasteframe.scratch import materialise, passing, shared_dir
from tests.test_pair_blocks import ROWS, some_rows


def rows_of(df):
    plain = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(map(plain, r)) for r in df.collect()), key=repr)


def tables(spark):
    at = f"{shared_dir(spark).removeprefix('file:')}/tasteframe"
    return set(os.listdir(at)) if os.path.isdir(at) else set()


@pytest.fixture(scope="module")
def odd(spark):
    """Null ratings, null ids."""
    return spark.createDataFrame(some_rows(5), ROWS).groupBy(C.USER, C.ITEM).agg(F.max(C.RATING).alias(C.RATING)).cache()


@pytest.mark.parametrize(("hot", "ordered", "left"), [(8, True, None), (8, False, [(1,), (2,), (9,)]), (20_000, False, None)])
def test_pairs_in_passes(spark, odd, hot, ordered, left):
    some = None if left is None else spark.createDataFrame(left, "x long")
    one, many = (similarity.corated_pairs(odd, min_support=3, ordered=ordered, hot=hot, chunk=4, left=some, at_once=n) for n in (10**9, 300 if left else 1500))
    assert rows_of(one) == rows_of(many) != []


@pytest.mark.parametrize(("hot", "model"), [(8, "cosine"), (8, "one"), (8, "itr"), (20_000, "itr")])
def test_neighbours_in_passes(odd, hot, model):
    odd = odd.dropna()
    train, targets = odd.where(f"({C.USER} + {C.ITEM}) % 4 > 0"), odd.where(f"({C.USER} + {C.ITEM}) % 4 = 0")
    kw = {"hot": hot, "chunk": 4, "k": 5, "min_k": 2}
    run = {
        "cosine": lambda n: neighbours.user_knn_cosine(train, targets, min_support=3, at_once=n, **kw),
        "one": lambda n: neighbours.item_knn_basic(train, targets, at_once=n, **kw),
        "itr": lambda n: neighbours.user_knn_itr(train, targets, at_once=n, **kw),
    }[model]
    one = rows_of(run(10**9))
    assert any(r[3] for r in one) and one == rows_of(run(900))


@pytest.mark.parametrize(("hot", "sim"), [(8, "pearson"), (20_000, "pearson")])
def test_grid_in_passes(odd, sim, hot):
    odd = odd.dropna()
    sets = [{"k": 3, "min_k": 1}, {"k": 6, "min_k": 2}] + [{"k": 3, "min_k": 1, "min_support": 3}]
    one, many = (rows_of(neighbours.knn_grid(odd, odd, sets, sim=sim, hot=hot, chunk=4, at_once=n)) for n in (10**9, 3000))
    assert one == many != []


def test_a_written_table_leaves_no_shuffle_files(spark):
    dirs = [str(d) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]

    def files():
        return {f for d in dirs for at, _, names in os.walk(d) for f in names if f.startswith("shuffle_") and f.endswith(".data")}

    wide = spark.range(50_000).withColumn("k", F.col("id") % 1000).repartition(3, "k").groupBy("k").agg(F.collect_list("id").alias("l"))
    before = files()
    written = materialise(wide, "wide")
    for _ in range(50):  # files go in the background
        if files() <= before:
            break
        time.sleep(0.2)
    assert files() <= before and written.count() == 1000


def test_tables_of_a_pass_go(spark):
    before = tables(spark)
    with passing(spark) as keep:
        inner = materialise(spark.range(5), "inner")
        with passing(spark) as hold:
            nested = hold(materialise(inner, "deep"), "nested")
        out = keep(nested.withColumn("x", F.lit(1)), "out")
        assert len(tables(spark) - before) == 3
    left = tables(spark) - before
    assert len(left) == 1 and out.count() == 5
    with pytest.raises(ZeroDivisionError), passing(spark):
        materialise(spark.range(5), "lost")
        1 / 0
    assert tables(spark) - before == left


def test_trials_and_families_leave_only_their_rows(spark, skewed, tmp_path):
    skewed = skewed.where(f"{C.USER} < 150 and {C.ITEM} < 60")
    before = tables(spark)
    found = latent.tune_latent_factor(skewed, trials=2)
    assert [r.trial for r in found.orderBy("trial").collect()] == [1, 2]
    names = sorted(n.rsplit("-", 1)[0] for n in tables(spark) - before)
    assert names == ["trial", "trial", "tune-test", "tune-train", "tuning"]
    before = tables(spark)
    grid = {"user_cosine": [{"k": 3, "min_k": 1}], "user_itr": [{"k": 3, "min_k": 1}]}
    assert jobs.grid_report(skewed, skewed, grid).count() == 2
    assert sorted(n.rsplit("-", 1)[0] for n in tables(spark) - before) == ["grid-rows", "grid-rows", "grid-test", "grid-train"]
    before = tables(spark)
    features = skewed.select(C.ITEM).distinct().withColumn("features", F.array(F.lit(1.0), (F.col(C.ITEM) % 5).cast("double")))
    paths = jobs.train_all(skewed, features, str(tmp_path / "models"), latent={"rank": 3, "max_iter": 2})
    assert all(spark.read.parquet(p).count() > 0 for p in paths.values())
    assert len(tables(spark) - before) == 1
