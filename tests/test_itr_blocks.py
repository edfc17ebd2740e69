"""ITR neighbours in blocks of users: the rows of the search by candidates, and what travels."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.operators import itr_blocks, neighbours, similarity

ROWS = f"{C.USER} long, {C.ITEM} long, {C.RATING} double"


def some_train(spark, seed: int, spread: int):
    """Ratings with null values and ids, and a user whose values are all null."""
    rng = np.random.default_rng(seed)
    pairs = sorted({(int(u), int(i)) for u, i in zip(rng.integers(0, 30, 420), rng.integers(0, 25, 420))})
    rows = [(u * spread, i, float(rng.integers(1, 11)) / 2) for u, i in pairs]
    rows += [(40 * spread, 4, None), (40 * spread, 5, None), (41 * spread, 4, None), (41 * spread, 6, 3.0), (None, 4, 2.0), (7 * spread, None, 2.0)]
    return spark.createDataFrame(rows, ROWS)


@pytest.mark.parametrize("spread,block", [(1, 10**6), (2**40, 700)])
def test_blocks_equal_the_search_by_candidates(spark, spread, block):
    """Every pair is asked for, with users and items nobody knows; small blocks cut a user's targets apart."""
    train = some_train(spark, 3, spread)
    targets = spark.createDataFrame([(u * spread, i) for u in (*range(0, 30, 2), 40, 41, 99) for i in (*range(25), 77)] + [(None, 3), (4 * spread, None)], f"{C.USER} long, {C.ITEM} long")
    base = similarity.along(train, "user").cache()
    own = {r.x: r.pairs for r in similarity.work_of(base.where("x is not null"), base.groupBy("y").agg(F.count("*").alias("n_y"))).collect()}
    assert block > max(own.values())
    sums, want, means = neighbours.itr_sums(train, targets, [3, 8], chunk=9, block=block)
    plan = sums._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Window" not in plan
    got = {(r.x, r.y): r for r in sums.collect()}
    old, _, _ = neighbours.itr_sums(train, targets, [3, 8], chunk=9, block=1)
    assert "Window" in old._jdf.queryExecution().toString()
    old = {(r.x, r.y): r for r in old.collect()}
    assert len(got) > 300 and set(got) == set(old)
    for key, row in got.items():
        for cut in ("k3", "k8"):
            g, w = row[cut], old[key][cut]
            assert g.n == w.n and g.den == pytest.approx(w.den, abs=1e-9) and g.num == pytest.approx(w.num or 0.0, abs=1e-9)
    assert want.count() == len({(r[C.USER], r[C.ITEM]) for r in targets.collect()})
    assert {r.x for r in means.collect()} == {*(u * spread for u in (*range(0, 30, 2), 40, 41))}


def test_targets_of_a_user_are_cut_into_parts(spark):
    """A user with more raters of targets than a block holds is served by several blocks, each with the user's own lists."""
    train = some_train(spark, 4, 1)
    targets = spark.createDataFrame([(41, i) for i in range(25)], f"{C.USER} long, {C.ITEM} long")
    seen = []
    inner = itr_blocks.spread
    itr_blocks.spread = lambda df, *keys: seen.append(df) or inner(df, *keys)
    try:
        neighbours.itr_sums(train, targets, [5], block=150)
    finally:
        itr_blocks.spread = inner
    lists, raters = (df.groupBy("b").agg(F.sum(F.size("v")).alias("n")).collect() for df in seen)
    assert sum(r.n for r in raters) > 300 and len(raters) > 1 and max(r.n for r in raters) < sum(r.n for r in raters)
    assert {r.b for r in raters} <= {r.b for r in lists}


@pytest.mark.parametrize("axis,sim,centred", [("user", "cosine", True), ("item", "pearson", False)])
def test_grid_sums_in_blocks_equal_the_ranked_rows(spark, axis, sim, centred):
    """Null ratings, unknown ids, several supports: no row per neighbour leaves a block."""
    train = some_train(spark, 5, 1)
    targets = spark.createDataFrame([(u, i) for u in (*range(0, 30, 3), 40, 41, 99) for i in (*range(0, 25, 2), 77)], f"{C.USER} long, {C.ITEM} long")
    settings = [{"k": 3, "min_k": 2}, {"k": 8}, {"k": 8, "min_support": 3}, {"k": 2, "min_support": 5}]
    run = lambda: neighbours.knn_grid(train, targets, settings, axis=axis, sim=sim, centred=centred)
    grid = run()
    assert "Window" not in grid._jdf.queryExecution().toString()
    inner = neighbours._from_blocks
    neighbours._from_blocks = lambda *a, **kw: None
    try:
        plain = run()
        assert "Window" in plain._jdf.queryExecution().toString()
        keys = (C.USER, C.ITEM, "k", "min_k", "min_support")
        want = {tuple(r[c] for c in keys): r for r in plain.collect()}
    finally:
        neighbours._from_blocks = inner
    got = grid.collect()
    assert len(got) == len(want) == targets.count() * len(settings) and any(r.actual_k > 2 for r in got)
    for r in got:
        w = want[tuple(r[c] for c in keys)]
        assert (r.actual_k, r.was_impossible) == (w.actual_k, w.was_impossible)
        assert r.est == w.est or r.est == pytest.approx(w.est, abs=1e-9)
