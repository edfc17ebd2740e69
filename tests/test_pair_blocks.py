"""Pairs that are added up in blocks: the sums, neighbours and what travels."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.operators import neighbours, similarity

ROWS = f"{C.USER} long, {C.ITEM} long, {C.RATING} double"


def some_rows(seed: int, spread: int = 1) -> list[tuple]:
    """Ratings with repeated rows, null ratings and null ids."""
    rng = np.random.default_rng(seed)
    rows = [(int(u) * spread, int(i), float(r) / 2) for u, i, r in zip(rng.integers(0, 30, 300), rng.integers(0, 25, 300), rng.integers(1, 11, 300))]
    return rows + rows[:20] + [(3 * spread, 4, None), (5 * spread, 4, None), (None, 4, 2.0), (7 * spread, None, 2.0)]


def plain(rows: list[tuple], axis: str) -> dict:
    by_y = defaultdict(list)
    for u, i, r in rows:
        x, y = (u, i) if axis == "user" else (i, u)
        if x is not None and y is not None:
            by_y[y].append((x, r))
    met = defaultdict(list)
    for members in by_y.values():
        for a, ra in members:
            for b, rb in members:
                if a != b:
                    met[a, b].append((ra, rb))
    total = lambda xs: sum(known) if (known := [x for x in xs if x is not None]) else None
    both = lambda f, *v: None if None in v else f(*v)
    return {k: (
        len(v), total(both(lambda a, b: a * b, a, b) for a, b in v), total(both(lambda a: a * a, a) for a, _ in v),
        total(both(lambda b: b * b, b) for _, b in v), total(a for a, _ in v), total(b for _, b in v)) for k, v in met.items()}


def is_close(got, want):
    return all((g is None) == (w is None) and (g is None or math.isclose(g, w, rel_tol=1e-12, abs_tol=1e-12)) for g, w in zip(got, want))


@pytest.mark.parametrize("axis,spread,block", [("user", 1, 10**6), ("item", 2**40, 400)])
def test_sums_with_nulls_repeats_and_large_ids(spark, axis, spread, block):
    rows = some_rows(1, spread)
    base = similarity.along(spark.createDataFrame(rows, ROWS), axis)
    sizes = base.groupBy("y").agg(F.count("*").alias("n_y"))
    want = plain(rows, axis)
    for ordered, m in ((False, 1), (True, 1), (False, 3)):
        got = {(r.u, r.v): tuple(r)[2:] for r in similarity.pair_sums(base, base, sizes, min_n=m, ordered=ordered, chunk=9, block=block).collect()}
        expected = {k: v for k, v in want.items() if v[0] >= m and (not ordered or k[0] < k[1])}
        assert set(got) == set(expected)
        assert all(is_close(got[k], expected[k]) for k in got)


def test_both_directions_and_some_left_ids(spark):
    rows = some_rows(2)
    ratings = spark.createDataFrame(rows, ROWS)
    want = plain(rows, "user")
    both = {(r.u, r.v): tuple(r)[2:] for r in similarity.corated_pairs(ratings, min_support=2).collect()}
    assert set(both) == {k for k, v in want.items() if v[0] >= 2} and all(is_close(both[k], want[k]) for k in both)
    left = spark.createDataFrame([(1,), (2,), (999,)], "x long")
    assert {(r.u, r.v) for r in similarity.corated_pairs(ratings, left=left).collect()} == {k for k in want if k[0] in (1, 2)}


def test_codes_of_ids_far_apart():
    users, v = np.array([3, 9]), np.array([-(2**62), 5, 2**62])
    codes = similarity.Codes.of(users, v)
    pairs = codes.encode(np.array([0, 0, 1]), v)
    assert [c.tolist() for c in codes.decode(pairs)] == [[3, 3, 9], v.tolist()]
    assert codes.find(np.array([9, 9, 4]), np.array([2**62, 6, 5])).tolist() == [pairs[2], -1, -1]


@pytest.mark.parametrize("axis,sim", [("user", "cosine"), ("user", "pearson"), ("item", "msd"), ("item", "adjusted_cosine")])
def test_neighbours_of_blocks_equal_those_of_a_similarity_table(spark, axis, sim):
    rows = [r for r in dict(((u, i), (u, i, r)) for u, i, r in some_rows(3) if u is not None and i is not None).values()]
    ratings = spark.createDataFrame(rows, ROWS)
    train, test = ratings.where((F.col(C.USER) + F.col(C.ITEM)) % 4 != 0), ratings.where((F.col(C.USER) + F.col(C.ITEM)) % 4 == 0)
    targets = test.select(C.USER, C.ITEM).unionByName(spark.createDataFrame([(999, 1), (1, 999)], f"{C.USER} long, {C.ITEM} long"))
    kw = {"axis": axis, "k": 4, "min_k": 2, "min_support": 2}
    sims = similarity.SIMILARITIES[sim](train, axis=axis, min_support=2)
    key = lambda df: {(r[C.USER], r[C.ITEM]): r for r in df.collect()}
    got, want = key(neighbours.knn_predict(train, targets, sim=sim, **kw)), key(neighbours.knn_predict(train, targets, sims=sims, **kw))
    assert set(got) == set(want)
    for k in got:
        assert got[k].est == pytest.approx(want[k].est) and got[k][3:] == want[k][3:]


def test_no_row_per_pair_is_shuffled(spark, ratings):
    """Neither the pairs of a common value nor their sums pass an exchange."""
    for df in (similarity.corated_pairs(ratings, min_support=2, ordered=True), similarity.corated_pairs(ratings, axis="item")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FlatMapGroupsInArrow" in plan and "hashpartitioning(u#" not in plan and "HashAggregate(keys=[u#" not in plan
    targets = ratings.select(C.USER, F.lit(50).cast("long").alias(C.ITEM))
    found = neighbours.knn_predict(ratings, targets, axis="item", k=2)
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().executedPlan().toString()
