"""Content models on all features, and the grid of the neighbourhood models, against plain computations."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.operators import features as FT
from tasteframe.operators import linear, neighbours
from tasteframe.plans import jobs, queries_recommend
from tasteframe.scratch import materialise
from tasteframe.sources.adapters import Tables

DIR = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(DIR), reason="shared tables not present")


@tables
def test_ridge_on_v3_solves_the_normal_equations(spark):
    """Every model of the query, its predictions and its explanations."""
    t = Tables(spark, DIR)
    models, x, names = queries_recommend.ridge_v3(t)
    arrays = {r.movieId: np.array(r.features) for r in x.collect()}
    name = {r.position: r.feature for r in names.collect()}
    width = len(next(iter(arrays.values())))
    assert width == len(name) > 100
    rated: dict = {}
    for r in t.train().collect():
        if r.movieId in arrays:
            rated.setdefault(r.userId, []).append((arrays[r.movieId], r.rating))
    found = {r.userId: r for r in models.collect()}
    assert found.keys() == rated.keys()
    for user in sorted(rated)[::7]:
        a, y = np.stack([p[0] for p in rated[user]]), np.array([p[1] for p in rated[user]])
        ac, yc = a - a.mean(axis=0), y - y.mean()
        w = np.linalg.solve(ac.T @ ac + queries_recommend.C_ALPHA * np.eye(width), ac.T @ yc)
        assert np.allclose(found[user].coef, w, atol=1e-6) and found[user].intercept == pytest.approx(y.mean() - a.mean(axis=0) @ w, abs=1e-6)
    known = {r.movieId for r in t.train().collect()}
    test = t.test().select(C.USER, C.ITEM)
    for r in linear.content_predict(models, test, x, t.train()).collect():
        if r.userId in found and r.movieId in known:
            m = found[r.userId]
            assert r.est == pytest.approx(float(np.clip(m.intercept + np.dot(m.coef, arrays[r.movieId]), C.RATING_MIN, C.RATING_MAX)), abs=1e-9) and not r.was_impossible
    items = {r.movieId: r for r in t.items().collect()}
    labels = set()
    for r in linear.explain(models, names, t.items(), test).collect():
        item, m = items[r.movieId], found.get(r.userId)
        if m is None:
            continue
        share = np.abs(m.coef) / np.abs(m.coef).sum() if np.abs(m.coef).sum() > 0 else np.zeros(width)
        words = []
        for p in np.lexsort((np.arange(width), -share))[:5] if share.any() else []:
            f, genres = name[int(p)], (item.genres or "").split("|")
            label = (f.replace("tag_", "") if f.startswith("tag_") else f.replace("genre_", "") if f.startswith("genre_") or f in genres else C.EXPLAIN_LABELS["year"] if f == "year"
                     else next((C.EXPLAIN_LABELS[k] for k in ("genome_", "visual_", "movie_") if f.startswith(k)), None))
            if label and label not in words:
                words.append(label)
        labels |= set(words[:3])
        if words:
            assert f"your profile values {', '.join(words[:3])}. Genres" in r.explanation
        else:
            assert "matches your content profile" in r.explanation
    assert len(labels) > 3


@tables
def test_all_features_least_squares(spark):
    """Plain least squares of the smallest norm on all 23 columns."""
    t = Tables(spark, DIR)
    x = materialise(FT.assemble(queries_recommend.v1_block(t), t.items())[0], "v1")
    rows = linear.training_rows(t.train(), x).collect()
    models = {r.userId: r for r in linear.user_linear(linear.training_rows(t.train(), x)).collect()}
    for user in sorted(models)[::9]:
        a = np.array([r.features for r in rows if r.userId == user])
        y = np.array([r.rating for r in rows if r.userId == user])
        w = np.linalg.pinv(a - a.mean(axis=0), rcond=1e-6) @ (y - y.mean())
        assert np.allclose(a @ np.array(models[user].coef) + models[user].intercept, (a - a.mean(axis=0)) @ w + y.mean(), atol=1e-5)


@pytest.mark.parametrize("axis, sim, centred", [("user", "cosine", True), ("user", "pearson", True), ("item", "cosine", False), ("user", "itr", True)])
def test_grid_equals_each_model(skewed, axis, sim, centred):
    train = skewed.where((F.col(C.USER) + F.col(C.ITEM)) % 5 != 0)
    targets = skewed.where((F.col(C.USER) + F.col(C.ITEM)) % 5 == 0).select(C.USER, C.ITEM)
    settings = [{"k": 3, "min_k": 2}, {"k": 8}, {"k": 8, "min_k": 5}] + ([{"k": 3, "min_support": 3}, {"k": 5, "min_k": 1, "min_support": 2}] if sim != "itr" else [])
    grid = materialise(neighbours.knn_grid(train, targets, settings, axis=axis, sim=sim, centred=centred), "grid")
    assert grid.count() == targets.count() * len(settings)
    for s in settings:
        full = {"min_k": 1, "min_support": 1} | s
        one = grid.where((F.col("k") == full["k"]) & (F.col("min_k") == full["min_k"]) & (F.col("min_support") == full["min_support"]))
        if sim == "itr":
            want = neighbours.user_knn_itr(train, targets, k=full["k"], min_k=full["min_k"])
        else:
            want = neighbours.knn_predict(train, targets, axis=axis, sim=sim, centred=centred, **full)
        want = {(r.userId, r.movieId): r for r in want.collect()}
        for r in one.collect():
            w = want[r.userId, r.movieId]
            assert r.est == pytest.approx(w.est, abs=1e-9) and (r.actual_k, r.was_impossible) == (w.actual_k, w.was_impossible)


def test_the_grid_is_whole():
    names = [jobs.setting_name(f, s) for f, sets in jobs.config_grid().items() if f in jobs.GRID_FAMILIES for s in sets]
    assert len(names) == len(set(names)) > 50 and "user_cosine_k80_min_k5_min_support3" in names
