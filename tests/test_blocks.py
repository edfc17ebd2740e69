"""Blocks with bounds, the threshold search and the protocols give what lists of all pairs give."""

from __future__ import annotations

import subprocess
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.operators import baselines, blocks, evaluate, linear, neighbours, protocols, ranking, recommend, scoring
from tasteframe.scratch import materialise


@pytest.fixture(scope="module")
def catalogue(spark):
    return spark.createDataFrame([(i, f"Item {i}", "Drama") for i in range(125)], C.ITEMS_SCHEMA)


@pytest.fixture(scope="module")
def content(spark, skewed):
    """Ridge models on six features; three items without features, some users without a model."""
    rng = np.random.default_rng(8)
    x = spark.createDataFrame([(i, rng.normal(size=6).tolist()) for i in range(122)], f"{C.ITEM} long, features array<double>")
    models = linear.user_ridge(linear.training_rows(skewed.where(f"{C.USER} % 9 <> 4"), x), alpha=5.0)
    return materialise(models, "models"), materialise(x, "features")


def vectors(spark, rng, n, d, key, spread=1.0):
    return spark.createDataFrame([(k, (rng.normal(size=d) * spread + (1.2 if key == C.USER else 0.9)).tolist()) for k in range(n)], f"{key} long, vec array<double>")


def test_blocks_that_cannot_win_are_skipped(spark, skewed):
    """Equal lists, most (user, block) pairs unvisited, and n rows a user and visit at most."""
    rng = np.random.default_rng(5)
    users = vectors(spark, rng, 400, 4, C.USER, 0.15)
    items = spark.createDataFrame([(k, (v * np.array([0.7, 0.7, 0.8, 0.6])).tolist()) for k, v in enumerate(rng.uniform(0.2, 1.3, 120)[:, None] * np.ones((1, 4)))], f"{C.ITEM} long, vec array<double>")
    report: dict = {}
    got = scoring.top_n_unseen(users, items, skewed, n=4, users_per_block=50, items_per_block=10, report=report)
    u, i = (np.array([r.vec for r in t.orderBy(k).collect()]) for t, k in ((users, C.USER), (items, C.ITEM)))
    s = np.floor(np.clip(u @ i.T, C.RATING_MIN, C.RATING_MAX) * 1e9 + 0.5) / 1e9
    for r in skewed.collect():
        s[r.userId, r.movieId] = -np.inf
    want = {k: np.lexsort((np.arange(120), -s[k]))[: min(4, int(np.isfinite(s[k]).sum()))].tolist() for k in range(400)}
    found: dict = {}
    for r in got.orderBy("rank").collect():
        found.setdefault(r.userId, []).append(r.movieId)
    assert found == {k: v for k, v in want.items() if v}
    assert report["pairs"] == 400 * 12 and report["visited"] < 0.5 * report["pairs"] and report["rows"] <= 4 * report["visited"]


def test_offers_are_never_too_low(spark, skewed, catalogue, content):
    """The bounds of blocks and of the neighbourhood model hold for every pair, with and without a limit of neighbours."""
    train, users, items = skewed, skewed.select(C.USER).distinct(), catalogue
    pairs = materialise(recommend.candidates(items, train, users), "pairs")
    for k, min_k in ((60, 5), (7, 3)):
        near = blocks.itr_bounds(train, 1.0, k=k, min_k=min_k)
        rows = blocks.best_unseen(users, items, train, [], 200, neighbours=near, slack=0.0, items_per_block=30)
        est = neighbours.user_knn_itr(train, pairs, k=k, min_k=min_k).select(C.USER, C.ITEM, "est")
        both = rows.join(est, [C.USER, C.ITEM], "full")
        wrong = both.where("est is null or upper is null or est > upper + 1e-9 or est < lower - 1e-9")
        assert both.count() == pairs.count() and wrong.count() == 0
        spread = both.agg(F.avg(F.col("upper") - F.col("lower"))).first()[0]
        assert spread < 3


def models_of(content):
    models, x = content
    return {
        "svd": baselines.predict_bias, "content": lambda some, want: linear.content_predict(models, want, x, some),
        "itr": lambda some, want: neighbours.user_knn_itr(some, want, **C.ITR_PARAMS),
    }, {"svd": blocks.bias_source, "content": lambda some, users, items, weight: blocks.content_source(models, x, some, weight)}


@pytest.mark.parametrize("names", [("svd", "itr"), ("svd", "content", "itr")])
def test_threshold_search_equals_all_pairs(skewed, catalogue, content, names, monkeypatch):
    """All users, all three weights: the lists of ``recommend``, from fewer scored pairs."""
    monkeypatch.setattr(blocks, "ITEMS_PER_BLOCK", 25)
    models, sources = models_of(content)
    models, sources = {k: models[k] for k in names}, {k: sources[k] for k in names if k != "itr"}
    users = skewed.select(C.USER).distinct()
    want = recommend.recommend(skewed, catalogue, users, models, n=5).collect()
    report: dict = {}
    got = recommend.recommend_all(skewed, catalogue, models, sources, n=5, first=2, report=report).collect()
    key = lambda r: (r.userId, r["rank"])
    assert [tuple(r) for r in sorted(got, key=key)] == [tuple(r) for r in sorted(want, key=key)]
    pairs = 400 * 125 - skewed.count()
    assert report["scored"] <= report["candidates"] < pairs and report["scored"] < 0.6 * pairs


def test_latent_factor_in_the_svd_slot(skewed, catalogue, content):
    from tasteframe.operators import latent

    model = latent.latent_factor(skewed.where("userId % 7 <> 3"), rank=4, max_iter=3)
    models = {"svd": lambda some, want: model.predict(want), "itr": models_of(content)[0]["itr"]}
    sources = {"svd": lambda some, users, items, weight: blocks.latent_source(model, users, items, weight)}
    want = recommend.recommend(skewed, catalogue, skewed.select(C.USER).distinct(), models, n=3).collect()
    got = recommend.recommend_all(skewed, catalogue, models, sources, n=3).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_surprise_me_for_all(skewed, catalogue, content):
    models, x = content
    want = recommend.surprise_me(models, x, skewed, catalogue, models.select(C.USER), n=4).collect()
    got = recommend.surprise_me_all(models, x, skewed, catalogue, n=4).collect()
    assert len(got) == len(want) > 0
    by = {(r.userId, r["rank"]): r for r in want}
    assert all(abs(r.final_score - by[r.userId, r["rank"]].final_score) <= 1e-3 for r in got)


def test_ranks_of_held_out_items(skewed, monkeypatch):
    """Counted in blocks, by pairs, and in plain Python; a held-out item that nobody else rated has no place."""
    more = skewed.unionByName(skewed.sparkSession.createDataFrame([(900, 900, 4.0)], skewed.schema))
    train, held = (materialise(x, "part") for x in evaluate.leave_one_out(more))
    monkeypatch.setattr(blocks, "ITEMS_PER_BLOCK", 20)
    seen: dict = {}
    for r in train.collect():
        seen.setdefault(r.userId, set()).add(r.movieId)
    items = sorted({i for v in seen.values() for i in v})
    for model in (protocols.BIAS, protocols.ITEM_MEAN):
        blocked = {tuple(r) for r in protocols.held_out_ranks(model, train, held).collect()}
        paired = {tuple(r) for r in protocols.held_out_ranks(protocols.Candidate(model.predict), train, held).collect()}
        assert blocked == paired and len(blocked) == 401 and (900, 900, None) in blocked
    means = {r.movieId: r.m for r in train.groupBy(C.ITEM).agg(F.avg(C.RATING).alias("m")).collect()}
    for user, item, rank in blocked:
        if rank is not None:
            better = [j for j in items if j not in seen[user] and j != item and (-round(means[j], 9), j) < (-round(means[item], 9), item)]
            assert rank == len(better) + 1


def test_ranks_from_blocks_that_are_better_as_a_whole(spark, skewed):
    """A block is visited only where it may hold both better and worse items; rated items of the others do not count."""
    train, held = (materialise(x, "part") for x in evaluate.leave_one_out(skewed))
    users, items = train.select(C.USER).distinct(), train.select(C.ITEM).distinct()
    report: dict = {}
    got = {tuple(r) for r in blocks.rank_of(users, items, train, held, blocks.bias_source(train, users, items), items_per_block=5, report=report).collect()}
    paired = {tuple(r) for r in protocols.held_out_ranks(protocols.Candidate(protocols.BIAS.predict), train, held).collect()}
    assert got == {r for r in paired if r[2] is not None} and len(got) > 0
    assert report["visited"] * 4 < report["pairs"]


def test_registry_and_report(skewed, catalogue):
    report = protocols.evaluation_report({"bias": protocols.BIAS, "constant": protocols.Candidate(lambda some, want: baselines.predict_constant(want))}, skewed, catalogue,
                                         metrics={"split": ["rmse"], "loo": ["hit_rate"], "full": ["diversity"]}, n=120)
    rows = {r.model: r for r in report.collect()}
    assert report.columns == ["model", "rmse", "hit_rate", "diversity"] and rows["constant"].rmse > rows["bias"].rmse
    assert rows["bias"].hit_rate == 1.0  # the lists are as long as the catalogue
    with pytest.raises(ValueError, match="unknown metrics of loo: rmse"):
        protocols.evaluation_report({}, skewed, catalogue, metrics={"loo": ["rmse"]})
    with pytest.raises(ValueError, match="exists"):
        protocols.metric("full", "rmse")(lambda rows, context: rows)


def test_nobody_and_nothing(spark, skewed, catalogue):
    none = spark.createDataFrame([], f"{C.USER} long")
    models = {"svd": baselines.predict_bias, "itr": models_of((None, None))[0]["itr"]}
    assert recommend.recommend_all(skewed, catalogue, models, {"svd": blocks.bias_source}, users=none).collect() == []
    assert recommend.recommend_all(skewed, catalogue.limit(0), models, {"svd": blocks.bias_source}).collect() == []
    stranger = spark.createDataFrame([(5000,)], f"{C.USER} long")
    got = recommend.recommend_all(skewed, catalogue, models, {"svd": blocks.bias_source}, users=stranger, n=3).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, recommend.recommend(skewed, catalogue, [5000], models, n=3).collect()))


def test_large_ids_in_random_choices(spark):
    """Ids may be any long."""
    ids = [2**60, -(2**63), 2**63 - 1, 0, -1]
    rows = spark.createDataFrame([(u, i, 3.0) for u in ids for i in ids], f"{C.USER} long, {C.ITEM} long, {C.RATING} double")
    train, test = evaluate.split_train_test(rows)
    assert train.count() + test.count() == 25
    train, held = evaluate.leave_one_out(rows)
    assert held.count() == 5 and train.count() == 20
    est = [r.est for r in baselines.predict_random_uniform(rows).collect()]
    assert len(set(est)) == 25 and all(C.RATING_MIN <= x <= C.RATING_MAX for x in est)
    assert ranking.top50_then_sample(rows.where(f"{C.USER} = 0"), 3, score=C.RATING).count() == 3


def test_entry_without_a_dependency_of_the_optional_parts():
    """Where a package that only they use is missing, all other queries are there."""
    code = ("import sys; sys.modules['zstandard'] = None; sys.modules['tokenizers'] = None; import __spark_entry__ as e; "
            "q, o = e.queries(), e.oracle_sql(); assert 'featured_items' in q and len(q) > 200 and set(o) <= set(q); print(len(q))")  # fmt: skip
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_visits_and_best_items_are_made_a_few_at_a_time():
    """Every user visits every block, and all scores are equal: what is made at once stays small, and nothing is lost."""
    users = pd.DataFrame({C.USER: np.arange(300), "v0": [np.ones(3)] * 300})
    parts = [*blocks._visits(users, np.ones((300, 50), bool), np.arange(50) + 7)]
    assert max(map(len, parts)) <= blocks.VISITS_AT_ONCE < 300 * 50 == sum(map(len, parts))
    met = pd.concat(parts)
    assert set(zip(met[C.USER], met["block"], strict=True)) == {(u, b + 7) for u in range(300) for b in range(50)} and met["block"].dtype == "int32"
    assert not [*blocks._visits(users, np.zeros((300, 50), bool), np.arange(50))]

    score = np.full((300, 40), 3.0)
    score[5, 30], score[6, :] = 4.0, -np.inf
    best = blocks._best(users[C.USER].to_numpy(), np.arange(40) * 2, score, np.full(300, -np.inf), 4)
    lists = best.groupby(C.USER)[C.ITEM].agg(list)
    assert len(lists) == 299 and lists[0] == [0, 2, 4, 6] == lists[299] and lists[5] == [60, 0, 2, 4] and 6 not in lists
    assert len(blocks._best(np.zeros(0, int), np.arange(40), np.zeros((0, 40)), np.zeros(0), 4)) == 0
