"""The paths for hot keys give the same numbers as plain brute force."""

from __future__ import annotations

import itertools
import math
import warnings
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.operators import catalogue, evaluate, features, latent, linear, neighbours, ranking, scoring, similarity, stats


def triplets(df):
    return [(r.userId, r.movieId, r.rating) for r in df.collect()]


def brute_pairs(rows, axis):
    by_y = defaultdict(list)
    for u, i, r in rows:
        x, y = (u, i) if axis == "user" else (i, u)
        by_y[y].append((x, r))
    sums = defaultdict(lambda: np.zeros(4))
    for members in by_y.values():
        for (a, ra), (b, rb) in itertools.permutations(members, 2):
            sums[a, b] += (1, ra * rb, ra * ra, rb * rb)
    return sums


@pytest.mark.parametrize("axis", ["user", "item"])
@pytest.mark.parametrize("m", [1, 2, 3])
def test_pair_sums_with_a_hot_key(skewed, axis, m):
    want = {k: v for k, v in brute_pairs(triplets(skewed), axis).items() if v[0] >= m}
    got = similarity.corated_pairs(skewed, axis=axis, min_support=m, hot=50, chunk=40).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r.n, r.suv, r.suu, r.svv) == pytest.approx(tuple(want[r.u, r.v]))


def test_a_hot_item_creates_no_candidate_pairs(skewed):
    """With two common items asked for, pairs that meet only on the hot item are never built."""
    base = similarity.along(skewed, "user")
    hot_rows = base.where(F.col("y") == 0).count()
    assert hot_rows * 3 > base.count() * 0.9
    pairs = similarity.corated_pairs(skewed, min_support=2, hot=50)
    assert pairs.count() < hot_rows * (hot_rows - 1) / 4


@pytest.mark.parametrize("block", [similarity.BLOCK_PAIRS, 1500])
def test_left_out_ratings_are_added_without_rows_of_pairs(spark, skewed, monkeypatch, block):
    """All pairs, u < v, and those of some users; null ratings; with small blocks ids that a block does not hold come from the join."""
    rows = skewed.withColumn(C.RATING, F.when((F.col(C.USER) + F.col(C.ITEM)) % 11 != 0, F.col(C.RATING)))
    asked = spark.createDataFrame([(u,) for u in range(0, 400, 3)], "x long")
    used = []
    join = similarity.salted_pairs
    monkeypatch.setattr(similarity, "salted_pairs", lambda *a, **b: used.append(1) or join(*a, **b))
    want = {(r.u, r.v): r for r in similarity._sum_pairs(join(*[similarity.along(rows, "user")] * 2, similarity.along(rows, "user").groupBy("y").agg(F.count("*").alias("n_y")))).where("n >= 3").collect()}
    for kw, keep in (({}, lambda u, v: True), ({"ordered": True}, lambda u, v: u < v), ({"left": asked}, lambda u, v: u % 3 == 0)):
        got = {(r.u, r.v): r for r in similarity.corated_pairs(rows, min_support=3, hot=50, chunk=40, block=block, **kw).collect()}
        assert set(got) == {k for k in want if keep(*k)} and len(got) > 0
        for k, r in got.items():
            assert tuple(r)[:3] == tuple(want[k])[:3]
            assert [a is None for a in r] == [a is None for a in want[k]]
            assert [a for a in r if a is not None] == pytest.approx([a for a in want[k] if a is not None])
    assert bool(used) == (block == 1500)


def test_neighbour_model_with_hot_targets(spark, skewed):
    train = skewed.where((F.col(C.USER) + F.col(C.ITEM)) % 5 != 0)
    targets = skewed.where((F.col(C.USER) + F.col(C.ITEM)) % 5 == 0).select(C.USER, C.ITEM)
    for axis in ("user", "item"):
        kw = {"axis": axis, "sim": "cosine", "k": 10, "min_k": 1, "min_support": 2}
        plain = {(r.userId, r.movieId): r for r in neighbours.knn_predict(train, targets, **kw).collect()}
        hot = neighbours.knn_predict(train, targets, **kw, hot=30, chunk=25).collect()
        assert len(hot) == len(plain)
        for r in hot:
            p = plain[r.userId, r.movieId]
            assert r.est == pytest.approx(p.est, abs=1e-9) and r.actual_k == p.actual_k


@pytest.mark.parametrize("axis,sim", [
    ("user", "cosine"), ("item", "cosine"), ("user", "msd"), ("item", "pearson"), ("user", "jaccard"), ("item", "adjusted_cosine"),
])
def test_neighbours_without_support_limit(skewed, axis, sim):
    """Several hot values, targets on hot and ordinary ones, pairs that meet on hot values only."""
    train = skewed.where((F.col(C.USER) * 3 + F.col(C.ITEM)) % 4 != 0)
    targets = skewed.where((F.col(C.USER) * 3 + F.col(C.ITEM)) % 4 == 0).select(C.USER, C.ITEM)
    kw = {"axis": axis, "sim": sim, "k": 6, "min_k": 1, "centred": sim != "jaccard"}
    hot = 4 if axis == "item" else 12
    plain = {(r.userId, r.movieId): r for r in neighbours.knn_predict(train, targets, **kw).collect()}
    got = neighbours.knn_predict(train, targets, **kw, hot=hot, chunk=35).collect()
    assert len(got) == len(plain)
    off = [r for r in got if abs(r.est - plain[r.userId, r.movieId].est) > 1e-7 or r.actual_k != plain[r.userId, r.movieId].actual_k]
    assert not off


def test_itr_with_hot_items(skewed):
    train = skewed.where((F.col(C.USER) + F.col(C.ITEM)) % 5 != 0)
    targets = skewed.where((F.col(C.USER) + F.col(C.ITEM)) % 5 == 0).select(C.USER, C.ITEM)
    plain = {(r.userId, r.movieId): r for r in neighbours.user_knn_itr(train, targets, k=10, min_k=2).collect()}
    hot = neighbours.user_knn_itr(train, targets, k=10, min_k=2, hot=30, chunk=35).collect()
    assert len(hot) == len(plain) and any(r.movieId == 0 for r in hot)
    for r in hot:
        p = plain[r.userId, r.movieId]
        assert r.est == pytest.approx(p.est, abs=1e-7) and r.actual_k == p.actual_k


def test_global_rank_equals_a_single_sort(skewed):
    got = ranking.popularity_rank(skewed).orderBy("rank").collect()
    want = sorted(((r.movieId, r.n) for r in got), key=lambda p: (-p[1], p[0]))
    assert [(r.movieId, r.n) for r in got] == want and [r["rank"] for r in got] == list(range(1, len(got) + 1))
    tail = ranking.long_tail(skewed).orderBy("rank").collect()
    share = np.cumsum([r.frequency for r in tail]) / sum(r.frequency for r in tail)
    assert [r.cumulative_share for r in tail] == pytest.approx(list(share))


def test_tag_combinations_with_ties_equal_listing(spark):
    """Ties at every place, tags with bars and with characters on both sides of the bar, a hot item, an item without id."""
    rng = np.random.default_rng(5)
    words = ["a", "ab", "a|b", "a|", "b", "~x", "zoo", "é", "b c"]
    rows = [(i, words[j]) for i in range(120) for j in rng.choice(len(words), rng.integers(1, 4), replace=False)]
    rows += [(500, f"t{j}") for j in range(3000)] + [(None, "a"), (None, "only here")] + rows[:40]
    tags = spark.createDataFrame(rows, f"{C.ITEM} long, tag string")
    counts = Counter("|".join(r.tags) for r in stats.tags_per_item(tags).collect() if len(r.tags) >= 2)
    for k in (1, 5, 12, 1000):
        want = sorted(counts.items(), key=lambda c: (-c[1], c[0].encode()))[:k]
        assert [(r.combination, r.n) for r in stats.top_tag_combinations(tags, k).collect()] == want


def test_close_estimates_spread_over_ranges(spark):
    """A user whose estimates differ in the sixth decimal, and a small one: even ranges, and the count of all pairs."""
    rng = np.random.default_rng(8)
    rows = [(1, i, float(rng.integers(1, 6)), 3.5 + float(rng.integers(0, 2500)) * 1e-6) for i in range(3000)]
    rows += [(2, 1, 4.0, 3.0), (2, 2, 1.0, 2.0), (2, 3, 2.0, -7.0), (2, 4, 5.0, 90.0)]
    p = spark.createDataFrame(rows, f"{C.USER} long, {C.ITEM} long, {C.RATING} double, est double")
    cells = p.groupBy(C.USER, C.RATING, "est").agg(F.count("*").alias("c"))
    sizes = {(r[C.USER], r.b): r.n for r in evaluate.estimate_ranges(cells, buckets=16, large=100).groupBy(C.USER, "b").agg(F.count("*").alias("n")).collect()}
    of_1 = [n for (u, _), n in sizes.items() if u == 1]
    assert len(of_1) == 16 and max(of_1) < 2 * sum(of_1) / 16 and sizes[(2, 0)] == 4
    nc = nd = 0
    for u in (1, 2):
        r, e = (np.array([x[j] for x in rows if x[0] == u]) for j in (2, 3))
        above, better = r[:, None] > r[None, :], e[:, None] > e[None, :]
        nc, nd = nc + int((above & better).sum()), nd + int((above & ~better).sum())
    assert evaluate.fcp(p, buckets=16, large=100).first()[0] == pytest.approx(nc / (nc + nd), abs=1e-12)
    assert evaluate.fcp(p).first()[0] == pytest.approx(nc / (nc + nd), abs=1e-12)


def test_fcp_equals_listing_all_pairs(skewed):
    p = skewed.withColumn("est", F.round((F.col(C.ITEM) * 7 + F.col(C.USER)) % 45 / 10 + 0.5, 1))
    nc = nd = 0
    per_user = defaultdict(list)
    for r in p.collect():
        per_user[r.userId].append((r.rating, r.est))
    for rows in per_user.values():
        for (ra, ea), (rb, eb) in itertools.permutations(rows, 2):
            if ra > rb:
                nc, nd = nc + (ea > eb), nd + (ea <= eb)
    for buckets in (1, 7, 256):
        assert evaluate.fcp(p, buckets=buckets, large=3).first()[0] == pytest.approx(nc / (nc + nd))


@pytest.fixture(scope="module")
def training(spark, skewed):
    rng = np.random.default_rng(5)
    x = spark.createDataFrame([(i, [float(v) for v in rng.random(4)]) for i in range(120)], f"{C.ITEM} long, features array<double>")
    return linear.training_rows(skewed, x), x


def as_dict(models):
    return {r.userId: (r.intercept, np.array(r.coef)) for r in models.collect()}


def user_rows(rows, user):
    data = sorted(rows.where(F.col(C.USER) == user).collect(), key=lambda r: r.movieId)
    return np.array([r.features for r in data]), np.array([r.rating for r in data])


@pytest.mark.parametrize("fit", [
    linear.user_linear, lambda r, **k: linear.user_ridge(r, alpha=2.0, **k), lambda r, **k: linear.user_elasticnet(r, alpha=0.01, l1_ratio=0.5, **k),
])
def test_chunked_users_get_the_same_model(training, fit):
    rows, _ = training
    whole, parts = as_dict(fit(rows)), as_dict(fit(rows, limit=30))
    assert whole.keys() == parts.keys()
    for u, (b, w) in whole.items():
        assert parts[u][0] == pytest.approx(b, abs=1e-6) and parts[u][1] == pytest.approx(w, abs=1e-6)


def test_ridge_against_normal_equations(training):
    rows, _ = training
    b, w = as_dict(linear.user_ridge(rows, alpha=2.0))[0]
    x, y = user_rows(rows, 0)
    z = np.hstack([x, np.ones((len(y), 1))])
    want = np.linalg.solve(z.T @ z + np.diag([2.0] * 4 + [0.0]), z.T @ y)
    assert np.append(w, b) == pytest.approx(want, abs=1e-8)


def test_elastic_net_meets_the_optimality_conditions():
    rng = np.random.default_rng(0)
    for n, p in ((8, 12), (60, 5), (40, 40)):
        x, y = rng.random((n, p)), rng.random(n) * 4
        m = linear.Moments.of(x, y)
        for alpha, l1 in ((0.01, 0.8), (0.1, 1.0), (0.05, 0.1), (10.0, 0.5)):
            w = linear.solve_elastic_net(m, alpha, l1)
            grad = (m.c - m.g @ w) / n - alpha * (1 - l1) * w
            assert np.all(np.abs(grad) <= alpha * l1 + 1e-6)
            assert np.all(np.abs(grad[w != 0] - alpha * l1 * np.sign(w[w != 0])) < 1e-6)


def svr_loss(w, x, y, cost, eps):
    return 0.5 * w @ w + cost * np.maximum(np.abs(y - x @ w[:-1] - w[-1]) - eps, 0).sum()


def test_svr_is_near_the_best_loss():
    rng = np.random.default_rng(1)
    x = rng.random((50, 4))
    y = x @ np.array([1.0, -2.0, 0.5, 0.0]) + 3 + rng.normal(size=50) * 0.3
    for cost, eps in ((0.1, 0.25), (0.5, 0.5), (5.0, 0.1)):
        best = svr_loss(linear.solve_svr(x, y, cost, eps), x, y, cost, eps)
        # Plain subgradient descent with averaging as an independent check.
        w, low = np.zeros(5), math.inf
        z = np.hstack([x, np.ones((50, 1))])
        for t in range(1, 20001):
            r = y - z @ w
            g = w - cost * z.T @ (np.sign(r) * (np.abs(r) > eps))
            w = w - g / (5 + 0.5 * t)
            low = min(low, svr_loss(w, x, y, cost, eps))
        assert best <= low * 1.001 + 1e-6


def test_svr_side_by_side_is_that_of_each():
    rng = np.random.default_rng(2)
    sizes = [*range(1, 70), 150]
    xs = [rng.random((n, 5)).round(int(n) % 3) for n in sizes]
    ys = [rng.integers(1, 11, n) / 2 for n in sizes]
    for x, y, w in zip(xs, ys, linear.solve_svr_many(xs, ys, 0.5, 0.25)):
        assert w == pytest.approx(linear.solve_svr(x, y, 0.5, 0.25), abs=1e-6)
    assert linear.solve_svr_many([], [], 0.5, 0.25) == []


def test_users_share_python_calls(spark):
    """Ordinary users of one block are fitted by one call, a user without id too, each on its own rows in order of the item."""
    rng = np.random.default_rng(4)
    made = [(u, i, float(rng.integers(1, 11)) / 2, [float(v) for v in rng.random(3)]) for u in [None, *range(40)] for i in rng.permutation(3 + (u or 0) % 7).tolist()]
    rows = spark.createDataFrame(made, f"{C.USER} long, {C.ITEM} long, {C.RATING} double, features array<double>")
    calls = spark.sparkContext.accumulator(0)

    def fit(x, y):
        return float(len(y)), np.concatenate([y, x[:, 0]])

    whole = linear.fit_users(rows, fit, linear.solve_ols)
    got = {r[C.USER]: (r.intercept, list(r.coef)) for r in whole.collect()}
    for u in [None, *range(40)]:
        own = sorted((i, r, x) for v, i, r, x in made if v == u)
        assert got.pop(u) == (len(own), [r for _, r, _ in own] + [x[0] for _, _, x in own])
    assert not got

    def count(xs, ys, folds):
        calls.add(1)
        return [fit(x, y) for x, y in zip(xs, ys)]

    assert linear._in_blocks(rows, len(made), count).count() == 41 and calls.value == 1


def test_elastic_net_of_dependent_features_ends_early():
    """Equal columns have many solutions, and the shortest on their support changes a sign: the steps end where they meet the conditions."""
    rng = np.random.default_rng(0)
    for _ in range(300):
        x, y = rng.integers(0, 2, (5, 20)).astype(float), rng.integers(1, 11, 5) / 2
        m = linear.Moments.of(x, y)
        with warnings.catch_warnings():
            warnings.simplefilter("error")
            w = linear.solve_elastic_net(m, 0.1, 1.0, max_iter=5_000)
        grad = (m.c - m.g @ w) / 5
        assert np.all(np.abs(grad) <= 0.1 + 1e-8) and np.all(np.abs(grad - 0.1 * np.sign(w))[np.abs(w) > 1e-9] < 1e-8)


def test_large_users_get_the_same_svr(training):
    rows, _ = training
    some = rows.where(F.col(C.USER) < 3)
    for fit in (
        lambda **k: linear.user_linear_svr(some, cost=0.5, epsilon=0.25, rounds=8, **k),
        lambda **k: linear.user_linear_svr_tiered(some, tiers=(20, 30), rounds=3, **k),
    ):
        whole, parts = as_dict(fit()), as_dict(fit(limit=60))
        for u, (b, w) in whole.items():
            assert parts[u][0] == pytest.approx(b, abs=1e-6) and parts[u][1] == pytest.approx(w, abs=1e-6)


def test_dependent_features_have_one_solution(spark):
    rng = np.random.default_rng(8)
    x = rng.random(60)
    rows = [(1, i, float(2 * x[i] + 0.01 * rng.normal()), [float(x[i]), float(x[i] + 1e-7 * rng.normal())]) for i in range(60)]
    rows = spark.createDataFrame(rows, f"{C.USER} long, {C.ITEM} long, {C.RATING} double, features array<double>")
    (whole,), (parts,) = (as_dict(linear.user_linear(rows, limit=n)).values() for n in (1000, 20))
    assert whole[1] == pytest.approx([1.0, 1.0], abs=0.05) and parts[1] == pytest.approx(whole[1], abs=1e-5)


def test_content_tiles_give_the_same_answer(skewed, training):
    _, x = training
    train = skewed.where((F.col(C.USER) + F.col(C.ITEM)) % 5 != 0)
    targets = skewed.where((F.col(C.USER) + F.col(C.ITEM)) % 5 == 0)
    one = {(r.userId, r.movieId): r.est for r in neighbours.content_knn(train, targets, x, k=7).collect()}
    many = neighbours.content_knn(train, targets, x, k=7, rows_per_tile=6, rows_per_block=50).collect()
    assert len(many) == len(one)
    assert all(r.est == pytest.approx(one[r.userId, r.movieId], abs=1e-9) for r in many)


def test_top_n_unseen_against_brute_force(spark, skewed, training):
    _, x = training
    rng = np.random.default_rng(9)
    users = spark.createDataFrame([(u, [float(v) * 3 for v in rng.random(4)]) for u in range(40)], f"{C.USER} long, vec array<double>")
    vecs = x.withColumnRenamed("features", "vec")
    got = defaultdict(list)
    for r in scoring.top_n_unseen(users, vecs, skewed, n=5, users_per_block=16, items_per_block=30).orderBy("rank").collect():
        got[r.userId].append(r.movieId)
    seen = {(u, i) for u, i, _ in triplets(skewed)}
    items = {r.movieId: np.array(r.vec) for r in vecs.collect()}
    for u in users.collect():
        score = {i: math.floor(min(5.0, max(0.5, float(np.dot(u.vec, v)))) * 1e9 + 0.5) / 1e9 for i, v in items.items() if (u.userId, i) not in seen}
        assert got.get(u.userId, []) == sorted(score, key=lambda i: (-score[i], i))[:5]


def test_anti_testset_takes_long_lists(skewed):
    want = skewed.select(C.USER).distinct().count() * skewed.select(C.ITEM).distinct().count() - skewed.count()
    assert catalogue.anti_testset(skewed, range(5000)).count() == want


def test_factor_model_finds_planted_structure(spark):
    rng = np.random.default_rng(2)
    p, q = rng.normal(size=(80, 2)), rng.normal(size=(60, 2))
    rows = [(u, i, float(np.clip(2.75 + p[u] @ q[i], 0.5, 5))) for u in range(80) for i in range(60) if (u * 7 + i * 3) % 5]
    held = [(u, i, float(np.clip(2.75 + p[u] @ q[i], 0.5, 5))) for u in range(80) for i in range(60) if not (u * 7 + i * 3) % 5]
    cols = f"{C.USER} long, {C.ITEM} long, {C.RATING} double"
    train, test = spark.createDataFrame(rows, cols), spark.createDataFrame(held, cols)
    model = latent.latent_factor(train, rank=4, max_iter=8, reg=0.02)
    rmse = evaluate.errors(model.predict(test).join(test, [C.USER, C.ITEM])).first().rmse
    base = test.agg(F.stddev_pop(C.RATING)).first()[0]
    assert rmse < 0.5 * base
    top = scoring.top_n_unseen(model.user_vectors(), model.item_vectors(), train, n=3)
    assert top.join(train, [C.USER, C.ITEM]).count() == 0
    assert stats.global_mean(train).first()[0] == pytest.approx(model.mean_table.first()[0])


def test_tiles_of_features_match_a_plain_scaler(spark, items):
    block = features.block_v1(items)
    x, names = features.assemble(block, items)
    width = names.count()
    assert all(len(r.features) == width for r in x.collect())


def test_chunk_sums_of_many_users_share_a_python_call(spark):
    """Users above the limit get the models of whole fits, and their chunks are grouped in blocks, not one by one."""
    rng = np.random.default_rng(8)
    rows = [(u, i, float(rng.integers(1, 11)) / 2, [float(x) for x in rng.normal(size=2)]) for u in range(40) for i in range(5 + u % 30)]
    df = spark.createDataFrame(rows, f"{C.USER} long, {C.ITEM} long, {C.RATING} double, features array<double>")
    whole = {r[C.USER]: r for r in linear.user_ridge(df, alpha=2.0).collect()}
    cut = linear.user_ridge(df, alpha=2.0, limit=6)
    got = {r[C.USER]: r for r in cut.collect()}
    assert set(got) == set(whole) == set(range(40))
    for u, r in got.items():
        assert [r.intercept, *r.coef] == pytest.approx([whole[u].intercept, *whole[u].coef])
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan and "FlatMapGroupsInArrow [b#" in plan
