"""Neighbourhood predictions for given (userId, movieId) targets.

Output of every model: userId, movieId, est, actual_k, was_impossible.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.functions import scalars as S
from tasteframe.operators import hot_neighbours, itr_blocks, stats
from tasteframe.operators.similarity import (
    BLOCK_PAIRS, CHUNK, HOT, PASS_PAIRS, SIMILARITIES, along, centre_by_user, itr_expr, itr_user_stats, salted_pairs, similar_raters,
)
from tasteframe.scratch import in_passes, materialise, spread


def _target_axis(targets: DataFrame, axis: str) -> DataFrame:
    x, y = (C.USER, C.ITEM) if axis == "user" else (C.ITEM, C.USER)
    return targets.select(F.col(x).alias("x"), F.col(y).alias("y")).distinct()


def neighbour_lookup(
    base: DataFrame, targets: DataFrame, sims: DataFrame, *, hot: int = HOT, chunk: int = CHUNK, carry: Sequence[str] = ()
) -> DataFrame:
    """(x, y, v, sim, r): for a target (x, y) the others v that rated y and are similar to x, with the columns ``carry`` of ``sims``.

    Targets on ordinary y go through the raters of y. Targets on hot y start from the neighbours of x
    and look up their rating of y, so the raters of a hot y are never paired with its targets.
    Eager in one small step: it looks whether any y is hot.
    """
    sizes = base.groupBy("y").agg(F.count("*").alias("n_y"))
    s = sims.select(F.col("u").alias("x"), "v", "sim", *carry)
    cols = ["x", "y", "v", "sim", "r", *carry]

    def via_raters(some: DataFrame) -> DataFrame:
        pairs = salted_pairs(some.select("x", "y", F.lit(0.0).alias("r")), base, sizes, chunk=chunk)
        pairs = pairs.select(F.col("u").alias("x"), "y", "v", F.col("rv").alias("r"))
        return pairs.join(s, ["x", "v"]).select(*cols)

    popular = sizes.where(F.col("n_y") > hot)
    if popular.isEmpty():
        return via_raters(targets)
    many = targets.join(popular.select("y"), "y", "left_semi")
    via_sim = many.join(s, "x").join(base.select(F.col("x").alias("v"), "y", "r"), ["v", "y"])
    return via_raters(targets.join(popular.select("y"), "y", "left_anti")).unionByName(via_sim.select(*cols))


def _from_blocks(
    train: DataFrame, base: DataFrame, want: DataFrame, sizes: DataFrame, axis: str, sim: str, min_n: int, k: int | None, chunk: int, **sums,
) -> DataFrame | None:
    """``similar_raters`` by a named similarity, or None where it needs more than the pair sums or a block cannot hold an id."""
    if sim not in ("cosine", "msd", "pearson", "adjusted_cosine"):
        return None
    values = materialise(along(centre_by_user(train), axis), "centred") if sim == "adjusted_cosine" else base

    def score(n: np.ndarray, s: dict[str, np.ndarray]) -> np.ndarray:
        return hot_neighbours.matrix_sim(sim, n, s["suv"], s["suu"], s["svv"], s["su"], s["sv"], None, None)

    return similar_raters(base, values, want, sizes, score, min_n=min_n, k=k, chunk=chunk, **sums)


def _passes(base: DataFrame, want: DataFrame, sizes: DataFrame, *, hot: int, min_support: int, at_once: int) -> int:
    """How many passes over the ids of the targets keep what a pass shuffles at about ``at_once`` entries: pairs of its ids, and candidates of its targets.

    Eager. Hot y make pairs only where they are not left out (with a support limit), and their targets have as many candidates as their id has pairs.
    """
    bound = sizes.agg(F.sum(F.col("n_y") * F.col("n_y")).alias("pairs"), F.max("n_y").alias("most")).first()
    if bound["most"] is None or bound["most"] <= hot and bound["pairs"] + want.count() * bound["most"] <= at_once:
        return 1
    sized, is_hot = base.join(want.select("x").distinct(), "x", "left_semi").join(sizes, "y"), F.col("n_y") > hot
    out = F.lit(True)
    if min_support > 1:
        out = F.row_number().over(W.partitionBy("x").orderBy(F.col("n_y").desc(), "y")) <= min_support - 1
    pairs = sized.withColumn("out", is_hot & out).groupBy("x").agg(F.sum(F.when(~F.col("out"), F.col("n_y")).otherwise(0)).alias("pairs"))
    asked = want.join(sizes, "y").groupBy("x").agg(F.sum(F.when(~is_hot, F.col("n_y")).otherwise(0)).alias("raters"), F.count_if(is_hot).alias("looked_up"))
    work = pairs.join(asked, "x").agg(F.sum(F.col("pairs") * (F.col("looked_up") + 1) + F.col("raters"))).first()[0] or 0
    return max(1, -(-work // at_once))


def _top_k_estimate(candidates: DataFrame, k: int) -> DataFrame:
    """Per target: weighted mean of dev over the k most similar v, ties by id."""
    w = W.partitionBy("x", "y").orderBy(F.col("sim").desc(), "v")
    best = candidates.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return best.groupBy("x", "y").agg(
        F.sum(F.col("sim") * F.col("dev")).alias("num"), F.sum("sim").alias("den"), F.count("*").alias("actual_k")
    )


def _emit(scored: DataFrame, axis: str, est: Column, impossible: Column, prior: Column, *, clip: bool) -> DataFrame:
    x, y = (C.USER, C.ITEM) if axis == "user" else (C.ITEM, C.USER)
    value = F.when(impossible, prior).otherwise(est)
    return scored.select(
        F.col("x").alias(x), F.col("y").alias(y), (S.clip(value) if clip else value).alias("est"),
        F.when(impossible, 0).otherwise(F.coalesce("actual_k", F.lit(0))).cast("int").alias("actual_k"),
        impossible.alias("was_impossible"),
    ).select(C.USER, C.ITEM, "est", "actual_k", "was_impossible")


def knn_predict(
    train: DataFrame, targets: DataFrame, *, axis: str = "user", sim: str = "cosine", k: int = 40,
    min_k: int = 1, min_support: int = 1, centred: bool = True, clip: bool = True,
    sims: DataFrame | None = None, hot: int = HOT, chunk: int = CHUNK, at_once: int = PASS_PAIRS,
) -> DataFrame:
    """k nearest neighbours along an axis.

    ``centred``: mean_x + sum(s * (r - mean_v)) / sum(s), and mean_x below ``min_k`` neighbours.
    Otherwise: sum(s * r) / sum(s), impossible below ``min_k``. Impossible predictions, and those for
    unknown users or items, take the global mean. The ratings are written to the shared folder once,
    since every step reads them. Targets with more than ``at_once`` candidates and pairs are served in passes.
    """
    train = materialise(train.select(C.USER, C.ITEM, C.RATING), "knn-train")
    base = along(train, axis)
    want = materialise(_target_axis(targets, axis), "knn-targets")
    sizes = base.groupBy("y").agg(F.count("*").alias("n_y"))
    popular = sizes.where(F.col("n_y") > hot)
    cold = popular.isEmpty()
    means = base.groupBy("x").agg(F.avg("r").alias("mean"))

    def best(some: DataFrame) -> DataFrame:
        if sims is None and min_support <= 1 and not cold:
            values = along(centre_by_user(train), axis) if sim == "adjusted_cosine" else base
            found = hot_neighbours.candidates(base, values, some, popular, sizes, sim=sim, k=k, chunk=chunk)
        else:
            found = _from_blocks(train, base, some, sizes, axis, sim, min_support, k, chunk) if sims is None and cold else None
            if found is None:
                similar = sims
                if similar is None:
                    similar = SIMILARITIES[sim](train, axis=axis, min_support=min_support, left=some, hot=hot, chunk=chunk)
                    if not cold:  # read by both ways of the lookup
                        similar = materialise(similar.where(F.col("sim") > 0), "knn-sims")
                found = neighbour_lookup(base, some, similar.where(F.col("sim") > 0), hot=hot, chunk=chunk)
        if centred:
            found = found.join(means.select(F.col("x").alias("v"), F.col("mean").alias("mv")), "v").withColumn(
                "dev", F.col("r") - F.col("mv"))
        else:
            found = found.withColumn("dev", F.col("r"))
        return _top_k_estimate(found, k)

    n = _passes(base, want, sizes, hot=hot, min_support=min_support, at_once=at_once)
    found = in_passes(want, "x", n, best, "knn-sums")
    known_y = base.select("y", F.lit(True).alias("known_y")).distinct()
    scored = want.join(found, ["x", "y"], "left").join(means, "x", "left").join(known_y, "y", "left")
    ratio = F.col("num") / F.nullif(F.col("den"), F.lit(0.0))
    enough = F.coalesce(F.col("actual_k") >= min_k, F.lit(False))
    unknown = F.col("mean").isNull() | F.col("known_y").isNull()
    if centred:
        est = F.col("mean") + F.when(enough, F.coalesce(ratio, F.lit(0.0))).otherwise(0.0)
        impossible = unknown
    else:
        est = ratio
        impossible = unknown | ~enough
    return _emit(scored, axis, est, impossible, stats.global_mean_value(train), clip=clip)


def user_knn_custom(train, targets, *, k=3, min_k=1, sim="msd", min_support=1, **kw) -> DataFrame:
    return knn_predict(train, targets, axis="user", sim=sim, k=k, min_k=min_k, min_support=min_support, **kw)


def user_knn_cosine(train, targets, *, k=40, min_k=1, min_support=1, **kw) -> DataFrame:
    return knn_predict(train, targets, axis="user", sim="cosine", k=k, min_k=min_k, min_support=min_support, **kw)


def user_knn_pearson(train, targets, *, k=40, min_k=1, min_support=1, **kw) -> DataFrame:
    return knn_predict(train, targets, axis="user", sim="pearson", k=k, min_k=min_k, min_support=min_support, **kw)


def item_knn_cosine_means(train, targets, *, k=60, min_k=3, adjusted=False, **kw) -> DataFrame:
    """Item axis with item means; ``adjusted`` takes user means off before the cosine."""
    sim = "adjusted_cosine" if adjusted else "cosine"
    return knn_predict(train, targets, axis="item", sim=sim, k=k, min_k=min_k, **kw)


def item_knn_basic(train, targets, *, k=40, min_k=3, **kw) -> DataFrame:
    return knn_predict(train, targets, axis="item", sim="cosine", k=k, min_k=min_k, centred=False, **kw)


def _with_itr_stats(df: DataFrame, user_stats: DataFrame, key: str) -> DataFrame:
    cols = [c for c in user_stats.columns if c != "x"]
    return df.join(user_stats.select(F.col("x").alias(key), *[F.col(c).alias(f"{key}_{c}") for c in cols]), key)


def _hot_dot() -> Column:
    """Dot product of two users over the hot items, from their rating maps."""
    u, v = F.col("u_hot"), F.col("v_hot")
    zero = F.lit(0.0)
    both = F.aggregate(F.map_keys(u), zero, lambda t, k: t + F.try_element_at(u, k) * F.coalesce(F.try_element_at(v, k), zero))
    return F.coalesce(both, zero)


def _itr_tile(k: int):
    """Best k per target in one tile (targets x raters), counting common hot items only."""

    def dense(items: pa.ChunkedArray, values: pa.ChunkedArray, at: dict, n: int) -> np.ndarray:
        m = np.zeros((n, len(at)))
        for row, (ids, rs) in enumerate(zip(items.to_pylist(), values.to_pylist())):
            for i, r in zip(ids or (), rs or ()):
                if i in at:
                    m[row, at[i]] = r
        return m

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        out = [np.zeros(0)] * 5
        if a.num_rows and b.num_rows:
            b = b.sort_by("v")
            known = {i for ids in a["hot_y"].to_pylist() for i in ids or ()}
            at = {i: c for c, i in enumerate(sorted(known))}
            ha, hb = dense(a["hot_y"], a["hot_r"], at, a.num_rows), dense(b["hot_y"], b["hot_r"], at, b.num_rows)
            col = lambda t, c: t[c].to_numpy()
            na, nb = col(a, "norm")[:, None], col(b, "norm")[None, :]
            dist = np.sqrt(np.maximum(na * na + nb * nb - 2 * (ha @ hb.T), 0))
            gap = np.abs(col(a, "mu")[:, None] - col(b, "mu")[None, :]) * np.abs(col(a, "sd")[:, None] - col(b, "sd")[None, :])
            sims = np.floor((1 - dist / (na + nb)) * (1 - 1 / (1 + np.exp(-gap))) * 1e9 + 0.5) / 1e9
            sims[col(a, "u")[:, None] == col(b, "v")[None, :]] = 0
            top = np.argsort(-sims, axis=1, kind="stable")[:, :k]
            s = np.take_along_axis(sims, top, axis=1)
            rows, cols = np.nonzero(s > 0)
            pick = top[rows, cols]
            out = [col(a, "u")[rows], np.full(len(rows), a["y"][0].as_py()), col(b, "v")[pick], s[rows, cols],
                   col(b, "r")[pick] - col(b, "mu")[pick]]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(out, types)], names=["x", "y", "v", "sim", "dev"])

    return run


def _itr_hot_targets(want: DataFrame, base: DataFrame, user_stats: DataFrame, dots: DataFrame, sizes: DataFrame, k: int, chunk: int) -> DataFrame:
    """Candidates (x, y, v, sim, dev) for targets on hot items, k per target and tile instead of all raters.

    Users with a common ordinary item are looked up one by one with their exact similarity. For all
    raters a tile finds the k best counting common hot items only, which is exact for the rest and never
    too high: more common items only raise the similarity. The best k of both are the best k of all.
    """
    exact = want.select(F.col("x").alias("u"), "y").join(dots, "u").join(
        base.select(F.col("x").alias("v"), "y", "r"), ["v", "y"])
    exact = _with_itr_stats(_with_itr_stats(exact, user_stats, "u"), user_stats, "v").select(
        F.col("u").alias("x"), "y", "v", itr_expr(F.col("suv") + _hot_dot()).alias("sim"), (F.col("r") - F.col("v_mu")).alias("dev"))

    grid = sizes.select("y", F.ceil(F.col("n_y") / chunk).cast("int").alias("c"))
    own = F.pmod(F.xxhash64("x"), F.col("c")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("c") - 1))
    traits = user_stats.select("x", "norm", "mu", "sd", F.map_keys("hot").alias("hot_y"), F.map_values("hot").alias("hot_r"))
    left = want.join(grid, "y").join(traits, "x").select(
        "y", own.alias("lc"), every.alias("rc"), F.col("x").alias("u"), "norm", "mu", "sd", "hot_y", "hot_r")
    right = base.join(want.select("y").distinct(), "y", "left_semi").join(grid, "y").join(traits, "x").select(
        F.col("y").alias("y"), every.alias("lc"), own.alias("rc"), F.col("x").alias("v"), F.col("r").alias("r"),
        *[F.col(c).alias(c) for c in ("norm", "mu", "sd", "hot_y", "hot_r")])
    keys = ["y", "lc", "rc"]
    tiles = spread(left, *keys).groupBy(*keys).cogroup(spread(right, *keys).groupBy(*keys)).applyInArrow(
        _itr_tile(k), "x long, y long, v long, sim double, dev double")
    both = exact.unionByName(tiles)
    return both.groupBy("x", "y", "v").agg(F.max("sim").alias("sim"), F.max("dev").alias("dev"))


def itr_sums(
    train: DataFrame, targets: DataFrame, cuts: Sequence[int], *, hot: int = HOT, chunk: int = CHUNK, block: int = BLOCK_PAIRS,
    at_once: int = PASS_PAIRS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(x, y, k<k> (num, den, n)): sums over the k best neighbours of every target, for all ``cuts``; the targets (x, y); the means of their users (x, mean).

    Added up in blocks of users where no item is hot and a block holds every user, else from rows of candidates; in passes over the users
    where there are more than ``at_once`` pairs and candidates. Eager.
    """
    base = along(train, "user")
    want = materialise(_target_axis(targets, "user"), "itr-targets")
    sizes = base.groupBy("y").agg(F.count("*").alias("n_y"))
    popular = sizes.where(F.col("n_y") > hot)
    user_stats = itr_user_stats(train)
    asked_stats = materialise(user_stats.join(want.select("x").distinct(), "x", "left_semi"), "itr-asked")
    means = asked_stats.select("x", F.col("mu").alias("mean"))
    cold = popular.isEmpty()

    def added(some: DataFrame) -> DataFrame:
        sums = itr_blocks.itr_sums(base, some, user_stats, asked_stats, sizes, cuts, chunk=chunk, block=block) if cold else None
        if sums is None:
            found = _itr_candidates(base, some, user_stats, sizes, popular, k=max(cuts), chunk=chunk)
            ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("x", "y").orderBy(F.col("sim").desc(), "v"))).where(F.col("rank") <= max(cuts))
            upto = lambda k, value: F.when(F.col("rank") <= k, value)
            sums = ranked.groupBy("x", "y").agg(*[F.struct(
                F.sum(upto(k, F.col("sim") * F.col("dev"))).alias("num"), F.sum(upto(k, F.col("sim"))).alias("den"), F.count(upto(k, F.lit(1))).alias("n")).alias(f"k{k}") for k in cuts])
        return sums

    n = _passes(base, want, sizes, hot=hot, min_support=1, at_once=at_once)
    sums = in_passes(want, "x", n, added, "itr-sums")
    return sums, want, means


def _itr_candidates(base: DataFrame, want: DataFrame, user_stats: DataFrame, sizes: DataFrame, popular: DataFrame, *, k: int, chunk: int) -> DataFrame:
    """(x, y, v, sim, dev) that hold the k best neighbours of every target. Eager."""
    ordinary, some, hot_part = base, want, F.lit(0.0)
    has_hot = not popular.isEmpty()
    if has_hot:
        popular = materialise(popular, "itr-hot")
        ordinary = base.join(popular.select("y"), "y", "left_anti")
        some = want.join(popular.select("y"), "y", "left_anti")
        maps = base.join(popular.select("y"), "y", "left_semi").groupBy("x").agg(
            F.map_from_entries(F.collect_list(F.struct("y", "r"))).alias("hot"))
        none = F.map_from_arrays(F.array().cast("array<bigint>"), F.array().cast("array<double>"))
        user_stats = materialise(user_stats.join(maps, "x", "left").withColumn("hot", F.coalesce("hot", none)), "itr-users")
        hot_part = _hot_dot()
    asked = ordinary.join(want.select("x").distinct(), "x", "left_semi")
    pairs = salted_pairs(asked, ordinary, sizes, chunk=chunk)
    dots = pairs.groupBy("u", "v").agg(F.sum(F.col("ru") * F.col("rv")).alias("suv"))
    raters = salted_pairs(some.withColumn("r", F.lit(0.0)), base, sizes, chunk=chunk).select("u", "y", "v", F.col("rv").alias("r"))
    found = raters.join(dots, ["u", "v"], "left")
    found = _with_itr_stats(_with_itr_stats(found, user_stats, "u"), user_stats, "v")
    found = found.select(
        F.col("u").alias("x"), "y", "v", itr_expr(F.coalesce("suv", F.lit(0.0)) + hot_part).alias("sim"),
        (F.col("r") - F.col("v_mu")).alias("dev"))
    if has_hot:
        many = want.join(popular.select("y"), "y", "left_semi")
        found = found.unionByName(_itr_hot_targets(many, base, user_stats, dots, popular, k, chunk))
    return found.where(F.col("sim") > 0)


def user_knn_itr(
    train: DataFrame, targets: DataFrame, *, k: int = 40, min_k: int = 3, clip: bool = True, hot: int = HOT, chunk: int = CHUNK, at_once: int = PASS_PAIRS,
) -> DataFrame:
    """ITR neighbours among all raters of the target item, with or without common items.

    Below ``min_k`` neighbours, and for unknown items, the user mean; unknown users take the global mean.
    Without hot items (more than ``hot`` ratings) blocks of users find them (``itr_blocks``). Else dot products over
    ordinary items come from a join, those over hot items from a small map per user, so a hot item never pairs its raters.
    Eager in small steps.
    """
    train = materialise(train.select(C.USER, C.ITEM, C.RATING), "itr-train")
    sums, want, means = itr_sums(train, targets, [k], hot=hot, chunk=chunk, at_once=at_once)
    best = F.col(f"k{k}")
    best = sums.select("x", "y", best["num"].alias("num"), best["den"].alias("den"), best["n"].alias("actual_k"))
    scored = want.join(best, ["x", "y"], "left").join(means, "x", "left")
    enough = F.coalesce(F.col("actual_k") >= min_k, F.lit(False))
    est = F.col("mean") + F.when(enough, F.coalesce(F.col("num") / F.nullif(F.col("den"), F.lit(0.0)), F.lit(0.0))).otherwise(0.0)
    return _emit(scored, "user", est, F.col("mean").isNull(), stats.global_mean_value(train), clip=clip)


def content_knn(
    train: DataFrame, targets: DataFrame, features: DataFrame, *, k: int = C.CONTENT_KNN_K,
    rows_per_tile: int = 4096, rows_per_block: int = 5_000, clip: bool = True,
) -> DataFrame:
    """mean_u + sum(s * (r - mean_u)) / (sum|s| + 1e-8) over the k rated items closest to the target item.

    Closeness is the cosine of the feature arrays, positive ones only. A user's rated items and
    targets are cut into tiles of at most ``rows_per_tile`` rows (more tiles for larger users); a tile
    multiplies its two blocks and passes on only the k best per target.
    """
    train = materialise(train.select(C.USER, C.ITEM, C.RATING), "content-train")
    want = materialise(targets.select(C.USER, C.ITEM).distinct(), "content-targets")
    rated = train.join(features, C.ITEM).select(C.USER, C.ITEM, C.RATING, "features")
    means = rated.groupBy(C.USER).agg(F.avg(C.RATING).alias("mean"), F.count("*").alias("n"))
    asked = want.join(features, C.ITEM)
    n_asked = asked.groupBy(C.USER).agg(F.count("*").alias("m"))
    tiles = means.join(n_asked, C.USER).select(
        C.USER, F.ceil(F.col("n") / rows_per_tile).cast("int").alias("rt"),
        F.ceil(F.col("m") / rows_per_tile).cast("int").alias("tt"))
    # Ordinary users (one tile) share a group with others; there are enough groups to keep each small.
    blocks = max(1, train.count() // rows_per_block)
    block = F.pmod(F.xxhash64(C.USER), F.lit(blocks)).cast("int")
    part = lambda n: F.pmod(F.xxhash64(C.ITEM), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = asked.join(tiles, C.USER).select(
        block.alias("ub"), F.col(C.USER).alias("u"), part("tt").alias("tb"), every("rt").alias("rb"),
        F.col(C.ITEM).alias("target"), F.col("features").alias("tvec"))
    right = rated.join(tiles, C.USER).select(
        block.alias("ub"), F.col(C.USER).alias("u"), every("tt").alias("tb"), part("rt").alias("rb"),
        F.col(C.ITEM).alias("other"), F.col(C.RATING).alias("r"), F.col("features").alias("rvec"))

    def unit_rows(column: pa.ChunkedArray) -> np.ndarray:
        m = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
        norms = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)

    def nearest(a: pa.Table, b: pa.Table) -> pa.Table:
        a, b = a.sort_by("u"), b.sort_by([("u", "ascending"), ("other", "ascending")])
        au, bu = a["u"].to_numpy(), b["u"].to_numpy()
        out = []
        if len(au) and len(bu):
            tv, rv = unit_rows(a["tvec"]), unit_rows(b["rvec"])
            target, other, r = a["target"].to_numpy(), b["other"].to_numpy(), b["r"].to_numpy()
            for user in np.intersect1d(au, bu):
                ta, tb = np.searchsorted(au, [user, user + 1])
                ra, rb = np.searchsorted(bu, [user, user + 1])
                sims = np.floor(tv[ta:tb] @ rv[ra:rb].T * 1e9 + 0.5) / 1e9
                top = np.argsort(-sims, axis=1, kind="stable")[:, :k]
                s = np.take_along_axis(sims, top, axis=1)
                rows, cols = np.nonzero(s > 0)
                pick = ra + top[rows, cols]
                out.append((np.full(len(rows), user), target[ta + rows], other[pick], s[rows, cols], r[pick]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0)] * 5
        types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(cols, types)], names=["x", "y", "v", "sim", "r"])

    keys = ["ub", "tb", "rb"]
    near = spread(left, *keys).groupBy(*keys).cogroup(spread(right, *keys).groupBy(*keys)).applyInArrow(
        nearest, "x long, y long, v long, sim double, r double")
    found = near.join(means.select(F.col(C.USER).alias("x"), "mean"), "x").select(
        "x", "y", "v", "sim", (F.col("r") - F.col("mean")).alias("dev"))
    known_item = train.select(F.col(C.ITEM).alias("y"), F.lit(True).alias("known_y")).distinct()
    known_user = train.groupBy(F.col(C.USER).alias("x")).agg(F.lit(True).alias("known_x"))
    scored = (
        want.select(F.col(C.USER).alias("x"), F.col(C.ITEM).alias("y"))
        .join(_top_k_estimate(found, k), ["x", "y"], "left")
        .join(means.select(F.col(C.USER).alias("x"), "mean"), "x", "left")
        .join(known_user, "x", "left").join(known_item, "y", "left")
    )
    prior = stats.global_mean_value(train)
    est = F.coalesce(F.col("mean"), prior) + F.coalesce(F.col("num") / (F.col("den") + 1e-8), F.lit(0.0))
    impossible = F.col("known_x").isNull() | F.col("known_y").isNull()
    return _emit(scored, "user", est, impossible, prior, clip=clip)


Setting = dict[str, int]


def knn_grid(
    train: DataFrame, targets: DataFrame, settings: Sequence[Setting], *, axis: str = "user", sim: str = "cosine", centred: bool = True,
    clip: bool = True, hot: int = HOT, chunk: int = CHUNK, at_once: int = PASS_PAIRS,
) -> DataFrame:
    """``knn_predict`` for many settings (k, min_k, min_support; default 1) from one search: its rows, with the settings as columns.

    Neighbours carry their support. For each support that is asked for they are ranked once, and the sums up to every k are
    taken in one step, in the block that finds them where no y is hot; ``min_k`` only chooses between them and the mean. With sim "itr" (no support) as ``user_knn_itr``.
    The ratings are written once. Eager.
    """
    settings = [dict(s) for s in dict.fromkeys(tuple(sorted(({"min_k": 1, "min_support": 1} | s).items())) for s in settings)]
    supports, cuts = sorted({s["min_support"] for s in settings}), sorted({(s["k"], s["min_support"]) for s in settings})
    most = max(k for k, _ in cuts)
    train = materialise(train.select(C.USER, C.ITEM, C.RATING), "grid-train")
    base = along(train, axis)
    if sim == "itr":
        if axis != "user" or supports != [1]:
            raise ValueError("itr has no support and compares users")
        sums, want, means = itr_sums(train, targets, [k for k, _ in cuts], hot=hot, chunk=chunk, at_once=at_once)
        sums = sums.select("x", "y", *[F.col(f"k{k}").alias(f"k{k}s{s}") for k, s in cuts])
    else:
        want = materialise(_target_axis(targets, axis), "grid-targets")
        sizes = base.groupBy("y").agg(F.count("*").alias("n_y"))
        means = materialise(base.groupBy("x").agg(F.avg("r").alias("mean")), "grid-means")
        less = {"less": means} if centred else {}
        cold = sizes.where(F.col("n_y") > hot).isEmpty()

        def upto(k: int, support: int, value: Column) -> Column:
            return F.sum(F.when((F.col("rank") <= k) & (F.col("at_least") == support), value))

        def added(some: DataFrame) -> DataFrame:
            sums = _from_blocks(train, base, some, sizes, axis, sim, supports[0], None, chunk, cuts=cuts, **less) if cold else None
            if sums is not None:
                return sums
            sims = SIMILARITIES[sim](train, axis=axis, min_support=supports[0], left=some, hot=hot, chunk=chunk).where(F.col("sim") > 0)
            found = neighbour_lookup(base, some, sims, hot=hot, chunk=chunk, carry=["support"])
            if centred:
                found = found.join(means.select(F.col("x").alias("v"), F.col("mean").alias("mv")), "v").withColumn("dev", F.col("r") - F.col("mv"))
            else:
                found = found.withColumn("dev", F.col("r"))
            each = F.explode(F.filter(F.array(*map(F.lit, supports)), lambda s: s <= F.col("support")))
            ranked = found.withColumn("at_least", each)
            ranked = ranked.withColumn("rank", F.row_number().over(W.partitionBy("x", "y", "at_least").orderBy(F.col("sim").desc(), "v"))).where(F.col("rank") <= most)
            return ranked.groupBy("x", "y").agg(*[
                F.struct(upto(k, s, F.col("sim") * F.col("dev")).alias("num"), upto(k, s, F.col("sim")).alias("den"), F.coalesce(upto(k, s, F.lit(1)), F.lit(0)).alias("n")).alias(f"k{k}s{s}")
                for k, s in cuts])

        n = _passes(base, want, sizes, hot=hot, min_support=supports[0], at_once=at_once)
        sums = in_passes(want, "x", n, added, "grid-sums")
    known_y = base.select("y", F.lit(True).alias("known_y")).distinct()
    scored = want.join(sums, ["x", "y"], "left").join(means, "x", "left").join(known_y, "y", "left")
    cells = F.array(*[
        F.struct(*[F.lit(int(s[c])).alias(c) for c in ("k", "min_k", "min_support")], F.col(f"k{s['k']}s{s['min_support']}").alias("sums")) for s in settings])
    rows = scored.select("x", "y", "mean", "known_y", F.explode(cells).alias("c")).select("x", "y", "mean", "known_y", "c.k", "c.min_k", "c.min_support", "c.sums.*")
    ratio = F.col("num") / F.nullif(F.col("den"), F.lit(0.0))
    enough = F.coalesce(F.col("n") >= F.col("min_k"), F.lit(False))
    unknown = F.col("mean").isNull() if sim == "itr" else F.col("mean").isNull() | F.col("known_y").isNull()
    if centred:
        est, impossible = F.col("mean") + F.when(enough, F.coalesce(ratio, F.lit(0.0))).otherwise(0.0), unknown
    else:
        est, impossible = ratio, unknown | ~enough
    value = F.when(impossible, stats.global_mean_value(train)).otherwise(est)
    x, y = (C.USER, C.ITEM) if axis == "user" else (C.ITEM, C.USER)
    return rows.select(
        F.col("x").alias(x), F.col("y").alias(y), "k", "min_k", "min_support", (S.clip(value) if clip else value).alias("est"),
        F.when(impossible, 0).otherwise(F.coalesce("n", F.lit(0))).cast("int").alias("actual_k"), impossible.alias("was_impossible"))


def sweep_min_k(train: DataFrame, targets: DataFrame, values, *, k: int = 3, min_support: int = 1, sim: str = "msd", **kw) -> DataFrame:
    """``knn_predict`` for all values of ``min_k``, from one search."""
    grid = knn_grid(train, targets, [{"k": k, "min_k": int(v), "min_support": min_support} for v in values], sim=sim, **kw)
    return grid.select(C.USER, C.ITEM, "est", "actual_k", "was_impossible", "min_k")


def sweep_min_support(train: DataFrame, targets: DataFrame, values, *, k: int = 40, min_k: int = 1, **kw) -> DataFrame:
    """``knn_predict`` for all values of ``min_support``, from one search."""
    grid = knn_grid(train, targets, [{"k": k, "min_k": min_k, "min_support": int(v)} for v in values], **kw)
    return grid.select(C.USER, C.ITEM, "est", "actual_k", "was_impossible", "min_support")
