"""Best unseen items of many users, and ranks of items, without (user, item) rows.

Scores are weighted sums of dot products, each bounded to the scale. Items are put in order of promise and cut into blocks; of
every block a few numbers are kept: the box and the ball that hold its vectors. From them follows the most that a block can
offer a user. Each user first visits the most promising block, which gives the score to beat, and then only the blocks that
can still beat it. In a visit, two matrices are multiplied and a few rows per user leave.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.functions import vectors as V
from tasteframe.operators import ranking, stats
from tasteframe.operators.baselines import bias_model
from tasteframe.operators.surprise import mean_vector
from tasteframe.scratch import materialise, spread

USERS_PER_BLOCK, ITEMS_PER_BLOCK = 512, 4096
#: Rows with vectors that a Python task hands on at once, and users whose best items it picks at once.
VISITS_AT_ONCE, PICKED_AT_ONCE = 4096, 128
#: Ratios of the largest to the smallest weight in a weighted mean for which its bounds are kept, and the fineness of deviations.
RATIOS, FINENESS = (1.0, 1.25, 1.5, 2.0, 3.0, 5.0, 10.0, 30.0, math.inf), 64


@dataclass(frozen=True)
class Source:
    """A model whose estimate is the dot product of a user's and an item's vector, bounded to the scale; ``fallback`` where one has none."""

    users: DataFrame  # userId, vec
    items: DataFrame  # movieId, vec
    weight: float = 1.0
    fallback: float = 0.0


@dataclass(frozen=True)
class Neighbours:
    """Bounds of the ITR neighbourhood model: users (userId, norm, mu, sd), items (movieId, raters, ranges of these over the raters,
    up and down: bounds of weighted mean deviations by RATIOS)."""

    users: DataFrame
    items: DataFrame
    weight: float
    fallback: float
    min_k: int


# --- sources -------------------------------------------------------------------------------------------

def bias_source(train: DataFrame, users: DataFrame, items: DataFrame, weight: float = 1.0) -> Source:
    """mu + b_u + b_i of ``baselines.predict_bias``; unknown users and items add nothing."""
    item_bias, user_bias = bias_model(train)
    gm, zero = stats.global_mean(train).first()[0], F.lit(0.0)
    u = users.select(C.USER).join(user_bias, C.USER, "left").select(C.USER, F.array(F.lit(gm) + F.coalesce("b_u", zero), F.lit(1.0)).alias("vec"))
    i = items.select(C.ITEM).join(item_bias, C.ITEM, "left").select(C.ITEM, F.array(F.lit(1.0), F.coalesce("b_i", zero)).alias("vec"))
    return Source(u, i, weight, gm)


def latent_source(model, users: DataFrame, items: DataFrame, weight: float = 1.0) -> Source:
    """A fitted ``latent.LatentModel``; parts of unknown users and items add nothing."""
    rank = model.items.select(F.max(F.size("q"))).first()[0]
    gm, zero, none = model.mean_table.first()[0], F.lit(0.0), F.array_repeat(F.lit(0.0), rank)
    u = users.select(C.USER).join(model.users, C.USER, "left").select(C.USER, F.concat(F.array(F.lit(gm) + F.coalesce("b_u", zero), F.lit(1.0)), F.coalesce("p", none)).alias("vec"))
    i = items.select(C.ITEM).join(model.items, C.ITEM, "left").select(C.ITEM, F.concat(F.array(F.lit(1.0), F.coalesce("b_i", zero)), F.coalesce("q", none)).alias("vec"))
    return Source(u, i, weight, gm)


def content_source(models: DataFrame, features: DataFrame, train: DataFrame, weight: float = 1.0) -> Source:
    """Linear models (userId, intercept, coef) on item features; the global mean for users without one and items nobody rated."""
    known = train.select(C.ITEM).distinct()
    items = features.join(known, C.ITEM, "semi").select(C.ITEM, F.concat(F.array(F.lit(1.0)), "features").alias("vec"))
    return Source(models.select(C.USER, F.concat(F.array("intercept"), "coef").alias("vec")), items, weight, stats.global_mean(train).first()[0])


def _weighted_bounds(value: np.ndarray, count: np.ndarray, k: int, ratio: float) -> float:
    """The largest mean of k of the values (count of each, largest first) whose weights differ by the ratio at most."""
    take = np.minimum(count, np.maximum(k - (np.cumsum(count) - count), 0))
    if math.isinf(ratio):
        return float(value[0])
    n, s = np.cumsum(take), np.cumsum(take * value)
    return float(((ratio * s + (s[-1] - s)) / (ratio * n + (n[-1] - n))).max())


def itr_bounds(train: DataFrame, weight: float, *, k: int, min_k: int) -> Neighbours:
    """What ``neighbours.user_knn_itr`` can add to a user's mean, per item, from its raters' deviations and their traits.

    The raters' deviations from their means are counted on a grid, so an item's list is bounded, however many rate it.
    """
    from tasteframe.operators.similarity import itr_user_stats

    traits = materialise(itr_user_stats(train).withColumnRenamed("x", C.USER), "itr-traits")
    rated = train.select(C.USER, C.ITEM, C.RATING).join(traits, C.USER)
    dev = (F.col(C.RATING) - F.col("mu")) * FINENESS
    ranges = rated.groupBy(C.ITEM).agg(
        F.count("*").alias("raters"), *[f(c).alias(f"{c}_{n}") for c in ("norm", "mu", "sd") for n, f in (("lo", F.min), ("hi", F.max))])
    cells = rated.groupBy(C.ITEM, F.floor(dev).alias("cell")).agg(F.count("*").alias("c"))
    lists = cells.groupBy(C.ITEM).agg(F.sort_array(F.collect_list(F.struct("cell", "c"))).alias("cells"))

    def bound(batches):
        for pdf in batches:
            up, down = [], []
            for cell in pdf["cells"]:
                at = np.array([c["cell"] for c in cell], float) / FINENESS
                n = np.array([c["c"] for c in cell], float)
                up.append([_weighted_bounds(at[::-1] + 1 / FINENESS, n[::-1], k, r) for r in RATIOS])
                down.append([-_weighted_bounds(-at, n, k, r) for r in RATIOS])
            yield pd.DataFrame({C.ITEM: pdf[C.ITEM], "up": up, "down": down})

    bounds = lists.mapInPandas(bound, f"{C.ITEM} long, up array<double>, down array<double>")
    return Neighbours(traits, materialise(ranges.join(bounds, C.ITEM), "itr-bounds"), weight, stats.global_mean(train).first()[0], min_k)


# --- dense parts ---------------------------------------------------------------------------------------

def _dense(column: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a column of arrays (zeros where there is none), and which there are."""
    there = column.notna().to_numpy()
    width = len(column[there].iloc[0]) if there.any() else 0
    out = np.zeros((len(column), width))
    if there.any():
        out[there] = np.stack(column[there].to_numpy())
    return out, there


def _clip(x: np.ndarray) -> np.ndarray:
    return np.clip(x, C.RATING_MIN, C.RATING_MAX)


def _linear(a: pd.DataFrame, b: pd.DataFrame, terms: Sequence[tuple[float, float]]) -> np.ndarray:
    """Weighted scores of users a (v0, v1, ...) and items b (q0, q1, ...)."""
    total = np.zeros((len(a), len(b)))
    for s, (weight, fallback) in enumerate(terms):
        (x, has_x), (y, has_y) = _dense(a[f"v{s}"]), _dense(b[f"q{s}"])
        est = _clip(x @ y.T) if x.shape[1] and y.shape[1] else np.full(total.shape, fallback)
        est[~has_x] = fallback
        est[:, ~has_y] = fallback
        total += weight * est
    return total


def _weight_ratio(a: pd.DataFrame, b: pd.DataFrame) -> np.ndarray:
    """Largest over smallest similarity that a user of a can have with raters of an item of b; infinite if it may vanish."""
    col = lambda t, c, axis: np.expand_dims(t[c].to_numpy(float), axis)
    u, lo, hi = col(a, "norm", 1), col(b, "norm_lo", 0), col(b, "norm_hi", 0)
    apart = lambda n: 1 - np.sqrt(u * u + n * n) / (u + n)  # noqa: E731  no common item
    least = np.minimum(apart(lo), apart(hi))
    near = np.clip(u, lo, hi)
    most = 1 - np.abs(u - near) / (u + near)
    mu, sd = col(a, "mu", 1), col(a, "sd", 1)
    gap = np.maximum(np.abs(mu - col(b, "mu_lo", 0)), np.abs(mu - col(b, "mu_hi", 0))) * np.maximum(np.abs(sd - col(b, "sd_lo", 0)), np.abs(sd - col(b, "sd_hi", 0)))
    small = least / (1 + np.exp(gap))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(small > 1e-7, (most / 2 + 1e-9) / (small - 1e-9), np.inf)


def _neighbour_part(a: pd.DataFrame, b: pd.DataFrame, rule: dict) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the weighted neighbourhood estimate."""
    shape = (len(a), len(b))
    raters = b["raters"].fillna(0).to_numpy()
    lower, upper = np.zeros(shape), np.zeros(shape)
    some = np.flatnonzero(raters >= rule["min_k"])
    if len(some):
        ratio = np.nan_to_num(_weight_ratio(a, b.iloc[some]), nan=np.inf)
        at = np.searchsorted(np.array(RATIOS), ratio)
        open_end = np.isinf(ratio)
        up, down = np.stack(b["up"].iloc[some].to_numpy()), np.stack(b["down"].iloc[some].to_numpy())
        up, down = up[np.arange(len(some)), at], down[np.arange(len(some)), at]
        # a similarity of zero drops out, and with too few left the mean stands
        upper[:, some], lower[:, some] = np.where(open_end, np.maximum(up, 0), up), np.where(open_end, np.minimum(down, 0), down)
    mean = a["mu"].to_numpy(float)[:, None]
    known = ~np.isnan(mean)
    est = [np.where(known, _clip(np.nan_to_num(mean) + part), rule["fallback"]) for part in (lower, upper)]
    return rule["weight"] * est[0], rule["weight"] * est[1]


# --- blocks of items and what they can offer --------------------------------------------------------------

class Catalogue:
    """Items with their vectors in blocks by promise, and the bounds of each block. Eager.

    ``bounds`` go to the driver and from there into the tasks: one row for every ``items_per_block`` items.
    """

    def __init__(self, users: DataFrame, items: DataFrame, sources: Sequence[Source], neighbours: Neighbours | None, items_per_block: int):
        self.terms = [(s.weight, s.fallback) for s in sources]
        self.rule = neighbours and {"weight": neighbours.weight, "fallback": neighbours.fallback, "min_k": neighbours.min_k}
        for s, source in enumerate(sources):
            users = users.join(source.users.select(C.USER, F.col("vec").alias(f"v{s}")), C.USER, "left")
            items = items.join(source.items.select(C.ITEM, F.col("vec").alias(f"q{s}")), C.ITEM, "left")
        if neighbours:
            users, items = users.join(neighbours.users, C.USER, "left"), items.join(neighbours.items, C.ITEM, "left")
        self.users = materialise(users, "asking")
        promise = F.lit(0.0)
        for s, (weight, fallback) in enumerate(self.terms):
            some = self.users.where(F.col(f"v{s}").isNotNull()).select(f"v{s}")
            if not some.isEmpty():
                centre = mean_vector(some, f"v{s}").first()[0]
                raw = V.dot(F.col(f"q{s}"), F.array(*[F.lit(float(x)) for x in centre]))
                promise = promise + weight * F.coalesce(F.greatest(F.least(raw, F.lit(C.RATING_MAX)), F.lit(C.RATING_MIN)), F.lit(fallback))
        if neighbours:
            promise = promise + neighbours.weight * F.coalesce(F.when(F.col("raters") >= neighbours.min_k, F.col("up")[3]), F.lit(0.0))
        ranked = ranking.global_rank(items.withColumn("_promise", promise), C.ITEM, value="_promise")
        self.items = materialise(ranked.withColumn("block", F.floor((F.col("rank") - 1) / items_per_block).cast("int")).drop("rank", "_promise"), "blocks")
        self.bounds = self._bounds()

    def _bounds(self) -> dict:
        n, min_k = len(self.terms), self.rule and self.rule["min_k"]

        def bound(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
            row: dict = {"block": [key[0]], "n": [len(b)], "offer": [0.0]}
            for s in range(n):
                y, has = _dense(b[f"q{s}"])
                y = y[has]
                centre = y.mean(axis=0) if len(y) else np.zeros(0)
                row |= {f"lo{s}": [y.min(axis=0) if len(y) else centre], f"hi{s}": [y.max(axis=0) if len(y) else centre], f"c{s}": [centre],
                        f"r{s}": [float(np.sqrt(((y - centre) ** 2).sum(axis=1)).max()) if len(y) else 0.0], f"whole{s}": [bool(has.all())]}
            if min_k is not None:
                some = b["raters"].fillna(0) >= min_k
                row["offer"] = [max([0.0, *(u[-1] for u in b["up"][some])])]
            return pd.DataFrame(row)

        arrays = "".join(f", lo{s} array<double>, hi{s} array<double>, c{s} array<double>, r{s} double, whole{s} boolean" for s in range(n))
        found = self.items.groupBy("block").applyInPandas(bound, f"block int, n long, offer double{arrays}").toPandas().sort_values("block", ignore_index=True)
        return {c: found[c].to_numpy() for c in found.columns}

    def offers(self) -> Callable[[pd.DataFrame], np.ndarray]:
        """A function of users that gives the most any item of each block can score."""
        bounds, terms, rule = self.bounds, self.terms, self.rule

        def most(a: pd.DataFrame) -> np.ndarray:
            total = np.zeros((len(a), len(bounds["block"])))
            for s, (weight, fallback) in enumerate(terms):
                x, has = _dense(a[f"v{s}"])
                est = np.full(total.shape, fallback)
                for j in range(total.shape[1]):
                    centre = np.asarray(bounds[f"c{s}"][j], float)
                    if len(centre) and x.shape[1]:
                        ball = x @ centre + np.linalg.norm(x, axis=1) * bounds[f"r{s}"][j]
                        box = np.maximum(x, 0) @ np.asarray(bounds[f"hi{s}"][j], float) + np.minimum(x, 0) @ np.asarray(bounds[f"lo{s}"][j], float)
                        est[:, j] = _clip(np.minimum(ball, box) + 1e-9)
                        if not bounds[f"whole{s}"][j]:
                            est[:, j] = np.maximum(est[:, j], fallback)
                est[~has] = fallback
                total += weight * est
            if rule:
                mean = a["mu"].to_numpy(float)[:, None]
                part = np.where(np.isnan(mean), rule["fallback"], _clip(np.nan_to_num(mean) + bounds["offer"][None, :].astype(float)))
                total += rule["weight"] * part
            return total + 1e-9

        return most

    def least_offers(self) -> Callable[[pd.DataFrame], np.ndarray]:
        """A function of users that gives what every item of each block scores at least. Linear sources only."""
        bounds, terms = self.bounds, self.terms

        def least(a: pd.DataFrame) -> np.ndarray:
            total = np.zeros((len(a), len(bounds["block"])))
            for s, (weight, fallback) in enumerate(terms):
                x, has = _dense(a[f"v{s}"])
                est = np.full(total.shape, fallback)
                for j in range(total.shape[1]):
                    centre = np.asarray(bounds[f"c{s}"][j], float)
                    if len(centre) and x.shape[1]:
                        ball = x @ centre - np.linalg.norm(x, axis=1) * bounds[f"r{s}"][j]
                        box = np.maximum(x, 0) @ np.asarray(bounds[f"lo{s}"][j], float) + np.minimum(x, 0) @ np.asarray(bounds[f"hi{s}"][j], float)
                        est[:, j] = _clip(np.maximum(ball, box) - 1e-9)
                        if not bounds[f"whole{s}"][j]:
                            est[:, j] = np.minimum(est[:, j], fallback)
                est[~has] = fallback
                total += weight * est
            return total - 1e-9

        return least

    def visits(self, asking: DataFrame, choose: Callable[[pd.DataFrame, np.ndarray], np.ndarray]) -> DataFrame:
        """Rows of ``asking`` (a superset of the columns of ``users``) for each block that ``choose(users, offers)`` marks."""
        most, blocks = self.offers(), self.bounds["block"]

        def run(batches):
            for a in batches:
                if len(a):
                    yield from _visits(a, choose(a, most(a)), blocks)

        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in asking.schema.fields)
        return materialise(asking.mapInPandas(run, f"{fields}, block int"), "visits")

    def meet(self, visits: DataFrame, seen: DataFrame, fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str, users_per_block: int) -> DataFrame:
        """``fn(users, items)`` on bounded groups: a block with up to about ``users_per_block`` of the users that visit it.

        Users have the column ``seen``: the items of the block that they have rated (none: null).
        """
        parts = visits.groupBy("block").agg(F.ceil(F.count("*") / users_per_block).cast("int").alias("parts"))
        at = self.items.select(C.ITEM, "block")
        rated = visits.select(C.USER, "block").join(seen.select(C.USER, C.ITEM).distinct().join(at, C.ITEM), [C.USER, "block"])
        rated = rated.groupBy(C.USER, "block").agg(F.collect_list(C.ITEM).alias("seen"))
        left = visits.join(parts, "block").withColumn("part", F.pmod(F.xxhash64(C.USER), F.col("parts")).cast("int")).drop("parts")
        left = left.join(rated, [C.USER, "block"], "left")
        right = self.items.join(parts, "block").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        keys = ["block", "part"]

        def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame | None:
            return fn(a.reset_index(drop=True), b.sort_values(C.ITEM, ignore_index=True)) if len(a) and len(b) else pd.DataFrame(columns=[c.split()[0] for c in schema.split(", ")])

        return spread(left, *keys).groupBy(*keys).cogroup(spread(right, *keys).groupBy(*keys)).applyInPandas(run, schema)


def _hide(a: pd.DataFrame, ids: np.ndarray, *scores: np.ndarray) -> None:
    """Seen items score nothing."""
    for row, old in enumerate(a["seen"]):
        if old is not None and len(old):
            at = np.minimum(np.searchsorted(ids, old), len(ids) - 1)
            at = at[ids[at] == old]
            for s in scores:
                s[row, at] = -np.inf


def _visits(a: pd.DataFrame, marked: np.ndarray, blocks: np.ndarray) -> Iterator[pd.DataFrame]:
    """A row of ``a`` per block that is marked for it, a few at a time: a user may visit every block, and each row repeats the user's vectors."""
    rows, cols = np.nonzero(marked)
    for i in range(0, len(rows), VISITS_AT_ONCE):
        some = slice(i, i + VISITS_AT_ONCE)
        yield a.iloc[rows[some]].assign(block=blocks[cols[some]].astype("int32"))


def _best(users: np.ndarray, ids: np.ndarray, score: np.ndarray, least: np.ndarray, n: int) -> pd.DataFrame:
    """The n best finite scores per user of at least ``least``, ties by the place of the item; a few users at a time, since ties may be many."""
    out = []
    for i in range(0, max(len(users), 1), PICKED_AT_ONCE):
        s = score[i:i + PICKED_AT_ONCE]
        rows, cols = np.nonzero((s >= least[i:i + PICKED_AT_ONCE, None]) & np.isfinite(s))
        found = pd.DataFrame({C.USER: users[i + rows], C.ITEM: ids[cols], "lower": s[rows, cols], "upper": s[rows, cols]})
        out.append(found.sort_values([C.USER, "upper"], ascending=[True, False], kind="stable").groupby(C.USER, sort=False).head(n))
    return pd.concat(out, ignore_index=True)


def _nth(s: np.ndarray, n: int) -> np.ndarray:
    """The n-th largest of every row; nothing is enough where there are fewer."""
    return np.partition(s, s.shape[1] - n, axis=1)[:, s.shape[1] - n] if s.shape[1] >= n else np.full(len(s), -np.inf)


def best_unseen(
    users: DataFrame, items: DataFrame, seen: DataFrame, sources: Sequence[Source], n: int = C.TOP_N, *, neighbours: Neighbours | None = None, slack: float | None = None,
    digits: int = 9, users_per_block: int = USERS_PER_BLOCK, items_per_block: int = ITEMS_PER_BLOCK, report: dict | None = None,
) -> DataFrame:
    """The n best of ``items`` that each of ``users`` has not rated.

    Without ``slack``: (userId, movieId, est, rank) by the score to ``digits`` digits, ties by the smaller item. With it: every item
    whose upper bound comes within the slack of the n-th best lower bound, as (userId, movieId, lower, upper): a set that holds the n
    best by any score between the bounds and up to half the slack off. ``neighbours`` needs a slack.
    ``report`` receives the number of (user, block) pairs, of those visited, and of rows that left the blocks. Eager.
    """
    if neighbours and slack is None:
        raise ValueError("neighbours are bounds only: give a slack")
    users, items = users.select(C.USER).distinct(), items.select(C.ITEM).distinct()
    cat = Catalogue(users, items, sources, neighbours, items_per_block)
    terms, rule, unit = cat.terms, cat.rule, 10.0**digits
    seen = materialise(seen.select(C.USER, C.ITEM), "seen")

    def visit(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        ids = b[C.ITEM].to_numpy()
        upper = _linear(a, b, terms)
        if slack is None:
            upper = np.floor(upper * unit + 0.5) / unit
            lower = upper
            _hide(a, ids, upper)
        else:
            lower = upper.copy()
            if rule:
                low, high = _neighbour_part(a, b, rule)
                lower, upper = lower + low, upper + high
            _hide(a, ids, lower, upper)
        least = _nth(lower, n) - (slack or 0.0)
        if slack is None:  # ties beyond n: the smaller items stay, which come first
            return _best(a[C.USER].to_numpy(), ids, upper, least, n)
        rows, cols = np.nonzero((upper >= least[:, None]) & np.isfinite(upper))
        return pd.DataFrame({C.USER: a[C.USER].to_numpy()[rows], C.ITEM: ids[cols], "lower": lower[rows, cols], "upper": upper[rows, cols]})

    schema = f"{C.USER} long, {C.ITEM} long, lower double, upper double"

    def first_block(a: pd.DataFrame, offers: np.ndarray) -> np.ndarray:
        return np.arange(offers.shape[1])[None, :] == offers.argmax(axis=1)[:, None] if offers.shape[1] else offers > 0

    def others(a: pd.DataFrame, offers: np.ndarray) -> np.ndarray:
        return (offers >= a["least"].to_numpy()[:, None] - (slack or 0.0)) & ~first_block(a, offers)

    def least_of(rows: DataFrame) -> DataFrame:
        order = W.partitionBy(C.USER).orderBy(F.col("lower").desc(), C.ITEM)
        return rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= n).groupBy(C.USER).agg(
            F.when(F.count("*") >= n, F.min("lower")).alias("least"))

    visits = cat.visits(cat.users, first_block)
    found = materialise(cat.meet(visits, seen, visit, schema, users_per_block), "found")
    asking = cat.users.join(least_of(found), C.USER, "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    again = cat.visits(asking, others)
    rows = materialise(found.unionByName(cat.meet(again, seen, visit, schema, users_per_block)), "found")
    if report is not None:
        report |= {"pairs": cat.users.count() * len(cat.bounds["block"]), "visited": visits.count() + again.count(), "rows": rows.count()}
    if slack is None:
        return ranking.top_n_per_user(rows.select(C.USER, C.ITEM, F.col("upper").alias("est")), n)
    least = least_of(rows).withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    return rows.join(least, C.USER).where(F.col("upper") >= F.col("least") - slack).drop("least")


def rank_of(
    users: DataFrame, items: DataFrame, seen: DataFrame, held: DataFrame, source: Source, *,
    users_per_block: int = USERS_PER_BLOCK, items_per_block: int = ITEMS_PER_BLOCK, report: dict | None = None,
) -> DataFrame:
    """(userId, movieId, rank): the place of one held-out item per user (``held``) among the items the user has not rated.

    Better items (a higher estimate, or the same and a smaller id) are counted block by block, no lists are made. Blocks that cannot
    hold one are left out, and of blocks that hold nothing else the items are known without a visit, less those that the user has rated. Held-out rows of users that are not among ``users`` or items that are not among ``items`` have no rank. Eager.
    """
    users, items = users.select(C.USER).distinct(), items.select(C.ITEM).distinct()
    cat = Catalogue(users, items, [source], None, items_per_block)
    terms = cat.terms
    vectors = cat.items.select(F.col(C.ITEM).alias("held"), F.col("q0"))
    asks = cat.users.join(held.select(C.USER, F.col(C.ITEM).alias("held")), C.USER).join(vectors, "held")

    def targets(batches):
        for a in batches:
            x, y = _dense(a["v0"]), _dense(a["q0"])
            ok = x[1] & y[1]
            score = np.full(len(a), terms[0][0] * terms[0][1])
            if ok.any():
                score[ok] = terms[0][0] * _clip(np.einsum("ij,ij->i", x[0][ok], y[0][ok]))
            yield a.drop(columns="q0").assign(score=np.floor(score * 1e9 + 0.5) / 1e9)

    asking = asks.select(C.USER, "v0", "held", "q0").mapInPandas(targets, f"{C.USER} long, v0 array<double>, held long, score double")
    asking = materialise(asking, "held-scores")
    least, blocks, sizes = cat.least_offers(), cat.bounds["block"], cat.bounds["n"]
    mark_of = lambda a: a["score"].to_numpy()[:, None]
    visits = cat.visits(asking, lambda a, offers: (offers >= mark_of(a) - 1e-8) & ~(least(a) > mark_of(a) + 1e-8))
    at = seen.select(C.USER, C.ITEM).distinct().join(cat.items.select(C.ITEM, "block"), C.ITEM).groupBy(C.USER, "block").agg(F.count("*").alias("n"))
    rated = at.groupBy(C.USER).agg(F.collect_list(F.struct("block", "n")).alias("at")).select(C.USER, F.col("at.block").alias("blocks"), F.col("at.n").alias("rated"))

    def whole(batches):
        for a in batches:
            if len(a):
                sure = least(a) > mark_of(a) + 1e-8
                better = sure @ sizes
                for row, (at, n) in enumerate(zip(a["blocks"], a["rated"])):
                    if at is not None:
                        better[row] -= np.asarray(n)[sure[row, np.searchsorted(blocks, at)]].sum()
                yield pd.DataFrame({C.USER: a[C.USER], "better": better})

    def count(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        ids = b[C.ITEM].to_numpy()
        s = np.floor(_linear(a, b, terms) * 1e9 + 0.5) / 1e9
        _hide(a, ids, s)
        mark, item = a["score"].to_numpy()[:, None], a["held"].to_numpy()[:, None]
        better = (s > mark) | (s == mark) & (ids[None, :] < item)
        return pd.DataFrame({C.USER: a[C.USER].to_numpy(), "better": (better & (ids[None, :] != item)).sum(axis=1)})

    schema = f"{C.USER} long, better long"
    counts = cat.meet(visits, seen, count, schema, users_per_block).unionByName(asking.join(rated, C.USER, "left").mapInPandas(whole, schema))
    counts = counts.groupBy(C.USER).agg(F.sum("better").alias("better"))
    if report is not None:
        report |= {"pairs": asking.count() * len(cat.bounds["block"]), "visited": visits.count()}
    return asking.select(C.USER, F.col("held").alias(C.ITEM)).join(counts, C.USER, "left").select(C.USER, C.ITEM, (F.coalesce("better", F.lit(0)) + 1).alias("rank"))
