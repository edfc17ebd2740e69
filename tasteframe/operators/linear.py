"""One linear model per user on item features.

Training rows are (userId, movieId, rating, features). Users with up to ``limit`` ratings are solved in
grouped calls, a block of users each. A user above it is never gathered: the rows are cut into chunks, each chunk gives its
sums of x, y, xx' and xy, the sums are added by an ordinary aggregate, and the same solver runs on them.
All models are tables (userId, intercept, coef).
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.functions import scalars as S
from tasteframe.functions import vectors as V
from tasteframe.operators import stats
from tasteframe.scratch import materialise, spread

LIMIT = 20_000
#: Rows that a grouped call over many chunks gets on average.
BLOCK_ROWS = 10_000
#: Rows that a grouped call over many ordinary users gets on average, and the most users whose support vector models are solved side by side.
USER_ROWS, SIDE_BY_SIDE = 2_500, 64
MODEL_SCHEMA = f"{C.USER} long, intercept double, coef array<double>"


def training_rows(ratings: DataFrame, features: DataFrame) -> DataFrame:
    return ratings.select(C.USER, C.ITEM, C.RATING).join(features, C.ITEM)


# --- small dense solvers -------------------------------------------------------------------------

class Moments:
    """Centred sums of one regression problem."""

    def __init__(self, n: float, sx: np.ndarray, sy: float, sxx: np.ndarray, sxy: np.ndarray, syy: float):
        self.n, self.mx, self.my = n, sx / n, sy / n
        self.g = sxx - n * np.outer(self.mx, self.mx)
        self.c = sxy - n * self.mx * self.my
        self.v = max(syy - n * self.my**2, 0.0)

    @classmethod
    def of(cls, x: np.ndarray, y: np.ndarray) -> "Moments":
        m = cls.__new__(cls)
        m.n, m.mx, m.my = len(y), x.mean(axis=0), y.mean()
        xc, yc = x - m.mx, y - m.my
        m.g, m.c, m.v = xc.T @ xc, xc.T @ yc, float(yc @ yc)
        return m

    def intercept(self, w: np.ndarray) -> float:
        return float(self.my - self.mx @ w)


def solve_ols(m: Moments) -> np.ndarray:
    return np.linalg.pinv(m.g, rcond=1e-10, hermitian=True) @ m.c


def solve_ridge(m: Moments, alpha: float) -> np.ndarray:
    return np.linalg.solve(m.g + alpha * np.eye(len(m.c)), m.c)


def solve_elastic_net(m: Moments, alpha: float, l1_ratio: float, *, max_iter: int = 100_000) -> np.ndarray:
    """Minimum of 1/(2n)|y - Xw|^2 + alpha l1 |w|_1 + alpha (1 - l1)/2 |w|^2 from the moments.

    Accelerated proximal steps find the nonzero entries; these are then solved for exactly, and the
    solution is taken when it meets the optimality conditions. Of dependent features it may not keep the signs; the steps
    then end where they meet the conditions themselves, as far as doubles show. A warning says so if none does.
    """
    p = len(m.c)
    l1, l2 = m.n * alpha * l1_ratio, m.n * alpha * (1 - l1_ratio)
    g = m.g + l2 * np.eye(p)
    step = np.linalg.eigvalsh(g)[-1]
    w = np.zeros(p)
    if step <= 1e-12:
        return w
    tol = 1e-9 * max(1.0, float(np.max(np.abs(m.c))))
    z, t = w, 1.0

    def optimal(w: np.ndarray, on: np.ndarray, within: float) -> bool:
        slack = np.abs(m.c - g @ w)
        slack[on] = np.abs(slack[on] - l1)
        off = np.setdiff1d(np.arange(p), on)
        return bool(np.all(slack[on] <= within) and np.all(slack[off] <= l1 + within))

    for i in range(1, max_iter + 1):
        v = z - (g @ z - m.c) / step
        new = np.sign(v) * np.maximum(np.abs(v) - l1 / step, 0.0)
        if (z - new) @ (new - w) > 0:
            t = 1.0
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, w, t = new + (t - 1) / t_new * (new - w), new, t_new
        if i % 25 == 0:
            on = np.flatnonzero(w)
            exact = np.zeros(p)
            sign = np.sign(w[on])
            if len(on):
                exact[on] = np.linalg.lstsq(g[np.ix_(on, on)], m.c[on] - l1 * sign, rcond=1e-12)[0]
            if np.all(exact[on] * sign >= -1e-12) and optimal(exact, on, tol):
                return exact
            if optimal(w, on, 1e-4 * tol):
                return w
    warnings.warn(f"elastic net did not meet the optimality conditions in {max_iter} steps", RuntimeWarning, stacklevel=2)
    return w


def _svr_weights(r: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Row weights of the quadratic that bounds the epsilon-insensitive loss at residual r."""
    return 1 / (4 * np.maximum(np.abs(r - epsilon), 1e-6)), 1 / (4 * np.maximum(np.abs(r + epsilon), 1e-6))


def svr_sums(z: np.ndarray, y: np.ndarray, w: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """One pass: z'Wz and z'W(target) for the weights at the current w. ``z`` ends with a column of ones."""
    a, b = _svr_weights(y - z @ w, epsilon)
    return (z * (a + b)[:, None]).T @ z, z.T @ (a * (y - epsilon) + b * (y + epsilon))


def svr_step(h: np.ndarray, t: np.ndarray, cost: float) -> np.ndarray:
    return np.linalg.solve(np.eye(len(t)) + 2 * cost * h, 2 * cost * t)


SVR_ROUNDS = 60


def solve_svr(x: np.ndarray, y: np.ndarray, cost: float, epsilon: float, rounds: int = SVR_ROUNDS) -> np.ndarray:
    """|w|^2/2 + C sum max(0, |y - xw - b| - eps), the intercept b being the last weight, by majorisation.

    The same number of steps from zero as for users whose rows are cut into chunks.
    """
    z = np.hstack([x, np.ones((len(y), 1))])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        w = svr_step(*svr_sums(z, y, w, epsilon), cost)
    return w


def solve_svr_many(xs: Sequence[np.ndarray], ys: Sequence[np.ndarray], cost: float, epsilon: float, rounds: int = SVR_ROUNDS) -> list[np.ndarray]:
    """``solve_svr`` of many problems with the same features: those of similar length take each step together, shorter ones with rows of zeros."""
    order = sorted(range(len(ys)), key=lambda i: len(ys[i]))
    out: list[np.ndarray] = [np.zeros(0)] * len(ys)
    for at in range(0, len(order), SIDE_BY_SIDE):
        some = order[at : at + SIDE_BY_SIDE]
        n, q = len(ys[some[-1]]), xs[some[0]].shape[1] + 1
        z, y, w = np.zeros((len(some), n, q)), np.zeros((len(some), n)), np.zeros((len(some), q))
        for j, i in enumerate(some):
            z[j, : len(ys[i]), :-1], z[j, : len(ys[i]), -1], y[j, : len(ys[i])] = xs[i], 1.0, ys[i]
        zt, one = np.ascontiguousarray(z.transpose(0, 2, 1)), np.eye(q)
        for _ in range(rounds):
            a, b = _svr_weights(y - (z @ w[:, :, None])[:, :, 0], epsilon)
            h = (zt * (a + b)[:, None, :]) @ z
            t = zt @ (a * (y - epsilon) + b * (y + epsilon))[:, :, None]
            w = np.linalg.solve(one + 2 * cost * h, 2 * cost * t)[:, :, 0]
        for j, i in enumerate(some):
            out[i] = w[j]
    return out


#: Folds are remainders of a hash of the item id, whatever the size of the user; FOLD_BASE is a multiple of all fold counts.
FOLD_BASE = 15


def fold_number() -> Column:
    return F.pmod(F.xxhash64(C.ITEM, F.lit(7)), F.lit(FOLD_BASE)).cast("int")


def contiguous_folds(n: int, k: int) -> list[np.ndarray]:
    """k validation index blocks in row order; the first n % k blocks hold one more row."""
    return [b for b in np.array_split(np.arange(n), k) if len(b)]


# --- grouped fitting -----------------------------------------------------------------------------

def _by_size(rows: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None, int]:
    """Rows of users up to the limit, rows of larger users with their count (none: no such user), and how many rows there are.

    Only the larger users (at most rows / limit of them) take part in the joins. Eager: the rows are
    counted per user.
    """
    counts = rows.groupBy(C.USER).agg(F.count("*").alias("n_user"))
    size = counts.agg(F.coalesce(F.sum("n_user"), F.lit(0)).alias("all"), F.coalesce(F.max("n_user"), F.lit(0)).alias("most")).first()
    keep = [C.USER, C.ITEM, C.RATING, "features"]
    if size["most"] <= limit:
        return rows.select(*keep), None, size["all"]
    large = counts.where(F.col("n_user") > limit)
    few = rows.join(large.select(C.USER), C.USER, "left_anti").select(*keep)
    return few, rows.join(large, C.USER).select(*keep, "n_user"), size["all"]


def _in_blocks(rows: DataFrame, count: int, solve: Callable[[list[np.ndarray], list[np.ndarray], list[np.ndarray]], list[tuple[float, np.ndarray]]]) -> DataFrame:
    """Models of users that fit in memory, each whole in one of the blocks; ``solve`` gets X, y and the folds of every user of a block.

    A grouped call per user would cost more than most users' solution. Rows ascend by item within a user.
    """
    blocks = max(1, count // USER_ROWS)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(C.USER, "ascending"), (C.ITEM, "ascending")])
        users = table[C.USER].combine_chunks().cast(pa.int64())
        known, ids = users.is_valid().to_numpy(zero_copy_only=False), users.fill_null(0).to_numpy()
        cuts = np.flatnonzero((np.diff(ids) != 0) | (np.diff(known.astype(np.int8)) != 0)) + 1
        x = table["features"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
        solved = solve(*[np.split(c, cuts) for c in (x, table[C.RATING].to_numpy(), table["fold"].to_numpy())])
        return pa.table({
            C.USER: users.take(pa.array(np.append(0, cuts))), "intercept": pa.array([float(b) for b, _ in solved], pa.float64()),
            "coef": pa.array([np.asarray(w, dtype=float) for _, w in solved], pa.list_(pa.float64())),
        })

    dealt = rows.withColumn("fold", fold_number()).withColumn("b", F.pmod(F.xxhash64(C.USER), F.lit(blocks)))
    return spread(dealt, "b").groupBy("b").applyInArrow(run, MODEL_SCHEMA)


def _arrays(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    pdf = pdf.sort_values(C.ITEM)
    return np.stack(pdf["features"].to_numpy()).astype(float), pdf[C.RATING].to_numpy(dtype=float)


def _model_row(user: int, intercept: float, coef: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({C.USER: [user], "intercept": [float(intercept)], "coef": [np.asarray(coef, dtype=float)]})


def _chunked(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of large users with a chunk number; about ``limit`` rows per chunk."""
    chunks = F.ceil(F.col("n_user") / limit)
    return rows.withColumn("chunk", F.pmod(F.xxhash64(C.ITEM), chunks).cast("int"))


def _add_up(parts: DataFrame) -> DataFrame:
    """Element-wise sums of the chunk arrays per user (partially aggregated on the map side)."""
    return parts.groupBy(C.USER).agg(vector_to_array(Summarizer.sum(array_to_vector("part"))).alias("part"))


def fit_users(
    rows: DataFrame, local: Callable[[np.ndarray, np.ndarray], tuple[float, np.ndarray]],
    from_moments: Callable[[Moments], np.ndarray], *, limit: int = LIMIT,
) -> DataFrame:
    """Fit every user: ``local(X, y)`` up to ``limit`` ratings, ``from_moments`` on summed chunks above."""
    few_rows, many_rows, count = _by_size(rows, limit)

    def sums(table: pa.Table) -> pa.Table:
        """Of one block of chunks, a row of sums per user and chunk."""
        table = table.sort_by([(C.USER, "ascending"), ("chunk", "ascending"), (C.ITEM, "ascending")])
        users, chunk = table[C.USER].to_numpy(), table["chunk"].to_numpy()
        starts = np.flatnonzero(np.append(True, (np.diff(users) != 0) | (np.diff(chunk) != 0)))
        x = table["features"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
        y = table[C.RATING].to_numpy()
        parts = []
        for start, end in zip(starts, np.append(starts[1:], len(y))):
            a, b = x[start:end], y[start:end]
            parts.append(np.concatenate([[len(b)], a.sum(axis=0), [b.sum()], (a.T @ a).ravel(), a.T @ b, [b @ b]]))
        return pa.table({C.USER: pa.array(users[starts], pa.int64()), "part": pa.array(parts, pa.list_(pa.float64()))})

    def solve(batches):
        for batch in batches:
            bs, ws = [], []
            for part in batch["part"]:
                part = part.values.to_numpy(zero_copy_only=False)
                p = int(round(np.sqrt(len(part) - 2))) - 1
                sx, sy, rest = part[1:p + 1], part[p + 1], part[p + 2:]
                m = Moments(part[0], sx, sy, rest[:p * p].reshape(p, p), rest[p * p:p * p + p], rest[-1])
                w = from_moments(m)
                bs.append(m.intercept(w))
                ws.append(np.asarray(w, dtype=float))
            cols = [batch[C.USER].cast(pa.int64()), pa.array(bs, pa.float64()), pa.array(ws, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(cols, names=[C.USER, "intercept", "coef"])

    few = _in_blocks(few_rows, count, lambda xs, ys, _: [local(x, y) for x, y in zip(xs, ys)])
    if many_rows is None:
        return few
    # A Python call serves a block of chunks: as many blocks as keep about BLOCK_ROWS rows in one, chunks whole.
    many_rows = materialise(_chunked(many_rows, limit).drop("n_user"), "chunk-rows")
    blocks = max(1, many_rows.count() // max(limit, BLOCK_ROWS))
    parts = spread(many_rows.withColumn("b", F.pmod(F.xxhash64(C.USER, "chunk"), F.lit(blocks))), "b").groupBy("b").applyInArrow(
        sums, f"{C.USER} long, part array<double>")
    return few.unionByName(_add_up(parts).mapInArrow(solve, MODEL_SCHEMA))


def _by_moments(solve: Callable[[Moments], np.ndarray]):
    def local(x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
        m = Moments.of(x, y)
        w = solve(m)
        return m.intercept(w), w

    return local


def user_linear(rows: DataFrame, *, limit: int = LIMIT) -> DataFrame:
    """Least squares with intercept; the smallest solution where the features do not determine one.

    Both sizes of users are solved from centred sums, with one cut-off for dependent features.
    """
    return fit_users(rows, _by_moments(solve_ols), solve_ols, limit=limit)


def user_ridge(rows: DataFrame, *, alpha: float = 1.0, limit: int = LIMIT) -> DataFrame:
    """Ridge with a free intercept; users with fewer ratings than features take the dual form."""
    def local(x, y):
        n, p = x.shape
        mx, my = x.mean(axis=0), y.mean()
        xc, yc = x - mx, y - my
        if n < p:
            w = xc.T @ np.linalg.solve(xc @ xc.T + alpha * np.eye(n), yc)
        else:
            w = np.linalg.solve(xc.T @ xc + alpha * np.eye(p), xc.T @ yc)
        return my - mx @ w, w

    return fit_users(rows, local, lambda m: solve_ridge(m, alpha), limit=limit)


def user_elasticnet(rows: DataFrame, *, alpha: float = 10.0, l1_ratio: float = 0.5, limit: int = LIMIT) -> DataFrame:
    solve = lambda m: solve_elastic_net(m, alpha, l1_ratio)
    return fit_users(rows, _by_moments(solve), solve, limit=limit)


def user_lasso(rows: DataFrame, *, alpha: float = 0.1, limit: int = LIMIT) -> DataFrame:
    return user_elasticnet(rows, alpha=alpha, l1_ratio=1.0, limit=limit)


# Tiers by number of ratings, with their settings (fixed values).
ELASTICNET_TIERS = (200, 700, 1300)
ELASTICNET_SMALL = (0.01, 0.8)
ELASTICNET_GRID = [(a, r) for r in (0.1, 0.3) for a in (0.01, 0.05, 0.1)]
ELASTICNET_FOLDS = 3
RIDGE_MID, RIDGE_LARGE = 24.0, 50.0
SVR_TIERS = (200, 700)
SVR_SMALL = (0.1, 0.25)
SVR_GRID_MID = [(c, e) for c in (0.1, 1.0, 5.0) for e in (0.1, 0.25)]
SVR_GRID_LARGE = [(c, e) for c in (1.0, 10.0, 50.0) for e in (0.05, 0.1, 0.25)]
SVR_FOLDS_MID, SVR_FOLDS_LARGE = 3, 5


def user_elasticnet_tiered(rows: DataFrame, *, tiers: Sequence[int] = ELASTICNET_TIERS, limit: int = LIMIT) -> DataFrame:
    """Settings by number of ratings: fixed net, cross-validated net, ridge 24, ridge 50."""
    small, mid, large = tiers
    if limit < large:
        raise ValueError("limit must not be below the last tier")

    def local(x, y):
        n, m = len(y), Moments.of(x, y)
        if n < small:
            w = solve_elastic_net(m, *ELASTICNET_SMALL)
        elif n < mid:
            best = (np.inf, ELASTICNET_GRID[0])
            folds = contiguous_folds(n, ELASTICNET_FOLDS)
            parts = [(Moments.of(np.delete(x, f, axis=0), np.delete(y, f)), x[f], y[f]) for f in folds]
            for setting in ELASTICNET_GRID:
                errs = []
                for fm, xv, yv in parts:
                    w = solve_elastic_net(fm, *setting)
                    errs.append(np.mean((yv - xv @ w - fm.intercept(w)) ** 2))
                best = min(best, (float(np.mean(errs)), setting), key=lambda b: b[0])
            w = solve_elastic_net(m, *best[1])
        else:
            w = solve_ridge(m, RIDGE_MID if n < large else RIDGE_LARGE)
        return m.intercept(w), w

    return fit_users(rows, local, lambda m: solve_ridge(m, RIDGE_LARGE), limit=limit)


def _svr_large(rows: DataFrame, grid: Sequence[tuple[float, float]], folds: int, *, limit: int, rounds: int) -> DataFrame:
    """Grid search and fit for users above the limit: each round is one pass over their chunks.

    Every (setting, fold) and every setting on all rows is its own problem; a chunk adds its sums to all
    of them. The state between rounds is one row per user, written to the shared folder.
    """
    problems = [(s, f) for s in range(len(grid)) for f in ([*range(folds), -1] if folds else [-1])]
    rows = materialise(_chunked(rows, limit).withColumn("fold", fold_number() % max(folds, 1)), "svr-rows")
    per_user = rows.groupBy(C.USER).agg(F.max("chunk").alias("last"), F.first(F.size("features")).alias("p"))
    state = per_user.select(C.USER, "last", "p", F.array_repeat(F.lit(0.0), (F.col("p") + 1) * len(problems)).alias("w"))

    def weights_of(s: DataFrame) -> DataFrame:
        return s.select(F.col(C.USER).alias("u"), F.explode(F.sequence(F.lit(0), "last")).alias("chunk"), "w")

    def work(gather):
        def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if left.empty or right.empty:
                return pd.DataFrame({C.USER: [], "part": []})
            x, y = _arrays(left)
            fold = left.sort_values(C.ITEM)["fold"].to_numpy()
            z = np.hstack([x, np.ones((len(y), 1))])
            w = np.asarray(right["w"].iloc[0]).reshape(len(problems), -1)
            part = np.concatenate([gather(z, y, fold, w[i], grid[s], f) for i, (s, f) in enumerate(problems)])
            return pd.DataFrame({C.USER: [key[0]], "part": [part]})

        keyed = rows.select(F.col(C.USER).alias("u"), "chunk", C.ITEM, C.RATING, "features", "fold")
        parts = spread(keyed, "u", "chunk").groupBy("u", "chunk").cogroup(spread(weights_of(state), "u", "chunk").groupBy("u", "chunk")).applyInPandas(
            run, f"{C.USER} long, part array<double>")
        return _add_up(parts)

    def weigh(z, y, fold, w, setting, f):
        on = fold != f
        h, t = svr_sums(z[on], y[on], w, setting[1])
        return np.concatenate([h.ravel(), t])

    def validate(z, y, fold, w, setting, f):
        on = fold == f
        return np.array([np.sum((y[on] - z[on] @ w) ** 2), on.sum()])

    def step(batches):
        for pdf in batches:
            ws = []
            for part in pdf["part"]:
                block = np.asarray(part).reshape(len(problems), -1)
                q = int(round((np.sqrt(4 * block.shape[1] + 1) - 1) / 2))
                ws.append(np.concatenate([
                    svr_step(b[:q * q].reshape(q, q), b[q * q:], grid[s][0]) for b, (s, _) in zip(block, problems)]))
            yield pd.DataFrame({"u": pdf[C.USER], "w_new": ws})

    for _ in range(rounds):
        moved = work(weigh).mapInPandas(step, "u long, w_new array<double>")
        state = materialise(state.join(moved, state[C.USER] == moved["u"]).select(
            C.USER, "last", "p", F.col("w_new").alias("w")), "svr-state")
    checked = work(validate).select(F.col(C.USER).alias("u"), "part")

    def choose(batches):
        for pdf in batches:
            out = []
            for user, part, w in zip(pdf[C.USER], pdf["part"], pdf["w"]):
                err = np.asarray(part).reshape(len(problems), 2)
                w = np.asarray(w).reshape(len(problems), -1)
                score = [np.mean([np.sqrt(err[i][0] / max(err[i][1], 1)) for i, (s, f) in enumerate(problems) if s == k and f >= 0] or [0.0])
                         for k in range(len(grid))]
                final = w[problems.index((int(np.argmin(score)), -1))]
                out.append(_model_row(user, final[-1], final[:-1]))
            yield pd.concat(out)

    both = state.join(checked, state[C.USER] == checked["u"]).select(C.USER, "part", "w")
    return both.mapInPandas(choose, MODEL_SCHEMA)


def _fit_svr(rows: DataFrame, solve, large_grid, large_folds: int, *, limit: int, rounds: int) -> DataFrame:
    few_rows, many, count = _by_size(rows, limit)
    few = _in_blocks(few_rows, count, lambda xs, ys, folds: [(w[-1], w[:-1]) for w in solve(xs, ys, folds)])
    if many is None:
        return few
    return few.unionByName(_svr_large(many, large_grid, large_folds, limit=limit, rounds=rounds))


def user_linear_svr(rows: DataFrame, *, cost: float = 0.5, epsilon: float = 0.5, limit: int = LIMIT, rounds: int = SVR_ROUNDS) -> DataFrame:
    """Linear support vector regression. Eager: looks whether any user is above the limit."""
    return _fit_svr(rows, lambda xs, ys, _: solve_svr_many(xs, ys, cost, epsilon, rounds), [(cost, epsilon)], 0, limit=limit, rounds=rounds)


def user_linear_svr_tiered(rows: DataFrame, *, tiers: Sequence[int] = SVR_TIERS, limit: int = LIMIT, rounds: int = SVR_ROUNDS) -> DataFrame:
    """Fixed settings for small users, grid searches by cross-validated RMSE above."""
    small, mid = tiers
    if limit < mid:
        raise ValueError("limit must not be below the last tier")

    def local(x, y, fold):
        n = len(y)
        grid, k = (SVR_GRID_MID, SVR_FOLDS_MID) if n < mid else (SVR_GRID_LARGE, SVR_FOLDS_LARGE)
        best = (np.inf, grid[0])
        for setting in grid:
            errs = []
            for f in range(k):
                out = fold % k == f
                w = solve_svr(x[~out], y[~out], *setting, rounds)
                errs.append(np.sqrt(np.sum((y[out] - x[out] @ w[:-1] - w[-1]) ** 2) / max(out.sum(), 1)))
            best = min(best, (float(np.mean(errs)), setting), key=lambda b: b[0])
        return solve_svr(x, y, *best[1], rounds)

    def solve(xs, ys, folds):
        few = [i for i, y in enumerate(ys) if len(y) < small]
        done = dict(zip(few, solve_svr_many([xs[i] for i in few], [ys[i] for i in few], *SVR_SMALL, rounds)))
        return [done[i] if i in done else local(xs[i], ys[i], folds[i]) for i in range(len(ys))]

    return _fit_svr(rows, solve, SVR_GRID_LARGE, SVR_FOLDS_LARGE, limit=limit, rounds=rounds)


# --- using the models ----------------------------------------------------------------------------

def content_predict(models: DataFrame, targets: DataFrame, features: DataFrame, train: DataFrame) -> DataFrame:
    """x . coef + intercept, bounded; an unknown user or an item nobody rated is impossible."""
    known = train.select(C.ITEM, F.lit(True).alias("known_item")).distinct()
    joined = (
        targets.select(C.USER, C.ITEM).join(models, C.USER, "left")
        .join(features, C.ITEM, "left").join(known, C.ITEM, "left")
    )
    raw = V.dot(F.col("coef"), F.col("features")) + F.col("intercept")
    est = F.when(F.col("known_item").isNotNull(), S.clip(raw))
    return joined.select(C.USER, C.ITEM, est.alias("e")).select(
        C.USER, C.ITEM, F.coalesce("e", stats.global_mean_value(train)).alias("est"), F.col("e").isNull().alias("was_impossible"))


def coef_importance(models: DataFrame, names: DataFrame) -> DataFrame:
    """Per feature over users: mean |coef|, mean coef, sample deviation, relative deviation."""
    cells = models.select(F.posexplode("coef").alias("position", "c"))
    agg = cells.groupBy("position").agg(
        F.avg(F.abs("c")).alias("mean_abs_coef"), F.avg("c").alias("mean_coef"), F.stddev_samp("c").alias("std_coef"))
    return agg.join(names, "position").select(
        "feature", "mean_abs_coef", "mean_coef", "std_coef",
        (F.col("std_coef") / (F.col("mean_abs_coef") + 1e-8)).alias("cv_coef"),
    ).orderBy(F.col("mean_abs_coef").desc(), "feature")


def feature_importances(models: DataFrame, names: DataFrame) -> DataFrame:
    """(userId, feature, importance, rank): |coef| as shares, largest first; users with all-zero coefficients have none."""
    cells = models.select(C.USER, F.posexplode(V.normalised_abs(F.col("coef"))).alias("position", "importance"))
    w = W.partitionBy(C.USER).orderBy(F.col("importance").desc(), "position")
    return cells.withColumn("rank", F.row_number().over(w)).join(names, "position").select(C.USER, "feature", "importance", "rank")


def user_explanation(rows: DataFrame) -> DataFrame:
    """(userId, scores): mean feature value weighted by r - min(r) + 1e-8, scaled to [0, 1] over the features."""
    low = rows.groupBy(C.USER).agg(F.min(C.RATING).alias("low"))
    weighted = rows.join(low, C.USER).withColumn("w", F.col(C.RATING) - F.col("low") + 1e-8)
    mean = vector_to_array(Summarizer.mean(array_to_vector("features"), F.col("w")))
    return weighted.groupBy(C.USER).agg(mean.alias("m")).select(C.USER, V.min_max(F.col("m")).alias("scores"))


def explanation_rows(explanations: DataFrame, names: DataFrame) -> DataFrame:
    cells = explanations.select(C.USER, F.posexplode("scores").alias("position", "score"))
    return cells.join(names, "position").select(C.USER, "feature", "score")


def explanation_topk(explanations: DataFrame, names: DataFrame, *, k: int = 20) -> DataFrame:
    w = W.partitionBy(C.USER).orderBy(F.col("score").desc(), "feature")
    return explanation_rows(explanations, names).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def explain(models: DataFrame, names: DataFrame, items: DataFrame, pairs: DataFrame) -> DataFrame:
    """(userId, movieId, explanation): a sentence from the five strongest features of the user.

    Words and genres are named, feature families by their label, the first three different ones are kept.
    """
    top = feature_importances(models, names).where(F.col("rank") <= 5).groupBy(C.USER).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "feature"))), lambda x: x["feature"]).alias("top"))
    known = models.select(C.USER, F.lit(True).alias("known_user"))
    joined = (
        pairs.select(C.USER, C.ITEM).join(items.select(C.ITEM, C.TITLE, C.GENRES), C.ITEM, "left")
        .join(known, C.USER, "left").join(top, C.USER, "left")
    )
    listed = S.split_genres(C.GENRES)

    def label(f):
        return (
            F.when(F.startswith(f, F.lit("tag_")), F.replace(f, F.lit("tag_"), F.lit("")))
            .when(F.startswith(f, F.lit("genre_")) | F.array_contains(listed, f), F.replace(f, F.lit("genre_"), F.lit("")))
            .when(f == "year", F.lit(C.EXPLAIN_LABELS["year"]))
            .when(F.startswith(f, F.lit("genome_")), F.lit(C.EXPLAIN_LABELS["genome_"]))
            .when(F.startswith(f, F.lit("visual_")), F.lit(C.EXPLAIN_LABELS["visual_"]))
            .when(F.startswith(f, F.lit("movie_")), F.lit(C.EXPLAIN_LABELS["movie_"]))
        )

    words = F.slice(F.array_distinct(F.filter(F.transform("top", label), lambda x: x.isNotNull())), 1, 3)
    title, genres = F.col(C.TITLE), F.col(C.GENRES)
    text = (
        F.when(title.isNull(), F.lit(C.EXPLAIN_UNKNOWN_ITEM))
        .when(F.col("known_user").isNull(), F.concat(F.lit("'"), title, F.lit("' is recommended based on your content profile. Genres: "), genres, F.lit(".")))
        .when(F.size(F.coalesce(words, F.array().cast("array<string>"))) > 0, F.concat(
            F.lit("'"), title, F.lit("' is recommended because your profile values "), F.array_join(words, ", "),
            F.lit(". Genres: "), genres, F.lit(".")))
        .otherwise(F.concat(F.lit("'"), title, F.lit("' matches your content profile. Genres: "), genres, F.lit(".")))
    )
    return joined.select(C.USER, C.ITEM, text.alias("explanation"))


def explain_without_model(items: DataFrame, pairs: DataFrame) -> DataFrame:
    """The sentence used when no content model is loaded."""
    joined = pairs.select(C.USER, C.ITEM).join(items.select(C.ITEM, C.TITLE, C.GENRES), C.ITEM, "left")
    text = F.when(F.col(C.TITLE).isNull(), F.lit(C.EXPLAIN_HISTORY)).otherwise(F.concat(
        F.lit("'"), F.col(C.TITLE), F.lit("' matches your taste profile. Genres: "), F.col(C.GENRES), F.lit(".")))
    return joined.select(C.USER, C.ITEM, text.alias("explanation"))
