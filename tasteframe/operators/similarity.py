"""User-user and item-item similarities from sums over common ratings.

Vocabulary: along an axis every rating is (x, y, r). On the user axis x is the user and y the item;
on the item axis they swap. Pairs (u, v) are values of x that share values of y.

Scale. Pair sums come from an equi-join on y. A value of y rated by n values of x makes n^2 pairs,
so y values above ``hot`` ratings need care:

* the join is salted: the ratings of a large y are cut into chunks of about ``chunk`` rows that meet in
  a grid of join keys, so no task holds a whole hot group;
* with ``min_support`` m > 1, a pair that counts shares at least m values. Each x therefore leaves its
  m - 1 most rated hot values out of the pair search: two values of x sharing m values always meet on
  a value that neither leaves out. One hot value thus creates no pairs of its own. The sums stay exact: a list
  entry carries what its id left out, and each of the two ids of a pair adds what the other one left out
  (``_sides``), so the pairs found are no rows. Ids with more pairs than a block holds are found by the salted join,
  and left-out ratings are added by key lookups;
* ``left`` limits u to the ids a caller asks about, which makes the work linear in the table per id;
* what travels is not a row per pair and common value but, per rating of u, the list of the others that
  rated the same y, in the narrowest types that hold the values. Blocks of u add the pairs up
  (``pair_sums``), drop those below the support, and only then write rows. An id u with more pairs than a
  block holds is left to the salted join;
* lists of more than ``PASS_PAIRS`` entries are worked off in passes over the ids, each written before the next begins, so the
  disk holds the lists of one pass.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.functions import scalars as S
from tasteframe.functions import vectors as V
from tasteframe.scratch import in_passes, materialise, passing, spread

HOT = 20_000
CHUNK = 5_000
#: Pairs (with repeats) that a block of ids adds up on average, and the most that one id may bring into it.
BLOCK_PAIRS = 1_000_000
#: List entries (with repeats) that are shuffled at once; where there are more, ids are served in passes, and one pass lies on disk at a time.
PASS_PAIRS = 150_000_000
SUMS = ("n", "suv", "suu", "svv", "su", "sv")


def along(ratings: DataFrame, axis: str) -> DataFrame:
    if axis not in ("user", "item"):
        raise ValueError("axis must be 'user' or 'item'")
    x, y = (C.USER, C.ITEM) if axis == "user" else (C.ITEM, C.USER)
    return ratings.select(F.col(x).alias("x"), F.col(y).alias("y"), F.col(C.RATING).alias("r"))


def salted_pairs(left: DataFrame, right: DataFrame, sizes: DataFrame, *, chunk: int = CHUNK) -> DataFrame:
    """Equi-join of (x, y, r) rows on y as (u, v, y, ru, rv) with u <> v.

    A large y is cut into c chunks on both sides; the chunks meet in a c x c grid of join keys, so one
    key holds at most about chunk x chunk pairs.
    """
    chunks = sizes.select("y", F.ceil(F.col("n_y") / chunk).cast("int").alias("c"))
    own = F.pmod(F.xxhash64("x"), F.col("c")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("c") - 1))
    r = right.join(chunks, "y").select(F.col("x").alias("v"), "y", F.col("r").alias("rv"), own.alias("rc"), every.alias("lc"))
    le = left.join(chunks, "y").select(F.col("x").alias("u"), "y", F.col("r").alias("ru"), own.alias("lc"), every.alias("rc"))
    keys = ["y", "lc", "rc"]
    joined = spread(le, *keys).join(spread(r, *keys), keys)
    return joined.where(F.col("u") != F.col("v")).select("u", "v", "y", "ru", "rv")


def _sum_pairs(pairs: DataFrame) -> DataFrame:
    ru, rv = F.col("ru"), F.col("rv")
    return pairs.groupBy("u", "v").agg(
        F.count("*").alias("n"), F.sum(ru * rv).alias("suv"), F.sum(ru * ru).alias("suu"),
        F.sum(rv * rv).alias("svv"), F.sum(ru).alias("su"), F.sum(rv).alias("sv"),
    )


def list_rows(
    left: DataFrame, right: DataFrame, sizes: DataFrame, *, ordered: bool = False, chunk: int = CHUNK, keep: Sequence[str] = (), carry: Sequence[str] = (),
    part: tuple[int, int] = (1, 0),
) -> DataFrame:
    """(u, y, ru, v, rv): for every row (x, y, r) of ``left`` the x and r of all ``right`` rows of its y, as arrays.

    ``ordered``: only of those with x above u. Lists ascend by r, so that equal values stand together and pack well.
    ``keep``: more columns of ``left``. ``carry``: more columns of ``right``, as arrays.
    ``part`` (n, d): only pairs whose ids have classes 0..n - 1 that add up to d, up to a multiple of n; a pair and its reverse are in the same part.
    The rows of a large y are cut into chunks that meet in a grid, as in ``salted_pairs``; a list then holds one chunk.
    """
    chunks = sizes.select("y", F.ceil(F.col("n_y") / chunk).cast("int").alias("c"))
    own = F.pmod(F.xxhash64("x"), F.col("c")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("c") - 1))
    n, d = part
    of_v = F.pmod(F.xxhash64(F.lit(n), F.col("x").cast("long")), F.lit(n)).cast("int")
    of_u = F.pmod(F.lit(d) - of_v, F.lit(n)).cast("int")
    cls = lambda c: [c.alias("cls")] if n > 1 else []
    lists = right.join(chunks, "y").groupBy("y", "c", own.alias("rc"), *cls(of_v)).agg(F.sort_array(F.collect_list(F.struct("r", "x", *carry))).alias("l"))
    keys = ["y", "lc", "rc", *["cls" for _ in cls(of_v)]]
    r = lists.select("y", "rc", every.alias("lc"), "l", *keys[3:])
    le = left.join(chunks, "y").select(F.col("x").alias("u"), "y", F.col("r").alias("ru"), own.alias("lc"), every.alias("rc"), *keep, *cls(of_u))
    joined = spread(le, *keys).join(spread(r, *keys), keys)
    if ordered:
        joined = joined.withColumn("l", F.filter("l", lambda e: e["x"] > F.col("u"))).where(F.size("l") > 0)
    return joined.select("u", "y", "ru", F.col("l.x").alias("v"), F.col("l.r").alias("rv"), *keep, *[F.col(f"l.{c}").alias(c) for c in carry])


def narrow(base: DataFrame) -> tuple[DataFrame, str] | None:
    """``base`` without null keys in the narrowest exact types, and the type of x; None if x, y are no integers or r holds NaN. Eager."""
    types = dict(base.dtypes)
    if not {types["x"], types["y"]} <= {"bigint", "int"} or types["r"] != "double":
        return None
    base = base.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    r = F.col("r")
    seen = base.agg(F.min("x").alias("low"), F.max("x").alias("high"), F.max(F.isnan(r)).alias("nan"), F.min(r == r.cast("float")).alias("exact")).first()
    if seen["nan"]:
        return None
    fits = seen["low"] is None or -(2**31) <= seen["low"] and seen["high"] < 2**31
    x = F.col("x").cast("int") if fits else F.col("x")
    return base.select(x.alias("x"), "y", (r.cast("float") if seen["exact"] else r).alias("r")), types["x"]


def work_of(left: DataFrame, sizes: DataFrame) -> DataFrame:
    """(x, pairs): how many list entries the rows of an id in ``left`` bring."""
    return left.join(sizes, "y").groupBy("x").agg(F.sum("n_y").alias("pairs"))


class Codes(NamedTuple):
    """One number per pair (u, v): the place of u, then the place of v among ``others`` or, where that fits, its distance from ``low``."""

    users: np.ndarray
    others: np.ndarray | None
    low: int
    wide: int

    @classmethod
    def of(cls, users: np.ndarray, v: np.ndarray) -> "Codes":
        low = int(v.min()) if len(v) else 0
        wide = int(v.max()) - low + 1 if len(v) else 1
        if wide * max(len(users), 1) < 2**62:
            return cls(users, None, low, wide)
        others = np.unique(v)
        return cls(users, others, 0, len(others))

    def encode(self, place: np.ndarray, v: np.ndarray) -> np.ndarray:
        at = v.astype(np.int64) - self.low if self.others is None else np.searchsorted(self.others, v)
        return place * self.wide + at

    def decode(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = code % self.wide
        return self.users[code // self.wide].astype(np.int64), at + self.low if self.others is None else self.others[at].astype(np.int64)

    def find(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Codes of pairs, -1 where u or v is not known here."""
        if not len(self.users):
            return np.full(len(u), -1)
        place = np.minimum(np.searchsorted(self.users, u), len(self.users) - 1)
        known = self.users[place] == u
        if self.others is None:
            known &= (v >= self.low) & (v < self.low + self.wide)
        else:
            known &= self.others[np.minimum(np.searchsorted(self.others, v), len(self.others) - 1)] == v
        return np.where(known, self.encode(place, v), -1)


class PairSums(NamedTuple):
    """Sums per pair, ascending by code."""

    codes: Codes
    code: np.ndarray
    n: np.ndarray
    sums: dict[str, np.ndarray]  # NaN: none of the values was known


def numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)


def flat_lists(table: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of rows (.., v, rv): the row number, v and rv of every list entry."""
    v = table["v"].combine_chunks()
    row = np.repeat(np.arange(table.num_rows), v.value_lengths().to_numpy(zero_copy_only=False))
    return row, v.flatten().to_numpy(), table["rv"].combine_chunks().flatten()


def add_up(table: pa.Table, min_n: int = 1, ordered: bool = False) -> PairSums:
    """Sums over the lists of one block (rows of ``list_rows``) for pairs that meet at least ``min_n`` times."""
    return add_up_first(table, min_n, ordered)[0]


def add_up_first(table: pa.Table, min_n: int = 1, ordered: bool = False) -> tuple[PairSums, np.ndarray]:
    """``add_up``, and per pair the place of one of its list entries."""
    users, place = np.unique(table["u"].to_numpy(), return_inverse=True)
    row, v, rv = flat_lists(table)
    codes = Codes.of(users, v)
    u = users[place[row]]
    keep = u < v if ordered else u != v
    entry = np.flatnonzero(keep)
    row, a, b = row[keep], numbers(table["ru"].combine_chunks())[row[keep]], numbers(rv)[keep]
    code = codes.encode(place[row], v[keep])
    order = np.argsort(code)
    code = code[order]
    starts = np.flatnonzero(np.diff(code, prepend=-1))
    n = np.diff(np.append(starts, len(code)))
    enough = n >= min_n
    order, code, n = order[np.repeat(enough, n)], code[starts[enough]], n[enough]
    starts, a, b = np.cumsum(n) - n, a[order], b[order]
    whole = not (np.isnan(a).any() or np.isnan(b).any())

    def total(x: np.ndarray) -> np.ndarray:
        if whole or not len(n):
            return np.add.reduceat(x, starts) if len(n) else np.zeros(0)
        known = ~np.isnan(x)
        return np.where(np.add.reduceat(known.astype(np.int64), starts) > 0, np.add.reduceat(np.where(known, x, 0.0), starts), np.nan)

    sums = {"suv": total(a * b), "suu": total(a * a), "svv": total(b * b), "su": total(a), "sv": total(b)}
    return PairSums(codes, code, n, sums), entry[order][starts]


def pair_sums(
    left: DataFrame, right: DataFrame, sizes: DataFrame, *, min_n: int = 1, ordered: bool = False, chunk: int = CHUNK, block: int = BLOCK_PAIRS,
    at_once: int | None = PASS_PAIRS,
) -> DataFrame:
    """The sums of all pairs (u of ``left``, v of ``right``) that share at least ``min_n`` values of y, as ``_sum_pairs`` of ``salted_pairs``.

    ``left`` holds all rows of ``right`` for some of its x. Eager in small steps; both should be written tables.
    """

    def joined(some: DataFrame) -> DataFrame:
        pairs = salted_pairs(some, right, sizes, chunk=chunk)
        pairs = _sum_pairs(pairs.where("u < v") if ordered else pairs)
        return pairs if min_n <= 1 else pairs.where(F.col("n") >= min_n)

    small = narrow(right)
    if small is None:
        return joined(left)
    rows, kind = small
    work = work_of(left, sizes)
    size = work.agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("all"), F.max("pairs").alias("most")).first()
    if at_once is not None and size["all"] > at_once:
        some = lambda part: pair_sums(part, right, sizes, min_n=min_n, ordered=ordered, chunk=chunk, block=block, at_once=None)
        return in_passes(left, "x", -(-size["all"] // at_once), some, "pairs")
    few, many = left, None
    if (size["most"] or 0) > block:
        large = materialise(work.where(F.col("pairs") > block).select("x"), "large")
        few, many = left.join(large, "x", "left_anti"), left.join(large, "x", "left_semi")
    blocks = max(1, -(-size["all"] // block))
    types = dict(rows.dtypes)
    few = few.where(F.col("x").isNotNull()).select(F.col("x").cast(types["x"]), "y", F.col("r").cast(types["r"]))
    listed = list_rows(few, rows, sizes, ordered=ordered, chunk=chunk).withColumn("b", F.pmod(F.xxhash64("u"), F.lit(blocks)))

    def run(table: pa.Table) -> pa.Table:
        p = add_up(table, min_n, ordered)
        ids = pa.int64() if kind == "bigint" else pa.int32()
        u, v = p.codes.decode(p.code)
        cols = {"u": pa.array(u, pa.int64()).cast(ids), "v": pa.array(v, pa.int64()).cast(ids), "n": pa.array(p.n, pa.int64())}
        return pa.table(cols | {c: pa.array(x, pa.float64(), mask=np.isnan(x)) for c, x in p.sums.items()})

    out = spread(listed, "b").groupBy("b").applyInArrow(run, f"u {kind}, v {kind}, n bigint, " + ", ".join(f"{c} double" for c in SUMS[1:]))
    return out if many is None else out.unionByName(joined(many))


def best_sums(target: np.ndarray, size: int, sims: np.ndarray, v: np.ndarray, dev: np.ndarray, cuts: Sequence[int]) -> list[tuple[np.ndarray, ...]]:
    """Per cut k the sums of sim * dev (over known dev; NaN: none) and of sim (NaN: none), and the number, of the k most similar rows of each target 0..size - 1, ties by v."""
    order = np.lexsort((v, -sims, target))
    target, sims, dev = target[order], sims[order], dev[order]
    n = np.bincount(target, minlength=size)
    rank = np.arange(len(target)) - (np.cumsum(n) - n)[target]
    known = ~np.isnan(dev)
    out = []
    for k in cuts:
        some = (rank < k) & known
        num = np.where(np.bincount(target[some], minlength=size) > 0, np.bincount(target[some], weights=sims[some] * dev[some], minlength=size), np.nan)
        den = np.where(n > 0, np.bincount(target[rank < k], weights=sims[rank < k], minlength=size), np.nan)
        out.append((num, den, np.minimum(n, k)))
    return out


def numbered(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first places of the distinct pairs (x, y), and the number of each row's pair."""
    xs, ys = np.unique(x, return_inverse=True)[1], np.unique(y, return_inverse=True)[1]
    return np.unique(xs * (ys.max(initial=0) + 1) + ys, return_index=True, return_inverse=True)[1:]


def similar_raters(
    base: DataFrame, values: DataFrame, targets: DataFrame, sizes: DataFrame, score: Callable[[np.ndarray, dict[str, np.ndarray]], np.ndarray], *,
    min_n: int = 1, k: int | None = None, cuts: Sequence[tuple[int, int]] | None = None, less: DataFrame | None = None,
    chunk: int = CHUNK, block: int = BLOCK_PAIRS,
) -> DataFrame | None:
    """(x, y, v, sim, r, support): for targets (x, y) the v that rated y and are similar to x, all or the ``k`` best, ties by id.

    With ``cuts`` (k, support) instead (x, y, k<k>s<support> (num, den, n)): the sums of sim * r and sim, and the number, of the k best of at least
    that support. ``less`` (x, mean): what is taken off the r of each v in these sums.

    A block of x holds the lists of raters of what its x rated, which give the sums and by ``score(n, sums)`` the similarities, and those of its
    targets, which are looked up among them: neither pairs nor similarities travel. ``base`` holds ratings, ``values`` what is summed.
    None where an id has more list entries than a block holds, or the types do not allow it. Eager in small steps; the tables should be written ones.
    """
    small, summed = narrow(base), narrow(values)
    if small is None or summed is None:
        return None
    (rows, kind), (summed, _) = small, summed
    known = targets.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    asked = values.join(known.select("x").distinct(), "x", "left_semi")
    work = work_of(asked.select("x", "y").unionByName(known.select("x", "y")), sizes)
    size = work.agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("all"), F.max("pairs").alias("most")).first()
    if (size["most"] or 0) > block:
        return None
    b = F.pmod(F.xxhash64(F.col("u").cast("long")), F.lit(max(1, -(-size["all"] // block)))).alias("b")
    mine = summed.join(known.select("x").distinct(), "x", "left_semi").select("x", "y", F.col("r"))
    sums = list_rows(mine, summed, sizes, chunk=chunk).select("*", b)
    carry = [] if cuts is None or less is None else ["mean"]
    listed = rows.join(less.select("x", "mean"), "x", "left") if carry else rows
    raters = list_rows(known.select("x", "y", F.lit(0.0).alias("r")), listed, sizes, chunk=chunk, carry=carry).select("u", "y", "v", "rv", *carry, b)
    y_kind = dict(base.dtypes)["y"]
    kinds = {"bigint": pa.int64(), "int": pa.int32()}
    sum_names = [f"{c}_k{k}s{s}" for k, s in cuts or () for c in ("num", "den", "n")]

    def summed_up(t: pa.Table, hit: np.ndarray, sims: np.ndarray, n: np.ndarray) -> pa.Table:
        row, v, r = flat_lists(t)
        dev = numbers(r)
        if carry:
            dev = dev - numbers(t["mean"].combine_chunks().flatten())
        x, y = t["u"].to_numpy(), t["y"].to_numpy()
        first, target = numbered(x, y)
        row, v, dev = row[hit], v[hit], dev[hit]
        found = {}
        for support in {s for _, s in cuts}:
            some, ks = n >= support, [k for k, s in cuts if s == support]
            found |= {(k, support): sums for k, sums in zip(ks, best_sums(target[row[some]], len(first), sims[some], v[some], dev[some], ks), strict=True)}
        any_ = np.bincount(target[row], minlength=len(first)) > 0
        ids = [pa.array(c[first][any_].astype(np.int64)).cast(kinds[of]) for c, of in ((x, kind), (y, y_kind))]
        cols = []
        for cut in cuts:
            num, den, count = (c[any_] for c in found[cut])
            cols += [pa.array(num, pa.float64(), mask=np.isnan(num)), pa.array(den, pa.float64(), mask=np.isnan(den)), pa.array(count, pa.int64())]
        return pa.table([*ids, *cols], names=["x", "y", *sum_names])

    def run(a: pa.Table, t: pa.Table) -> pa.Table:
        p = add_up(a, min_n)
        sims = score(p.n, p.sums)
        with np.errstate(invalid="ignore"):
            near = sims > 0
        code, sims, n = p.code[near], sims[near], p.n[near]
        row, v, r = flat_lists(t)
        x, y = t["u"].to_numpy()[row], t["y"].to_numpy()[row]
        wanted = p.codes.find(x, v)
        at = np.minimum(np.searchsorted(code, wanted), max(len(code) - 1, 0))
        hit = np.flatnonzero(code[at] == wanted) if len(code) else np.zeros(0, dtype=np.int64)
        if cuts is not None:
            return summed_up(t, hit, sims[at[hit]], n[at[hit]])
        x, y, v, r, at = x[hit], y[hit], v[hit], r.take(pa.array(hit)), at[hit]
        if k is not None and len(hit):
            order = np.lexsort((v, -sims[at], y, x))
            first = np.append(True, (np.diff(x[order]) != 0) | (np.diff(y[order]) != 0))
            rank = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
            pick = order[rank < k]
            x, y, v, r, at = x[pick], y[pick], v[pick], r.take(pa.array(pick)), at[pick]
        ids = [pa.array(c.astype(np.int64)).cast(kinds[t_]) for c, t_ in ((x, kind), (y, y_kind), (v, kind))]
        cols = [*ids, pa.array(sims[at], pa.float64()), r.cast(pa.float64()), pa.array(n[at], pa.int64())]
        return pa.table(cols, names=["x", "y", "v", "sim", "r", "support"])

    blocks = spread(sums, "b").groupBy("b").cogroup(spread(raters, "b").groupBy("b"))
    if cuts is None:
        return blocks.applyInArrow(run, f"x {kind}, y {y_kind}, v {kind}, sim double, r double, support bigint")
    out = blocks.applyInArrow(run, f"x {kind}, y {y_kind}, " + ", ".join(f"{c} {'bigint' if c.startswith('n_') else 'double'}" for c in sum_names))
    return out.select("x", "y", *[F.struct(*[F.col(f"{c}_k{k}s{s}").alias(c) for c in ("num", "den", "n")]).alias(f"k{k}s{s}") for k, s in cuts])


def corated_pairs(
    ratings: DataFrame, *, axis: str = "user", min_support: int = 1, left: DataFrame | None = None,
    ordered: bool = False, hot: int = HOT, chunk: int = CHUNK, block: int = BLOCK_PAIRS, at_once: int = PASS_PAIRS,
) -> DataFrame:
    """Sums over common ratings per pair (u, v) with at least ``min_support`` of them.

    ``left``: a table with a column x; only these ids appear as u. ``ordered`` keeps u < v.
    Eager: the ratings are written to the shared folder once, since every step reads them, and it looks for hot y.
    """
    base = materialise(along(ratings, axis), "rated")
    sizes = base.groupBy("y").agg(F.count("*").alias("n_y"))
    asked = base if left is None else base.join(left.select("x").distinct(), "x", "left_semi")

    def keep(pairs: DataFrame) -> DataFrame:
        return pairs.where("u < v") if ordered else pairs

    popular = sizes.where(F.col("n_y") > hot)
    if min_support <= 1 or popular.isEmpty():
        if left is not None or ordered:
            return pair_sums(asked, base, sizes, min_n=min_support, ordered=ordered, chunk=chunk, at_once=at_once)
        half = pair_sums(base, base, sizes, min_n=min_support, ordered=True, chunk=chunk, at_once=at_once)
        turned = {"u": "v", "v": "u", "suu": "svv", "svv": "suu", "su": "sv", "sv": "su"}
        both = [F.struct(*[F.col(name.get(c, c)).alias(c) for c in ("u", "v", *SUMS)]) for name in ({}, turned)]
        return half.select(F.inline(F.array(*both)))
    order = W.partitionBy("x").orderBy(F.col("n_y").desc(), "y")
    left_out = base.join(popular, "y").withColumn("k", F.row_number().over(order)).where(
        F.col("k") <= min_support - 1
    ).select("x", "y", "r")
    searched = base.join(left_out.select("x", "y"), ["x", "y"], "left_anti")
    asked_searched = searched if left is None else searched.join(left.select("x").distinct(), "x", "left_semi")

    def joined(some: DataFrame, others: DataFrame) -> DataFrame:
        found = materialise(_sum_pairs(keep(salted_pairs(some, others, sizes, chunk=chunk))), "pairs")
        pairs = found.select("u", "v")
        by_u = pairs.join(left_out.select(F.col("x").alias("u"), "y", F.col("r").alias("ru")), "u").join(
            base.select(F.col("x").alias("v"), "y", F.col("r").alias("rv")), ["v", "y"]
        )
        by_v = pairs.join(left_out.select(F.col("x").alias("v"), "y", F.col("r").alias("rv")), "v").join(
            searched.select(F.col("x").alias("u"), "y", F.col("r").alias("ru")), ["u", "y"]
        )
        cols = ["u", "v", "ru", "rv"]
        extra = _sum_pairs(by_u.select(*cols).unionByName(by_v.select(*cols)))
        total = found.unionByName(extra).groupBy("u", "v").agg(*[F.sum(c).alias(c) for c in SUMS])
        return total.where(F.col("n") >= min_support)

    small = narrow(base)
    if small is None:
        return joined(asked_searched, searched)
    left_out, searched = materialise(left_out, "left-out"), materialise(searched, "searched")
    asked_searched = searched if left is None else materialise(searched.join(left.select("x").distinct(), "x", "left_semi"), "asked")
    room = max(1, block // (min_support - 1))
    of_all = searched.groupBy("y").agg(F.count("*").alias("n_y"))
    work = work_of(searched, of_all)
    few, asked_few, parts = searched, asked_searched, []
    if (work.agg(F.max("pairs")).first()[0] or 0) > room:
        large = materialise(work.where(F.col("pairs") > room).select("x"), "large")
        few, asked_few = (materialise(t.join(large, "x", "left_anti"), "few") for t in (searched, asked_searched))
        parts = [joined(asked_searched.join(large, "x", "left_semi"), searched), joined(asked_few, searched.join(large, "x", "left_semi"))]

    def added(part: tuple[int, int]) -> DataFrame:
        mine = _sides(few, few if left is None else asked_few, few, left_out, popular, small, room, min_support, chunk, part)
        if left is None:
            rows = mine.select(F.inline(F.array(_side(0), _side(1))))
        else:
            theirs = _sides(few, few, asked_few, left_out, popular, small, room, min_support, chunk, part)
            rows = mine.select(F.inline(F.array(_side(0)))).unionByName(theirs.select(F.inline(F.array(_side(1)))))
        return _add_sides(keep(rows)).where(F.col("n") >= min_support)

    entries = work_of(asked_few, of_all).agg(F.coalesce(F.sum("pairs"), F.lit(0))).first()[0] * (1 if left is None else 2)
    n = max(1, -(-entries // at_once))
    out = added((1, 0)) if n == 1 else None
    for d in range(n) if n > 1 else ():
        with passing(base.sparkSession) as hold:
            done = hold(added((n, d)), "pairs")
        out = done if out is None else out.unionByName(done)
    for part in parts:
        out = out.unionByName(part)
    return out


def _sides(
    base: DataFrame, some: DataFrame, others: DataFrame, left_out: DataFrame, popular: DataFrame, small: tuple[DataFrame, str], block: int, m: int, chunk: int,
    part: tuple[int, int] = (1, 0),
) -> DataFrame:
    """(x, o, common sums, more sums): pairs of an x of ``some`` and an o of ``others`` that share a value neither leaves out.

    The common sums are over values that both or neither leave out, the more sums over those that o leaves out and x does not; what x
    leaves out and o does not is known where o stands first. A pair with m values in all has a row in both orders, or in one that has all
    of them: it is written where it has m values, or some that only o leaves out. ``small`` gives the types (``narrow``), ``part`` the pairs (``list_rows``).
    """
    types = dict(small[0].dtypes)
    cast = lambda t: t.where(F.col("x").isNotNull() & F.col("y").isNotNull()).select(F.col("x").cast(types["x"]), "y", F.col("r").cast(types["r"]))
    some, others, given = cast(some), cast(others), cast(left_out)
    sizes = others.groupBy("y").agg(F.count("*").alias("n_y"))
    total = (work_of(some, sizes).agg(F.sum("pairs")).first()[0] or 0) // part[0]
    to_block = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(max(1, -(-total // block)))).alias("b")
    span = given.agg(F.min("y").alias("low"), F.max("y").alias("high")).first()
    y = F.col("y").cast("int") if span["low"] is None or -(2**31) <= span["low"] and span["high"] < 2**31 else F.col("y")
    slots = [f"{c}{j}" for j in range(m - 1) for c in ("y", "r")]
    held = given.groupBy("x").agg(F.sort_array(F.collect_list(F.struct(y.alias("y"), "r"))).alias("l"))
    held = held.select("x", *[F.get("l", F.lit(j))[c].alias(f"{c}{j}") for j in range(m - 1) for c in ("y", "r")])
    listed = list_rows(some, others.join(held, "x", "left"), sizes, chunk=chunk, carry=slots, part=part).select("u", "ru", "v", "rv", *slots, to_block("u"))
    ids = some.select("x").distinct()
    hot_y = popular.select("y")
    own = cast(base).join(hot_y, "y", "left_semi").withColumn("out", F.lit(False)).unionByName(given.withColumn("out", F.lit(True)))
    own = own.join(ids, "x", "left_semi").select("x", "y", "r", "out", to_block("x"))
    kind, found = small[1], [f"{a}_{c}" for a in ("common", "more") for c in SUMS]

    def run(a: pa.Table, mine: pa.Table) -> pa.Table:
        p, first = add_up_first(a)
        x, o = p.codes.decode(p.code)
        at_x = p.code // p.codes.wide
        my_y, my_r = mine["y"].to_numpy(), numbers(mine["r"].combine_chunks())
        is_out = mine["out"].to_numpy(zero_copy_only=False) if mine.num_rows else np.zeros(0, dtype=bool)
        ys = np.unique(my_y)
        users = p.codes.users
        my_x = mine["x"].to_numpy()
        place = np.searchsorted(users, my_x)
        key = place * (len(ys) + 1) + np.searchsorted(ys, my_y)
        met = np.flatnonzero(users[np.minimum(place, len(users) - 1)] == my_x) if len(users) else np.zeros(0, dtype=np.int64)
        order = met[np.argsort(key[met], kind="stable")]
        key, my_r, is_out = key[order], my_r[order], is_out[order]
        pair, ru, rv, both = [], [], [], []
        for j in range(m - 1):
            held_y = a[f"y{j}"].combine_chunks().flatten()
            there = np.flatnonzero(held_y.is_valid().to_numpy(zero_copy_only=False)[first])
            value = held_y.fill_null(0).to_numpy()[first[there]]
            at = np.searchsorted(ys, value)
            known = np.flatnonzero(ys[np.minimum(at, len(ys) - 1)] == value) if len(ys) else np.zeros(0, dtype=np.int64)
            there, at = there[known], at[known]
            wanted = at_x[there] * (len(ys) + 1) + at
            low, high = np.searchsorted(key, wanted), np.searchsorted(key, wanted, side="right")
            n = high - low
            hit = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            pair.append(np.repeat(there, n))
            ru.append(my_r[hit])
            rv.append(np.repeat(numbers(a[f"r{j}"].combine_chunks().flatten())[first[there]], n))
            both.append(is_out[hit])
        pair, ru, rv, both = map(np.concatenate, (pair, ru, rv, both))
        common, more = {"n": p.n} | p.sums, {}
        size = len(p.code)
        for which, out in ((both, common), (~both, more)):
            q, a_, b_ = pair[which], ru[which], rv[which]
            out["n"] = out.get("n", 0) + np.bincount(q, minlength=size)
            for c, values in (("suv", a_ * b_), ("suu", a_ * a_), ("svv", b_ * b_), ("su", a_), ("sv", b_)):
                known = ~np.isnan(values)
                add = np.bincount(q[known], weights=values[known], minlength=size)
                old = out.get(c, np.full(size, np.nan))
                out[c] = np.where(np.bincount(q[known], minlength=size) > 0, np.nan_to_num(old) + add, old)
        pick = (common["n"] + more["n"] >= m) | (more["n"] > 0)
        type_ = pa.int64() if kind == "bigint" else pa.int32()
        cols = [pa.array(c[pick], pa.int64()).cast(type_) for c in (x, o)]
        for sums in (common, more):
            cols += [pa.array(sums[c][pick], pa.int64()) if c == "n" else pa.array(sums[c][pick], pa.float64(), mask=np.isnan(sums[c][pick])) for c in SUMS]
        return pa.table(cols, names=["x", "o", *found])

    schema = f"x {kind}, o {kind}, " + ", ".join(f"{c} {'bigint' if c.endswith('_n') else 'double'}" for c in found)
    return spread(listed, "b").groupBy("b").cogroup(spread(own, "b").groupBy("b")).applyInArrow(run, schema)


def _side(at: int) -> Column:
    """A row of ``_sides`` as seen from u: u stands first (0) or last (1)."""
    turned = {"suu": "svv", "svv": "suu", "su": "sv", "sv": "su"} if at else {}
    u, v = ("o", "x") if at else ("x", "o")
    sums = [F.col(f"{a}_{turned.get(c, c)}").alias(f"{a}_{c}") for a in ("common", "more") for c in SUMS]
    return F.struct(F.col(u).alias("u"), F.col(v).alias("v"), F.lit(at).alias("at"), *sums)


def _add_sides(rows: DataFrame) -> DataFrame:
    """The sums of a pair from its one or two rows: the common ones once, the others of both."""
    def total(c: str) -> Column:
        pick = lambda at, of: F.max(F.when(F.col("at") == at, F.col(f"{of}_{c}")))
        terms = [F.coalesce(pick(0, "common"), pick(1, "common")), pick(0, "more"), pick(1, "more")]
        zero = F.lit(0).cast("long") if c == "n" else F.lit(0.0)
        return F.when(F.coalesce(*terms).isNotNull(), sum((F.coalesce(t, zero) for t in terms), zero)).alias(c)

    return rows.groupBy("u", "v").agg(*map(total, SUMS))


def _ratio(num: Column, den: Column, eps: float = 0.0) -> Column:
    return F.when(den > eps, num / F.when(den > eps, den)).otherwise(0.0)


def cosine_expr() -> Column:
    return _ratio(F.col("suv"), F.sqrt(F.col("suu") * F.col("svv")), 1e-12)


def pearson_expr() -> Column:
    n, su, sv = F.col("n"), F.col("su"), F.col("sv")
    zero = F.lit(0.0)
    den = F.sqrt(F.greatest(n * F.col("suu") - su * su, zero) * F.greatest(n * F.col("svv") - sv * sv, zero))
    return _ratio(n * F.col("suv") - su * sv, den, 1e-9)


def msd_expr() -> Column:
    msd = (F.col("suu") + F.col("svv") - 2 * F.col("suv")) / F.col("n")
    return 1 / (1 + msd)


def _finish(pairs: DataFrame, sim: Column) -> DataFrame:
    return pairs.select("u", "v", sim.alias("sim"), F.col("n").alias("support"))


def sim_msd(ratings: DataFrame, **kw) -> DataFrame:
    return _finish(corated_pairs(ratings, **kw), msd_expr())


def sim_cosine(ratings: DataFrame, **kw) -> DataFrame:
    """Cosine over the common ratings only."""
    return _finish(corated_pairs(ratings, **kw), cosine_expr())


def sim_pearson(ratings: DataFrame, **kw) -> DataFrame:
    """Correlation over the common ratings; 0 where one side does not vary."""
    return _finish(corated_pairs(ratings, **kw), S.snap(pearson_expr()))


def sim_jaccard(ratings: DataFrame, *, axis: str = "user", **kw) -> DataFrame:
    pairs = corated_pairs(ratings, axis=axis, **kw)
    counts = along(ratings, axis).groupBy("x").agg(F.count("*").alias("c"))
    both = pairs.join(counts.select(F.col("x").alias("u"), F.col("c").alias("cu")), "u").join(
        counts.select(F.col("x").alias("v"), F.col("c").alias("cv")), "v")
    return _finish(both, F.col("n") / (F.col("cu") + F.col("cv") - F.col("n")))


def centre_by_user(ratings: DataFrame) -> DataFrame:
    means = ratings.groupBy(C.USER).agg(F.avg(C.RATING).alias("m"))
    return ratings.join(means, C.USER).select(C.USER, C.ITEM, (F.col(C.RATING) - F.col("m")).alias(C.RATING))


def sim_adjusted_cosine(ratings: DataFrame, *, axis: str = "item", **kw) -> DataFrame:
    """Cosine after taking each user's mean off the ratings."""
    return _finish(corated_pairs(centre_by_user(ratings), axis=axis, **kw), S.snap(cosine_expr()))


SIMILARITIES = {
    "msd": sim_msd, "jaccard": sim_jaccard, "cosine": sim_cosine, "pearson": sim_pearson,
    "adjusted_cosine": sim_adjusted_cosine,
}


def itr_user_stats(ratings: DataFrame) -> DataFrame:
    """Norm, mean and population deviation per user."""
    return ratings.groupBy(F.col(C.USER).alias("x")).agg(
        F.sqrt(F.sum(F.col(C.RATING) * F.col(C.RATING))).alias("norm"),
        F.avg(C.RATING).alias("mu"), F.stddev_pop(C.RATING).alias("sd"),
    )


def itr_expr(dot: Column, a: str = "u", b: str = "v") -> Column:
    """Triangle similarity over the union of the ratings (absent = 0) times user rating preference.

    The squared distance over the union is norm_u^2 + norm_v^2 - 2 dot, so users without a common
    item keep a positive similarity.
    """
    nu, nv = F.col(f"{a}_norm"), F.col(f"{b}_norm")
    dist = F.sqrt(F.greatest(nu * nu + nv * nv - 2 * dot, F.lit(0.0)))
    triangle = F.when(nu + nv > 0, 1 - dist / (nu + nv)).otherwise(0.0)
    gap = F.abs(F.col(f"{a}_mu") - F.col(f"{b}_mu")) * F.abs(F.col(f"{a}_sd") - F.col(f"{b}_sd"))
    return S.snap(triangle * (1 - 1 / (1 + F.exp(-gap))))


def with_user_stats(df: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    return df.join(stats.select(F.col("x").alias(key), *[F.col(c).alias(f"{key}_{c}") for c in ("norm", "mu", "sd")]), key)


def sim_itr(ratings: DataFrame, *, left: DataFrame | None = None, ordered: bool = False, **kw) -> DataFrame:
    """ITR similarity of the pairs that share an item (``neighbours.knn_itr`` also serves the others)."""
    stats = itr_user_stats(ratings)
    pairs = corated_pairs(ratings, axis="user", left=left, ordered=ordered, **kw)
    return _finish(with_user_stats(with_user_stats(pairs, stats, "u"), stats, "v"), itr_expr(F.col("suv")))


def sim_content(features: DataFrame, pairs: DataFrame) -> DataFrame:
    """Cosine of item feature arrays for the given item pairs (u, v)."""
    a = features.select(F.col(C.ITEM).alias("u"), F.col("features").alias("fu"))
    b = features.select(F.col(C.ITEM).alias("v"), F.col("features").alias("fv"))
    return pairs.join(a, "u").join(b, "v").select(
        "u", "v", V.dot(V.l2_normalise(F.col("fu")), V.l2_normalise(F.col("fv"))).alias("sim"))


def sim_genre_jaccard(items: DataFrame, pairs: DataFrame) -> DataFrame:
    """Genre overlap (1 - distance) of the given item pairs (u, v)."""
    a = items.select(F.col(C.ITEM).alias("u"), F.col(C.GENRES).alias("gu"))
    b = items.select(F.col(C.ITEM).alias("v"), F.col(C.GENRES).alias("gv"))
    return pairs.join(a, "u").join(b, "v").select("u", "v", (1 - S.genre_jaccard_distance("gu", "gv")).alias("sim"))
