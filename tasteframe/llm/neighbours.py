"""Nearest neighbours by inner product: multi-index hashing of learned rotated binary codes, reranked on the vectors."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteframe.llm.common import by_group, smallest_hashes
from tasteframe.scratch import materialise

#: Code length, bits of an indexed substring, and the bounded sample that rotations and radius are learned from.
BITS, SUBSTRING, SAMPLE, PROBES = 128, 16, 8_000, 200
#: Share of the sample's true neighbours that the learned radius reaches.
AIM = 0.97
#: Rows of a block of candidates and of a block of queries.
CANDIDATES, QUERIES = 16_384, 4_096


@dataclass(frozen=True)
class Codes:
    """Rotations that turn a vector into signs, and the Hamming radius to search."""

    rotation: np.ndarray  # dimensions x BITS
    radius: int

    def of(self, x: np.ndarray) -> np.ndarray:
        """Codes of the rows of x, as BITS // SUBSTRING numbers of SUBSTRING bits each."""
        return np.packbits(x @ self.rotation > 0, axis=1).view(np.uint16)


def rotations(x: np.ndarray, bits: int = BITS, rounds: int = 20) -> np.ndarray:
    """Iterative quantisation: rotations that bring vectors near their sign corners; several, until there are enough bits."""
    rng, parts = np.random.default_rng(5), []
    norms = np.linalg.norm(x, axis=1, keepdims=True)
    x = x / norms
    while sum(p.shape[1] for p in parts) < bits:
        r = np.linalg.qr(rng.normal(size=(x.shape[1], x.shape[1])))[0]
        for _ in range(rounds):
            u, _, vt = np.linalg.svd(x.T @ np.sign(x @ r))
            r = u @ vt
        parts.append(r)
    return np.concatenate(parts, 1)[:, :bits]


def learn(vectors: DataFrame, k: int) -> Codes | None:
    """Rotations and radius from at most SAMPLE vectors (those with the smallest hash of the id); None without vectors.

    The radius is the smallest that reaches AIM of the k nearest of PROBES vectors among the sample. Neighbours in the
    whole table are nearer than in a sample, so the recall there is higher. Eager; the sample goes to the driver.
    """
    rows = smallest_hashes(vectors, SAMPLE, "vec_id", "vec").select("vec").toPandas()
    if not len(rows):
        return None
    x = np.stack(rows["vec"].to_numpy()).astype(np.float64)
    codes = Codes(rotations(x), BITS)
    own = codes.of(x)
    needed = []
    for i in range(min(PROBES, len(x))):
        near = x @ x[i]
        near[i] = -np.inf
        best = np.argsort(-near)[: min(k, len(x) - 1)]
        needed.append(np.bitwise_count(own[best] ^ own[i]).sum(1))
    needed = np.sort(np.concatenate(needed)) if needed else np.zeros(0)
    return Codes(codes.rotation, int(needed[int(AIM * (len(needed) - 1))]) if len(needed) else BITS)


def usable(vectors: DataFrame, vec: str) -> Column:
    """Vectors that are not null, hold finite numbers only and are not zero."""
    x = F.col(vec)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(x.isNotNull() & (F.size(x) > 0) & finite & F.exists(x, lambda v: v != 0), F.lit(False))


def _search(codes: Codes, k: int):
    n_sub = BITS // SUBSTRING
    each = codes.radius // n_sub
    values = np.arange(1 << SUBSTRING, dtype=np.uint16)

    def run(g: dict[str, np.ndarray]) -> pd.DataFrame | None:
        asks = g["ask"].astype(bool)
        if not asks.any() or asks.all():
            return None
        x = np.stack(g["vec"]).astype(np.float64)
        ids, own = g["vec_id"][~asks], codes.of(x[~asks])
        queries, probes = g["vec_id"][asks], codes.of(x[asks])
        cand, ask = x[~asks], x[asks]
        repeated = len(np.unique(ids)) < len(ids)
        # one index per substring: candidates sorted by their value, and where each value begins
        order = [np.argsort(own[:, s], kind="stable") for s in range(n_sub)]
        begins = [np.searchsorted(own[o, s], np.arange((1 << SUBSTRING) + 1)) for s, o in enumerate(order)]
        filled = [values[np.diff(b) > 0] for b in begins]
        out = []
        for q in range(len(queries)):
            # pigeonhole: a code within the radius differs in at most radius // n_sub bits of some substring
            found = np.zeros(len(ids), bool)
            for s in range(n_sub):
                hit = filled[s][np.bitwise_count(filled[s] ^ probes[q, s]) <= each].astype(np.int64)
                a, n = begins[s][hit], begins[s][hit + 1] - begins[s][hit]
                found[order[s][np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())]] = True
            rows = np.flatnonzero(found)
            rows = rows[np.bitwise_count(own[rows] ^ probes[q]).sum(1) <= codes.radius]
            rows = rows[ids[rows] != queries[q]]
            if not len(rows):
                continue
            score = (cand[rows] * ask[q]).sum(1)
            if len(rows) > k and not repeated:
                least = np.partition(score, len(rows) - k)[len(rows) - k]
                rows, score = rows[score >= least], score[score >= least]
            best = np.lexsort((ids[rows], -score))
            if repeated:  # an id counts with its best vector
                best = best[np.sort(np.unique(ids[rows[best]], return_index=True)[1])]
            best = best[:k]
            out.append(pd.DataFrame({"query_id": queries[q], "vec_id": ids[rows[best]], "score": score[best]}))
        return pd.concat(out) if out else None

    return run


def _blocks(vectors: DataFrame, queries: DataFrame, codes: Codes, k: int, n: int, n_queries: int) -> DataFrame:
    """The k best of every query and block of candidates, then of every query."""
    c, q = max(1, -(-n // CANDIDATES)), max(1, -(-n_queries // QUERIES))
    all_c, all_q = F.explode(F.sequence(F.lit(0), F.lit(c - 1))), F.explode(F.sequence(F.lit(0), F.lit(q - 1)))
    here = F.pmod(F.xxhash64("vec_id", "vec"), F.lit(c)).cast("int")
    there = F.pmod(F.xxhash64("vec_id", "vec", F.lit(1)), F.lit(q)).cast("int")
    left = vectors.select("vec_id", "vec", F.lit(False).alias("ask"), here.alias("cb"), all_q.alias("qb"))
    right = queries.select("vec_id", "vec", F.lit(True).alias("ask"), all_c.alias("cb"), there.alias("qb"))
    rows = left.union(right).withColumn("key", F.xxhash64("cb", "qb")).drop("cb", "qb")
    return _ranked(by_group(rows, "key", _search(codes, k), "query_id long, vec_id long, score double"), k)


def _ranked(near: DataFrame, k: int) -> DataFrame:
    """The k best of every query; an id that several vectors share counts with its best score."""
    best = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, queries: DataFrame | None = None, k: int = 20, vec: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates of largest inner product found for each query.

    ``vectors`` has vec_id and an array of numbers; ``queries`` some of its rows (default: ids divisible by 20). Candidates
    are all rows but those with the query's id. Null, empty, zero vectors and those with null or non-finite numbers take no
    part, nor do rows without vec_id. Vectors of several lengths are searched length by length, as a product needs two of one length.
    Of rows that share a vec_id each different vector asks and is found; the id stands once, with its best score. Equal scores: the
    smaller vec_id first. Scores are inner products of the given vectors in double precision.

    Every vector is indexed. Candidates and queries meet in a grid of blocks of bounded size; in a block each substring
    of the codes has its own index, and probing all values within radius // substrings bits finds every code within the
    radius. A query for which fewer than k are found is asked again with the radius of all bits. Eager.
    """
    names = {"vec_id", vec}
    rows = vectors.select(*[c for c in vectors.columns if c in names]).filter(usable(vectors, vec) & F.col("vec_id").isNotNull())
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vec).cast("array<double>").alias("vec"))
    rows = materialise(rows.distinct().withColumn("d", F.size("vec")), "vectors")
    asks = rows.filter("vec_id % 20 = 0")
    if queries is not None:
        asks = rows.join(queries.select(F.col("vec_id").cast("long").alias("vec_id")).distinct(), "vec_id", "left_semi")
    lengths = [r.d for r in asks.select("d").distinct().collect()]
    found = [_of_length(rows.filter(F.col("d") == d).drop("d"), asks.filter(F.col("d") == d).drop("d"), k) for d in sorted(lengths)]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if len(found) == 1:
        return found[0]
    return _ranked(reduce(DataFrame.union, found).drop("rank"), k)


def _of_length(rows: DataFrame, asks: DataFrame, k: int) -> DataFrame:
    """As ``nearest``, of distinct (vec_id, vec) whose vectors have one length."""
    n, ids, n_queries = rows.count(), rows.select("vec_id").distinct().count(), asks.count()
    codes = learn(rows, k)
    first = materialise(_blocks(rows, asks, codes, k, n, n_queries), "nearest")
    full = first.groupBy("query_id").count().filter(F.col("count") >= min(k, ids - 1))
    poor = materialise(asks.join(full, F.col("vec_id") == F.col("query_id"), "left_anti"), "asked-again")
    n_poor = poor.count()
    if not n_poor:
        return first
    again = _blocks(rows, poor, Codes(codes.rotation, BITS), k, n, n_poor)
    return first.join(poor.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").union(again)
