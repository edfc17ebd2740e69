"""Near duplicates by SetSketch registers: exponentially spaced truncated minima, banded, then verified on full sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteframe.llm.common import U64, WordCodes, blank_words, by_group, components, fresh_name, pieces, shingles
from tasteframe.scratch import materialise

#: Register base, rate and range of the sketch: registers fit 16 bits for sets of up to 10^22 elements.
BASE, RATE, TOP = 1.001, 20.0, 2**16 - 1
#: Registers per band; a bucket is cut into blocks of at most so many sets and bytes of sets.
WIDTH, BLOCK_SETS, BLOCK_BYTES = 4, 2048, 32 << 20
#: Pairs are dropped unverified only where twice the log-likelihood of the threshold lies this far below the best.
SCREEN = 36.0


def bands_for(threshold: float, miss: float = 1e-7) -> int:
    """Bands of ``WIDTH`` registers, so that a pair at the threshold shares no band with at most the given probability."""
    return max(1, math.ceil(math.log(miss) / math.log(1 - threshold**WIDTH)))


def _salts(m: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20240611)
    return r.integers(0, 2**64, m, U64), r.integers(0, 2**63, m, U64) * U64(2) + U64(1)


def sketch(sets: list[np.ndarray], m: int) -> np.ndarray:
    """m registers per nonempty set: 1 - log_b of the least of exponential variables, rounded down, cut to 0..TOP.

    The registers of a union are the larger ones of both sets, so sketches of parts merge.
    """
    xor, mul = _salts(m)
    out = np.empty((len(sets), m), U64)
    at = 0
    while at < len(sets):
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= 1 << 17):
            size += len(sets[end])
            end += 1
        x = np.concatenate(sets[at:end])
        starts = np.cumsum([0, *map(len, sets[at : end - 1])])
        for j in range(m):
            out[at:end, j] = np.minimum.reduceat((x ^ xor[j]) * mul[j], starts)
        at = end
    least = -np.log1p(-(out.astype(np.float64) + 0.5) / 2.0**64 * (1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(least) / math.log(BASE)), 0, TOP).astype(np.uint16)


def joint_loglik(sizes_x: float, sizes_y: np.ndarray, less: np.ndarray, more: np.ndarray, m: int, jaccard) -> np.ndarray:
    """Log-likelihood of a Jaccard similarity given how many registers of x are smaller and larger than those of y."""
    u, v = sizes_x / (sizes_x + sizes_y), sizes_y / (sizes_x + sizes_y)
    jaccard = np.minimum(jaccard, np.minimum(u / v, v / u))

    def p(z):
        return -np.log1p(-np.clip(z, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    up, down = p(u - v * jaccard), p(v - u * jaccard)
    same = np.clip(1 - up - down, 1e-12, 1)
    return more * np.log(np.maximum(up, 1e-12)) + less * np.log(np.maximum(down, 1e-12)) + (m - less - more) * np.log(same)


def likely(sizes_x: float, sizes_y: np.ndarray, regs_x: np.ndarray, regs_y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(estimate of the similarity, whether the threshold is still possible) from the registers of x against rows of y."""
    less, more = (regs_x < regs_y).sum(1), (regs_x > regs_y).sum(1)
    grid = np.linspace(0, 1, 41)
    ll = np.stack([joint_loglik(sizes_x, sizes_y, less, more, len(regs_x), g) for g in grid])
    best = ll.argmax(0)
    at = np.max([joint_loglik(sizes_x, sizes_y, less, more, len(regs_x), g) for g in np.linspace(threshold, 1, 7)], 0)
    return grid[best], 2 * (ll.max(0) - at) <= SCREEN


def _digests(docs: DataFrame, k: int, m: int | None, with_set: bool) -> DataFrame:
    """Per row: doc_id, n (set size), digest of the set (null: empty), then registers or the sorted set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for b in pieces(batches):
            sets = [np.unique(shingles(codes.of(blank_words(t)), k)) for t in b.column(1).to_pylist()]
            keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            if with_set:
                more = [s.tobytes() for s in sets]
            else:
                full = [s for s in sets if len(s)]
                regs = iter(sketch(full, m) if full else [])
                more = [next(regs).tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(list(map(len, sets)), pa.int64()), pa.array(keys, pa.binary()), pa.array(more, pa.binary())],
                ["doc_id", "n", "digest", "body"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n long, digest binary, body binary"
    )


def _block_links(threshold: float, m: int):
    """Links inside one block of a bucket, as few as connect what is connected there."""

    def run(g: dict[str, np.ndarray]) -> pd.DataFrame | None:
        rep, n, own, band = g["rep"], g["n"].astype(np.float64), g["own"], int(g["band"][0])
        order = np.argsort(n, kind="stable")
        rep, n, own = rep[order], n[order], own[order]
        regs = np.stack([np.frombuffer(x, np.uint16) for x in g["regs"][order]])
        bodies, sets = g["body"][order], {}
        words = regs.reshape(len(rep), m // WIDTH, WIDTH)
        across = g["lo"][0] != g["hi"][0]
        root = np.arange(len(rep))

        def elements(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = np.frombuffer(bodies[i], U64)
            return sets[i]

        links = []
        for i in range(len(rep) - 1):
            end = np.searchsorted(n, n[i] / threshold * (1 + 1e-9), "right")
            js = np.arange(i + 1, end)
            js = js[(root[js] != root[i]) & ((own[js] != own[i]) if across else True)]
            if band and len(js):  # a pair belongs to the first band that both share
                js = js[~(words[js, :band] == words[i, :band]).all(2).any(1)]
            if not len(js):
                continue
            estimate, possible = likely(n[i], n[js], regs[i], regs[js], threshold)
            for j in js[possible][np.argsort(-estimate[possible], kind="stable")]:
                if root[i] == root[j]:
                    continue
                both = len(np.intersect1d(elements(i), elements(j), assume_unique=True))
                if both >= threshold * (n[i] + n[j] - both) - 1e-9:
                    links.append((rep[i], rep[j]))
                    root[root == root[j]] = root[i]
        return pd.DataFrame(links, columns=["a", "b"]) if links else None

    return run


def near_duplicates(docs: DataFrame, threshold: float = 0.85, k: int = 5, miss: float = 1e-7) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): connected groups of texts with Jaccard similarity >= threshold.

    Words are lower-cased (A-Z) runs without ASCII white space, a document's set its distinct k-word shingles; a shorter
    text is one shingle, an empty or null text has none and is linked with nothing. One row per input row.
    ``component_id`` is the smallest doc_id that can be reached, ``kept`` says whether it is the row's own. Rows with
    one doc_id are one node. A row without doc_id is linked with nothing: its component is null and it is kept.
    Other columns of ``docs`` are ignored.

    Equal sets are folded into one class. Classes that agree in a band of registers meet in a bucket; a bucket with
    over ``BLOCK_SETS`` sets is cut into pairs of blocks, which cover all its pairs. In a block a joint likelihood of the
    registers orders the pairs and drops those that cannot reach the threshold, others are compared on full
    sets unless links found there connect them already. Links between classes, not pairs of copies, leave a block.
    A pair at the threshold is missed with probability ``miss``. Eager: writes steps to the shared folder.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    bands = bands_for(threshold, miss) if threshold < 1 else 1
    m = bands * WIDTH
    rows = materialise(_digests(docs, k, m, False), "sketches")
    classes = (
        rows.filter("digest is not null and doc_id is not null")
        .groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("body").alias("regs"))
    )
    classes = materialise(classes, "classes")
    size = 2 * WIDTH
    spread = classes.select(
        "digest", "n",
        F.posexplode(F.expr(f"transform(sequence(0, {bands - 1}), i -> xxhash64(i, substring(regs, i * {size} + 1, {size})))"))
        .alias("band", "bucket"),
    )
    buckets = (
        spread.groupBy("bucket", "band")
        .agg(F.count("*").alias("k"), F.bit_xor(F.xxhash64("digest")).alias("who"), F.sum("n").alias("size"))
        .filter("k > 1")
    )
    # buckets with the same members are one: the first band stays
    buckets = buckets.groupBy("who", "k", "size").agg(F.min(F.struct("band", "bucket")).alias("first"))
    blocks = F.greatest(F.ceil(F.col("k") / BLOCK_SETS), F.ceil(F.col("size") * 8 / BLOCK_BYTES)).cast("int")
    buckets = materialise(buckets.select("first.*", blocks.alias("blocks")), "buckets")
    members = materialise(spread.join(buckets, ["bucket", "band"]).select("digest", "bucket", "band", "blocks"), "members")
    wanted = classes.join(members.select("digest").distinct(), "digest", "left_semi")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    sets = _digests(texts, k, None, True).select("digest", "body").dropDuplicates(["digest"])
    sets = materialise(wanted.join(sets, "digest"), "sets")
    own = F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int")
    rowed = (
        members.join(sets, "digest").withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("rep", "n", "regs", "body", "band", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "bucket")
        .withColumn("key", F.xxhash64("bucket", "lo", "hi")).drop("bucket")
    )
    links = by_group(rowed, "key", _block_links(threshold, m), "a long, b long")
    # an id with several texts links their classes, and its empty rows follow it
    print_of = F.xxhash64("digest")
    several = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.min(print_of).alias("least"), F.max(print_of).alias("most"))
    several = materialise(several.filter("least <> most").select("doc_id"), "several")
    texts_of = rows.filter("digest is not null").join(several, "doc_id").select("doc_id", "digest").distinct()
    own_links = texts_of.join(classes.select("digest", "rep"), "digest").filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    roots = components(links.union(own_links), "a", "b")
    found = (
        classes.select("digest", "rep").join(roots, F.col("rep") == F.col("node"), "left")
        .select("digest", F.coalesce("root", "rep").alias("root"))
    )
    of_id = several.join(roots, F.col("doc_id") == F.col("node")).select("doc_id", "root")
    rooted = rows.filter("digest is not null").join(found, "digest", "left").select("doc_id", "n", "root")
    rooted = rooted.union(rows.filter("digest is null").join(of_id, "doc_id", "left").select("doc_id", "n", "root"))
    return (
        rooted.select(
            "doc_id", F.col("n").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def keep_one(docs: DataFrame, threshold: float = 0.8, k: int = 5) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: that with the smallest doc_id.

    Of rows that repeat a doc_id one stays (the smallest text). Rows without doc_id stay. Columns are unchanged.
    """
    names = docs.columns
    count, one = fresh_name(names, "_rows_of_id"), fresh_name(names, "_row")
    kept = near_duplicates(docs, threshold, k).filter("kept and doc_id is not null").groupBy("doc_id").agg(F.count("*").alias(count))
    kept = materialise(kept, "kept")
    # ids grow with the documents: one plan for every size, a merge of both sides by id
    rows = docs.join(kept.hint("merge"), "doc_id")
    once = rows.filter(F.col(count) == 1).select(names)
    rest = F.struct(F.lit(0).alias(fresh_name(names, "_none")), *[c for c in names if c not in ("doc_id", "text")])  # compared as JSON: maps have no order
    many = rows.filter(F.col(count) > 1).groupBy("doc_id").agg(F.min_by(F.struct("text", rest.alias("rest")), F.struct("text", F.to_json(rest))).alias(one))
    many = many.select(*[F.col("doc_id") if c == "doc_id" else F.col(one)["text"].alias(c) if c == "text" else F.col(one)["rest"][c].alias(c) for c in names])
    return once.union(many).union(docs.filter("doc_id is null").select(names))


ORACLE = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents),
sets AS MATERIALIZED (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                                      ELSE [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] END) AS s
    FROM texts),
members AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS MATERIALIZED (
    SELECT a.doc_id AS x, b.doc_id AS y FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (
    SELECT doc_id, doc_id AS other FROM sets UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON r.other = l.x)
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM sets s JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r ON r.doc_id = s.doc_id
"""
