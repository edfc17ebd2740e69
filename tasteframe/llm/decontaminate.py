"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, weighted-shingle verification."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteframe.llm.common import U64, WordCodes, pieces, plain_words, shingles
from tasteframe.scratch import materialise

#: Words per shingle, and the least weighted similarity of a leak.
WORDS, SIMILARITY = 5, 0.8
#: Fingerprints have BLOCKS blocks of 16 bits; within RADIUS bits, one block differs in at most RADIUS // BLOCKS bits.
BLOCKS, RADIUS = 4, 23
#: Items that one scan of the documents looks for: bounds the broadcast index. More items take more scans.
ITEMS_A_SCAN, BYTES_A_SCAN = 400, 8 << 20
#: Shingles whose running sums are held at once.
SPAN = 1 << 16
_BITS = np.arange(64, dtype=U64)


def weights(words: list[bytes], k: int) -> np.ndarray:
    """Weight of each run of k words: its bytes. A run of long words says more than one of short ones."""
    sums = np.cumsum([0, *map(len, words)])
    return (sums[k:] - sums[:-k]).astype(np.int64)


def _signs(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """A row per shingle: plus or minus its weight for each of the 64 bits of its code."""
    return np.where((h[:, None] >> _BITS) & U64(1), w[:, None], -w[:, None])


def _pack(sums: np.ndarray) -> np.ndarray:
    return ((sums > 0).astype(U64) << _BITS).sum(1, dtype=U64)


@dataclass
class Item:
    item_id: int | None
    k: int
    hashes: np.ndarray  # distinct, sorted
    counts: np.ndarray
    weight: np.ndarray
    size: int  # shingles, repeats counted
    mass: int


def _item(item_id: int | None, words: list[bytes], codes: WordCodes) -> tuple[Item, int]:
    k = min(WORDS, len(words))
    h, w = shingles(codes.of(words), k), weights(words, k)
    u, at, n = np.unique(h, return_index=True, return_counts=True)
    return Item(item_id, k, u, n, w[at], len(h), int(w.sum())), int(_pack(_signs(h, w).sum(0, keepdims=True))[0])


class Index:
    """Items by 16-bit blocks of their fingerprints: each block value leads to the items whose block lies within the bound.

    Two fingerprints within RADIUS differ in at most RADIUS // BLOCKS bits of some block, so a probe of all blocks
    finds every item within the radius.
    """

    def __init__(self, items: list[tuple]):
        codes = WordCodes()
        made = [_item(i, words, codes) for i, words in items]
        self.items = [m[0] for m in made]
        self.prints = np.array([m[1] for m in made], U64)
        flips = np.array([sum(1 << b for b in c) for r in range(RADIUS // BLOCKS + 1) for c in combinations(range(16), r)], np.int32)
        self.offsets, self.lists = [], []
        for b in range(BLOCKS):
            own = ((self.prints >> U64(16 * b)) & U64(0xFFFF)).astype(np.int32)
            near = (own[:, None] ^ flips).ravel()
            order = np.argsort(near, kind="stable")
            self.lists.append(np.repeat(np.arange(len(made), dtype=np.int32), len(flips))[order])
            self.offsets.append(np.searchsorted(near[order], np.arange((1 << 16) + 1)))
        self.groups: dict[int, dict[int, np.ndarray]] = {}
        for at, item in enumerate(self.items):
            sizes = self.groups.setdefault(item.k, {})
            sizes[item.size] = np.append(sizes.get(item.size, np.zeros(0, np.int64)), at)
        self.known, self.screen = {}, {}
        for k in self.groups:
            self.known[k] = np.unique(np.concatenate([i.hashes for i in self.items if i.k == k]))
            self.screen[k] = np.zeros(1 << 20, bool)
            self.screen[k][self.known[k] >> U64(44)] = True
        self.lightest = {k: min(i.mass for i in self.items if i.k == k) for k in self.groups}

    def within(self, prints: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of all pairs within the radius, of the items ``members``."""
        windows, items = [], []
        allowed = np.zeros(len(self.items), bool)
        allowed[members] = True
        for b in range(BLOCKS):
            code = ((prints >> U64(16 * b)) & U64(0xFFFF)).astype(np.int64)
            start, n = self.offsets[b][code], self.offsets[b][code + 1] - self.offsets[b][code]
            w = np.repeat(np.arange(len(prints)), n)
            i = self.lists[b][np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)]
            windows.append(w[allowed[i]])
            items.append(i[allowed[i]])
        w, i = np.concatenate(windows), np.concatenate(items)
        pair = np.unique(w.astype(np.int64) * len(self.items) + i)
        w, i = np.divmod(pair, len(self.items))
        d = np.bitwise_count(prints[w] ^ self.prints[i])
        near = d <= RADIUS
        return w[near], i[near], d[near]

    def similarity(self, at: int, h: np.ndarray, w_sum: int) -> float:
        """Weighted Jaccard similarity of an item and a window, repeats counted."""
        item = self.items[at]
        u, n = np.unique(h, return_counts=True)
        pos = np.minimum(np.searchsorted(u, item.hashes), len(u) - 1)
        both = int((np.where(u[pos] == item.hashes, np.minimum(n[pos], item.counts), 0) * item.weight).sum())
        return both / (item.mass + w_sum - both)

    def leaks(self, words: list[bytes], codes: np.ndarray) -> Iterator[tuple]:
        """(item, similarity, first word, words, distance) of the best window of each item that the text holds."""
        for k, sizes in self.groups.items():
            if len(words) < k:
                continue
            h = shingles(codes, k)
            hit = np.flatnonzero(self.screen[k][h >> U64(44)])
            if not len(hit):
                continue
            known = self.known[k]
            hit = hit[known[np.minimum(np.searchsorted(known, h[hit]), len(known) - 1)] == h[hit]]
            w = weights(words, k)
            if w[hit].sum() < SIMILARITY * self.lightest[k]:
                continue
            active = np.zeros(len(h), np.int64)
            active[hit] = w[hit]
            mass, all_mass = np.concatenate([[0], np.cumsum(active)]), np.concatenate([[0], np.cumsum(w)])
            whole = np.concatenate([np.zeros((1, 64), np.int64), np.cumsum(_signs(h, w), 0)]) if len(h) <= SPAN else None
            for size, members in sizes.items():
                s = min(size, len(h))
                got, total = mass[s:] - mass[:-s], all_mass[s:] - all_mass[:-s]
                # shared weight is at most the known weight of the window: windows below cannot reach the similarity
                least = min(self.items[i].mass for i in members)
                starts = np.flatnonzero((got >= SIMILARITY * total) & (got >= SIMILARITY * least))
                best: dict[int, tuple] = {}
                while len(starts):
                    part = starts[starts < starts[0] + SPAN]
                    starts = starts[len(part):]
                    if whole is not None:
                        prints = _pack(whole[part + s] - whole[part])
                    else:
                        a, z = part[0], part[-1] + s
                        sums = np.concatenate([np.zeros((1, 64), np.int64), np.cumsum(_signs(h[a:z], w[a:z]), 0)])
                        prints = _pack(sums[part - a + s] - sums[part - a])
                    for x, i, d in zip(*self.within(prints, members), strict=True):
                        if i in best and best[i][0] >= 1.0:
                            continue
                        p = int(part[x])
                        sim = self.similarity(i, h[p : p + s], int(total[p]))
                        if sim >= SIMILARITY and (i not in best or sim > best[i][0]):
                            best[i] = (sim, p, s + k - 1, int(d))
                for i, found in best.items():
                    yield (self.items[i].item_id, *found)


#: The last index that this worker process has built.
_BUILT: dict[str, tuple[list, Index]] = {}


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words, distance): the best window of each item that a document holds.

    Words are runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased. A window has the item's number
    of words (or is the whole document, if that is shorter). SimHash fingerprints of windows and items add the
    weights of their 5-word shingles (items with fewer words: the item as one); every item within RADIUS bits is found by its
    blocks, and those whose weighted Jaccard similarity reaches SIMILARITY are leaks. Windows whose known shingles
    weigh too little to reach it are not hashed, which loses none. Of equal windows the first one stands.

    Items and documents without words, or with null text, leak nothing. Rows that repeat an id are rows of their own; a null id
    stays null. Each scan broadcasts at most ITEMS_A_SCAN items and BYTES_A_SCAN bytes of their text (one larger
    item is scanned for alone); a larger benchmark is cut into more scans of all documents. Eager for the benchmark.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    count, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    scans = max(1, -(-count // (ITEMS_A_SCAN // 2)) if count > ITEMS_A_SCAN else 1, -(-size * 2 // BYTES_A_SCAN) if size > BYTES_A_SCAN else 1)
    items = materialise(items.withColumn("scan", F.pmod(F.xxhash64("item_id", "text"), F.lit(scans)).cast("int")), "items")
    schema = "doc_id long, item_id long, similarity double, first_word long, n_words long, distance int"
    found = spark.createDataFrame([], schema)
    for scan in range(scans):
        mine = [(r.item_id, plain_words(r.text)) for r in items.filter(F.col("scan") == scan).orderBy("item_id", "text").collect()]
        mine = [x for x in mine if x[1]]
        for at in range(0, len(mine), ITEMS_A_SCAN):
            found = found.union(texts.mapInArrow(_scan(spark.sparkContext.broadcast(mine[at : at + ITEMS_A_SCAN])), schema))
    return found


def _scan(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _BUILT.get("last")
        if made is None or made[0] != sent.value:
            made = _BUILT["last"] = (sent.value, Index(sent.value))
        index, codes = made[1], WordCodes()
        for b in pieces(batches):
            rows: list[tuple] = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = plain_words(text)
                if words:
                    rows += [(doc_id, *x) for x in index.leaks(words, codes.of(words))]
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                    ["doc_id", "item_id", "similarity", "first_word", "n_words", "distance"],
                )

    return run


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; rows without doc_id stay, columns are unchanged."""
    found = materialise(leaks(docs, benchmark).select("doc_id").distinct(), "leaks")
    return docs.join(found, "doc_id", "left_anti").select(docs.columns)
