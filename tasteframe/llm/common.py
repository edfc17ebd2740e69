"""Helpers shared by the operators: words, hashes, groups inside sorted partitions, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteframe.scratch import materialise

U64 = np.uint64
#: Stands behind the words of a text that has fewer words than a shingle.
PAD = U64(0x9E3779B97F4A7C15)


def blank_words(text: str | None) -> list[bytes]:
    """Runs of characters that are not ASCII white space, A-Z lower-cased (bytes.lower and bytes.split are ASCII-only)."""
    return (text or "").encode("utf-8", "replace").lower().split()


class WordCodes(dict):
    """64-bit code of a word; forgets all when it holds ``most`` words, so its memory is bounded."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), U64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over the output."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
        return x ^ (x >> U64(32))


def shingles(codes: np.ndarray, k: int) -> np.ndarray:
    """Codes of all runs of k words; fewer words: the padded sequence as one; none: empty."""
    if not len(codes):
        return np.zeros(0, U64)
    if len(codes) < k:
        codes = np.concatenate([codes, np.full(k - len(codes), PAD, U64)])
    n = len(codes) - k + 1
    with np.errstate(over="ignore"):
        h = np.zeros(n, U64)
        for j in range(k):
            h = (h + codes[j : j + n]) * U64(0x9FB21C651E98DF25 + 2 * j) ^ (h >> U64(29))
    return mix(h)


def pieces(batches: Iterable[pa.RecordBatch], most_bytes: int = 8 << 20, most_rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that one piece holds some megabytes; a single larger row stays whole."""
    for batch in batches:
        rows = max(1, min(most_rows, int(batch.num_rows * most_bytes / max(1, batch.nbytes))))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def fresh_name(columns: Iterable[str], name: str) -> str:
    """``name``, with as many underscores in front as no column has; Spark compares names without case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def smallest_hashes(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The n rows with the smallest hash of the first key, in that order (ties by the other keys).

    A first cut by a hash that about n rows lie below, and some to be safe, leaves a bounded number of rows to sort, so that
    tasks do not send n rows each to a single one. Equal keys share a hash: give the rows distinct keys. Eager: counts.
    """
    h = F.xxhash64(keys[0])
    share = min(1.0, (n + 8 * n**0.5 + 50) / max(1, df.count()))
    return df.filter(h <= min(2**63 - 1, int(2**64 * share) - 2**63)).orderBy(h, *keys).limit(n)


def by_group(
    df: DataFrame, key: str, fn: Callable[[dict[str, np.ndarray]], pd.DataFrame | None], schema: str, flush: int = 20_000
) -> DataFrame:
    """``fn`` on each group of ``key`` (a bounded group: the caller blocks larger ones), as columns of one dict.

    A shuffle by key, a sort inside the partitions and one pass over Arrow batches; for very many small groups
    this costs far less than a call through the grouped interface.
    """
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[pd.DataFrame] = []
        open_parts: list[pa.Table] = []

        def group() -> None:
            t = pa.concat_tables(open_parts)
            open_parts.clear()
            made = fn({n: t.column(n).to_numpy() for n in names})
            if made is not None and len(made):
                out.append(made)

        def emit() -> Iterator[pa.RecordBatch]:
            yield from pa.Table.from_pandas(pd.concat(out), preserve_index=False).to_batches()
            out.clear()

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(names.index(key)).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if open_parts and keys[a] != last:
                    group()
                    if sum(map(len, out)) >= flush:
                        yield from emit()
                last = keys[a]
                open_parts.append(pa.Table.from_batches([batch.slice(a, b - a)]))
        if open_parts:
            group()
        if out:
            yield from emit()

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, F.col(key)).sortWithinPartitions(key).mapInArrow(run, schema)


def components(edges: DataFrame, a: str, b: str, most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` reaches, itself included.

    Alternating stars: every node hands its larger neighbours, then its smaller ones, to its smallest neighbour.
    Rounds grow with the logarithm of the longest chain. Each round is written to the shared folder, so lineage
    stays short, and only two numbers per round reach the driver. Nulls and self-loops link nothing.
    """
    e = edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u"))
    e = materialise(e.filter("v is not null and u is not null and v <> u").distinct(), "edges")

    def print_of(t: DataFrame) -> tuple:
        return tuple(t.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "u"))).first())

    was = print_of(e)
    for _ in range(most_rounds):
        if not was[0]:
            break
        both = e.select(F.col("v").alias("x"), F.col("u").alias("y")).union(e.select("u", "v"))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.filter("y > x").join(least, "x").select(F.col("y").alias("v"), F.col("m").alias("u")).distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).filter("v <> u")
        e = materialise(small.union(least).distinct(), "edges")
        now = print_of(e)
        if now == was:
            break
        was = now
    else:
        raise RuntimeError("components did not settle")
    stars = e.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return stars.union(e.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())


_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def plain_words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased."""
    return (text or "").encode("utf-8", "replace").translate(_PLAIN).split()
