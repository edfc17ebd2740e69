"""Spelling variants: words one edit apart, found as squared distances of letter counts by blocked Gram matrices.

Words are held as Latin-1 bytes, a byte per code point; their bytewise order is that of the code points.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteframe.llm.common import by_group, pieces
from tasteframe.scratch import materialise

#: A run whose hash it divides loses a letter; shortest word, fewest occurrences; how much more frequent a form is.
MODULUS, SHORTEST, FEWEST, TIMES = 97, 5, 3, 2
#: Letter groups, of which one edit changes two at most; words of a tile; distinct words that a counting task holds at once.
GROUPS, TILE, HELD = 4, 2048, 300_000
KEYS = list(combinations(range(GROUPS), GROUPS - 2))
#: A-Z lower-cased, a-z and U+00C0 to U+00FF kept, all else white space.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
_U = np.uint64


def runs(text: str | None) -> list[bytes]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z lower-cased, as Latin-1."""
    return (text or "").encode("latin-1", "replace").translate(_LETTERS).split()


def slip(run: bytes, prefix_crc: int) -> bytes:
    """The run, or, where MODULUS divides the CRC-32 of ``<doc_id>:<run>``, the run without the letter that the hash names."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix_crc)
    if h % MODULUS:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(documents: DataFrame) -> DataFrame:
    """(word, n) of the words of at least SHORTEST code points and FEWEST occurrences. A null doc_id counts as empty, a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def emit() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for b in pieces(batches):
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for one, n in Counter(runs(text)).items():
                    word = slip(one, start)
                    if len(word) >= SHORTEST:
                        held[word] += n
            if len(held) > HELD:
                yield emit()
        yield emit()

    parts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "word binary, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= FEWEST)


def letter_groups(words: DataFrame) -> np.ndarray:
    """Group of each letter, so that the groups hold about as many letters of all words: the most frequent first, each to the lightest group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(256, np.int64)
        for b in batches:
            sums += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint8), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(range(256), pa.int32()), pa.array(sums, pa.int64())], ["letter", "n"])

    rows = words.select("word").mapInArrow(run, "letter int, n long").groupBy("letter").agg(F.sum("n").alias("n")).collect()
    groups, load = np.zeros(256, np.int64), [0] * GROUPS
    for letter, n in sorted(rows, key=lambda r: (-r[1], r[0])):
        groups[letter] = least = int(np.argmin(load))
        load[least] += n
    return groups


def letter_counts(words: list[bytes]) -> np.ndarray:
    """A row of 256 letter counts per word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    at = np.repeat(np.arange(len(words)) * 256, lengths) + np.frombuffer(b"".join(words), np.uint8)
    return np.bincount(at, minlength=256 * len(words)).reshape(len(words), 256)


def in_cells(words: DataFrame, groups: np.ndarray) -> DataFrame:
    """(cell, key, word, n): each word under a hash of its letter counts in every choice of groups that an edit can leave unchanged."""
    spread = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64) | _U(1)
    names = ["cell", "key", "word", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            counts = letter_counts(b.column(0).to_pylist()).astype(_U)
            with np.errstate(over="ignore"):
                term = counts * spread
                term ^= term >> _U(31)
                term *= _U(0x9E3779B97F4A7C15)
                of_group = [term[:, groups == g].sum(axis=1, dtype=_U) for g in range(GROUPS)]
                for k, kept in enumerate(KEYS):
                    cell = sum((of_group[g] * _U(2 * g + 3) for g in kept), start=np.full(b.num_rows, k, _U) * _U(0xD6E8FEB86659FD93))
                    cell ^= cell >> _U(29)
                    yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), pa.array(np.full(b.num_rows, k, np.int32)), b.column(0), b.column(1)], names)

    return words.select("word", "n").mapInArrow(run, "cell long, key int, word binary, n long")


def in_tiles(cells: DataFrame) -> DataFrame:
    """(task, key, side, word, n): cells of over TILE words are cut by a hash of the word into tiles, every two of which make a task.

    ``side`` is 0 for the first tile of a task, 1 for the second, 2 for a tile with itself.
    """
    large = cells.groupBy("cell").agg(F.count("*").alias("size")).filter(F.col("size") > TILE)
    large = large.select("cell", F.ceil(F.col("size") / TILE).cast("int").alias("tiles"))
    rows = cells.join(large, "cell", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    task = F.when(F.col("tiles") == 1, F.col("cell")).otherwise(F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other")))
    return rows.select(task.alias("task"), "key", F.when(F.col("own") == F.col("other"), 2).otherwise((F.col("own") > F.col("other")).cast("int")).alias("side"), "word", "n")


def close_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where rows of letter counts are at a squared distance of two or less: |x|^2 + |y|^2 - 2xy as one product."""
    used = np.flatnonzero(a.any(axis=0) | b.any(axis=0))
    kind = np.float32 if max(a.sum(axis=1).max(), b.sum(axis=1).max()) < 1000 else np.float64  # sums of squares stay exact
    a, b = a[:, used].astype(kind), b[:, used].astype(kind)
    left = np.concatenate([2 * a, -(a * a).sum(axis=1, keepdims=True), -np.ones((len(a), 1), kind)], axis=1)
    right = np.concatenate([b, np.ones((len(b), 1), kind), (b * b).sum(axis=1, keepdims=True)], axis=1)
    return np.nonzero(left @ right.T >= -2.5)


def one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether rows of letters differ by exactly one replaced letter (same width) or one inserted (``long`` is a letter wider)."""
    if short.shape[1] == long.shape[1]:
        return (short != long).sum(axis=1) == 1
    differs, shifted = short != long[:, :-1], short != long[:, 1:]
    width = short.shape[1]
    first = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    after_last = np.where(shifted.any(axis=1), width - shifted[:, ::-1].argmax(axis=1), 0)
    return after_last <= first


def _near_in_task(key: int, words: list[bytes], side: np.ndarray, groups: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of near words of a task that belong to this key: its groups are the first choice that the edit leaves unchanged."""
    counts = letter_counts(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    of_group = np.stack([counts[:, groups == g] @ np.ones((groups == g).sum(), np.int64) for g in range(GROUPS)], axis=1)
    blocks = {(int(n), s): np.flatnonzero((lengths == n) & (side == s)) for n in np.unique(lengths) for s in np.unique(side)}
    letters = {k: np.frombuffer(b"".join(words[i] for i in v), np.uint8).reshape(len(v), k[0]) for k, v in blocks.items() if len(v)}
    two = side[0] != 2
    for (n, s), rows in blocks.items():
        if not len(rows):
            continue
        for m, t in [(n, 1 - s), (n + 1, 1 - s)] if two else [(n, 2), (n + 1, 2)]:
            others = blocks.get((m, t), [])
            if not len(others) or two and n == m and s:
                continue
            i, j = close_pairs(counts[rows], counts[others])
            if n == m and not two:
                i, j = i[i < j], j[i < j]
            step = max(1, (4 << 20) // m)
            for at in range(0, len(i), step):
                p, q = i[at : at + step], j[at : at + step]
                ok = one_edit(letters[n, s][p], letters[m, t][q])
                p, q = rows[p[ok]], others[q[ok]]
                if len(p):
                    same = [(counts[p][:, groups == g] == counts[q][:, groups == g]).all(axis=1) for g in range(GROUPS)]
                    first = np.select([np.logical_and.reduce([same[g] for g in kept]) for kept in KEYS], range(len(KEYS)), -1)
                    yield p[first == key], q[first == key]


def near_words(words: DataFrame, groups: np.ndarray) -> DataFrame:
    """(word, n_near, best): how many words of ``words`` (word, n) are one edit away, and the most frequent as struct (minus n, word).

    Letters stand in GROUPS groups. An edit changes the counts of two letters at most, so some GROUPS - 2 groups keep all
    their counts: near words share a cell for one of their choices. In a cell, length by length, Gram matrices of the
    letter counts give the squared distances within a length and between adjacent ones; pairs at two or less are verified letter by
    letter, and counted only under their first choice. What leaves a task is one row per word, not the pairs.
    """

    def task(x: dict[str, np.ndarray]) -> pd.DataFrame | None:
        words, n = x["word"].tolist(), x["n"]
        if len(words) < 2:
            return None
        found = list(_near_in_task(int(x["key"][0]), words, x["side"], groups))
        if not found:
            return None
        i, j = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        i, j = np.concatenate([i, j]), np.concatenate([j, i])
        if not len(i):
            return None
        rank = np.empty(len(words), np.int64)
        rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        order = np.lexsort((rank[j], -n[j], i))
        who, first, count = np.unique(i[order], return_index=True, return_counts=True)
        best = j[order][first]
        return pd.DataFrame({"word": [words[k] for k in who], "n_near": count.astype(np.int64), "best_n": -n[best], "best": [words[k] for k in best]})

    tasks = in_tiles(in_cells(words, groups))
    parts = by_group(tasks, "task", task, "word binary, n_near long, best_n long, best binary")
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("best_n", "best")).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): the end of each chain of forms, by doubling the steps. n doubles at every form, so
    a chain has fewer steps than n has bits, and the rounds are the bits of that number. Eager."""
    now = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        now = materialise(now.join(on, F.col("root") == F.col("_w"), "left").select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")), "roots")
        if not now.filter("moved").limit(1).count():
            return now.drop("moved")
        now = now.drop("moved")


def variants(documents: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words of ``documents`` (doc_id, text). Eager.

    Two words are near if they differ by exactly one inserted, deleted or replaced code point. A word's form is its most frequent near word
    (ties: the smallest) if that is at least TIMES as frequent; its root is the last form of the chain, itself without a form.
    Null and empty texts have no words, a null doc_id hashes as empty, repeated rows count again, words of any length are
    compared; an empty table gives no rows. Other columns are ignored.
    """
    words = materialise(count_words(documents), "words")
    near = near_words(words, letter_groups(words))
    formed = words.join(near.select("word", "n_near", F.col("best.best").alias("best"), (-F.col("best.best_n")).alias("best_n")), "word", "left")
    large = F.col("best_n") >= F.col("n") * TIMES
    formed = formed.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(large, F.col("best")).alias("form"), F.when(large, F.col("best_n")).alias("form_n"))
    formed = materialise(formed, "forms")
    out = formed.join(roots(formed.filter("form is not null")), "word", "left").withColumn("root", F.coalesce("root", "word"))
    return out.select(*[F.decode(c, "ISO-8859-1").alias(c) for c in ("word", "form", "root")], "n", "n_near", "form_n")


#: Words that share all but one letter are joined by what is left; no letter counts.
ORACLE = """
WITH RECURSIVE crc AS (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i::BIGINT, list_transform(range(8), lambda k: 0::BIGINT)),
                              lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
found AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM found GROUP BY ALL),
hashed AS (
    SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT,
        flatten(list_transform(str_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
                               lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195::BIGINT, ord(c)::BIGINT - 64] END))),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h FROM counted, crc),
slipped AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
gaps AS (SELECT word, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
    SELECT x.word, y.word AS other FROM gaps x JOIN gaps y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
    UNION SELECT g.word, w.word FROM gaps g JOIN words w ON w.word = g.a || g.b
    UNION SELECT w.word, g.word FROM gaps g JOIN words w ON w.word = g.a || g.b),
ranked AS (
    SELECT e.word, other, w.n AS other_n, count(*) OVER (PARTITION BY e.word) AS n_near, row_number() OVER (PARTITION BY e.word ORDER BY w.n DESC, other) AS r
    FROM near e JOIN words w ON w.word = other),
formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * w.n THEN other END AS form, CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
    FROM words w LEFT JOIN ranked k ON k.word = w.word AND r = 1),
steps AS (
    SELECT word, word AS at FROM formed
    UNION ALL SELECT s.word, f.form FROM steps s JOIN formed f ON f.word = s.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, s.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN steps s ON s.word = f.word JOIN formed e ON e.word = s.at AND e.form IS NULL
"""
