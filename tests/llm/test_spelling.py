"""Spelling variants: against the SQL twin, plain brute force, and cells cut into tiles."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from tasteframe.llm import spelling
from tests.llm.conftest import DOCS, rows_of

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def twin(docs) -> list:
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toArrow())
    return sorted(map(tuple, con.execute(spelling.ORACLE).fetchall()))


def got(docs) -> list:
    return sorted(tuple(r) for r in spelling.variants(docs).select(COLUMNS).collect())


def edits(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.fixture(scope="module")
def typed(spark):
    """Few letters, so that many words are near each other, anagrams and doubled letters among them; chains of forms."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abÉé") for _ in range(rng.randint(4, 8))) for _ in range(500)]
    chain = ["sparkling"] * 60 + ["sparklin"] * 25 + ["sparkli"] * 9 + ["sparkl"] * 4 + ["Sparks"] * 3 + ["x" * 3000] * 5 + ["x" * 3001] * 12
    texts = {i: " ".join(rng.choices(words, k=30)) + f" don't×stop÷now ÀÉÎ{'õ' * (i % 3)}, " + rng.choice(chain) + "\n" + "日本 " + rng.choice(chain) for i in range(300)}
    texts |= {300: None, 301: "", 302: " ".join(chain)}
    return spark.createDataFrame([*rows_of(texts), (None, "without number sparkling", *[None] * 9), (5, texts[5], *[None] * 9)], DOCS)


def test_equals_the_twin_and_brute_force(typed):
    rows = got(typed)
    assert rows == twin(typed) and len(rows) > 300
    counts: Counter = Counter()
    for doc_id, text in typed.select("doc_id", "text").collect():
        for run in spelling.runs(text):
            run = run.decode("latin-1")
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    counts = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}
    assert {r[0]: r[3] for r in rows} == counts
    form = {}
    for w, f, _, n, n_near, form_n in rows:
        near = [v for v in counts if edits(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        assert n_near == len(near)
        form[w] = best if best and counts[best] >= 2 * n else None
        assert f == form[w] and form_n == (counts[best] if form[w] else None)
    for w, *_, in rows:
        at = w
        while form[at]:
            at = form[at]
        assert dict((r[0], r[2]) for r in rows)[w] == at
    assert max(len({r[0], r[1], r[2]}) for r in rows) == 3


def test_tiles_lose_and_double_nothing(typed, monkeypatch):
    """Every cell is cut; the driver alone plans the tiles."""
    whole = got(typed)
    monkeypatch.setattr(spelling, "TILE", 7)
    assert got(typed) == whole


def test_empty_tables(spark, no_docs):
    assert got(no_docs) == []
    assert got(spark.createDataFrame([(1, None), (2, ""), (3, "1234 5678"), (4, "once upon")], "doc_id long, text string")) == []


def test_squared_distances_and_edits():
    rng = np.random.default_rng(2)
    for n, m in ((6, 6), (6, 7)):
        a, b = rng.integers(97, 101, (300, n)).astype(np.uint8), rng.integers(97, 101, (300, m)).astype(np.uint8)
        x, y = ([bytes(r) for r in t] for t in (a, b))
        cx, cy = spelling.letter_counts(x), spelling.letter_counts(y)
        i, j = spelling.close_pairs(cx, cy)
        assert set(zip(i.tolist(), j.tolist(), strict=True)) == {(p, q) for p in range(300) for q in range(300) if ((cx[p] - cy[q]) ** 2).sum() <= 2}
        assert spelling.one_edit(a[i], b[j]).tolist() == [edits(x[p].decode(), y[q].decode()) for p, q in zip(i, j, strict=True)]
