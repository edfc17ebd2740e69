"""The Merkle manifest: against its SQL twin, a tree in plain Python, single requests and damaged proofs."""

from __future__ import annotations

import hashlib

import duckdb
from pyspark.sql import functions as F

from tasteframe.llm import merkle
from tasteframe.scratch import materialise

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def twin(docs) -> list:
    con = duckdb.connect()
    con.register("documents", docs.select(*merkle.FIELDS).toArrow())
    return sorted(map(repr, con.execute(merkle.ORACLE).fetchall()))


def got(docs) -> list:
    return sorted(repr(tuple(r)) for r in merkle.verify(docs).select(COLUMNS).collect())


def test_all_cases_equal_the_twin(spark, messy):
    """Null ids and texts, repeated rows, a lang of null, of one row, of nine and of 65 rows, clashing columns."""
    more = [(1000 + i, f"Text {i}", f"lang{(i > 0) + (i > 9)}" if i else None, "s", None) for i in range(75)] + [(7, "Ünïcode É", "é", None, 3), (7, "ANOTHER", "zz", None, 3), (-4, "MINUS", "zz", "q", 3)]
    docs = messy.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string, source string, n_chars long"), allowMissingColumns=True)
    assert got(docs) == twin(docs)


def test_plain_tree(spark):
    docs = spark.createDataFrame([(i, f"A text {i}", "en", None, 8) for i in range(9)], "doc_id long, text string, lang string, source string, n_chars long")
    leaves = [h(f"1:{i}", "-", "2:en", "1:8", f"8:A text {i}") for i in range(9)]
    first, second = h(*leaves[:8]), h(leaves[8])
    rows = {r.doc_id: r for r in merkle.verify(docs).collect()}
    assert {r.root for r in rows.values()} == {h(first, second)} == {r.subroot for r in rows.values()}
    assert [rows[i].leaf for i in range(9)] == leaves
    assert rows[8].proof_sha256 == h(first) and rows[3].proof_sha256 == h(*leaves[:3], *leaves[4:8], second)
    import zlib

    assert {i for i, r in rows.items() if not r.verified} == {i for i in range(9) if zlib.crc32(str(i).encode()) % 3 == 0}


def test_one_row_and_no_rows(spark, no_docs):
    one = spark.createDataFrame([(5, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    leaf = h("1:5", "-", "-", "-", "-")
    assert [tuple(r) for r in merkle.verify(one).collect()] == [(5, leaf, leaf, leaf, h(), leaf, True)]
    assert merkle.verify(no_docs).select(COLUMNS).collect() == []


def test_a_few_requests_walk_only_their_branches(spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "en").otherwise("de").alias("lang"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    m = merkle.build(materialise(docs, "digests"))
    wanted = spark.createDataFrame([(0,), (3,), (599,), (4000,)], "doc_id long")
    rows = {r.doc_id: r for r in merkle.proofs(m, wanted).collect()}
    full = {r.doc_id: r for r in merkle.proofs(m).collect()}
    assert rows.keys() == {0, 3, 599} and len(full) == 600 and all(rows[i] == full[i] for i in rows)
    for r in full.values():
        acc = r.digest
        for s in r.path:
            acc = h(*s.before, acc, *s.after)
        assert acc == m.root
    store = {r.digest: r.children for r in m.store().collect()}
    assert all(h(*c) == d for d, c in store.items()) and m.root in store
    damaged = merkle.proofs(m).withColumn("path", F.expr("transform(path, (s, i) -> if(i = 1, named_struct('before', s.after, 'after', s.before), s))"))
    assert damaged.filter(merkle.folded(F.col("digest"), F.col("path")) == m.root).count() < 600
