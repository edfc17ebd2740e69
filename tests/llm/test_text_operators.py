"""Licence scan, language model, quality rules, mixing and near duplicates on messy documents, against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tasteframe.llm import common, decontaminate, language_model, licenses, mixing, near_dedup, quality
from tests.llm.conftest import DOCS, rows_of

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def oracle(df, sql: str, table: str = "documents") -> tuple[list[tuple], list[str]]:
    con = duckdb.connect()
    con.register(table, df.toArrow())
    return con.execute(sql).fetchall(), [c[0] for c in con.description]


def same(df, rows, names):
    def key(r):
        return [("" if x is None else f"{x:.9g}" if isinstance(x, float) else str(x)) for x in r]

    assert sorted(map(key, df.select(names).collect())) == sorted(map(key, rows))


def test_words_split_on_ascii_only():
    text = "A b C d\x0be É"
    assert [w.decode() for w in common.blank_words(text)] == BLANK.findall(lowered(text))
    assert [w.decode() for w in common.plain_words("Ab-c é9_ü—x\x7fy")] == ["ab", "c", "é9", "ü—x", "y"]
    assert common.blank_words(None) == [] == common.plain_words(None)


# near duplicates


def brute_components(texts: dict, percent: int) -> tuple[dict, dict]:
    sets = {}
    for i, t in texts.items():
        w = BLANK.findall(lowered(t))
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


@pytest.mark.parametrize(("percent", "block"), [(85, 2048), (85, 4), (60, 4)])
def test_near_duplicates_match_brute_force(messy, texts, monkeypatch, percent, block):
    monkeypatch.setattr(near_dedup, "BLOCK_SETS", block)
    want, sizes = brute_components(texts, percent)
    rows = near_dedup.near_duplicates(messy, percent / 100).collect()
    assert len(rows) == len(texts) + 4
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.n_shingles, r.kept) == (want[r.doc_id], sizes[r.doc_id], want[r.doc_id] == r.doc_id)


def test_keep_one_keeps_columns_and_clean_documents(messy, texts):
    want, _ = brute_components(texts, 80)
    kept = near_dedup.keep_one(messy, 0.8)
    assert kept.columns == messy.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted(i for i in texts if want[i] == i)
    assert ids.count(None) == 2


def test_an_id_with_several_texts_is_one_node(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    rows = [(3, b), (5, a), (5, b), (5, ""), (5, None), (7, a), (8, d), (9, c), (9, d), (10, c + " more"), (11, ""), (12, "one of its own"), (12, "and another")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    root = {3: 3, 5: 3, 7: 3, 8: 8, 9: 8, 10: 8, 11: 11, 12: 12}
    got = near_dedup.near_duplicates(docs).collect()
    assert len(got) == len(rows) and all((r.component_id, r.kept) == (root[r.doc_id], root[r.doc_id] == r.doc_id) for r in got)
    assert sorted(r.doc_id for r in near_dedup.keep_one(docs).collect()) == [3, 8, 11, 12]


def test_columns_with_the_names_of_helpers(spark):
    """Stages of the pipeline on columns that are named like their own, maps among them, and repeated ids."""
    docs = spark.createDataFrame([(i % 4, f"text number {i // 2} of some words", "s", 1, 2, 3, 4, {"a": i}) for i in range(10)], "doc_id long, text string, source string, _rows_of_id int, _ROW int, "
                                 "_plan_of_source int, _hash_of_id int, m map<string,int>")  # fmt: skip
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 2]
    mixed = mixing.mixed_documents(docs.withColumn("copies", F.lit("x")))
    assert mixed.columns == [*docs.columns, "copies", "target_words"] and mixed.count() <= 10


def test_near_duplicates_of_nothing(no_docs):
    assert near_dedup.near_duplicates(no_docs).collect() == []
    assert near_dedup.keep_one(no_docs).collect() == []


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 900).astype(np.uint64)
    a, b = np.unique(x[:700]), np.unique(x[200:])
    ra, rb, both = near_dedup.sketch([a, b, np.unique(x)], 400)
    assert (np.maximum(ra, rb) == both).all()
    estimate, possible = near_dedup.likely(float(len(a)), np.array([float(len(b))]), ra, rb[None], 0.5)
    assert abs(estimate[0] - 500 / 900) < 0.1 and possible[0]
    assert not near_dedup.likely(float(len(a)), np.array([float(len(b))]), ra, rb[None], 0.95)[1][0]


def test_components_of_chains_and_stars(spark):
    edges = [(i + 1, i) for i in range(100, 160)] + [(7, i) for i in range(300, 340)] + [(5, 5), (None, 4), (1000, 900), (900, 1000)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {i: 100 for i in range(100, 161)} | {7: 7} | {i: 7 for i in range(300, 340)} | {1000: 900, 900: 900}


# licences


def test_licences_match_sql(messy, spark):
    more = {
        100: "Under the MIT License or the MIT\nlicense. Apache-License! GENERAL PUBLIC LICENSE",
        101: licenses.NOTICES[4][1] + " tail", 102: licenses.NOTICES[7][1].replace("software", "thing").upper(), 103: "mit licenses, apache  license",
        104: " ".join(w for w in licenses.NOTICES[10][1].split() if w != "charge"), 105: "general public", 106: "mit mit license license",
    }
    docs = messy.union(spark.createDataFrame(rows_of(more), DOCS))
    got = licenses.scan(docs)
    same(got, *oracle(docs.select("doc_id", "text"), licenses.ORACLE))
    rows = {r.doc_id: r for r in got.collect()}
    assert (rows[100].n_base, rows[100].first_word, rows[100].base_labels) == (4, 2, "apache,gpl,mit")
    assert rows[101].labels == "bsd" and "gpl-notice" in rows[102].labels and rows[103].n_base == 1 and rows[104].labels == ""


def test_licences_of_nothing(no_docs):
    assert licenses.scan(no_docs).collect() == []


def test_postings_are_intersected():
    """Only starts on which posted words agree are compared, and every place with enough weight is among them."""
    rng = random.Random(3)
    index = licenses.Index({w: rng.uniform(0.01, 3) for w in licenses.vocabulary()})
    words = [w.encode() for w in licenses.vocabulary()] + [b"other"] * 20
    compared = suggested = 0
    for _ in range(200):
        text = rng.choices(words, k=60)
        for t in rng.sample(index.templates, 2):
            at = rng.randint(0, 60)
            text[at:at] = [w if rng.random() < 0.93 else b"other" for w in t.words]
        starts = set(index.starts(text))
        single = {(n, i - o) for i, w in enumerate(text) for n, o, _ in index.postings.get(w, ())}
        assert starts <= single
        compared, suggested = compared + len(starts), suggested + len(single)
        for n, t in enumerate(index.templates):
            for p in range(len(text) - len(t.words) + 1):
                if sum(x for x, v, w in zip(t.weight, t.words, text[p:], strict=False) if v == w) >= t.least:
                    assert (n, p) in starts
    assert compared < 0.3 * suggested


# mixing


def brute_targets(sizes: list[tuple]) -> dict:
    order = sorted(sizes, key=lambda s: (s[0] is None, (s[0] or "").encode()))
    weight = {s: i % 3 + 1 for i, (s, _) in enumerate(order)}
    size, target, free, left = dict(sizes), {}, {s for s, _ in sizes}, float(sum(n for _, n in sizes))
    while True:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 3 * size[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = 3.0 * size[s]
            left -= target[s]
        free -= over


def test_mixing_targets_and_budgets(messy):
    rows = mixing.mix(messy).collect()
    docs = messy.select("doc_id", "text", "source").collect()
    assert len(rows) == len(docs)
    sizes = Counter()
    for d in docs:
        sizes[d.source] += len(BLANK.findall(d.text or ""))
    want = brute_targets(list(sizes.items()))
    by_target = {round(t, 6) for t in want.values()}
    assert {round(r.target, 6) for r in rows} == by_target and all(0 <= r.taken <= 3 * r.size for r in rows)
    same(mixing.mix(messy), *oracle(messy.select("doc_id", "text", "source"), mixing.ORACLE))
    copies = mixing.mixed_documents(messy)
    assert copies.columns == [*messy.columns, "copies", "target_words"]
    taken = sum(len(BLANK.findall(r.text or "")) * r.copies for r in copies.collect())
    assert taken == sum(r.taken for r in rows)


def test_mixing_comes_near_targets(spark):
    source = [["a", "b", "c", "ß", "Z"][i % 5] if i % 3 else "a" for i in range(6000)]
    docs = spark.createDataFrame([(i, "w " * (i % 50 + 1), s) for i, s in enumerate(source)], "doc_id long, text string, source string")
    rows = mixing.mix(docs).collect()
    by = {}
    for r in rows:
        by.setdefault((source[r.doc_id], r.target), []).append(r.taken)
    assert len(by) == 5 and all(abs(sum(v) - t) <= 50 for (_, t), v in by.items())
    assert sum(sum(v) for v in by.values()) == pytest.approx(sum(r.size for r in rows), abs=300)


def test_mixing_nothing_and_empty_texts(no_docs, spark):
    assert mixing.mix(no_docs).collect() == []
    empty = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mixing.mix(empty).collect()] == [(0, 0.0, 0)] * 2


# quality


def test_quality_learns_rules_and_scores_every_row(messy, spark, texts):
    junk = {1000 + i: " ".join(["buy", "now!!"] * (20 + i)) for i in range(60)}
    docs = messy.union(spark.createDataFrame(rows_of(junk), DOCS))
    labels = [(i, 1, 0) for i in texts if i < 75] + [(i, 0, 0) for i in junk] + [(None, 1, 0), (3, None, 1), (5000, 0, 0), (1001, 0, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    assert quality.fit(docs.repartition(5, "text"), labels.repartition(3)) == model
    assert model.weights and all(0 <= a < len(quality.STATISTICS) for r, _ in model.weights for a, _, _ in r.bounds)
    rows = quality.score(docs, model).collect()
    assert len(rows) == len(texts) + 4 + 60 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in junk or r.held_out and r.doc_id < 75]
    assert sum(r.predicted == int(r.doc_id < 75) for r in held) >= 0.95 * len(held)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.filter("doc_id >= 1000").count() <= 3


def test_quality_scores_are_the_rules(messy, spark, texts, monkeypatch):
    """The score by plain Python from the rules; equal rows and texts of one id are bounded by the sample."""
    labels = spark.createDataFrame([(i, int(i % 2 == 0 or i > 60)) for i in texts if i is not None], "doc_id long, quality int")
    seen = []
    inner = quality.with_statistics
    monkeypatch.setattr(quality, "with_statistics", lambda d, name="_statistics": (seen.append(d.count()) if name == "stats" else None, inner(d, name))[1])
    many = messy.select("doc_id", "text").unionByName(spark.range(200).selectExpr("2L as doc_id", "concat('text ', id % 90) as text"))
    model = quality.fit(many, labels, sample=60)
    assert seen == [60]
    for r in quality.score(many, model).join(many, "doc_id").dropDuplicates(["doc_id", "text"]).filter("doc_id <> 2").collect():
        x = quality.text_statistics(r.text)
        total = model.intercept
        for rule, weight in model.weights:
            if all(x[at] <= bound if below else x[at] > bound for at, below, bound in rule.bounds):
                total += weight
        assert abs(r.score - 1 / (1 + math.exp(-total))) < 1e-12 and r.predicted == int(r.score >= 0.3)


@pytest.mark.parametrize(("labels", "score"), [([], 0.5), ([(1, 1)] * 1, 2 / 3), ([(1, 0), (2, 0)], 1 / 4)])
def test_quality_without_two_classes(messy, no_docs, spark, labels, score):
    model = quality.fit(messy, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert {round(r.score, 9) for r in quality.score(messy, model).collect()} == {round(score, 9)}
    assert quality.score(no_docs, model).collect() == []


# language model


def test_language_model_base_is_exact_and_model_is_better(messy, spark):
    rows = {i: r for i, r in enumerate(language_model.score(messy).collect())}
    docs = [(r.doc_id, [*BLANK.findall(lowered(r.text)), None]) for r in messy.collect()]
    train = Counter(w for i, ws in docs if not language_model.held_out(i) for w in ws)
    n, v = sum(train.values()), len(train)

    def key(i, size, known, base):
        return ("" if i is None else str(i), size, known, round(base, 6))

    want = sorted(key(i, len(ws), sum(train[w] > 0 for w in ws), sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for i, ws in docs)
    assert sorted(key(r.doc_id, r.n_tokens, r.n_known, r.base_score) for r in rows.values()) == want
    assert {r.train_tokens for r in rows.values()} == {n}
    assert all(r.score < 0 and r.held_out == language_model.held_out(r.doc_id) for r in rows.values())
    assert sum(r.score for r in rows.values()) > sum(r.base_score for r in rows.values())


def test_language_model_of_nothing(no_docs, spark):
    assert language_model.score(no_docs).collect() == []
    held = next(i for i in range(100) if language_model.held_out(i))
    (row,) = language_model.score(spark.createDataFrame([(held, "never learned")], "doc_id long, text string")).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)


def test_pieces_do_not_change_base_scores(messy, monkeypatch, spark):
    whole = sorted((str(r.doc_id), r.n_known, round(r.base_score, 6)) for r in language_model.score(messy).collect())
    monkeypatch.setattr(language_model, "PIECE", 1)  # has no effect on workers that import the module anew, but must not break
    assert whole == sorted((str(r.doc_id), r.n_known, round(r.base_score, 6)) for r in language_model.score(messy.repartition(7)).collect())


def test_predictive_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    words, contexts = 60, 4
    n = rng.poisson(1.5, (words, contexts)).astype(np.uint64)
    row, context = np.repeat(np.arange(words), contexts), np.tile(np.arange(contexts), words)
    codes = np.arange(words, dtype=np.uint64) + np.uint64(10)
    first = language_model._first(codes, row, context, n.ravel())
    totals = language_model.Totals(int(n.sum()), int((n.sum(1) > 0).sum()), first[0], 0.6, 0.5, (first[1],), (float((n.sum(1) > 0).sum()),))
    for _ in range(language_model.SWEEPS):
        t = language_model._after(totals)(codes, row, context, n.ravel())
        totals = language_model.Totals(totals.tokens, totals.types, totals.customers, 0.6, 0.5, (*totals.tables, t[0]), (*totals.root_tables, t[1, 0]))
    p = language_model.predictive(codes, row, context, n.ravel(), totals).reshape(words, contexts)
    seen = n.sum(1) > 0
    unknown = p[~seen][0] if (~seen).any() else language_model.predictive(np.array([10**6], np.uint64), np.zeros(contexts, int), np.arange(contexts), np.zeros(contexts), totals)
    assert p[seen].sum(0) + unknown == pytest.approx(np.ones(contexts), abs=1e-9)


def exact_mean(n: int, weight: float, d: float) -> float:
    """Mean tables under weight^t S(n, t), by the recursion in scaled numbers."""
    p = np.array([0.0, 1.0])
    for m in range(1, n):
        t = np.arange(len(p) + 1)
        p = np.append(p, 0) * np.maximum(m - t * d, 0) + weight * np.insert(p, 0, 0)
        p = p / p.sum()
    return float((p * np.arange(len(p))).sum())


def test_seating_is_the_posterior():
    """Mean tables for few and for many customers, against the exact law; the judge of a chain that reseats one customer at a time."""
    key = np.random.default_rng(1).integers(0, 2**63, 40_000).astype(np.uint64)
    for n, weight, d in ((2, 0.3, 0.5), (50, 2.0, 0.5), (1000, 0.05, 0.8), (300, 400.0, 0.7), (1024, 30.0, 0.3), (1500, 0.4, 0.6), (3000, 20.0, 0.5), (4000, 3000.0, 0.7), (2000, 90.0, 0.9), (1100, 8.0, 0.2)):
        drawn = language_model.seat(np.full(len(key), float(n)), np.full(len(key), weight), d, key, 0)
        assert drawn.mean() == pytest.approx(exact_mean(n, weight, d), rel=0.03), (n, weight, d)
        assert drawn.min() >= 1 and drawn.max() <= n
    # taking customers out and reseating them one by one ends in the same mean
    rng, sizes, seen = np.random.default_rng(0), [20.0], []
    for step in range(40_000):
        j = rng.choice(len(sizes), p=np.array(sizes) / 20)
        sizes[j] -= 1
        sizes = [x for x in sizes if x]
        p = np.array([*(x - 0.5 for x in sizes), 2.0])
        j = rng.choice(len(p), p=p / p.sum())
        sizes = [*sizes, 1.0] if j == len(sizes) else [x + (i == j) for i, x in enumerate(sizes)]
        seen.append(len(sizes))
    assert np.mean(seen[2000:]) == pytest.approx(exact_mean(20, 2.0, 0.5), rel=0.03)
    assert language_model.seat(np.array([0.0, 1.0, 1e6]), np.ones(3), 0.5, key[:3], 0)[:2].tolist() == [0, 1]


def test_score_is_that_of_word_contexts(messy):
    """Pairs of neighbouring words counted with dictionaries, one model over all of them, summed up per text."""
    codes = common.WordCodes()
    docs = [(r.doc_id, [*map(codes.__getitem__, common.blank_words(r.text)), language_model.END]) for r in messy.collect()]

    def pairs(ws):
        return [(w, 1 + p % 65535 if p is not None else 0) for p, w in zip([None, *ws[:-1]], ws, strict=True)]

    n = Counter({p: 0 for _, ws in docs for p in pairs(ws)})
    n.update(p for i, ws in docs if not language_model.held_out(i) for p in pairs(ws))
    keys = sorted(n)
    words = sorted({w for w, _ in keys})
    at = {w: j for j, w in enumerate(words)}
    model = np.array(words, np.uint64), np.array([at[w] for w, _ in keys]), np.array([c for _, c in keys]), np.array([n[k] for k in keys], np.uint64)
    first = language_model._first(*model)
    d, d0 = (language_model._discount(*x) for x in ((first[2].sum(), first[3].sum()), first[4, 1:3]))
    totals = language_model.Totals(int(first[0].sum()), int(first[4, 0]), first[0], d, d0, (first[1],), (first[4, 0],))
    for _ in range(language_model.SWEEPS):
        t = language_model._after(totals)(*model)
        totals = language_model.Totals(totals.tokens, totals.types, first[0], d, d0, (*totals.tables, t[0]), (*totals.root_tables, t[1, 0]))
    logp = dict(zip(keys, np.log10(language_model.predictive(*model, totals)), strict=True))
    want = sorted((str(i), len(ws), sum(logp[p] for p in pairs(ws))) for i, ws in docs)
    got = sorted((str(r.doc_id), r.n_tokens, r.score) for r in language_model.score(messy).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], rel=1e-5)


def test_scores_do_not_depend_on_the_session(spark, messy):
    """Buckets follow the shuffle partitions, seats do not."""
    was, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    for n in ("3", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(sorted((str(r.doc_id), r.n_tokens, round(r.score, 6)) for r in language_model.score(messy).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", was)
    assert found[0] == found[1]


# decontamination


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string, doc_id long")


def test_leaks_are_found_and_clean_documents_left(messy, spark, texts, monkeypatch):
    passage = texts[20].split()[:18]
    items = [(1, " ".join(passage), 5), (2, "Quite another item that no text here has at all, not even a part.", 6), (3, "zq xv wq", 7), (4, "", 8), (5, None, 9), (None, "item without id stands here in full", 1),
             (6, " ".join(texts[85].split()[30_000:30_040]), 1)]
    more = {200: "start of it. " + " ".join(passage).upper().replace(" ", ", ") + " and more words", 201: "a zq-XV wq b", 202: "x item without id, stands here in full y",
            203: " ".join([*passage[:9], "new", *passage[10:]]), 204: " ".join(passage[:-1])}
    docs = messy.union(spark.createDataFrame(rows_of(more), DOCS))
    want = {(20, 1), (200, 1), (201, 3), (202, None), (204, 1), (85, 6)}
    for most in (400, 2):
        monkeypatch.setattr(decontaminate, "ITEMS_A_SCAN", most)
        rows = decontaminate.leaks(docs, bench(spark, items)).collect()
        assert {(r.doc_id, r.item_id) for r in rows} == want
    found = {(r.doc_id, r.item_id): r for r in rows}
    assert (found[200, 1].similarity, found[200, 1].first_word, found[200, 1].n_words) == (1.0, 3, 18) and 0.8 <= found[204, 1].similarity < 1
    clean = decontaminate.without_leaks(docs, bench(spark, items))
    assert clean.columns == docs.columns
    assert clean.count() == docs.count() - 6


def test_leaks_of_nothing(messy, no_docs, spark):
    assert decontaminate.leaks(messy, bench(spark, [])).collect() == []
    assert decontaminate.leaks(no_docs, bench(spark, [(1, "a b c d e f", 1)])).collect() == []


def test_probing_finds_all_prints_within_the_radius():
    rng = np.random.default_rng(3)
    items = [(i, [str(x).encode() for x in rng.integers(0, 1000, 12)]) for i in range(150)]
    index = decontaminate.Index(items)
    prints = index.prints[rng.integers(0, 150, 80)].copy()
    for i in range(80):
        for b in rng.choice(64, i % 30, replace=False):
            prints[i] ^= np.uint64(1) << np.uint64(b)
    w, i, d = index.within(prints, np.arange(150))
    full = np.bitwise_count(prints[:, None] ^ index.prints)
    assert set(zip(w.tolist(), i.tolist(), strict=True)) == {tuple(x) for x in np.argwhere(full <= decontaminate.RADIUS).tolist()}
