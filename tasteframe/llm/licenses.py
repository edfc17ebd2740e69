"""Licence scan with a positional rare-token index over licence notices."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteframe.llm.common import pieces, plain_words

#: The phrases that every scan looks for, with their labels.
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

#: Notices as published with the licences (label, words of the notice, mandatory key phrase).
NOTICES = [
    ("agpl", "gnu affero general public license", "affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("artistic", "distributed under the terms of the artistic license", "artistic license"),
    ("boost", "distributed under the boost software license version 1 0", "boost software license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
            "following conditions are met", "redistribution and use in source and binary forms"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("eclipse", "made available under the terms of the eclipse public license", "eclipse public license"),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
                   "license as published by the free software foundation", "gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     "permission to use copy modify"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                  "documentation files", "permission is hereby granted free of charge"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable",
     "without any express or implied warranty"),
]
#: Share of a notice's weight that must stand at its place; digits of scores.
COVERAGE, DIGITS = 0.8, 6
#: Share of that weight that words without postings may have: what posted words must agree on is the rest.
POSTED = 0.5
#: Added to every weight, so that words of all documents still count.
FLOOR = 0.01


def vocabulary() -> list[str]:
    return sorted({w for text, _ in BASE for w in text.split()} | {w for _, text, _ in NOTICES for w in text.split()})


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    weight: tuple[float, ...]
    key: tuple[int, int]  # the mandatory phrase: from, to
    least: float
    base: bool


def _template(label: str, text: str, key: str, idf: dict[str, float], base: bool) -> Template:
    words, phrase = text.split(), key.split()
    at = next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)
    weight = tuple(idf[w] for w in words)
    return Template(label, tuple(w.encode() for w in words), weight, (at, at + len(phrase)), COVERAGE * sum(weight), base)


class Index:
    """Postings of the rarest words of each template: word to (template, offset, weight).

    A template is posted under its words of highest IDF until words that are not posted weigh less than POSTED of the coverage that
    a place needs. A text's rare words are looked up, and the postings of a template intersected by relative position: the
    weights of the words that agree on a start are added up, and a start is compared word by word, key phrase first, only if
    they and all words that are not posted can reach COVERAGE.
    """

    def __init__(self, idf: dict[str, float]):
        self.templates = [_template(l, t, t, idf, True) for t, l in BASE] + [_template(l, t, k, idf, False) for l, t, k in NOTICES]
        self.postings: dict[bytes, list[tuple[int, int, float]]] = {}
        #: What the posted words of a start must weigh: beyond it the other words cannot make up.
        self.enough: list[float] = []
        for n, t in enumerate(self.templates):
            left, posted = sum(t.weight), set()
            for w in sorted(set(t.words), key=lambda w: (-idf[w.decode()], w)):
                if left < POSTED * t.least:
                    break
                posted.add(w)
                left -= sum(x for x, v in zip(t.weight, t.words, strict=True) if v == w)
            self.enough.append(t.least - left)
            for at, w in enumerate(t.words):
                if w in posted:
                    self.postings.setdefault(w, []).append((n, at, t.weight[at]))

    def starts(self, words: list[bytes]) -> list[tuple[int, int]]:
        """(template, start) whose posted words weigh enough."""
        held: dict[tuple[int, int], float] = {}
        for at, w in enumerate(words):
            for n, offset, weight in self.postings.get(w, ()):
                place = n, at - offset
                held[place] = held.get(place, 0.0) + weight
        return [(n, p) for (n, p), x in held.items() if x >= self.enough[n] - 1e-9 and 0 <= p <= len(words) - len(self.templates[n].words)]

    def scan(self, words: list[bytes]) -> tuple:
        """(places of base phrases, first, last, base labels, labels, score) of a text."""
        base, labels, places, score = set(), set(), [], 0.0
        for n, p in self.starts(words):
            t = self.templates[n]
            here = words[p : p + len(t.words)]
            a, b = t.key
            if tuple(here[a:b]) != t.words[a:b]:
                continue
            held = sum(x for x, v, w in zip(t.weight, t.words, here, strict=True) if v == w)
            if held < t.least:
                continue
            labels.add(t.label)
            score = max(score, held / sum(t.weight))
            if t.base:
                base.add(t.label)
                places.append(p)
        return len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), round(score, DIGITS)


def word_weights(docs: DataFrame) -> dict[str, float]:
    """IDF of each licence word over all documents (null texts count as empty): the vocabulary is fixed, so is the result's size."""
    known = frozenset(w.encode() for w in vocabulary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        rows = 0
        for b in pieces(batches):
            for text in b.column(0).to_pylist():
                rows += 1
                seen.update(known.intersection(plain_words(text)))
        pairs = [("", rows), *((w.decode(), n) for w, n in seen.items())]
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs]), pa.array([p[1] for p in pairs], pa.int64())], ["word", "n"])

    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r.word: r.n for r in counts.collect()}
    n = found.get("", 0)
    return {w: math.log((n + 1) / (found.get(w, 0) + 1)) + FLOOR for w in vocabulary()}


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), a row per row.

    Words are runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased; null texts are empty. ``n_base`` counts
    all places of the BASE phrases, ``first_word`` and ``last_word`` are their smallest and largest start (null: none).
    ``labels`` adds the notices that stand in the text with at least COVERAGE of their IDF weight at the right places and with their whole key
    phrase. ``score`` is the best coverage found, 0 without any. Ids may be null or repeat; other columns are ignored.
    Reads the texts twice; the first pass is eager.
    """
    index = Index(word_weights(docs))
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = plain_words(text)
                rows.append((doc_id, len(words), *index.scan(words)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def _values() -> str:
    rows = [(l, t, 0, len(t.split()), True) for t, l in BASE]
    for label, text, key in NOTICES:
        words, phrase = text.split(), key.split()
        at = next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)
        rows.append((label, text, at, at + len(phrase), False))
    return ", ".join(f"({n}, '{l}', '{t}', {a}, {b}, {str(x).lower()})" for n, (l, t, a, b, x) in enumerate(rows))


ORACLE = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents),
templates AS (SELECT * FROM (VALUES {_values()}) t(n, label, text, a, b, base)),
posted AS (
    SELECT n, label, a, b, base, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) - 1 AS o,
           len(string_split(text, ' ')) AS size
    FROM templates),
spread AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS i FROM docs),
known AS MATERIALIZED (SELECT * FROM spread WHERE word IN (SELECT word FROM posted)),
df AS (SELECT word, count(DISTINCT r) AS df FROM known GROUP BY word),
weighed AS (
    SELECT p.*, ln(((SELECT count(*) FROM docs) + 1) / (coalesce(df, 0) + 1)) + {FLOOR} AS w FROM posted p LEFT JOIN df USING (word)),
whole AS (SELECT n, sum(w) AS whole FROM weighed GROUP BY n),
hits AS (
    SELECT k.r, n, i - o AS p, sum(w) AS held, count(*) FILTER (WHERE o >= a AND o < b) AS in_key, any_value(b - a) AS key,
           any_value(size) AS size, any_value(label) AS label, any_value(base) AS base
    FROM known k JOIN weighed USING (word) GROUP BY k.r, n, i - o),
found AS (
    SELECT h.*, held / whole AS share FROM hits h JOIN whole USING (n) JOIN docs d ON d.r = h.r
    WHERE in_key = key AND p >= 0 AND p + h.size <= len(words) AND held >= {COVERAGE} * whole - 1e-9),
each AS (
    SELECT r, count(*) FILTER (WHERE base) AS n_base, min(p) FILTER (WHERE base) AS first_word, max(p) FILTER (WHERE base) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
           string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
    FROM found GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(round(coalesce(score, 0), {DIGITS}) AS DOUBLE) AS score
FROM docs LEFT JOIN each USING (r)
"""
