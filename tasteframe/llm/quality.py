"""Quality classifier: a sparse ensemble of conjunctive rules taken from tree paths, scored as Spark column expressions."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tasteframe.llm.common import pieces, smallest_hashes
from tasteframe.scratch import materialise

#: Statistics of one text, in the order in which ``text_statistics`` gives them.
STATISTICS = [
    "log_words", "mean_word", "longest_word", "distinct_words", "top_word", "doubled_words", "one_char_words", "odd_words",
    "log_lines", "distinct_lines", "upper", "digits", "punctuation", "enders", "symbols", "other_bytes", "spaces",
    "capital_words", "distinct_pairs", "stretch",
]
#: At most so many labelled rows are learned from: those with the smallest hash of the doc_id.
SAMPLE = 20_000
TREES, DEPTH, LASSO, SEED = 24, 3, 0.0015, 7
_UPPER, _DIGIT = range(65, 91), range(48, 58)
_ENDERS = [ord(c) for c in ".,;:?"]
_PUNCT = [c for c in range(33, 127) if not chr(c).isalnum()]
_SYMBOLS = [c for c in _PUNCT if c not in _ENDERS and chr(c) not in "'\"()-"]


def text_statistics(text: str | None) -> list[float]:
    """The statistics of a whole text; null counts as empty, and an empty text has zeros."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    if not words:
        return [0.0] * len(STATISTICS)
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n, size = len(words), len(raw)
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    lines = raw.split(b"\n")
    pairs = set(zip(words[:-1], words[1:], strict=True))
    odd = sum(not w[-2:].isalnum() and len(w) > 2 and 33 <= w[-2] < 127 and not chr(w[-2]).isalnum() for w in words)
    return [
        math.log1p(n), float(lengths.mean()), float(min(lengths.max(), 200)), len(counts) / n, max(counts.values()) / n,
        sum(a == b for a, b in zip(words[:-1], words[1:], strict=True)) / n, float((lengths == 1).mean()), odd / n,
        math.log1p(len(lines)), len(set(lines)) / len(lines), seen[_UPPER].sum() / size, seen[_DIGIT].sum() / size,
        seen[_PUNCT].sum() / size, seen[_ENDERS].sum() / size, seen[_SYMBOLS].sum() / size, seen[128:].sum() / size,
        (seen[32] + seen[9:14].sum()) / size, sum(w[:1].isupper() for w in words) / n, len(pairs) / max(1, n - 1),
        math.log1p(n / len(lines)),
    ]


def with_statistics(docs: DataFrame, name: str = "_statistics") -> DataFrame:
    """``docs`` with an array of the statistics of ``text`` as the column ``name``."""
    schema = T.StructType([*docs.drop(name).schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))])
    docs = docs.drop(name)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            stats = pa.array([text_statistics(t) for t in b.column(at).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*b.columns, stats], [*b.schema.names, name])

    return docs.mapInArrow(run, schema)


@dataclass(frozen=True)
class Rule:
    """A conjunction of bounds: (index of the statistic, whether it must be at most the bound, bound)."""

    bounds: tuple[tuple[int, bool, float], ...]

    def column(self, stats: str) -> Column:
        test = F.lit(True)
        for at, below, bound in self.bounds:
            x = F.col(stats)[at]
            test = test & ((x <= bound) if below else (x > bound))
        return test

    def __str__(self) -> str:
        return " and ".join(f"{STATISTICS[a]} {'<=' if b else '>'} {x:.6g}" for a, b, x in self.bounds)


@dataclass(frozen=True)
class RuleModel:
    """Log-odds: the intercept plus the weights of the rules that hold."""

    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self, stats: str) -> Column:
        total = F.lit(float(self.intercept))
        for rule, weight in self.weights:
            total = total + F.when(rule.column(stats), F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _paths(tree) -> list[Rule]:
    """Every path from the root to a node below it, as a rule; bounds on one statistic are merged."""
    found: list[Rule] = []

    def walk(node, bounds: tuple) -> None:
        if bounds:
            upper: dict[tuple[int, bool], float] = {}
            for at, below, x in bounds:
                upper[at, below] = (min if below else max)(x, upper.get((at, below), x))
            found.append(Rule(tuple(sorted((a, b, x) for (a, b), x in upper.items()))))
        if node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            at, x = split.featureIndex(), split.threshold()
            walk(node.leftChild(), (*bounds, (at, True, x)))
            walk(node.rightChild(), (*bounds, (at, False, x)))

    walk(tree._call_java("rootNode"), ())
    return found


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> RuleModel:
    """Learn from rows of ``docs`` with a label: forest paths become rules, a lasso logistic regression weighs them.

    ``labels``: doc_id, quality (0/1; nulls are left out, repeated labels of one document are averaged and rounded).
    Held-out documents (crc32 of the doc_id as text, modulo 5, is 0) are never used. Learns from at most ``sample`` rows with different (doc_id, text).
    Without labelled rows the score is 1/2, with one class only it is the class's smoothed rate. Eager.
    """
    spark = docs.sparkSession
    rated = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y"))
        .dropna().filter(~held_out("doc_id")).groupBy("doc_id").agg(F.round(F.avg("y")).alias("y"))
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = materialise(rows.select("doc_id").distinct().join(rated, "doc_id"), "rated")
    chosen = materialise(smallest_hashes(chosen, sample, "doc_id"), "chosen")
    # an id can have many rows: equal texts count once, and of different ones those with the smallest hash fill up the sample
    chosen = materialise(rows.select("doc_id").join(chosen, "doc_id").groupBy("doc_id").agg(F.first("y").alias("y"), F.count("*").alias("rows")), "rows-of-chosen")
    once = rows.join(chosen.filter("rows = 1"), "doc_id").select("doc_id", "y", "text")
    left = sample - chosen.filter("rows = 1").count()
    many = rows.withColumn("of_text", F.xxhash64("text")).join(chosen.filter("rows > 1"), "doc_id")
    picked = materialise(many.select("doc_id", "of_text").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "of_text").limit(left), "picked")
    many = many.join(picked, ["doc_id", "of_text"]).groupBy("doc_id", "of_text").agg(F.first("y").alias("y"), F.first("text").alias("text"))
    train = with_statistics(once.unionByName(many.select("doc_id", "y", "text")), "stats").select("doc_id", "y", "stats")
    # the sample is small: one sorted partition makes the draws of the forest, and so the model, the same in every run
    train = materialise(train, "training").coalesce(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "y", "stats")
    n, good = train.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    if not n or good in (0, n):
        rate = (good + 1) / (n + 2)
        return RuleModel(math.log(rate / (1 - rate)), ())
    data = train.select(F.col("y").alias("label"), array_to_vector("stats").alias("features"), "stats").cache()
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, maxBins=64, minInstancesPerNode=max(2, n // 500), seed=SEED, subsamplingRate=0.7, featureSubsetStrategy="onethird"
    ).fit(data.select("label", "features"))
    rules = list(dict.fromkeys(r for t in forest.trees for r in _paths(t)))
    held = F.array(*[r.column("stats").cast("double") for r in rules])
    lasso = LogisticRegression(regParam=LASSO, elasticNetParam=1.0, maxIter=100, standardization=True)
    model = lasso.fit(data.select("label", array_to_vector(held).alias("features")))
    data.unpersist()
    weights = model.coefficients.toArray()
    return RuleModel(float(model.intercept), tuple((r, float(w)) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-9))


def held_out(doc_id: str, parts: int = 5) -> Column:
    """Whether crc32 of the id as text leaves no remainder; false without id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == 0, F.lit(False))


def score(docs: DataFrame, model: RuleModel, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted), a row per row; empty and null texts get the score of zeros as statistics."""
    rows = with_statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    rows = rows.select("doc_id", held_out("doc_id").alias("held_out"), model.score("_statistics").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` without those whose score lies below the threshold; columns are unchanged."""
    name = "_statistics_of_text"
    return with_statistics(docs, name).filter(fit(docs, labels).score(name) >= threshold).drop(name)
