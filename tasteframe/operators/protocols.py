"""Evaluation protocols (split, leave-one-out, full) with a registry of their metrics.

* ``split``: predictions for a held-out share of the ratings; a metric is a function of the predictions.
* ``loo``: one rating per user is held out; a metric is a function of the place of that item among the items the user has not rated.
* ``full``: trained on everything; a metric is a function of each user's n best unseen items.

Models whose estimate is a dot product are ranked in blocks (``blocks``); others list users x items.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.functions import scalars as S
from tasteframe.operators import baselines, blocks, catalogue, evaluate, ranking, stats
from tasteframe.scratch import materialise

Predict = Callable[[DataFrame, DataFrame], DataFrame]
MakeSource = Callable[[DataFrame, DataFrame, DataFrame], blocks.Source]
KINDS = ("split", "loo", "full")


@dataclass(frozen=True)
class Candidate:
    """A model to evaluate: ``predict(train, targets)`` gives est; ``source(train, users, items)``, if it is one dot product, its vectors."""

    predict: Predict
    source: MakeSource | None = None


@dataclass(frozen=True)
class Context:
    """What metrics may need besides their rows."""

    items: DataFrame
    ratings: DataFrame
    n: int


METRICS: dict[str, dict[str, Callable[[DataFrame, Context], DataFrame]]] = {kind: {} for kind in KINDS}


def metric(kind: str, name: str):
    """Register ``fn(rows, context)``, which returns a row with a single number, as a metric of a protocol."""
    if kind not in KINDS:
        raise ValueError(f"no protocol {kind}: {', '.join(KINDS)}")

    def register(fn: Callable[[DataFrame, Context], DataFrame]):
        if any(name in of_kind for of_kind in METRICS.values()):
            raise ValueError(f"metric {name} exists")
        METRICS[kind][name] = fn
        return fn

    return register


for _name in ("rmse", "mae", "mse"):
    metric("split", _name)(lambda rows, context, name=_name: evaluate.errors(rows).select(name))
metric("split", "fcp")(lambda rows, context: evaluate.fcp(rows))
metric("split", "ndcg")(lambda rows, context: evaluate.ndcg_at_k(rows, k=context.n))
metric("full", "diversity")(lambda rows, context: evaluate.intra_list_diversity(rows, context.items))
metric("full", "novelty")(lambda rows, context: evaluate.novelty_log2(rows, stats.item_popularity(context.ratings)))


@metric("loo", "hit_rate")
def _(rows: DataFrame, context: Context) -> DataFrame:
    """Share of users whose held-out item is among their n best."""
    return rows.agg(F.coalesce(F.avg(F.coalesce((F.col("rank") <= context.n).cast("int"), F.lit(0))), F.lit(0.0)))


@metric("loo", "reciprocal_rank")
def _(rows: DataFrame, context: Context) -> DataFrame:
    return rows.agg(F.coalesce(F.avg(F.coalesce(1 / F.col("rank"), F.lit(0.0))), F.lit(0.0)))


@metric("full", "novelty_rank")
def _(rows: DataFrame, context: Context) -> DataFrame:
    return evaluate.novelty_rank(rows, ranking.popularity_rank(context.ratings))


def item_mean_source(train: DataFrame, users: DataFrame, items: DataFrame) -> blocks.Source:
    """``baselines.predict_item_mean``: a user's vector is 1, an item's its mean."""
    means = train.groupBy(C.ITEM).agg(F.array(F.avg(C.RATING)).alias("vec"))
    return blocks.Source(users.select(C.USER, F.array(F.lit(1.0)).alias("vec")), means, 1.0, stats.global_mean(train).first()[0])


BIAS = Candidate(baselines.predict_bias, blocks.bias_source)
ITEM_MEAN = Candidate(baselines.predict_item_mean, item_mean_source)


def _unseen_estimates(model: Candidate, train: DataFrame) -> DataFrame:
    """Estimates of all unseen pairs: users x items rows, for models that are no dot product."""
    pairs = catalogue.anti_testset(train, train.select(C.USER).distinct()).select(C.USER, C.ITEM)
    est = F.floor(F.col("est") * 1e9 + 0.5) / 1e9
    return model.predict(train, pairs).select(C.USER, C.ITEM, est.alias("est"))


def held_out_ranks(model: Candidate, train: DataFrame, held: DataFrame) -> DataFrame:
    """(userId, movieId, rank) of each held-out row: its place among the items that train rates and the user has not rated there.

    Null for users without other ratings and items without other raters. Eager.
    """
    users, items = train.select(C.USER).distinct(), train.select(C.ITEM).distinct()
    if model.source:
        ranks = blocks.rank_of(users, items, train, held, model.source(train, users, items))
    else:
        est = _unseen_estimates(model, train)
        place = F.row_number().over(W.partitionBy(C.USER).orderBy(F.col("est").desc(), C.ITEM))
        ranks = est.withColumn("rank", place).join(held.select(C.USER, C.ITEM), [C.USER, C.ITEM], "semi").select(C.USER, C.ITEM, "rank")
    return held.select(C.USER, C.ITEM).join(ranks, [C.USER, C.ITEM], "left")


def full_lists(model: Candidate, ratings: DataFrame, n: int) -> DataFrame:
    """(userId, movieId, est, rank): the n best unseen items of every user, trained on all ratings. Eager."""
    users, items = ratings.select(C.USER).distinct(), ratings.select(C.ITEM).distinct()
    if model.source:
        return blocks.best_unseen(users, items, ratings, [model.source(ratings, users, items)], n)
    return ranking.top_n_per_user(_unseen_estimates(model, ratings), n)


def evaluation_report(
    models: dict[str, Candidate], ratings: DataFrame, items: DataFrame, *, metrics: dict[str, Sequence[str]] | None = None,
    n: int = C.TOP_N, share: float = 0.20, seed: int = 1, held_seed: int = 0, digits: int = 4,
) -> DataFrame:
    """A row per model with a column per metric.

    ``metrics``: names by protocol (default: all that are registered); a protocol without names is not run. Every protocol's rows are
    written once, so that a metric reads a short plan. Eager.
    """
    wanted = metrics if metrics is not None else {kind: list(of_kind) for kind, of_kind in METRICS.items()}
    for kind, names in wanted.items():
        if unknown := [x for x in names if x not in METRICS.get(kind, {})]:
            raise ValueError(f"unknown metrics of {kind}: {', '.join(unknown)}")
    ratings = materialise(ratings.select(C.USER, C.ITEM, C.RATING), "ratings")
    context = Context(items, ratings, n)
    parts = {}
    if wanted.get("split"):
        parts["split"] = [materialise(x, "split") for x in evaluate.split_train_test(ratings, share=share, seed=seed)]
    if wanted.get("loo"):
        parts["loo"] = [materialise(x, "held") for x in evaluate.leave_one_out(ratings, seed=held_seed)]
    report = None
    for name, model in models.items():
        rows = {}
        if "split" in parts:
            train, test = parts["split"]
            est = model.predict(train, test.select(C.USER, C.ITEM)).select(C.USER, C.ITEM, "est")
            rows["split"] = est.join(test, [C.USER, C.ITEM])
        if "loo" in parts:
            rows["loo"] = held_out_ranks(model, *parts["loo"])
        if wanted.get("full"):
            rows["full"] = full_lists(model, ratings, n)
        row = ratings.sparkSession.range(1).select(F.lit(name).alias("model"))
        for kind, found in rows.items():
            found = materialise(found, f"{kind}-{name}")
            for x in wanted[kind]:
                row = row.withColumn(x, S.fixed_round(METRICS[kind][x](found, context).scalar(), digits))
        report = row if report is None else report.unionByName(row)
    return report
