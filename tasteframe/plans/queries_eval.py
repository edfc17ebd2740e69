"""Queries: baselines, blends, splits and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.functions import scalars as S
from tasteframe.operators import baselines as B
from tasteframe.operators import evaluate as E
from tasteframe.operators import blocks, hybrid, protocols, ranking, stats
from tasteframe.operators import neighbours as N
from tasteframe.plans.queries_models import CLIP, MSD, content_knn_sql, itr_knn_sql, knn_sql, sims_of, v1_arrays
from tasteframe.plans.registry import dec, query, relation
from tasteframe.scratch import materialise

R = S.fixed_round
SEEDED = "CAST('0x' || substr(md5(concat(userId, ' ', movieId, ' {seed}')), 1, 15) AS BIGINT)"

relation("item_means", "SELECT movieId AS mid, avg(rating) AS im FROM train GROUP BY movieId")
relation("bias_i", "SELECT movieId AS mid, (sum(rating) - count(*) * max(g)) / (10 + count(*)) AS bi FROM train, train_gm GROUP BY movieId")
relation("bias_u", "SELECT userId AS uid, (sum(rating - bi) - count(*) * max(g)) / (15 + count(*)) AS bu FROM train JOIN bias_i ON movieId = mid, train_gm GROUP BY userId")
relation("bias_pred", f"""
    SELECT userId, movieId, rating, {CLIP.format('g + coalesce(bu, 0) + coalesce(bi, 0)')} AS est
    FROM test LEFT JOIN bias_i ON movieId = mid LEFT JOIN bias_u ON userId = uid, train_gm""")
# Estimates with few decimals make ties between rows common.
relation("preds", f"SELECT userId, movieId, rating, {dec('est', 2)} AS est FROM bias_pred")

relation("gm_preds", f"SELECT userId, movieId, rating, {dec('g', 6)} AS est FROM test, train_gm")
relation("knn_preds", f"SELECT k.userId, k.movieId, rating, est FROM ({knn_sql(sims_of(MSD, 2), k=3, min_k=2)}) k JOIN (SELECT userId AS tu, movieId AS tm, rating FROM test) q ON k.userId = tu AND k.movieId = tm")


def preds(t):
    """Bias predictions for the test rows, written once: every metric reads them several times."""
    train = materialise(t.train().select(C.USER, C.ITEM, C.RATING), "train")
    p = B.predict_bias(train, t.test().select(C.USER, C.ITEM, C.RATING))
    return materialise(p.select(C.USER, C.ITEM, C.RATING, R("est", 2).alias("est")), "predictions")


def keys(t):
    return t.test().select(C.USER, C.ITEM)


@query("predict_constant", "SELECT userId, movieId, CAST(2 AS DOUBLE) AS est FROM test")
def _(t):
    return B.predict_constant(keys(t))


@query("predict_random_uniform", f"SELECT userId, movieId, {dec('0.5 + ' + SEEDED.format(seed=0) + ' / 1152921504606846976.0 * 4.5', 6)} AS est FROM test")
def _(t):
    return B.predict_random_uniform(keys(t)).withColumn("est", R("est", 6))


@query("predict_random_score")
def _(t):
    return B.predict_random_score(keys(t))


@query("predict_global_mean", f"SELECT userId, movieId, {dec('g', 6)} AS est FROM test, train_gm")
def _(t):
    return B.predict_global_mean(t.train(), keys(t)).withColumn("est", R("est", 6))


@query("predict_random_sample", f"""
    SELECT t.userId, t.movieId, {dec('coalesce(r.rating, g)', 6)} AS est, r.rating IS NULL AS was_impossible
    FROM (SELECT userId, movieId, CAST('0x' || substr(md5(concat(userId, ' ', movieId, ' 0')), 1, 15) AS BIGINT) AS h FROM test) t
    LEFT JOIN (SELECT userId, rating, row_number() OVER (PARTITION BY userId ORDER BY rating) - 1 AS pos, count(*) OVER (PARTITION BY userId) AS n FROM train) r
    ON r.userId = t.userId AND r.pos = t.h % r.n, train_gm""")
def _(t):
    return B.predict_random_sample(t.train(), keys(t)).withColumn("est", R("est", 6))


@query("prediction_fallback", f"""
    SELECT userId, movieId, {dec('CASE WHEN im IS NULL THEN g ELSE greatest(0.5, least(5.0, im)) END', 6)} AS est, im IS NULL AS was_impossible
    FROM test LEFT JOIN (SELECT mid, im FROM item_means) m ON movieId = mid, train_gm""")
def _(t):
    means = t.train().groupBy(C.ITEM).agg(F.avg(C.RATING).alias("est"))
    return B.prediction_fallback(keys(t).join(means, C.ITEM, "left"), t.train()).withColumn("est", R("est", 6))


@query("predict_bias", f"SELECT userId, movieId, rating, {dec('est', 6)} AS est FROM bias_pred")
def _(t):
    return B.predict_bias(t.train(), t.test().select(C.USER, C.ITEM, C.RATING)).withColumn("est", R("est", 6))


@query("split_train_test", f"SELECT userId, movieId, rating, CASE WHEN {SEEDED.format(seed=1)} % 10000 < 2000 THEN 'test' ELSE 'train' END AS part FROM ratings")
def _(t):
    train, test = E.split_train_test(t.ratings().select(C.USER, C.ITEM, C.RATING), share=0.20, seed=1)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


relation("held", f"SELECT userId, movieId FROM (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY {SEEDED.format(seed=0)}, movieId) AS r FROM ratings) x WHERE r = 1")


@query("leave_one_out", """
    SELECT r.userId, r.movieId, rating, CASE WHEN h.userId IS NULL THEN 'train' ELSE 'test' END AS part
    FROM ratings r LEFT JOIN held h ON r.userId = h.userId AND r.movieId = h.movieId""")
def _(t):
    train, held = E.leave_one_out(t.ratings())
    cols = [C.USER, C.ITEM, C.RATING]
    return train.select(*cols, F.lit("train").alias("part")).unionByName(held.select(*cols, F.lit("test").alias("part")))


@query("rmse_mae_mse", f"SELECT {dec('sqrt(avg((rating - est) * (rating - est)))', 6)} AS rmse, {dec('avg(abs(rating - est))', 6)} AS mae, {dec('avg((rating - est) * (rating - est))', 6)} AS mse FROM preds")
def _(t):
    e = E.errors(preds(t))
    return e.select(*[R(c, 6).alias(c) for c in ("rmse", "mae", "mse")])


_FCP = """SELECT a.userId, count(CASE WHEN a.est > b.est THEN 1 END) AS nc, count(CASE WHEN a.est <= b.est THEN 1 END) AS nd
    FROM preds a JOIN preds b ON a.userId = b.userId AND a.rating > b.rating GROUP BY a.userId"""


@query("fcp", f"SELECT {dec('sum(nc) / CAST(sum(nc) + sum(nd) AS DOUBLE)', 6)} AS fcp FROM ({_FCP}) x")
def _(t):
    return E.fcp(preds(t)).withColumn("fcp", R("fcp", 6))


@query("fcp_mean", f"SELECT {dec('avg(nullif(nc, 0)) / (avg(nullif(nc, 0)) + avg(nullif(nd, 0)))', 6)} AS fcp FROM ({_FCP}) x")
def _(t):
    return E.fcp(preds(t), mode="mean").withColumn("fcp", R("fcp", 6))


relation("user_ndcg", """
    SELECT userId, CASE WHEN sum(ideal) > 0 THEN sum(gain) / sum(ideal) ELSE 0 END AS ndcg FROM (
      SELECT userId, CASE WHEN rating >= 4.0 AND rp <= 10 THEN 1 / log2(rp + 1) ELSE 0 END AS gain,
             CASE WHEN rating >= 4.0 AND ri <= 10 THEN 1 / log2(ri + 1) ELSE 0 END AS ideal FROM (
        SELECT *, row_number() OVER (PARTITION BY userId ORDER BY est DESC, movieId) AS rp,
               row_number() OVER (PARTITION BY userId ORDER BY rating DESC, movieId) AS ri FROM preds) x) y GROUP BY userId""")


@query("ndcg_at_k", f"SELECT {dec('avg(ndcg)', 6)} AS ndcg FROM user_ndcg")
def _(t):
    return E.ndcg_at_k(preds(t)).withColumn("ndcg", R("ndcg", 6))


@query("ndcg_per_user", f"SELECT userId, {dec('ndcg', 6)} AS ndcg FROM user_ndcg")
def _(t):
    return E.ndcg_per_user(preds(t)).withColumn("ndcg", R("ndcg", 6))


relation("top10", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY est DESC, movieId) AS rank FROM preds) x WHERE rank <= 10")


@query("top_n_per_user", "SELECT userId, movieId, rating, est, rank FROM top10")
def _(t):
    return ranking.top_n_per_user(preds(t))


@query("top_n_per_user_random_ties", "SELECT userId, est, rank FROM top10")
def _(t):
    return ranking.top_n_per_user(preds(t), ties="random").select(C.USER, "est", "rank")


@query("predicted_rank", "SELECT userId, movieId, rank AS predicted_rank FROM top10")
def _(t):
    return ranking.predicted_rank(preds(t), 10).select(C.USER, C.ITEM, "predicted_rank")


@query("ideal_rank", "SELECT userId, movieId, r AS ideal_rank FROM (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY rating DESC, movieId) AS r FROM preds) x WHERE r <= 10")
def _(t):
    return ranking.ideal_rank(preds(t), 10).select(C.USER, C.ITEM, "ideal_rank")


relation("list_pairs", """
    SELECT a.userId, a.movieId AS item_a, b.movieId AS item_b,
      1 - CAST(len(list_intersect(string_split(i.genres, '|'), string_split(j.genres, '|'))) AS DOUBLE)
        / len(list_distinct(list_concat(string_split(i.genres, '|'), string_split(j.genres, '|')))) AS distance
    FROM top10 a JOIN top10 b ON a.userId = b.userId AND a.rank < b.rank JOIN items i ON i.movieId = a.movieId JOIN items j ON j.movieId = b.movieId""")


@query("intra_list_pairs", f"SELECT userId, item_a, item_b, {dec('distance', 6)} AS distance FROM list_pairs")
def _(t):
    return E.intra_list_pairs(ranking.top_n_per_user(preds(t)), t.items()).withColumn("distance", R("distance", 6))


@query("intra_list_diversity", f"SELECT {dec('avg(d)', 6)} AS diversity FROM (SELECT avg(distance) AS d FROM list_pairs GROUP BY userId) x")
def _(t):
    return E.intra_list_diversity(ranking.top_n_per_user(preds(t)), t.items()).withColumn("diversity", R("diversity", 6))


relation("pops", "SELECT movieId AS mid, CAST(count(*) AS DOUBLE) / (SELECT count(DISTINCT userId) FROM ratings) AS p FROM ratings GROUP BY movieId")


@query("novelty_log2", f"SELECT {dec('avg(s)', 6)} AS novelty FROM (SELECT avg(-log2(coalesce(p, 1e-10))) AS s FROM top10 LEFT JOIN pops ON movieId = mid GROUP BY userId) x")
def _(t):
    top = ranking.top_n_per_user(preds(t))
    return E.novelty_log2(top, stats.item_popularity(t.ratings())).withColumn("novelty", R("novelty", 6))


# The ten best items by the bias model that a user has not rated in the train part.
relation("unseen10", f"""
    SELECT userId, movieId, rank FROM (
      SELECT uid AS userId, mid AS movieId, row_number() OVER (PARTITION BY uid ORDER BY floor({CLIP.format('g + bu + bi')} * 1e9 + 0.5) / 1e9 DESC, mid) AS rank
      FROM bias_u JOIN bias_i ON true, train_gm WHERE NOT EXISTS (SELECT 1 FROM train s WHERE s.userId = uid AND s.movieId = mid)) x WHERE rank <= 10""")


def unseen_lists(t):
    train = materialise(t.train().select(C.USER, C.ITEM, C.RATING), "train")
    users, items = train.select(C.USER).distinct(), train.select(C.ITEM).distinct()
    return blocks.best_unseen(users, items, train, [blocks.bias_source(train, users, items)])


@query("novelty_rank", f"""
    SELECT {dec('avg(s)', 6)} AS novelty_rank FROM (
      SELECT t.userId, sum(coalesce(k.rank, (SELECT count(*) FROM popular))) AS s FROM unseen10 t LEFT JOIN popular k ON t.movieId = k.movieId GROUP BY t.userId) x""")
def _(t):
    ranks = ranking.popularity_rank(t.ratings())
    return E.novelty_rank(unseen_lists(t), ranks).withColumn("novelty_rank", R("novelty_rank", 6))


@query("recs_vs_holdout", "SELECT t.userId, t.movieId, CASE WHEN r.rank IS NULL THEN 0 ELSE 1 END AS hit FROM test t LEFT JOIN unseen10 r ON t.userId = r.userId AND t.movieId = r.movieId")
def _(t):
    return E.recs_vs_holdout(unseen_lists(t), keys(t))


@query("hit_rate", f"SELECT {dec('count(r.rank) / CAST(count(*) AS DOUBLE)', 6)} AS hit_rate FROM test t LEFT JOIN unseen10 r ON t.userId = r.userId AND t.movieId = r.movieId")
def _(t):
    return E.hit_rate(unseen_lists(t), keys(t)).withColumn("hit_rate", R("hit_rate", 6))


@query("compare_predictions", f"""
    SELECT p.userId, p.movieId, {dec('p.est', 6)} AS est_a, {dec('im', 6)} AS est_b, abs(p.est - im) < 0.05 AS equal
    FROM preds p JOIN item_means ON movieId = mid""")
def _(t):
    means = t.train().groupBy(C.ITEM).agg(F.avg(C.RATING).alias("est"))
    out = E.compare_predictions(preds(t), keys(t).join(means, C.ITEM), digits=1)
    return out.select(C.USER, C.ITEM, R("est_a", 6).alias("est_a"), R("est_b", 6).alias("est_b"), "equal")


def blend_sql(targets: str, *, rounded: bool = True) -> str:
    blend = "(CASE WHEN s.est IS NULL THEN 0 ELSE 0.45 * s.est END + CASE WHEN c.est IS NULL THEN 0 ELSE 0.30 * c.est END + CASE WHEN i.est IS NULL THEN 0 ELSE 0.25 * i.est END) / nullif((CASE WHEN s.est IS NULL THEN 0 ELSE 0.45 END + CASE WHEN c.est IS NULL THEN 0 ELSE 0.30 END + CASE WHEN i.est IS NULL THEN 0 ELSE 0.25 END), 0)"
    return f"""
        SELECT t.userId, t.movieId, {dec(CLIP.format(blend), 6)} AS est FROM {targets} t
        LEFT JOIN bias_pred s ON s.userId = t.userId AND s.movieId = t.movieId
        LEFT JOIN (SELECT * FROM ({content_knn_sql(targets, 20, rounded=False)}) c0 WHERE NOT was_impossible) c ON c.userId = t.userId AND c.movieId = t.movieId
        LEFT JOIN (SELECT * FROM ({itr_knn_sql(targets, 60, 5, rounded=False)}) i0 WHERE NOT was_impossible) i ON i.userId = t.userId AND i.movieId = t.movieId"""


@query("hybrid_blend", blend_sql("test"))
def _(t):
    """Closed-form scores in the three slots; the neighbourhood slots are missing where there are too few neighbours."""
    train, want = t.train(), keys(t)
    scores = {
        "svd": B.predict_bias(train, want),
        "content": N.content_knn(train, want, v1_arrays(t)),
        "itr": N.user_knn_itr(train, want, **C.ITR_PARAMS),
    }
    return hybrid.hybrid_blend(train, want, scores).select(C.USER, C.ITEM, R("est", 6).alias("est"))


@query("weighted_blend", f"""
    SELECT userId, movieId, {dec('(coalesce(0.6 * est, 0) + coalesce(0.4 * im, 0)) / nullif(CASE WHEN est IS NULL THEN 0 ELSE 0.6 END + CASE WHEN im IS NULL THEN 0 ELSE 0.4 END, 0)', 6)} AS est
    FROM preds LEFT JOIN item_means ON movieId = mid""")
def _(t):
    means = t.train().groupBy(C.ITEM).agg(F.avg(C.RATING).alias("im"))
    return preds(t).join(means, C.ITEM, "left").select(C.USER, C.ITEM, R(S.weighted_blend([("est", 0.6), ("im", 0.4)]), 6).alias("est"))


@query("evaluate_models", " UNION ALL ".join(f"""
    SELECT '{name}' AS model, {dec('sqrt(avg((rating - est) * (rating - est)))', 4)} AS rmse, {dec('avg(abs(rating - est))', 4)} AS mae,
      (SELECT {dec('avg(ndcg)', 4)} FROM (SELECT userId, CASE WHEN sum(ideal) > 0 THEN sum(gain) / sum(ideal) ELSE 0 END AS ndcg FROM (
         SELECT userId, CASE WHEN rating >= 4.0 AND rp <= 10 THEN 1 / log2(rp + 1) ELSE 0 END AS gain, CASE WHEN rating >= 4.0 AND ri <= 10 THEN 1 / log2(ri + 1) ELSE 0 END AS ideal FROM (
           SELECT *, row_number() OVER (PARTITION BY userId ORDER BY est DESC, movieId) AS rp, row_number() OVER (PARTITION BY userId ORDER BY rating DESC, movieId) AS ri FROM {rel}) x) y GROUP BY userId) z) AS ndcg_10,
      (SELECT {dec('avg(d)', 4)} FROM (SELECT avg(1 - CAST(len(list_intersect(string_split(i.genres, '|'), string_split(j.genres, '|'))) AS DOUBLE) / len(list_distinct(list_concat(string_split(i.genres, '|'), string_split(j.genres, '|'))))) AS d
         FROM (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY est DESC, movieId) AS rk FROM {rel}) a JOIN (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY est DESC, movieId) AS rk FROM {rel}) b
         ON a.userId = b.userId AND a.rk < b.rk AND b.rk <= 10 JOIN items i ON i.movieId = a.movieId JOIN items j ON j.movieId = b.movieId GROUP BY a.userId) q) AS diversity,
      (SELECT {dec('avg(s)', 4)} FROM (SELECT avg(-log2(coalesce(p, 1e-10))) AS s FROM (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY est DESC, movieId) AS rk FROM {rel}) a LEFT JOIN pops ON movieId = mid WHERE rk <= 10 GROUP BY userId) w) AS novelty
    FROM {rel}""" for name, rel in (("bias", "preds"), ("global_mean", "gm_preds"), ("user_knn", "knn_preds"))))
def _(t):
    from tasteframe.plans.jobs import evaluate_models

    knn = lambda train, want: N.user_knn_custom(train, want, k=3, min_k=2, sim="msd", min_support=2)
    models = {
        "bias": lambda train, want: B.predict_bias(train, want).withColumn("est", R("est", 2)),
        "global_mean": lambda train, want: B.predict_global_mean(train, want).withColumn("est", R("est", 6)),
        "user_knn": lambda train, want: knn(train, want).withColumn("est", R("est", 6)),
    }
    return evaluate_models(models, t.train(), t.test(), t.items(), t.ratings())


# --- protocols: bias model and item means, on the split, on one held-out item per user, and on everything ------------

def biases_sql(name: str, rows: str) -> None:
    """Relations of the bias model on some rows: <name>_g, <name>_i, <name>_u."""
    relation(f"{name}_g", f"SELECT avg(rating) AS g FROM {rows}")
    relation(f"{name}_i", f"SELECT movieId AS mid, avg(rating) AS im, (sum(rating) - count(*) * max(g)) / (10 + count(*)) AS bi FROM {rows}, {name}_g GROUP BY movieId")
    relation(f"{name}_u", f"SELECT userId AS uid, (sum(rating - bi) - count(*) * max(g)) / (15 + count(*)) AS bu FROM {rows} JOIN {name}_i ON movieId = mid, {name}_g GROUP BY userId")


relation("split_test", f"SELECT * FROM ratings WHERE {SEEDED.format(seed=1)} % 10000 < 2000")
relation("split_train", f"SELECT * FROM ratings WHERE NOT ({SEEDED.format(seed=1)} % 10000 < 2000)")
relation("held_train", "SELECT r.* FROM ratings r LEFT JOIN held h ON r.userId = h.userId AND r.movieId = h.movieId WHERE h.userId IS NULL")
for _name, _rows in (("split", "split_train"), ("loo", "held_train"), ("whole", "ratings")):
    biases_sql(_name, _rows)
_EST = {"bias": CLIP.format("g + coalesce(bu, 0) + coalesce(bi, 0)"), "item_mean": CLIP.format("coalesce(im, g)")}
for _model, _est in _EST.items():
    relation(f"split_{_model}", f"SELECT userId, movieId, rating, {_est} AS est FROM split_test LEFT JOIN split_i ON movieId = mid LEFT JOIN split_u ON userId = uid, split_g")
    for _name, _rows in (("loo", "held_train"), ("whole", "ratings")):
        relation(f"{_name}_{_model}", f"""
            SELECT uid AS userId, mid AS movieId, row_number() OVER (PARTITION BY uid ORDER BY floor({_est} * 1e9 + 0.5) / 1e9 DESC, mid) AS rank
            FROM {_name}_u JOIN {_name}_i ON true, {_name}_g WHERE NOT EXISTS (SELECT 1 FROM {_rows} s WHERE s.userId = uid AND s.movieId = mid)""")


def report_sql(model: str) -> str:
    return f"""
        SELECT '{model}' AS model, {dec('sqrt(avg((rating - est) * (rating - est)))', 4)} AS rmse, {dec('avg(abs(rating - est))', 4)} AS mae, {dec('avg((rating - est) * (rating - est))', 4)} AS mse,
          (SELECT {dec('count(CASE WHEN a.est > b.est THEN 1 END) / CAST(count(*) AS DOUBLE)', 4)} FROM split_{model} a JOIN split_{model} b ON a.userId = b.userId AND a.rating > b.rating) AS fcp,
          (SELECT {dec('count(CASE WHEN rank <= 10 THEN 1 END) / CAST(count(*) AS DOUBLE)', 4)} FROM held h LEFT JOIN loo_{model} l ON l.userId = h.userId AND l.movieId = h.movieId) AS hit_rate,
          (SELECT {dec('sum(coalesce(1.0 / rank, 0)) / count(*)', 4)} FROM held h LEFT JOIN loo_{model} l ON l.userId = h.userId AND l.movieId = h.movieId) AS reciprocal_rank,
          (SELECT {dec('avg(s)', 4)} FROM (SELECT l.userId, sum(k.rank) AS s FROM whole_{model} l JOIN popular k ON l.movieId = k.movieId WHERE l.rank <= 10 GROUP BY l.userId) x) AS novelty_rank,
          (SELECT {dec('avg(s)', 4)} FROM (SELECT avg(-log2(p)) AS s FROM whole_{model} JOIN pops ON movieId = mid WHERE rank <= 10 GROUP BY userId) x) AS novelty
        FROM split_{model}"""


@query("evaluation_report", " UNION ALL ".join(map(report_sql, _EST)))
def _(t):
    """Three protocols with metrics of the registry."""
    wanted = {"split": ["rmse", "mae", "mse", "fcp"], "loo": ["hit_rate", "reciprocal_rank"], "full": ["novelty_rank", "novelty"]}
    return protocols.evaluation_report({"bias": protocols.BIAS, "item_mean": protocols.ITEM_MEAN}, t.ratings(), t.items(), metrics=wanted)


@query("held_out_ranks", """
    SELECT h.userId, h.movieId, rank FROM held h LEFT JOIN loo_bias l ON l.userId = h.userId AND l.movieId = h.movieId""")
def _(t):
    train, held = E.leave_one_out(t.ratings().select(C.USER, C.ITEM, C.RATING))
    return protocols.held_out_ranks(protocols.BIAS, materialise(train, "held-train"), materialise(held, "held"))
