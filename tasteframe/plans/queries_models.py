"""Queries: similarities and neighbourhood models."""

from __future__ import annotations

from pyspark.sql import functions as F

from tasteframe import constants as C
from tasteframe.functions import scalars as S
from tasteframe.operators import features as FT
from tasteframe.operators import neighbours as N
from tasteframe.operators import similarity as SM
from tasteframe.plans.queries_features import v1_block
from tasteframe.plans.registry import dec, query, relation, snap

R = S.fixed_round


def pairs_sql(table: str, x: str, y: str, r: str = "rating", order: str = "<>") -> str:
    return f"""
        SELECT a.{x} AS u, b.{x} AS v, count(*) AS n, sum(a.{r} * b.{r}) AS suv, sum(a.{r} * a.{r}) AS suu, sum(b.{r} * b.{r}) AS svv,
               sum(a.{r}) AS su, sum(b.{r}) AS sv
        FROM {table} a JOIN {table} b ON a.{y} = b.{y} AND a.{x} {order} b.{x} GROUP BY a.{x}, b.{x}"""


COS = "CASE WHEN sqrt(suu * svv) > 1e-12 THEN suv / sqrt(suu * svv) ELSE 0 END"
PEARSON = """CASE WHEN sqrt(greatest(n * suu - su * su, 0) * greatest(n * svv - sv * sv, 0)) > 1e-9
    THEN (n * suv - su * sv) / sqrt(greatest(n * suu - su * su, 0) * greatest(n * svv - sv * sv, 0)) ELSE 0 END"""
MSD = "1 / (1 + (suu + svv - 2 * suv) / n)"


def itr_sql(dot: str) -> str:
    return snap(f"""(CASE WHEN a.norm + b.norm > 0 THEN 1 - sqrt(greatest(a.norm * a.norm + b.norm * b.norm - 2 * {dot}, 0)) / (a.norm + b.norm) ELSE 0 END)
        * (1 - 1 / (1 + exp(-(abs(a.mu - b.mu) * abs(a.sd - b.sd)))))""")


relation("user_pairs", pairs_sql("ratings", "userId", "movieId", order="<"))
relation("item_pairs", pairs_sql("ratings", "movieId", "userId", order="<"))
relation("train_pairs", pairs_sql("train", "userId", "movieId"))
relation("train_item_pairs", pairs_sql("train", "movieId", "userId"))
relation("centred", "SELECT userId, movieId, rating - avg(rating) OVER (PARTITION BY userId) AS rating FROM ratings")
relation("centred_train", "SELECT userId, movieId, rating - avg(rating) OVER (PARTITION BY userId) AS rating FROM train")
relation("norms", "SELECT userId, sqrt(sum(rating * rating)) AS norm, avg(rating) AS mu, stddev_pop(rating) AS sd FROM ratings GROUP BY userId")
relation("train_norms", "SELECT userId, sqrt(sum(rating * rating)) AS norm, avg(rating) AS mu, stddev_pop(rating) AS sd FROM train GROUP BY userId")
relation("train_gm", "SELECT avg(rating) AS g FROM train")


def sims_query(name, fn, expr, *, axis="user", m=1, table=None, **kw):
    table = table or ("user_pairs" if axis == "user" else "item_pairs")

    @query(name, f"SELECT u, v, {dec(expr, 6)} AS sim, n AS support FROM {table} WHERE n >= {m}")
    def _(t):
        return fn(t.ratings(), axis=axis, min_support=m, ordered=True, **kw).withColumn("sim", R("sim", 6))


sims_query("sim_msd", SM.sim_msd, MSD, m=2)
sims_query("sim_cosine", SM.sim_cosine, COS, m=3)
sims_query("sim_pearson", SM.sim_pearson, snap(PEARSON), m=3)
sims_query("sim_cosine_items", SM.sim_cosine, COS, axis="item", m=2)
sims_query("sim_pearson_items", SM.sim_pearson, snap(PEARSON), axis="item", m=2)


@query("corated_pairs", "SELECT u, v, n, suv, suu, svv, su, sv FROM user_pairs WHERE n >= 2")
def _(t):
    return SM.corated_pairs(t.ratings(), min_support=2, ordered=True)


@query("corated_pairs_hot", "SELECT u, v, n, suv, suu, svv, su, sv FROM user_pairs WHERE n >= 3")
def _(t):
    """The same sums with a low hot limit, so that the left-out path carries real rows."""
    return SM.corated_pairs(t.ratings(), min_support=3, ordered=True, hot=30, chunk=8)


@query("sim_jaccard", f"""
    SELECT u, v, {dec('CAST(p.n AS DOUBLE) / (a.n + b.n - p.n)', 6)} AS sim, p.n AS support
    FROM user_pairs p JOIN ustats a ON p.u = a.userId JOIN ustats b ON p.v = b.userId WHERE p.n >= 2""")
def _(t):
    return SM.sim_jaccard(t.ratings(), min_support=2, ordered=True).withColumn("sim", R("sim", 6))


@query("sim_adjusted_cosine", f"SELECT u, v, {dec(snap(COS), 6)} AS sim, n AS support FROM ({pairs_sql('centred', 'movieId', 'userId', order='<')}) x WHERE n >= 2")
def _(t):
    return SM.sim_adjusted_cosine(t.ratings(), min_support=2, ordered=True).withColumn("sim", R("sim", 6))


@query("sim_itr", f"""
    SELECT u, v, {dec(itr_sql('p.suv'), 6)} AS sim, n AS support
    FROM user_pairs p JOIN norms a ON u = a.userId JOIN norms b ON v = b.userId WHERE n >= 2""")
def _(t):
    return SM.sim_itr(t.ratings(), min_support=2, ordered=True).withColumn("sim", R("sim", 6))


@query("sim_genre_jaccard", f"""
    SELECT a.movieId AS u, b.movieId AS v,
      {dec("CAST(len(list_intersect(string_split(a.genres, '|'), string_split(b.genres, '|'))) AS DOUBLE) / len(list_distinct(list_concat(string_split(a.genres, '|'), string_split(b.genres, '|'))))", 6)} AS sim
    FROM item_pairs p JOIN items a ON p.u = a.movieId JOIN items b ON p.v = b.movieId WHERE n >= 3""")
def _(t):
    pairs = SM.corated_pairs(t.ratings(), axis="item", min_support=3, ordered=True).select("u", "v")
    return SM.sim_genre_jaccard(t.items(), pairs).withColumn("sim", R("sim", 6))


def v1_arrays(t):
    return FT.assemble(v1_block(t), t.items())[0]


relation("v1_space", "SELECT feature, row_number() OVER (ORDER BY feature) AS p FROM (SELECT DISTINCT feature FROM v1) x")
relation("v1_arrays", """
    SELECT movieId, list(coalesce(value, 0) ORDER BY p) AS f FROM (
      SELECT i.movieId, s.p, v.value FROM items i JOIN v1_space s ON true LEFT JOIN v1 v ON v.movieId = i.movieId AND v.feature = s.feature) x GROUP BY movieId""")
relation("v1_norms", "SELECT movieId, f, sqrt(list_inner_product(f, f)) AS s FROM v1_arrays")


@query("sim_content", f"""
    SELECT u, v, {dec('coalesce(list_inner_product(a.f, b.f) / nullif(a.s * b.s, 0), 0)', 6)} AS sim
    FROM item_pairs p JOIN v1_norms a ON p.u = a.movieId JOIN v1_norms b ON p.v = b.movieId WHERE n >= 3""")
def _(t):
    pairs = SM.corated_pairs(t.ratings(), axis="item", min_support=3, ordered=True).select("u", "v")
    return SM.sim_content(v1_arrays(t), pairs).withColumn("sim", R("sim", 6))


@query("top_k_neighbours", f"""
    SELECT u, v, {dec('sim', 6)} AS sim, rank FROM (SELECT u, v, sim, row_number() OVER (PARTITION BY u ORDER BY sim DESC, v) AS rank
      FROM (SELECT u, v, {MSD} AS sim FROM {'(' + pairs_sql('ratings', 'userId', 'movieId') + ')'} d WHERE n >= 2) y) z WHERE rank <= 10""")
def _(t):
    from tasteframe.operators.ranking import top_k_neighbours

    return top_k_neighbours(SM.sim_msd(t.ratings(), min_support=2), 10).select("u", "v", R("sim", 6).alias("sim"), "rank")


@query("positive_similarity_only", f"SELECT u, v, {dec(snap(PEARSON), 6)} AS sim, n AS support FROM user_pairs WHERE n >= 3 AND ({snap(PEARSON)}) > 0")
def _(t):
    from tasteframe.operators.filters import positive_similarity_only

    return positive_similarity_only(SM.sim_pearson(t.ratings(), min_support=3, ordered=True)).withColumn("sim", R("sim", 6))


CLIP = "greatest(0.5, least(5.0, {}))"


def knn_sql(sims: str, *, axis: str = "user", k: int, min_k: int, centred: bool = True) -> str:
    """SQL twin of ``neighbours.knn_predict`` for a relation of (u, v, sim)."""
    x, y = ("userId", "movieId") if axis == "user" else ("movieId", "userId")
    dev = "r.rating - mv.m" if centred else "r.rating"
    body = "mx.m + CASE WHEN coalesce(kk, 0) >= {0} THEN coalesce(num / nullif(den, 0), 0) ELSE 0 END".format(min_k) if centred else "num / nullif(den, 0)"
    bad = "mx.m IS NULL OR ky.y IS NULL" + ("" if centred else f" OR coalesce(kk, 0) < {min_k}")
    return f"""
        SELECT t.userId, t.movieId, {dec(CLIP.format(f'CASE WHEN {bad} THEN g ELSE {body} END'), 6)} AS est,
               CAST(CASE WHEN {bad} THEN 0 ELSE coalesce(kk, 0) END AS INT) AS actual_k, ({bad}) AS was_impossible
        FROM test t LEFT JOIN (
          SELECT x, y, sum(sim * dev) AS num, sum(sim) AS den, count(*) AS kk FROM (
            SELECT q.{x} AS x, q.{y} AS y, s.sim, {dev} AS dev, row_number() OVER (PARTITION BY q.{x}, q.{y} ORDER BY s.sim DESC, s.v) AS rk
            FROM test q JOIN train r ON q.{y} = r.{y} JOIN ({sims}) s ON s.u = q.{x} AND s.v = r.{x}
            JOIN (SELECT {x} AS id, avg(rating) AS m FROM train GROUP BY {x}) mv ON mv.id = r.{x} WHERE s.sim > 0) c WHERE rk <= {k} GROUP BY x, y) e
        ON e.x = t.{x} AND e.y = t.{y}
        LEFT JOIN (SELECT {x} AS id, avg(rating) AS m FROM train GROUP BY {x}) mx ON mx.id = t.{x}
        LEFT JOIN (SELECT DISTINCT {y} AS y FROM train) ky ON ky.y = t.{y}, train_gm"""


def shown(p):
    return p.select(C.USER, C.ITEM, R("est", 6).alias("est"), "actual_k", "was_impossible")


def sims_of(expr: str, m: int, axis: str = "user") -> str:
    return f"SELECT u, v, {expr} AS sim FROM {'train_pairs' if axis == 'user' else 'train_item_pairs'} WHERE n >= {m}"


@query("user_knn_custom", knn_sql(sims_of(MSD, 2), k=3, min_k=2))
def _(t):
    return shown(N.user_knn_custom(t.train(), t.test(), k=3, min_k=2, sim="msd", min_support=2))


@query("user_knn_cosine", knn_sql(sims_of(COS, 3), k=80, min_k=5))
def _(t):
    return shown(N.user_knn_cosine(t.train(), t.test(), **C.USER_COSINE_PARAMS))


@query("user_knn_pearson", knn_sql(sims_of(snap(PEARSON), 3), k=20, min_k=5))
def _(t):
    return shown(N.user_knn_pearson(t.train(), t.test(), **C.USER_PEARSON_PARAMS))


@query("user_knn_cosine_hot", knn_sql(sims_of(COS, 3), k=80, min_k=5))
def _(t):
    """The cosine model with low hot limits: every special path carries rows."""
    return shown(N.user_knn_cosine(t.train(), t.test(), **C.USER_COSINE_PARAMS, hot=24, chunk=7))


@query("user_knn_jaccard", knn_sql(f"""
    SELECT u, v, CAST(p.n AS DOUBLE) / (a.c + b.c - p.n) AS sim FROM train_pairs p JOIN (SELECT userId, count(*) AS c FROM train GROUP BY userId) a ON u = a.userId
    JOIN (SELECT userId, count(*) AS c FROM train GROUP BY userId) b ON v = b.userId WHERE p.n >= 2""", k=40, min_k=1))
def _(t):
    return shown(N.user_knn_custom(t.train(), t.test(), k=40, min_k=1, sim="jaccard", min_support=2))


@query("item_knn_cosine_means", knn_sql(sims_of(COS, 1, "item"), axis="item", k=60, min_k=3))
def _(t):
    return shown(N.item_knn_cosine_means(t.train(), t.test(), **C.ITEM_KNN_PARAMS))


@query("item_knn_adjusted_cosine", knn_sql(
    f"SELECT u, v, {snap(COS)} AS sim FROM ({pairs_sql('centred_train', 'movieId', 'userId')}) x WHERE n >= 2", axis="item", k=60, min_k=3))
def _(t):
    return shown(N.item_knn_cosine_means(t.train(), t.test(), adjusted=True, min_support=2, **C.ITEM_KNN_PARAMS))


@query("item_knn_basic", knn_sql(sims_of(COS, 1, "item"), axis="item", k=40, min_k=3, centred=False))
def _(t):
    return shown(N.item_knn_basic(t.train(), t.test(), **C.ITEM_COSINE_PARAMS))


@query("item_knn_basic_hot", knn_sql(sims_of(COS, 1, "item"), axis="item", k=40, min_k=3, centred=False))
def _(t):
    """The same model with a low hot limit: maps, lookups and tiles carry rows."""
    return shown(N.item_knn_basic(t.train(), t.test(), **C.ITEM_COSINE_PARAMS, hot=36, chunk=20))


def itr_knn_sql(targets: str, k: int, min_k: int, rounded: bool = True) -> str:
    est = f"a0.mu + CASE WHEN coalesce(kk, 0) >= {min_k} THEN coalesce(num / nullif(den, 0), 0) ELSE 0 END"
    est = CLIP.format(f"CASE WHEN a0.mu IS NULL THEN g ELSE {est} END")
    return f"""
        SELECT t.userId, t.movieId, {dec(est, 6) if rounded else est} AS est,
               CAST(CASE WHEN a0.mu IS NULL THEN 0 ELSE coalesce(kk, 0) END AS INT) AS actual_k, a0.mu IS NULL AS was_impossible
        FROM {targets} t LEFT JOIN (
          SELECT x, y, sum(sim * dev) AS num, sum(sim) AS den, count(*) AS kk FROM (
            SELECT x, y, sim, dev, row_number() OVER (PARTITION BY x, y ORDER BY sim DESC, v) AS rk FROM (
              SELECT q.userId AS x, q.movieId AS y, r.userId AS v, {itr_sql('coalesce(p.suv, 0)')} AS sim, r.rating - b.mu AS dev
              FROM {targets} q JOIN train r ON q.movieId = r.movieId AND r.userId <> q.userId
              JOIN train_norms a ON a.userId = q.userId JOIN train_norms b ON b.userId = r.userId
              LEFT JOIN train_pairs p ON p.u = q.userId AND p.v = r.userId) c0 WHERE sim > 0) c WHERE rk <= {k} GROUP BY x, y) e
        ON e.x = t.userId AND e.y = t.movieId LEFT JOIN train_norms a0 ON a0.userId = t.userId, train_gm"""


@query("user_knn_itr", itr_knn_sql("test", 60, 5))
def _(t):
    return shown(N.user_knn_itr(t.train(), t.test(), **C.ITR_PARAMS))


@query("user_knn_itr_hot", itr_knn_sql("test", 60, 5))
def _(t):
    """The same model with a low hot limit: maps, lookups and tiles carry rows."""
    return shown(N.user_knn_itr(t.train(), t.test(), **C.ITR_PARAMS, hot=24, chunk=10))


def content_knn_sql(targets: str, k: int, rounded: bool = True) -> str:
    est = CLIP.format("coalesce(m.m, g) + coalesce(num / (den + 1e-8), 0)")
    return f"""
        SELECT t.userId, t.movieId, {dec(est, 6) if rounded else est} AS est, CAST(coalesce(kk, 0) AS INT) AS actual_k, false AS was_impossible
        FROM {targets} t LEFT JOIN (
          SELECT x, y, sum(sim * dev) AS num, sum(sim) AS den, count(*) AS kk FROM (
            SELECT x, y, sim, dev, row_number() OVER (PARTITION BY x, y ORDER BY sim DESC, v) AS rk FROM (
              SELECT q.userId AS x, q.movieId AS y, r.movieId AS v, {snap('coalesce(list_inner_product(a.f, b.f) / nullif(a.s * b.s, 0), 0)')} AS sim, r.rating - um.m AS dev
              FROM {targets} q JOIN train r ON q.userId = r.userId JOIN v1_norms a ON a.movieId = q.movieId JOIN v1_norms b ON b.movieId = r.movieId
              JOIN (SELECT userId, avg(rating) AS m FROM train GROUP BY userId) um ON um.userId = q.userId) c0 WHERE sim > 0) c WHERE rk <= {k} GROUP BY x, y) e
        ON e.x = t.userId AND e.y = t.movieId LEFT JOIN (SELECT userId, avg(rating) AS m FROM train GROUP BY userId) m ON m.userId = t.userId, train_gm"""


@query("content_knn", content_knn_sql("test", 20))
def _(t):
    return shown(N.content_knn(t.train(), t.test(), v1_arrays(t)))


@query("content_knn_tiles", content_knn_sql("test", 20))
def _(t):
    """Many small tiles per user give the same answer."""
    return shown(N.content_knn(t.train(), t.test(), v1_arrays(t), rows_per_tile=5))


@query("sweep_min_k", " UNION ALL ".join(f"SELECT *, {m} AS min_k FROM ({knn_sql(sims_of(MSD, 2), k=3, min_k=m)}) s{m}" for m in (1, 2, 3)))
def _(t):
    p = N.sweep_min_k(t.train(), t.test(), (1, 2, 3), sim="msd", k=3, min_support=2)
    return p.withColumn("est", R("est", 6))


@query("sweep_min_support", " UNION ALL ".join(f"SELECT *, {m} AS min_support FROM ({knn_sql(sims_of(MSD, m), k=3, min_k=2)}) s{m}" for m in (2, 3)))
def _(t):
    p = N.sweep_min_support(t.train(), t.test(), (2, 3), sim="msd", k=3, min_k=2)
    return p.withColumn("est", R("est", 6))


@query("neighbour_lookup", f"""
    SELECT q.userId, q.movieId, count(*) AS n_neighbours, {dec('max(sim)', 6)} AS best
    FROM test q JOIN train r ON q.movieId = r.movieId JOIN ({sims_of(MSD, 2)}) s ON s.u = q.userId AND s.v = r.userId GROUP BY q.userId, q.movieId""")
def _(t):
    base = SM.along(t.train(), "user")
    want = t.test().select(F.col(C.USER).alias("x"), F.col(C.ITEM).alias("y"))
    sims = SM.sim_msd(t.train(), min_support=2, left=want)
    found = N.neighbour_lookup(base, want, sims)
    return found.groupBy(F.col("x").alias(C.USER), F.col("y").alias(C.ITEM)).agg(
        F.count("*").alias("n_neighbours"), R(F.max("sim"), 6).alias("best"))
