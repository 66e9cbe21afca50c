"""Model-based queries: ALS family, LFM, FM, SVD, NMF.

Fits are eager actions inside the callable; the returned DataFrame holds
the model output.  Only R13's seen half and R20 (fixed rule weights) are
SQL-comparable; the rest are checked by row counts and invariant tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import models as M
from ..operators import prep as P
from ..operators.aggregate import most_active
from ..operators.evaluate import rmse
from ..operators.threshold import max_inner_product
from ..session import scratch_path, stored
from ..sources import catalog as C
from . import sql as Q
from .cf import _all, _tr
from .registry import register


LFM_K = 8


def _rule_factor(key: str, f: int) -> str:
    """Fixed factor of a user or item as SQL that Spark and DuckDB read alike."""
    return f"(({key} * {31 + 2 * f} + {f * 17}) % 997) / CAST(997.0 AS DOUBLE) - CAST(0.5 AS DOUBLE)"


def _rule_vector(key: str, scale: str) -> list[str]:
    return [f"({_rule_factor(key, f)}) {scale}" for f in range(LFM_K)]


#: Norms of items differ by their id, so that the search has an order to use.
_LFM_SCALE = "/ (1 + item_id % 40)"


def _als_input(spark, sf):
    """user_movies (string user, item, count -1 -> 3) with a 32-bit user index."""
    um = C.user_movies(spark, sf)
    rated = um.select("user", "item_id", F.when(F.col("count") == -1, F.lit(3))
                      .otherwise(F.col("count")).cast("float").alias("rating"))
    idm = P.build_id_map(rated, "user", "user_idx")
    return rated.join(idm, "user"), idm


def _render(recs: DataFrame, idm: DataFrame, names: DataFrame) -> DataFrame:
    j = recs.join(names, "item_id", "left").withColumn("name", F.coalesce("name", F.lit("")))
    g = j.groupBy("user_idx").agg(F.array_sort(F.collect_list(F.struct(
        "rank", F.concat_ws(":", F.col("item_id").cast("string"), "name").alias("s")))).alias("_e"))
    return g.join(idm, "user_idx").select("user", F.array_join("_e.s", ",").alias("recs"))


@register("als_topn")
def als_topn(spark: SparkSession, sf: str) -> DataFrame:
    """Explicit ALS (rank 50, 10 iterations, λ=1e-4), 5 items per user rendered
    ``id:name,...`` (seen items are not removed, as in the reference)."""
    data, idm = _als_input(spark, sf)
    model = M.fit_als(data, rank=50, max_iter=10, reg=1e-4, user="user_idx")
    recs = M.recommend_for_all(model, 5, user="user_idx")
    return _render(recs, idm, C.item_names(spark, sf).withColumn("item_id", F.col("item_id").cast("int")))


@register("als_implicit")
def als_implicit(spark: SparkSession, sf: str) -> DataFrame:
    """Implicit-feedback ALS (confidence α = 40) on the interaction counts, top 5."""
    data, _ = _als_input(spark, sf)
    model = M.fit_als(data, rank=10, max_iter=10, reg=0.01, implicit=True, alpha=40.0, user="user_idx")
    return M.recommend_for_all(model, 5, user="user_idx").select(
        "user_idx", "item_id", F.round("score", 6).alias("score"), "rank")


#: Fits at a time, and blocks of items in each (few, because every block gets the factors of nearly all users).
GRID_PARALLELISM = 6
GRID_ITEM_BLOCKS = 2


@register("als_grid")
def als_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Rank {10,50} x λ {1, .01, 1e-4} explicit and x α {1, 40} implicit;
    MSE on the training data itself (train = test, as in the reference)."""
    from concurrent.futures import ThreadPoolExecutor

    data, _ = _als_input(spark, sf)
    data = data.persist()
    lists = M.rating_lists(data, "user_idx").persist()
    grid = []
    for rank in (10, 50):
        for reg in (1.0, 0.01, 0.0001):
            grid.append(("explicit", rank, reg, None))
            for alpha in (1.0, 40.0):
                grid.append(("implicit", rank, reg, alpha))

    def fit(cfg):
        kind, rank, reg, alpha = cfg
        m = M.fit_als(data, rank=rank, max_iter=10, reg=reg, implicit=kind == "implicit",
                      alpha=alpha or 1.0, user="user_idx", item_blocks=GRID_ITEM_BLOCKS)
        return (kind, rank, reg, alpha, float(M.training_mse_lists(m, lists, "user_idx")))

    # independent fits are submitted as concurrent Spark jobs (as CrossValidator's
    # ``parallelism`` does); the scheduler shares the executors between them
    with ThreadPoolExecutor(max_workers=GRID_PARALLELISM) as pool:
        rows = list(pool.map(fit, grid))
    lists.unpersist()
    data.unpersist()
    return spark.createDataFrame(rows, "kind string, rank int, reg double, alpha double, mse double")


@register("inspect_user", Q.with_(Q.USER_MOVIES, """
top AS (SELECT "user" FROM user_movies GROUP BY "user" ORDER BY COUNT(*) DESC, "user" LIMIT 1)""") + """
SELECT DISTINCT u."user", u.item_id, COALESCE(p.p_name, '') AS name
FROM user_movies u JOIN top ON u."user" = top."user" LEFT JOIN part p ON p.p_partkey = u.item_id""")
def inspect_user(spark: SparkSession, sf: str) -> DataFrame:
    """R13 (seen half): names of the items the most active user interacted with.
    The recommended half is ``als_topn`` filtered to the same user."""
    um = C.user_movies(spark, sf).select("user", "item_id")
    top = most_active(um, "user")
    names = C.item_names(spark, sf)
    seen = um.join(F.broadcast(top), "user").distinct()
    return seen.join(names, "item_id", "left").select(
        "user", "item_id", F.coalesce("name", F.lit("")).alias("name"))


@register("als_grid_holdout")
def als_grid_holdout(spark: SparkSession, sf: str) -> DataFrame:
    """R12 on a holdout: the same 18 settings, each fitted on 80 % of the ratings and scored by MSE on the others."""
    data, _ = _als_input(spark, sf)
    return M.tune_als(data, [10, 50], [1.0, 0.01, 0.0001], [1.0, 40.0], user="user_idx", parallelism=GRID_PARALLELISM,
                      item_blocks=GRID_ITEM_BLOCKS)


#: Users that R13 looks at besides the most active ones: no row has this one.
UNKNOWN_USER = -1


@register("inspect_model", Q.with_(Q.RATINGS, f"""
who AS (SELECT user_id FROM ratings GROUP BY 1 ORDER BY COUNT(*) DESC, user_id LIMIT 2),
p AS (SELECT user_id, {', '.join(f'{x} AS p{f}' for f, x in enumerate(_rule_vector('user_id', '')))} FROM who),
q AS (SELECT item_id, {', '.join(f'{x} AS q{f}' for f, x in enumerate(_rule_vector('item_id', _LFM_SCALE)))} FROM (SELECT DISTINCT item_id FROM ratings)),
s AS (SELECT user_id, item_id, {' + '.join(f'p{f} * q{f}' for f in range(LFM_K))} AS score FROM p CROSS JOIN q),
best AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rk FROM s),
one AS (SELECT user_id, round(p0, 6) AS factor FROM p)""") + """
SELECT r.user_id, 'seen' AS part, r.item_id, COALESCE(p_name, '') AS name, CAST(0 AS BIGINT) AS rank, factor
FROM ratings r JOIN one USING (user_id) LEFT JOIN part ON p_partkey = r.item_id
UNION ALL
SELECT b.user_id, 'recommended', b.item_id, COALESCE(p_name, ''), CAST(rk AS BIGINT), factor
FROM best b JOIN one USING (user_id) LEFT JOIN part ON p_partkey = b.item_id WHERE rk <= 5""")
def inspect_model(spark: SparkSession, sf: str) -> DataFrame:
    """R13 whole: names of the seen and of the 5 recommended items and the first user factor, for two active users and an
    unknown one (which has no row), from rule-made factors so that SQL gives the same rows."""
    r = _all(spark, sf).select("user_id", "item_id")
    active = r.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "user_id").limit(2).select("user_id")
    who = active.unionByName(spark.createDataFrame([(UNKNOWN_USER,)], active.schema))
    factors = lambda key, scale: r.select(key).distinct().select(
        key, F.array(*[F.expr(x) for x in _rule_vector(key, scale)]).alias("features"))
    out = M.inspect_users(who, r, factors("user_id", ""), factors("item_id", _LFM_SCALE), C.item_names(spark, sf), 5)
    return out.withColumn("factor", F.round("factor", 6))


@register("inspect_als")
def inspect_als(spark: SparkSession, sf: str) -> DataFrame:
    """R13 on the fitted ALS model of R10's input: the most active user and an unknown one."""
    data, idm = _als_input(spark, sf)
    model = M.fit_als(data, rank=10, max_iter=5, reg=0.01, user="user_idx")
    who = most_active(data, "user").unionByName(spark.createDataFrame([("nobody",)], "user string"))
    own = model.userFactors.join(idm, F.col("id") == F.col("user_idx")).select("user", "features")
    names = C.item_names(spark, sf).withColumn("item_id", F.col("item_id").cast("int"))
    return M.inspect_users(who, data.select("user", "item_id").distinct(), own, model.itemFactors.withColumnRenamed("id", "item_id"),
                           names, 5, user="user")


_IDS = """
rated AS (SELECT "user", item_id FROM user_movies),
ids AS (SELECT "user", CAST(row_number() OVER (ORDER BY "user") - 1 AS INTEGER) AS idx FROM (SELECT DISTINCT "user" FROM rated))"""


@register("save_model", Q.with_(Q.USER_MOVIES, _IDS) + """
SELECT idx AS id, 10 AS rank FROM ids""")
def save_model(spark: SparkSession, sf: str) -> DataFrame:
    """IO11: fit ALS, save it to the shared folder, load it back, return the loaded user factors."""
    data, _ = _als_input(spark, sf)
    model = M.fit_als(data, rank=10, max_iter=5, reg=0.01, user="user_idx")
    path = scratch_path(spark, "als-model")
    model.write().overwrite().save(path)
    loaded = M.ALSModel.load(path)
    return loaded.userFactors.select("id", F.size("features").alias("rank"))


@register("load_model", Q.with_(Q.USER_MOVIES, _IDS) + """
SELECT DISTINCT idx AS user_idx, item_id, TRUE AS same FROM rated JOIN ids USING ("user")""")
def load_model(spark: SparkSession, sf: str) -> DataFrame:
    """IO11: a saved ALS model loaded back scores the training pairs like the original."""
    data, _ = _als_input(spark, sf)
    model = M.fit_als(data, rank=10, max_iter=5, reg=0.01, user="user_idx")
    path = scratch_path(spark, "als-model")
    model.write().overwrite().save(path)
    loaded = M.ALSModel.load(path)
    pairs = data.select("user_idx", "item_id").distinct()
    both = loaded.transform(model.transform(pairs).withColumnRenamed("prediction", "_p"))
    return both.select("user_idx", "item_id", (F.abs(F.col("_p") - F.col("prediction")) < 1e-9).alias("same"))


def _lfm_model(spark, sf):
    """The model with its user and item maps (ALS takes 32-bit ids; the tables' ids may be larger)."""
    r = C.ratings(spark, sf).select("user_id", "item_id")
    users, items = (P.build_id_map(r, f"{x}_id", f"{x}_idx") for x in ("user", "item"))
    # drawn by their place, so that the samples reach their user's partition with the item's index
    samples = P.sample_histories(r.join(items, "item_id", "left").select("user_id", "item_idx"), item="item_idx")
    mapped = samples.join(users, "user_id").where(F.col("item_idx").isNotNull()).select(
        "user_idx", "item_idx", F.col("label").cast("float").alias("label"))
    # ALS reads its input more than once
    model = M.fit_als(stored(mapped, "samples"), rank=10, max_iter=10, reg=0.01, user="user_idx", item="item_idx", rating="label")
    return model, users, items


@register("lfm")
def lfm(spark: SparkSession, sf: str) -> DataFrame:
    """Latent factor model on positives + sampled negatives (0/1 targets),
    squared error with L2 per sample - fitted by ALS; returns the user factors."""
    model, users, _ = _lfm_model(spark, sf)
    return model.userFactors.join(users, F.col("id") == F.col("user_idx")).select("user_id", "features")


@register("lfm_recommend")
def lfm_recommend(spark: SparkSession, sf: str) -> DataFrame:
    """Score Σ_f p_uf q_fi over all items, best 10 per user; items by falling norm, users stop by their bound."""
    model, users, items = _lfm_model(spark, sf)
    own = model.userFactors.join(users, F.col("id") == F.col("user_idx")).select("user_id", "features")
    all_items = model.itemFactors.join(items, F.col("id") == F.col("item_idx")).select("item_id", "features")
    best = max_inner_product(own, all_items, 10)
    return best.select("user_id", "item_id", F.round("score", 6).alias("score"), "rank")


@register("lfm_recommend_rule", Q.with_(Q.RATINGS, f"""
p AS (SELECT user_id, {', '.join(f'{x} AS p{f}' for f, x in enumerate(_rule_vector('user_id', '')))} FROM (SELECT DISTINCT user_id FROM ratings)),
q AS (SELECT item_id, {', '.join(f'{x} AS q{f}' for f, x in enumerate(_rule_vector('item_id', _LFM_SCALE)))} FROM (SELECT DISTINCT item_id FROM ratings)),
s AS (SELECT user_id, item_id, {' + '.join(f'p{f} * q{f}' for f in range(LFM_K))} AS score FROM p CROSS JOIN q)""") + """
SELECT user_id, item_id, round(score, 6) AS score, CAST(rk AS BIGINT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rk FROM s) WHERE rk <= 10""")
def lfm_recommend_rule(spark: SparkSession, sf: str) -> DataFrame:
    """R17 from saved factors: the same search over rule-made factors, so that SQL gives the same rows."""
    r = _all(spark, sf)
    side = lambda key, scale: r.select(key).distinct().select(
        key, F.array(*[F.expr(x) for x in _rule_vector(key, scale)]).alias("features"))
    best = max_inner_product(side("user_id", ""), side("item_id", _LFM_SCALE), 10)
    return best.select("user_id", "item_id", F.round("score", 6).alias("score"), "rank")


@register("fm_regression")
def fm_regression(spark: SparkSession, sf: str) -> DataFrame:
    """Factorisation machine (k=10, λ=0.001, step 0.01) on one-hot user+item
    features of the train ratings; train and test RMSE."""
    r = C.ratings(spark, sf).select("user_id", "item_id", "rating", C.split_bucket().alias("_b"))
    x = M.onehot_features(r)
    train = x.where(F.col("_b") < C.SPLIT_TRAIN_BELOW)
    test = x.where(F.col("_b") >= C.SPLIT_TRAIN_BELOW)
    model = M.fit_fm(train, max_iter=100)
    keys = ("user_id", "item_id")
    out = []
    for name, d in (("train", train), ("test", test)):
        pr = model.transform(d).select(*keys, "prediction")
        out.append(rmse(pr, d.select(*keys, "rating")).select(F.lit(name).alias("split"), "rmse", "n"))
    return out[0].unionByName(out[1])


FM_K = 10
FM_W0 = 0.1


def _fm_rule_weights(features: DataFrame, f: str = "feature") -> DataFrame:
    """Fixed FM weights as a rule of the feature index (no training, reproducible in SQL)."""
    lin = ((F.col(f) * 7919) % 1000).cast("double") / F.lit(1000.0) - F.lit(0.5)
    fac = [((((F.col(f) * 31 + q * 17) % 997).cast("double") / F.lit(997.0)) - F.lit(0.5)) / F.lit(10.0)
           for q in range(FM_K)]
    return features.select(f, lin.alias("w"), *[c.alias(f"v_{q}") for q, c in enumerate(fac)])


def _fm_rule_sql() -> str:
    lin = "((f * 7919) % 1000) / 1000.0 - 0.5"
    terms = []
    for q in range(FM_K):
        v = f"((((f * 31 + {q * 17}) % 997) / 997.0) - 0.5) / 10.0"
        terms.append(f"power(SUM({v}), 2) - SUM(power({v}, 2))")
    return Q.with_(Q.RATINGS, """
idx AS (SELECT user_id, item_id,
               dense_rank() OVER (ORDER BY user_id) - 1 AS uf,
               (SELECT COUNT(DISTINCT user_id) FROM ratings) + dense_rank() OVER (ORDER BY item_id) - 1 AS itf
        FROM ratings),
act AS (SELECT user_id, item_id, uf AS f FROM idx UNION ALL SELECT user_id, item_id, itf AS f FROM idx)""") + f"""
SELECT user_id, item_id,
       round({FM_W0} + SUM({lin}) + 0.5 * ({' + '.join(terms)}), 6) AS prediction
FROM act GROUP BY user_id, item_id"""


@register("fm_score", _fm_rule_sql())
def fm_score(spark: SparkSession, sf: str) -> DataFrame:
    """FM formula w0 + Σ w x + ½ Σ_f[(Σ v x)² − Σ v² x²] applied to every rating
    (one-hot user and item features) with rule-generated weights."""
    idx = P.onehot_user_item(_all(spark, sf).select("user_id", "item_id"))
    act = (idx.select("user_id", "item_id", F.col("user_idx").alias("feature"))
              .unionByName(idx.select("user_id", "item_id", F.col("item_idx").alias("feature")))
              .withColumn("x", F.lit(1.0)))
    act = act.withColumn("row_id", F.struct("user_id", "item_id"))
    feats = act.select("feature").distinct()
    wts = _fm_rule_weights(feats)
    s = M.fm_score(act.select("row_id", "feature", "x"), wts.select("feature", "w"),
                   wts.select("feature", *[f"v_{q}" for q in range(FM_K)]), FM_W0, k=FM_K)
    return s.select(F.col("row_id.user_id").alias("user_id"), F.col("row_id.item_id").alias("item_id"),
                    F.round("prediction", 6).alias("prediction"))


@register("svd_predict")
def svd_predict(spark: SparkSession, sf: str) -> DataFrame:
    """Rank-15 truncated SVD of the zero-filled train matrix; U·diag(s)·Vᵀ on the test cells."""
    tr = _tr(spark, sf).select("user_id", "item_id", F.col("rating").alias("v"))
    u, s, v = M.truncated_svd(tr, k=15)
    cells = C.test(spark, sf).select("user_id", "item_id", "rating")
    pred = M.svd_predict_cells(u, s, v, cells)
    return pred.select("user_id", "item_id", "rating", F.round("prediction", 6).alias("prediction"))


@register("nmf_factors")
def nmf_factors(spark: SparkSession, sf: str) -> DataFrame:
    """2-component NMF of the zero-filled rating matrix (multiplicative updates);
    returns the user factors W."""
    r = _all(spark, sf).select("user_id", "item_id", F.col("rating").alias("v"))
    w, _h, _losses = M.nmf(r, k=2, iters=20, with_losses=False)
    return w.select("user_id", F.round("w0", 6).alias("w0"), F.round("w1", 6).alias("w1"))
