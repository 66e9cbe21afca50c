"""Rating prediction (R5, R6), RMSE/MSE (E5, E6, E11), classification
metrics (E7-E10) and the sparse products J8/J9.

The DuckDB oracles for R5/R6 use the *dense* definitions (full distance
matrices built by cross joins inside DuckDB), so they check the sparse
algebra of ``operators.predict`` rather than repeat it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate as E
from ..operators import models as M
from ..operators import predict as PR
from ..operators import recommend as R
from ..operators import similarity as S
from ..session import kept
from ..sources import catalog as C
from . import sql as Q
from .cf import _all, _most_popular_item, _tr
from .registry import register


def r6(c: str):
    return F.round(F.col(c), 6).alias(c)


def _cells(spark, sf):
    return C.test(spark, sf).select("user_id", "item_id", "rating")


_DENSE_BASE = """
users AS (SELECT DISTINCT user_id FROM ratings),
items AS (SELECT DISTINCT item_id FROM ratings),
cells AS (SELECT user_id, item_id, rating FROM test)"""

_DENSE_ITEM = """
inrm AS (SELECT item_id, sqrt(SUM(CAST(rating AS DOUBLE) * rating)) AS nr FROM train GROUP BY item_id),
idp AS (SELECT a.item_id AS i, b.item_id AS j, SUM(CAST(a.rating AS DOUBLE) * b.rating) AS dot
        FROM train a JOIN train b ON a.user_id = b.user_id AND a.item_id <> b.item_id GROUP BY 1, 2),
ics AS (SELECT idp.i, idp.j, idp.dot / (n1.nr * n2.nr) AS s
        FROM idp JOIN inrm n1 ON idp.i = n1.item_id JOIN inrm n2 ON idp.j = n2.item_id),
iw AS (SELECT a.item_id AS i, b.item_id AS j,
              CASE WHEN a.item_id = b.item_id THEN 0.0 ELSE 1.0 - COALESCE(ics.s, 0.0) END AS w
       FROM items a CROSS JOIN items b LEFT JOIN ics ON ics.i = a.item_id AND ics.j = b.item_id),
iden AS (SELECT i, SUM(abs(w)) AS d FROM iw GROUP BY i),
inum AS (SELECT c.user_id, c.item_id, SUM(t.rating * iw.w) AS nm
         FROM cells c JOIN train t ON t.user_id = c.user_id
         JOIN iw ON iw.i = t.item_id AND iw.j = c.item_id GROUP BY c.user_id, c.item_id),
ipred AS (SELECT c.user_id, c.item_id, c.rating, COALESCE(inum.nm, 0.0) / iden.d AS prediction
          FROM cells c LEFT JOIN inum ON inum.user_id = c.user_id AND inum.item_id = c.item_id
          JOIN iden ON iden.i = c.item_id)"""

_DENSE_USER = """
nitems AS (SELECT COUNT(*) AS n FROM items),
um AS (SELECT u.user_id, COALESCE(SUM(t.rating), 0) / CAST((SELECT n FROM nitems) AS DOUBLE) AS m
       FROM users u LEFT JOIN train t ON t.user_id = u.user_id GROUP BY u.user_id),
unrm AS (SELECT user_id, sqrt(SUM(CAST(rating AS DOUBLE) * rating)) AS nr FROM train GROUP BY user_id),
udp AS (SELECT a.user_id AS i, b.user_id AS j, SUM(CAST(a.rating AS DOUBLE) * b.rating) AS dot
        FROM train a JOIN train b ON a.item_id = b.item_id AND a.user_id <> b.user_id GROUP BY 1, 2),
ucs AS (SELECT udp.i, udp.j, udp.dot / (n1.nr * n2.nr) AS s
        FROM udp JOIN unrm n1 ON udp.i = n1.user_id JOIN unrm n2 ON udp.j = n2.user_id),
uw AS (SELECT a.user_id AS i, b.user_id AS j,
              CASE WHEN a.user_id = b.user_id THEN 0.0 ELSE 1.0 - COALESCE(ucs.s, 0.0) END AS w
       FROM users a CROSS JOIN users b LEFT JOIN ucs ON ucs.i = a.user_id AND ucs.j = b.user_id),
uden AS (SELECT i, SUM(abs(w)) AS d FROM uw GROUP BY i),
unum AS (SELECT c.user_id, c.item_id, SUM(uw.w * (COALESCE(t.rating, 0) - um.m)) AS nm
         FROM cells c JOIN uw ON uw.i = c.user_id
         JOIN um ON um.user_id = uw.j
         LEFT JOIN train t ON t.user_id = uw.j AND t.item_id = c.item_id
         GROUP BY c.user_id, c.item_id),
upred AS (SELECT c.user_id, c.item_id, c.rating, um.m + unum.nm / uden.d AS prediction
          FROM cells c JOIN unum ON unum.user_id = c.user_id AND unum.item_id = c.item_id
          JOIN um ON um.user_id = c.user_id JOIN uden ON uden.i = c.user_id)"""


def _item_pred(spark, sf):
    return PR.predict_item(_tr(spark, sf), C.ratings(spark, sf), _cells(spark, sf))


def _user_pred(spark, sf):
    return PR.predict_user(_tr(spark, sf), C.ratings(spark, sf), _cells(spark, sf))


@register("predict_item_avg", Q.with_(Q.RATINGS, _DENSE_BASE, _DENSE_ITEM) + """
SELECT user_id, item_id, round(prediction, 6) AS prediction FROM ipred""")
def predict_item_avg(spark: SparkSession, sf: str) -> DataFrame:
    """Item-based prediction (cosine-distance weights) for every test cell."""
    return _item_pred(spark, sf).select("user_id", "item_id", r6("prediction"))


@register("predict_user_mean", Q.with_(Q.RATINGS, _DENSE_BASE, _DENSE_USER) + """
SELECT user_id, item_id, round(prediction, 6) AS prediction FROM upred""")
def predict_user_mean(spark: SparkSession, sf: str) -> DataFrame:
    """User-based mean-centred prediction (distance weights) for every test cell."""
    return _user_pred(spark, sf).select("user_id", "item_id", r6("prediction"))


@register("rmse", Q.with_(Q.RATINGS, _DENSE_BASE, _DENSE_ITEM) + """
SELECT round(sqrt(AVG(power(prediction - rating, 2))), 6) AS rmse, CAST(COUNT(*) AS BIGINT) AS n
FROM ipred WHERE rating <> 0""")
def rmse(spark: SparkSession, sf: str) -> DataFrame:
    """E5: RMSE of the item-based predictions over non-zero test cells."""
    return E.rmse(_item_pred(spark, sf), _cells(spark, sf)).select(r6("rmse"), "n")


_ITEM_MEAN = """
imean AS (SELECT item_id, AVG(CAST(rating AS DOUBLE)) AS prediction FROM train GROUP BY item_id)"""


@register("mse", Q.with_(Q.RATINGS, _ITEM_MEAN) + """
SELECT round(AVG(power(CAST(t.rating AS DOUBLE) - m.prediction, 2)), 6) AS mse,
       CAST(COUNT(*) AS BIGINT) AS n
FROM ratings t JOIN imean m ON t.item_id = m.item_id""")
def mse(spark: SparkSession, sf: str) -> DataFrame:
    """MSE of item-mean predictions over all ratings (ids unseen in train drop out)."""
    tr = _tr(spark, sf)
    pred = tr.groupBy("item_id").agg(F.avg(F.col("rating").cast("double")).alias("prediction"))
    r = C.ratings(spark, sf).select("user_id", "item_id", "rating")
    p = r.select("user_id", "item_id").join(pred, "item_id")
    return E.mse(p, r).select(r6("mse"), "n")


# --------------------------------------------------------------- E7-E10
_SCORED = """
scored AS (SELECT l.doc_id, l.quality AS y,
                  CAST(d.n_chars AS DOUBLE) / (CAST(d.n_chars AS DOUBLE) + 2000.0) AS p,
                  d.n_chars AS score
           FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def _scored(spark, sf):
    lb = C.table(spark, sf, "labels").select("doc_id", F.col("quality").alias("y"))
    d = C.table(spark, sf, "documents").select("doc_id", "n_chars")
    p = F.col("n_chars").cast("double") / (F.col("n_chars").cast("double") + F.lit(2000.0))
    return lb.join(d, "doc_id").select("doc_id", "y", p.alias("p"), F.col("n_chars").alias("score"))


@register("accuracy", Q.with_(_SCORED) + """
SELECT round(AVG(CAST((CASE WHEN p > 1.0 - p THEN 1 ELSE 0 END) = y AS DOUBLE)), 6) AS accuracy,
       CAST(COUNT(*) AS BIGINT) AS n FROM scored""")
def accuracy(spark: SparkSession, sf: str) -> DataFrame:
    """Argmax agreement of [1-p, p] with the quality label (p from document length)."""
    s = _scored(spark, sf).withColumn("probs", F.array(F.lit(1.0) - F.col("p"), F.col("p")))
    return E.accuracy(s, "probs", "y").select(r6("accuracy"), "n")


@register("log_loss", Q.with_(_SCORED) + """
SELECT round(AVG(-(y * ln(p + 1e-7) + (1 - y) * ln(1 - p + 1e-7))), 6) AS log_loss,
       CAST(COUNT(*) AS BIGINT) AS n FROM scored""")
def log_loss(spark: SparkSession, sf: str) -> DataFrame:
    """Mean binary cross-entropy of p against quality."""
    return E.log_loss(_scored(spark, sf), "p", "y").select(r6("log_loss"), "n")


@register("auc", Q.with_(_SCORED) + """
SELECT round((SUM(CASE WHEN y = 1 THEN rk ELSE 0 END) - SUM(y) * (SUM(y) + 1) / 2.0)
             / (SUM(y) * (COUNT(*) - SUM(y))), 6) AS auc
FROM (SELECT y, rank() OVER (ORDER BY score) + (COUNT(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk
      FROM scored)""")
def auc(spark: SparkSession, sf: str) -> DataFrame:
    """ROC AUC of document length as a quality score (rank-sum, tie-averaged)."""
    return E.auc(_scored(spark, sf), "score", "y").select(r6("auc"))


@register("half_squared_error", Q.with_(_SCORED) + """
SELECT round(SUM(power(y - p, 2)) / 2.0, 6) AS half_squared_error FROM scored""")
def half_squared_error(spark: SparkSession, sf: str) -> DataFrame:
    """Σ (y - p)^2 / 2."""
    return E.half_squared_error(_scored(spark, sf), "p", "y").select(r6("half_squared_error"))


# --------------------------------------------------------------- J8, J9
@register("spmv", Q.with_(Q.RATINGS, """
nrm AS (SELECT item_id AS m, SUM(CAST(rating AS DOUBLE) * rating) AS ss FROM ratings GROUP BY item_id),
dp AS (SELECT a.item_id AS i, b.item_id AS j, SUM(CAST(a.rating AS DOUBLE) * b.rating) AS dot
       FROM ratings a JOIN ratings b ON a.user_id = b.user_id AND a.item_id < b.item_id GROUP BY 1, 2),
cs AS (SELECT dp.i, dp.j, dp.dot / (sqrt(p1.ss) * sqrt(p2.ss)) AS w
       FROM dp JOIN nrm p1 ON dp.i = p1.m JOIN nrm p2 ON dp.j = p2.m),
xp AS (SELECT item_id AS x FROM ratings GROUP BY item_id ORDER BY COUNT(*) DESC, item_id LIMIT 1),
row_x AS (SELECT CASE WHEN cs.i = xp.x THEN cs.j ELSE cs.i END AS item_id, cs.w
          FROM cs JOIN xp ON cs.i = xp.x OR cs.j = xp.x)""") + """
SELECT t.user_id, round(SUM(t.rating * row_x.w), 6) AS score
FROM ratings t JOIN row_x ON t.item_id = row_x.item_id GROUP BY t.user_id""")
def spmv(spark: SparkSession, sf: str) -> DataFrame:
    """Each user's sparse rating vector times the similarity vector of one item."""
    r = _all(spark, sf)
    return R.row_scores(r, S.sim_row(r, _most_popular_item(r))).select("user_id", r6("score"))


@register("dense_matmul", Q.with_(Q.RATINGS, _DENSE_BASE, """
inrm AS (SELECT item_id, sqrt(SUM(CAST(rating AS DOUBLE) * rating)) AS nr FROM train GROUP BY item_id),
idp AS (SELECT a.item_id AS i, b.item_id AS j, SUM(CAST(a.rating AS DOUBLE) * b.rating) AS dot
        FROM train a JOIN train b ON a.user_id = b.user_id AND a.item_id <> b.item_id GROUP BY 1, 2),
ics AS (SELECT idp.i, idp.j, idp.dot / (n1.nr * n2.nr) AS s
        FROM idp JOIN inrm n1 ON idp.i = n1.item_id JOIN inrm n2 ON idp.j = n2.item_id),
prod AS (SELECT c.user_id, c.item_id, SUM(t.rating * ics.s) AS v
         FROM cells c JOIN train t ON t.user_id = c.user_id
         JOIN ics ON ics.i = t.item_id AND ics.j = c.item_id GROUP BY c.user_id, c.item_id)""") + """
SELECT c.user_id, c.item_id, round(COALESCE(prod.v, 0.0), 6) AS value
FROM cells c LEFT JOIN prod ON prod.user_id = c.user_id AND prod.item_id = c.item_id""")
def dense_matmul(spark: SparkSession, sf: str) -> DataFrame:
    """(ratings · item similarity) at the test cells, as a join + sum."""
    tr = _tr(spark, sf)
    cells = _cells(spark, sf).select("user_id", "item_id")
    sums = S.neighbor_sums(tr, cells, "user_id", "item_id", "rating")
    prod = sums.where(F.col("user_id").isNotNull()).select("user_id", "item_id", F.col("sum").alias("v"))
    out = cells.join(prod, ["user_id", "item_id"], "left")
    return out.select("user_id", "item_id", F.round(F.coalesce("v", F.lit(0.0)), 6).alias("value"))


# --------------------------------------------------------------- R7, R8 (dense definitions)
from ..operators import dense_topn as DT  # noqa: E402


_ITEM_TOPN = Q.with_(Q.RATINGS, _DENSE_BASE, """
inrm AS (SELECT item_id, sqrt(SUM(CAST(rating AS DOUBLE) * rating)) AS nr FROM train GROUP BY item_id),
idp AS (SELECT a.item_id AS i, b.item_id AS j, SUM(CAST(a.rating AS DOUBLE) * b.rating) AS dot
        FROM train a JOIN train b ON a.user_id = b.user_id AND a.item_id <> b.item_id GROUP BY 1, 2),
ics AS (SELECT idp.i, idp.j, idp.dot / (n1.nr * n2.nr) AS s
        FROM idp JOIN inrm n1 ON idp.i = n1.item_id JOIN inrm n2 ON idp.j = n2.item_id),
nit AS (SELECT COUNT(*) AS n FROM items),
dd AS (SELECT it.item_id, (SELECT n FROM nit) - (1.0 + COALESCE(SUM(ics.s), 0.0)) AS d
       FROM items it LEFT JOIN ics ON ics.i = it.item_id GROUP BY it.item_id),
ru AS (SELECT u.user_id, COALESCE(SUM(t.rating), 0) AS r
       FROM users u LEFT JOIN train t ON t.user_id = u.user_id GROUP BY u.user_id),
nu AS (SELECT t.user_id, ics.j AS item_id, SUM(t.rating * ics.s) AS nn
       FROM train t JOIN ics ON ics.i = t.item_id GROUP BY t.user_id, ics.j),
grid AS (SELECT u.user_id, it.item_id FROM users u CROSS JOIN items it
         WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.item_id = it.item_id)),
pred AS (SELECT g.user_id, g.item_id, (ru.r - COALESCE(nu.nn, 0.0)) / dd.d AS score
         FROM grid g JOIN ru ON ru.user_id = g.user_id JOIN dd ON dd.item_id = g.item_id
         LEFT JOIN nu ON nu.user_id = g.user_id AND nu.item_id = g.item_id)""") + """
SELECT user_id, item_id, round(score, 6) AS score, CAST(rk AS BIGINT) AS rank FROM (
  SELECT user_id, item_id, score,
         row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rk
  FROM pred) WHERE rk <= 20"""


@register("topn_from_predictions", _ITEM_TOPN)
def topn_from_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Top 20 unseen items per user of the matrix by the item-based distance prediction,
    over all items (dense definition, computed sparsely)."""
    out = DT.topn_from_item_predictions(_tr(spark, sf), C.ratings(spark, sf), 20)
    return out.select("user_id", "item_id", r6("score"), "rank")


_USER_GRID = """
nitems AS (SELECT COUNT(*) AS n FROM items),
um AS (SELECT u.user_id, COALESCE(SUM(t.rating), 0) / CAST((SELECT n FROM nitems) AS DOUBLE) AS m
       FROM users u LEFT JOIN train t ON t.user_id = u.user_id GROUP BY u.user_id),
unrm AS (SELECT user_id, sqrt(SUM(CAST(rating AS DOUBLE) * rating)) AS nr FROM train GROUP BY user_id),
udp AS (SELECT a.user_id AS i, b.user_id AS j, SUM(CAST(a.rating AS DOUBLE) * b.rating) AS dot
        FROM train a JOIN train b ON a.item_id = b.item_id AND a.user_id <> b.user_id GROUP BY 1, 2),
ucs AS (SELECT udp.i, udp.j, udp.dot / (n1.nr * n2.nr) AS s
        FROM udp JOIN unrm n1 ON udp.i = n1.user_id JOIN unrm n2 ON udp.j = n2.user_id),
ucon AS (SELECT um.user_id, um.m, (SELECT SUM(m) FROM um) - COALESCE(SUM(ucs.s * v.m), 0) - um.m AS a,
                (SELECT COUNT(*) FROM users) - COALESCE(SUM(ucs.s), 0) - 1 AS b
         FROM um LEFT JOIN ucs ON ucs.i = um.user_id LEFT JOIN um v ON v.user_id = ucs.j GROUP BY um.user_id, um.m),
ci AS (SELECT it.item_id, COALESCE(SUM(t.rating), 0) AS c FROM items it LEFT JOIN train t ON t.item_id = it.item_id GROUP BY 1),
sui AS (SELECT ucs.i AS user_id, t.item_id, SUM(ucs.s * t.rating) AS s
        FROM ucs JOIN train t ON t.user_id = ucs.j GROUP BY 1, 2),
pred AS (SELECT u.user_id, ci.item_id, u.m + (ci.c - COALESCE(sui.s, 0.0) - u.a) / u.b AS score
         FROM ucon u CROSS JOIN ci LEFT JOIN sui ON sui.user_id = u.user_id AND sui.item_id = ci.item_id
         WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.item_id = ci.item_id))"""


_USER_TOPN = Q.with_(Q.RATINGS, _DENSE_BASE, _USER_GRID) + """
SELECT user_id, item_id, round(score, 6) AS score, CAST(rk AS BIGINT) AS rank FROM (
  SELECT user_id, item_id, score,
         row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rk
  FROM pred) WHERE rk <= 20"""


@register("topn_from_user_predictions", _USER_TOPN)
def topn_from_user_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Top 20 unseen items per user by the user-based prediction, over all items."""
    out = DT.topn_from_user_predictions(_tr(spark, sf), C.ratings(spark, sf), 20)
    return out.select("user_id", "item_id", r6("score"), "rank")


@register("topn_from_svd")
def topn_from_svd(spark: SparkSession, sf: str) -> DataFrame:
    """Top 20 unseen items per user by the rank-15 SVD of the zero-filled matrix."""
    tr = _tr(spark, sf)
    u, s, v = M.truncated_svd(tr.select("user_id", "item_id", F.col("rating").alias("v")), k=15)
    return DT.topn_from_svd(u, s, v, tr, 20).select("user_id", "item_id", r6("score"), "rank")


@register("item_cf_dense_topn", Q.with_(Q.RATINGS, _DENSE_BASE, """
inrm AS (SELECT item_id, sqrt(SUM(CAST(rating AS DOUBLE) * rating)) AS nr FROM train GROUP BY item_id),
idp AS (SELECT a.item_id AS i, b.item_id AS j, SUM(CAST(a.rating AS DOUBLE) * b.rating) AS dot
        FROM train a JOIN train b ON a.user_id = b.user_id AND a.item_id <> b.item_id GROUP BY 1, 2),
ics AS (SELECT idp.i, idp.j, idp.dot / (n1.nr * n2.nr) AS s
        FROM idp JOIN inrm n1 ON idp.i = n1.item_id JOIN inrm n2 ON idp.j = n2.item_id),
dw AS (SELECT a.item_id AS i, b.item_id AS j,
              CASE WHEN a.item_id = b.item_id THEN 0.0
                   ELSE greatest(1.0 - COALESCE(ics.s, 0.0), 0.0) END AS w
       FROM items a CROSS JOIN items b LEFT JOIN ics ON ics.i = a.item_id AND ics.j = b.item_id),
nb AS (SELECT i, j, w FROM (
         SELECT i, j, w, row_number() OVER (PARTITION BY i ORDER BY w DESC, j) AS rk
         FROM dw WHERE w <> 0) WHERE rk <= 20),
sc AS (SELECT t.user_id, nb.j AS item_id, SUM(nb.w * t.rating) AS score
       FROM train t JOIN nb ON t.item_id = nb.i GROUP BY t.user_id, nb.j),
unseen AS (SELECT * FROM sc WHERE NOT EXISTS (
       SELECT 1 FROM train t WHERE t.user_id = sc.user_id AND t.item_id = sc.item_id))""") + """
SELECT user_id, item_id, round(score, 6) AS score, CAST(rk AS BIGINT) AS rank FROM (
  SELECT user_id, item_id, score,
         row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rk
  FROM unseen) WHERE rk <= 10""")
def item_cf_dense_topn(spark: SparkSession, sf: str) -> DataFrame:
    """Item CF with cosine-distance weights ('largest distance' neighbours, K=20, N=10)."""
    out = DT.item_cf_dense_topn(_tr(spark, sf), C.ratings(spark, sf), 20, 10)
    return out.select("user_id", "item_id", r6("score"), "rank")


# --------------------------------------------------------------- E11
def _model_row(model: str, pred: DataFrame, recs: DataFrame, train: DataFrame, test: DataFrame) -> DataFrame:
    """RMSE on the test cells, and the metrics of the top 20 (per recommendation made)."""
    error = E.rmse(pred, test).select("rmse", F.lit(0).alias("_k"))
    top = E.evaluate_topn(recs, train, test, 20, denominator="actual").withColumn("_k", F.lit(0))
    return error.join(F.broadcast(top), "_k").select(F.lit(model).alias("model"), *[r6(c) for c in ("rmse", "precision", "recall", "coverage", "popularity")])


@register("compare_models", Q.with_(Q.RATINGS, _DENSE_BASE, _DENSE_ITEM, _DENSE_USER, f"""
recs AS (SELECT 'item' AS model, * FROM ({_ITEM_TOPN}) UNION ALL SELECT 'user' AS model, * FROM ({_USER_TOPN})),
err AS (SELECT 'item' AS model, sqrt(AVG(power(prediction - rating, 2))) AS rmse FROM ipred WHERE rating <> 0
        UNION ALL SELECT 'user', sqrt(AVG(power(prediction - rating, 2))) FROM upred WHERE rating <> 0),
pop_e AS (SELECT item_id, COUNT(*) AS n FROM train GROUP BY item_id),
rr AS (SELECT r.model, r.item_id, s.user_id IS NOT NULL AS hit, COALESCE(ln(1 + CAST(p.n AS DOUBLE)), 0) AS lp
       FROM recs r LEFT JOIN test s ON s.user_id = r.user_id AND s.item_id = r.item_id LEFT JOIN pop_e p ON p.item_id = r.item_id),
m AS (SELECT model, COUNT(*) FILTER (WHERE hit) AS hits, COUNT(*) AS n, COUNT(DISTINCT item_id) AS items, SUM(lp) AS lp FROM rr GROUP BY 1)""") + """
SELECT m.model, round(err.rmse, 6) AS rmse, round(hits / CAST(n AS DOUBLE), 6) AS precision,
       round(hits / CAST((SELECT COUNT(*) FROM test WHERE user_id IN (SELECT user_id FROM train)) AS DOUBLE), 6) AS recall,
       round(items / CAST((SELECT COUNT(DISTINCT item_id) FROM train) AS DOUBLE), 6) AS coverage, round(lp / n, 6) AS popularity
FROM m JOIN err ON err.model = m.model""")
def compare_models(spark: SparkSession, sf: str) -> DataFrame:
    """RMSE, precision, recall, coverage and popularity of the item and user predictions (``compare_models_svd``: SVD too)."""
    tr, te, every = _tr(spark, sf), _cells(spark, sf), C.ratings(spark, sf)
    by_item = _model_row("item", _item_pred(spark, sf), kept(DT.topn_from_item_predictions(tr, every, 20)), tr, te)
    return by_item.unionByName(_model_row("user", _user_pred(spark, sf), kept(DT.topn_from_user_predictions(tr, every, 20)), tr, te))


@register("compare_models_svd")
def compare_models_svd(spark: SparkSession, sf: str) -> DataFrame:
    """The SVD's row."""
    tr, te = _tr(spark, sf), _cells(spark, sf)
    u, s, v = M.truncated_svd(tr.select("user_id", "item_id", F.col("rating").alias("v")), k=15)
    u, v = kept(u), kept(v)
    pred = M.svd_predict_cells(u, s, v, te.select("user_id", "item_id"))
    return _model_row("svd", pred, kept(DT.topn_from_svd(u, s, v, tr, 20)), tr, te)
