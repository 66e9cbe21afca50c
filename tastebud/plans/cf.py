"""Collaborative-filtering queries: similarities, neighbours, top-N, metrics.

All queries run on the hash-split ``train``/``test`` views of the catalog.
Scores are rounded to 6 places in the output; rankings compare scores
rounded to 9 places and break ties on the id ascending.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate as E
from ..operators import recommend as R
from ..operators import similarity as S
from ..sources import catalog as C
from . import sql as Q
from .registry import register

K_NEIGHBORS = 20
N_RECS = 10


def r6(c: str):
    return F.round(F.col(c), 6).alias(c)


def _tr(spark, sf):
    return C.train(spark, sf).select("user_id", "item_id", "rating")


def _all(spark, sf):
    """All ratings, for queries whose operator knows no holdout."""
    return C.ratings(spark, sf).select("user_id", "item_id", "rating")


def _te(spark, sf):
    return C.test(spark, sf).select("user_id", "item_id", "rating")


def _topn_out(df: DataFrame) -> DataFrame:
    return df.select("user_id", "item_id", r6("score"), "rank")


def _most_popular_item(r: DataFrame):
    """Id of the most rated item (ties: smallest id); None without ratings."""
    top = (S.member_counts(r, "item_id")
            .orderBy(F.col("n").desc(), F.col("item_id").asc()).first())
    return top and top["item_id"]


# --------------------------------------------------------------- R1 item CF
def item_cf_recs(spark: SparkSession, sf: str) -> DataFrame:
    return R.item_cf_topn(_tr(spark, sf), k=K_NEIGHBORS, n=N_RECS)


R1_SQL = Q.with_(Q.RATINGS, Q.ITEM_COS, Q.topk("isim", K_NEIGHBORS, "nb"), """
sc AS (SELECT t.user_id, nb.j AS item_id, SUM(nb.w * t.rating) AS score
       FROM train t JOIN nb ON t.item_id = nb.i GROUP BY t.user_id, nb.j),
unseen AS (SELECT * FROM sc WHERE NOT EXISTS (
       SELECT 1 FROM train t WHERE t.user_id = sc.user_id AND t.item_id = sc.item_id)),
recs AS (SELECT * FROM (
       SELECT user_id, item_id, score,
              row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rank
       FROM unseen) WHERE rank <= 10)""")


@register("item_cf_topn", R1_SQL + """
SELECT user_id, item_id, round(score, 6) AS score, CAST(rank AS BIGINT) AS rank FROM recs""")
def item_cf_topn(spark: SparkSession, sf: str) -> DataFrame:
    """Item CF (binary cosine, K=20 neighbours, score Σ w·r, top 10 unseen)."""
    return _topn_out(item_cf_recs(spark, sf))


# --------------------------------------------------------------- R2/R3 user CF
def _user_cf_sql(weighted: bool) -> str:
    val = "nb.w * t.rating" if weighted else "nb.w"
    return Q.with_(Q.RATINGS, Q.USER_COS, Q.topk("usim", K_NEIGHBORS, "nb"), f"""
sc AS (SELECT nb.i AS user_id, t.item_id, SUM({val}) AS score
       FROM nb JOIN train t ON nb.j = t.user_id GROUP BY nb.i, t.item_id),
unseen AS (SELECT * FROM sc WHERE NOT EXISTS (
       SELECT 1 FROM train t WHERE t.user_id = sc.user_id AND t.item_id = sc.item_id)),
recs AS (SELECT * FROM (
       SELECT user_id, item_id, score,
              row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rank
       FROM unseen) WHERE rank <= 10)""")


TOPN_SELECT = """
SELECT user_id, item_id, round(score, 6) AS score, CAST(rank AS BIGINT) AS rank FROM recs"""


@register("user_cf_topn", _user_cf_sql(False) + TOPN_SELECT)
def user_cf_topn(spark: SparkSession, sf: str) -> DataFrame:
    """R2: user CF, K=20 similar users, score Σ w, top 10 unseen."""
    return _topn_out(R.user_cf_topn(_tr(spark, sf), K_NEIGHBORS, N_RECS, weighted=False))


@register("user_cf_topn_weighted", _user_cf_sql(True) + TOPN_SELECT)
def user_cf_topn_weighted(spark: SparkSession, sf: str) -> DataFrame:
    """User CF, score Σ w·r."""
    return _topn_out(R.user_cf_topn(_tr(spark, sf), K_NEIGHBORS, N_RECS, weighted=True))


# --------------------------------------------------------------- E1-E4
def _eval_sql(recs_sql: str) -> str:
    return recs_sql + """,
pop_e AS (SELECT item_id, COUNT(*) AS n FROM train GROUP BY item_id),
rr AS (SELECT r.user_id, r.item_id,
              CASE WHEN EXISTS (SELECT 1 FROM test s WHERE s.user_id = r.user_id
                                AND s.item_id = r.item_id) THEN 1 ELSE 0 END AS hit,
              ln(1 + CAST(p.n AS DOUBLE)) AS lp
       FROM recs r LEFT JOIN pop_e p ON r.item_id = p.item_id),
m AS (SELECT
   (SELECT CAST(SUM(hit) AS BIGINT) FROM rr) AS hits,
   (SELECT CAST(COUNT(*) AS BIGINT) FROM rr) AS n_recs,
   (SELECT CAST(COUNT(DISTINCT item_id) AS BIGINT) FROM rr) AS n_rec_items,
   (SELECT SUM(lp) FROM rr) AS pop_sum,
   (SELECT CAST(COUNT(DISTINCT user_id) AS BIGINT) FROM train) AS n_users,
   (SELECT CAST(COUNT(DISTINCT item_id) AS BIGINT) FROM train) AS n_items,
   (SELECT CAST(COUNT(*) AS BIGINT) FROM test s
     WHERE s.user_id IN (SELECT user_id FROM train)) AS n_test)
"""


def _eval(spark, sf, recs: DataFrame) -> DataFrame:
    m = E.evaluate_topn(recs, _tr(spark, sf), _te(spark, sf), N_RECS)
    return m.select(r6("precision"), r6("recall"), r6("coverage"), r6("popularity"),
                    "hits", "n_recs", "n_users", "n_items", "n_test")


EVAL_SELECT = """
SELECT round(hits / CAST(n_users * 10 AS DOUBLE), 6) AS precision,
       round(hits / CAST(n_test AS DOUBLE), 6) AS recall,
       round(n_rec_items / CAST(n_items AS DOUBLE), 6) AS coverage,
       round(pop_sum / CAST(n_users * 10 AS DOUBLE), 6) AS popularity,
       hits, n_recs, n_users, n_items, n_test FROM m"""


@register("evaluate_topn", _eval_sql(R1_SQL) + EVAL_SELECT)
def evaluate_topn(spark: SparkSession, sf: str) -> DataFrame:
    """E1-E4 in one pass on R1's recommendations."""
    return _eval(spark, sf, item_cf_recs(spark, sf))


@register("evaluate_user_cf", _eval_sql(_user_cf_sql(False)) + EVAL_SELECT)
def evaluate_user_cf(spark: SparkSession, sf: str) -> DataFrame:
    """E1-E4 on R2 (the configuration of the published user-CF figures)."""
    return _eval(spark, sf, R.user_cf_topn(_tr(spark, sf), K_NEIGHBORS, N_RECS))


@register("evaluate_user_cf_weighted", _eval_sql(_user_cf_sql(True)) + EVAL_SELECT)
def evaluate_user_cf_weighted(spark: SparkSession, sf: str) -> DataFrame:
    """E1-E4 on R3."""
    return _eval(spark, sf, R.user_cf_topn(_tr(spark, sf), K_NEIGHBORS, N_RECS, weighted=True))


@register("precision_at_n", _eval_sql(R1_SQL) + """
SELECT round(hits / CAST(n_users * 10 AS DOUBLE), 6) AS precision FROM m""")
def precision_at_n(spark: SparkSession, sf: str) -> DataFrame:
    """Hits / (N x train users) for R1."""
    return evaluate_topn(spark, sf).select("precision")


@register("recall_at_n", _eval_sql(R1_SQL) + """
SELECT round(hits / CAST(n_test AS DOUBLE), 6) AS recall FROM m""")
def recall_at_n(spark: SparkSession, sf: str) -> DataFrame:
    """Hits / test rows of train users, for R1."""
    return evaluate_topn(spark, sf).select("recall")


@register("coverage", _eval_sql(R1_SQL) + """
SELECT round(n_rec_items / CAST(n_items AS DOUBLE), 6) AS coverage FROM m""")
def coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct recommended items / distinct train items, for R1."""
    return evaluate_topn(spark, sf).select("coverage")


@register("popularity", _eval_sql(R1_SQL) + """
SELECT round(pop_sum / CAST(n_users * 10 AS DOUBLE), 6) AS popularity FROM m""")
def popularity(spark: SparkSession, sf: str) -> DataFrame:
    """Mean ln(1 + #raters) per recommendation slot, for R1."""
    return evaluate_topn(spark, sf).select("popularity")


# --------------------------------------------------------------- A1, A10
@register("item_popularity", Q.with_(Q.RATINGS) + """
SELECT item_id, CAST(COUNT(*) AS BIGINT) AS n FROM train GROUP BY item_id""")
def item_popularity(spark: SparkSession, sf: str) -> DataFrame:
    """A1: raters per item in train."""
    return S.member_counts(_tr(spark, sf), "item_id")


@register("cooccurrence", Q.with_(Q.RATINGS, Q.ITEM_COS) + """
SELECT i, j, CAST(c AS BIGINT) AS c FROM co""")
def cooccurrence(spark: SparkSession, sf: str) -> DataFrame:
    """A10: co-rating users per ordered item pair (i != j)."""
    return S.cooccurrence(_tr(spark, sf))


# --------------------------------------------------------------- S1-S11
def _jaccard_sql(group: str, member: str, diag: str | None) -> str:
    d = "" if diag is None else f"""
UNION ALL SELECT {member} AS i, {member} AS j, CAST({diag} AS DOUBLE) AS w
  FROM (SELECT DISTINCT {member} FROM ratings)"""
    return Q.with_(Q.RATINGS, f"""
cnt AS (SELECT {member} AS m, COUNT(*) AS n FROM ratings GROUP BY {member}),
co AS (SELECT a.{member} AS i, b.{member} AS j, COUNT(*) AS c
       FROM ratings a JOIN ratings b ON a.{group} = b.{group} AND a.{member} <> b.{member}
       GROUP BY a.{member}, b.{member}),
jac AS (SELECT co.i, co.j, co.c / CAST(p1.n + p2.n - co.c AS DOUBLE) AS w
        FROM co JOIN cnt p1 ON co.i = p1.m JOIN cnt p2 ON co.j = p2.m{d})""") + """
SELECT i, j, round(w, 6) AS w FROM jac"""


def _sim_out(df: DataFrame) -> DataFrame:
    return df.select("i", "j", r6("w"))


@register("jaccard_items", _jaccard_sql("user_id", "item_id", "1.0"))
def jaccard_items(spark: SparkSession, sf: str) -> DataFrame:
    """Item-item Jaccard of rater sets, both directions, diagonal 1, zero pairs omitted."""
    return _sim_out(S.jaccard(_all(spark, sf), "user_id", "item_id", diagonal=1.0))


@register("jaccard_users", _jaccard_sql("item_id", "user_id", "1.0"))
def jaccard_users(spark: SparkSession, sf: str) -> DataFrame:
    """Row (user) Jaccard, both directions, diagonal 1."""
    return _sim_out(S.jaccard(_all(spark, sf), "item_id", "user_id", diagonal=1.0))


@register("jaccard_rows", _jaccard_sql("item_id", "user_id", "0.0"))
def jaccard_rows(spark: SparkSession, sf: str) -> DataFrame:
    """User Jaccard with the diagonal left at 0 (the double loop skips it)."""
    return _sim_out(S.jaccard(_all(spark, sf), "item_id", "user_id", diagonal=0.0))


@register("jaccard_binary", _jaccard_sql("user_id", "item_id", "1.0"))
def jaccard_binary(spark: SparkSession, sf: str) -> DataFrame:
    """Σab / Σ(a+b-ab) on 0/1 item vectors; full matrix with diagonal 1 (sparse)."""
    return _sim_out(S.similarity(_all(spark, sf), "jaccard", diagonal=True))


@register("similarity_metrics", Q.with_(Q.RATINGS, """
st AS (SELECT item_id AS m, COUNT(*) AS n, SUM(CAST(rating AS DOUBLE) * rating) AS ss FROM ratings GROUP BY 1),
pr AS (SELECT a.item_id AS i, b.item_id AS j, COUNT(*) AS c, SUM(CAST(a.rating AS DOUBLE) * b.rating) AS dot
       FROM ratings a JOIN ratings b ON a.user_id = b.user_id GROUP BY 1, 2)""") + """
SELECT i, j, CAST(floor(2.0 * c / (x.n + y.n) * 1000000 + 0.5) AS BIGINT) AS dice_ppm,
       CAST(floor(c / CAST(least(x.n, y.n) AS DOUBLE) * 1000000 + 0.5) AS BIGINT) AS overlap_ppm,
       CAST(floor(dot / (x.ss + y.ss - dot) * 1000000 + 0.5) AS BIGINT) AS tanimoto_ppm
FROM pr JOIN st x ON x.m = i JOIN st y ON y.m = j""")
def similarity_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """S9 with other metrics: Dice, overlap and Tanimoto of the rating vectors from one pair aggregate, full
    matrix, in parts per million."""
    out = S.similarity(_all(spark, sf), "dice", "overlap", "tanimoto", value="rating", diagonal=True)
    ppm = lambda c, name: F.floor(F.col(c) * 1000000 + 0.5).cast("long").alias(name)  # noqa: E731  engines round ties apart
    return out.select("i", "j", ppm("w", "dice_ppm"), ppm("w2", "overlap_ppm"), ppm("w3", "tanimoto_ppm"))


def _rated_cos_sql(group: str, member: str, both: bool, diag: bool, rows: str = "ratings") -> str:
    cmp = "<>" if both else "<"
    d = """
UNION ALL SELECT m AS i, m AS j, 1.0::DOUBLE AS w FROM nrm WHERE ss > 0""" if diag else ""
    return Q.with_(Q.RATINGS, f"""
nrm AS (SELECT {member} AS m, SUM(CAST(rating AS DOUBLE) * rating) AS ss
        FROM {rows} GROUP BY {member}),
dp AS (SELECT a.{member} AS i, b.{member} AS j,
              SUM(CAST(a.rating AS DOUBLE) * b.rating) AS dot
       FROM {rows} a JOIN {rows} b ON a.{group} = b.{group} AND a.{member} {cmp} b.{member}
       GROUP BY a.{member}, b.{member}),
cs AS (SELECT dp.i, dp.j, dp.dot / (sqrt(p1.ss) * sqrt(p2.ss)) AS w
       FROM dp JOIN nrm p1 ON dp.i = p1.m JOIN nrm p2 ON dp.j = p2.m{d})""") + """
SELECT i, j, round(w, 6) AS w FROM cs"""


@register("cosine_items_rated", _rated_cos_sql("user_id", "item_id", False, False))
def cosine_items_rated(spark: SparkSession, sf: str) -> DataFrame:
    """S3: cosine of item rating columns, i < j only, no diagonal."""
    return _sim_out(S.cosine_rated(_all(spark, sf), "user_id", "item_id", "rating"))


@register("cosine_users_rated", _rated_cos_sql("item_id", "user_id", True, True))
def cosine_users_rated(spark: SparkSession, sf: str) -> DataFrame:
    """Cosine of user rating rows, symmetric, diagonal 1."""
    return _sim_out(S.cosine_rated(_all(spark, sf), "item_id", "user_id", "rating",
                                   both=True, diagonal=True))


@register("cosine_items_cooc", Q.with_(Q.RATINGS, Q.ITEM_COS) + """
SELECT i, j, round(w, 6) AS w FROM isim""")
def cosine_items_cooc(spark: SparkSession, sf: str) -> DataFrame:
    """Binary item cosine from co-occurrence, both directions."""
    return _sim_out(S.cosine_cooc(_tr(spark, sf), "user_id", "item_id"))


@register("cosine_users_cooc", Q.with_(Q.RATINGS, Q.USER_COS) + """
SELECT i, j, round(w, 6) AS w FROM usim""")
def cosine_users_cooc(spark: SparkSession, sf: str) -> DataFrame:
    """Binary user cosine over the inverted index, both directions."""
    return _sim_out(S.cosine_cooc(_tr(spark, sf), "item_id", "user_id"))


def _dist_sql(group: str, member: str) -> str:
    return _rated_cos_sql(group, member, True, True, "train").replace(
        "SELECT i, j, round(w, 6) AS w FROM cs", "SELECT i, j, round(1.0 - w, 6) AS d FROM cs")


@register("cosine_distance_users", _dist_sql("item_id", "user_id"))
def cosine_distance_users(spark: SparkSession, sf: str) -> DataFrame:
    """S6 (users): 1 - cosine, sparse form: every pair not listed has distance 1."""
    sim = S.cosine_rated(_tr(spark, sf), "item_id", "user_id", "rating", both=True, diagonal=True)
    return S.cosine_distance(sim).select("i", "j", r6("d"))


@register("cosine_distance_items", _dist_sql("user_id", "item_id"))
def cosine_distance_items(spark: SparkSession, sf: str) -> DataFrame:
    """S6 (items): 1 - cosine of item columns, sparse form."""
    sim = S.cosine_rated(_tr(spark, sf), "user_id", "item_id", "rating", both=True, diagonal=True)
    return S.cosine_distance(sim).select("i", "j", r6("d"))


_X_SQL = """
xp AS (SELECT item_id AS x FROM ratings GROUP BY item_id ORDER BY COUNT(*) DESC, item_id LIMIT 1)"""


@register("sim_row", _rated_cos_sql("user_id", "item_id", False, False).replace(
    "SELECT i, j, round(w, 6) AS w FROM cs", "").rstrip() + "," + _X_SQL.strip("\n") + """
SELECT CASE WHEN cs.i = xp.x THEN cs.j ELSE cs.i END AS j, round(cs.w, 6) AS w
FROM cs JOIN xp ON cs.i = xp.x OR cs.j = xp.x""")
def sim_row(spark: SparkSession, sf: str) -> DataFrame:
    """Similarity row (S3) of the most rated item."""
    r = _all(spark, sf)
    return S.sim_row(r, _most_popular_item(r)).select("j", r6("w"))


@register("top_k_neighbors", Q.with_(Q.RATINGS, Q.ITEM_COS) + """
SELECT i, j, round(w, 6) AS w, CAST(rk AS BIGINT) AS rank FROM (
  SELECT i, j, w, row_number() OVER (PARTITION BY i ORDER BY w DESC, j) AS rk FROM isim)
WHERE rk <= 20""")
def top_k_neighbors(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 most similar items per item (binary cosine)."""
    nb = S.cosine_neighbors(_tr(spark, sf), K_NEIGHBORS)
    return nb.select("i", "j", r6("w"), "rank")


@register("score_single_item", _rated_cos_sql("user_id", "item_id", False, False).replace(
    "SELECT i, j, round(w, 6) AS w FROM cs", "").rstrip() + "," + _X_SQL.strip("\n") + """,
row_x AS (SELECT CASE WHEN cs.i = xp.x THEN cs.j ELSE cs.i END AS item_id, cs.w
          FROM cs JOIN xp ON cs.i = xp.x OR cs.j = xp.x),
dotu AS (SELECT t.user_id, SUM(t.rating * row_x.w) AS score
         FROM ratings t JOIN row_x ON t.item_id = row_x.item_id GROUP BY t.user_id)
SELECT u.user_id, round(COALESCE(dotu.score, 0.0), 6) AS score
FROM (SELECT DISTINCT user_id FROM ratings) u LEFT JOIN dotu ON u.user_id = dotu.user_id""")
def score_single_item(spark: SparkSession, sf: str) -> DataFrame:
    """Score every user for the most rated item by Σ r_ui · sim(x, i); 0 without overlap."""
    r = _all(spark, sf)
    return R.score_single_item(r, _most_popular_item(r)).select("user_id", r6("score"))


@register("binary_scores", Q.with_(Q.RATINGS, """
cnt AS (SELECT item_id AS m, COUNT(*) AS n FROM ratings GROUP BY item_id),
co AS (SELECT a.item_id AS i, b.item_id AS j, COUNT(*) AS c
       FROM ratings a JOIN ratings b ON a.user_id = b.user_id AND a.item_id <> b.item_id
       GROUP BY a.item_id, b.item_id),
jac AS (SELECT co.i, co.j, co.c / CAST(p1.n + p2.n - co.c AS DOUBLE) AS w
        FROM co JOIN cnt p1 ON co.i = p1.m JOIN cnt p2 ON co.j = p2.m),
sc AS (SELECT t.user_id, jac.j AS item_id, SUM(jac.w) AS score
       FROM ratings t JOIN jac ON t.item_id = jac.i GROUP BY t.user_id, jac.j)""") + """
SELECT user_id, item_id, round(score, 6) AS score FROM sc
WHERE score <> 0 AND NOT EXISTS (SELECT 1 FROM ratings t WHERE t.user_id = sc.user_id
                                 AND t.item_id = sc.item_id)""")
def binary_scores(spark: SparkSession, sf: str) -> DataFrame:
    """(S·a)*(1-a) with item Jaccard S (diagonal 1); seen and zero cells dropped.

    The diagonal only ever scores seen items, which are zeroed, so it is not
    materialised."""
    tr = _all(spark, sf)
    sim = S.jaccard_columns(tr, "user_id", "item_id")
    return R.binary_scores(tr, sim).select("user_id", "item_id", r6("score"))


@register("binary_topn", Q.with_(Q.RATINGS, """
cnt AS (SELECT item_id AS m, COUNT(*) AS n FROM ratings GROUP BY item_id),
co AS (SELECT a.item_id AS i, b.item_id AS j, COUNT(*) AS c
       FROM ratings a JOIN ratings b ON a.user_id = b.user_id AND a.item_id <> b.item_id
       GROUP BY a.item_id, b.item_id),
jac AS (SELECT co.i, co.j, co.c / CAST(p1.n + p2.n - co.c AS DOUBLE) AS w
        FROM co JOIN cnt p1 ON co.i = p1.m JOIN cnt p2 ON co.j = p2.m),
sc AS (SELECT t.user_id, jac.j AS item_id, SUM(jac.w) AS score
       FROM ratings t JOIN jac ON t.item_id = jac.i GROUP BY t.user_id, jac.j)""") + """
SELECT user_id, item_id, round(score, 6) AS score, CAST(rk AS BIGINT) AS rank FROM (
  SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rk
  FROM sc WHERE NOT EXISTS (SELECT 1 FROM ratings t WHERE t.user_id = sc.user_id AND t.item_id = sc.item_id)) WHERE rk <= 10""")
def binary_topn(spark: SparkSession, sf: str) -> DataFrame:
    """R9, the 10 best cells per user, without the grid's rows."""
    tr = _all(spark, sf)
    return R.binary_top_n(tr, S.jaccard_columns(tr, "user_id", "item_id"), 10).select("user_id", "item_id", r6("score"), "rank")
