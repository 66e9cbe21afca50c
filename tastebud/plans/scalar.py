"""Scalar, aggregate, join, set and sort queries (X, A, J, U, K families)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as X
from ..operators import aggregate as A
from ..operators import prep as P
from ..operators import recommend as R
from ..operators import sets as U
from ..operators import similarity as S
from ..operators import topk as K
from ..session import kept
from ..sources import catalog as C
from . import sql as Q
from .cf import R1_SQL, _all, _tr, item_cf_recs
from .registry import register


def r6(c: str):
    return F.round(F.col(c), 6).alias(c)


# ------------------------------------------------------------------ X family
@register("parse_cast", """
SELECT event_id,
       TRY_CAST(trim(string_split(regexp_replace(props, '[{}"]', '', 'g'), ':')[2]) AS INTEGER) AS k
FROM events""")
def parse_cast(spark: SparkSession, sf: str) -> DataFrame:
    """Split the props text on ':', trim, cast to int."""
    ev = C.table(spark, sf, "events")
    return ev.select("event_id", X.parse_field("props", ":", 1, "int", strip_chars='{}"').alias("k"))


@register("recode_missing_rating", Q.with_(Q.USER_MOVIES) + """
SELECT "user", item_id, CASE WHEN "count" = -1 THEN 3 ELSE "count" END AS rating, event_id
FROM user_movies""")
def recode_missing_rating(spark: SparkSession, sf: str) -> DataFrame:
    """Unknown count -1 -> rating 3."""
    um = C.user_movies(spark, sf)
    return um.select("user", "item_id", X.recode_missing("count", -1, 3).alias("rating"), "event_id")


@register("tokenize", """
SELECT doc_id, unnest(string_split(text, ' ')) AS token FROM documents""")
def tokenize(spark: SparkSession, sf: str) -> DataFrame:
    """Split every document on spaces and flatten (whole texts)."""
    d = C.table(spark, sf, "documents").select("doc_id", "text")
    return d.select("doc_id", F.explode(X.tokens("text", " ")).alias("token"))


@register("count_missing_features", Q.with_(Q.WIDE) + """
SELECT id, CAST((acctbal = -1)::INT + (n_events = -1)::INT + (mean_value = -1)::INT
       + (n_types = -1)::INT + (nation = -1)::INT AS BIGINT) AS n_missing
FROM wide""")
def count_missing_features(spark: SparkSession, sf: str) -> DataFrame:
    """Per row, number of feature columns equal to -1 (id/target excluded)."""
    w = C.wide(spark, sf)
    cols = ["acctbal", "n_events", "mean_value", "n_types", "nation"]
    return w.select("id", X.count_equal(cols, -1).alias("n_missing"))


@register("feature_cross", Q.with_(Q.WIDE) + """
SELECT id, round(acctbal * mean_value, 6) AS cross_value FROM wide""")
def feature_cross(spark: SparkSession, sf: str) -> DataFrame:
    """Product of two feature columns."""
    w = C.wide(spark, sf)
    return w.select("id", F.round(X.feature_cross("acctbal", "mean_value"), 6).alias("cross_value"))


@register("drop_columns", Q.with_(Q.WIDE) + """
SELECT id, target, acctbal, nation, segment FROM wide""")
def drop_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Drop the ignored columns (event statistics) from the wide table."""
    return C.wide(spark, sf).drop("n_events", "mean_value", "n_types")


@register("log_popularity", Q.with_(Q.RATINGS) + """
SELECT item_id, round(ln(1 + CAST(COUNT(*) AS DOUBLE)), 6) AS log_pop FROM train GROUP BY item_id""")
def log_popularity(spark: SparkSession, sf: str) -> DataFrame:
    """ln(1 + raters) per item."""
    pop = S.member_counts(_tr(spark, sf), "item_id")
    return pop.select("item_id", F.round(X.log_popularity("n"), 6).alias("log_pop"))


@register("nonzero_filter", Q.with_(Q.RATINGS) + """
SELECT user_id, item_id, rating FROM test t WHERE rating <> 0
AND NOT EXISTS (SELECT 1 FROM train r WHERE r.user_id = t.user_id AND r.item_id = t.item_id)""")
def nonzero_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Rated test cells whose train cell is empty (the evaluation cells)."""
    te = C.test(spark, sf).select("user_id", "item_id", "rating")
    return te.where(F.col("rating") != 0).join(_tr(spark, sf), ["user_id", "item_id"], "left_anti")


_ITEM_MEAN_PRED = """
imean AS (SELECT item_id, AVG(CAST(rating AS DOUBLE)) AS prediction FROM train GROUP BY item_id)"""


def _item_mean_pred(spark, sf):
    return _tr(spark, sf).groupBy("item_id").agg(F.avg(F.col("rating").cast("double")).alias("prediction"))


@register("square_error", Q.with_(Q.RATINGS, _ITEM_MEAN_PRED) + """
SELECT t.user_id, t.item_id, round(power(t.rating - m.prediction, 2), 6) AS se
FROM test t JOIN imean m ON t.item_id = m.item_id""")
def square_error(spark: SparkSession, sf: str) -> DataFrame:
    """X11: (rating - prediction)^2 for test cells, prediction = train item mean."""
    te = C.test(spark, sf).select("user_id", "item_id", "rating")
    j = te.join(_item_mean_pred(spark, sf), "item_id")
    return j.select("user_id", "item_id", F.round(X.square_error("rating", "prediction"), 6).alias("se"))


@register("lookup_user", Q.with_(Q.RATINGS, Q.TOP_USER) + """
SELECT r.user_id, c.c_name, r.item_id, r.rating
FROM ratings r JOIN top_user ON r.user_id = top_user.x JOIN customer c ON c.c_custkey = r.user_id""")
def lookup_user(spark: SparkSession, sf: str) -> DataFrame:
    """The most active user's name and own rows (equality filter)."""
    r = C.ratings(spark, sf).select("user_id", "item_id", "rating")
    top = A.most_active(r, "user_id")
    cu = C.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
    return r.join(F.broadcast(top), "user_id").join(cu, "user_id").select(
        "user_id", "c_name", "item_id", "rating")


@register("lookup_in_set", Q.with_(Q.RATINGS, Q.TOP_USER) + """
SELECT p.p_partkey, p.p_name FROM part p
WHERE p.p_partkey IN (SELECT r.item_id FROM ratings r JOIN top_user ON r.user_id = top_user.x)""")
def lookup_in_set(spark: SparkSession, sf: str) -> DataFrame:
    """Items (part rows) in the set of the most active user's items (semi join)."""
    r = C.ratings(spark, sf).select("user_id", "item_id")
    top = A.most_active(r, "user_id")
    items = r.join(F.broadcast(top), "user_id").select(F.col("item_id").alias("p_partkey"))
    part = C.table(spark, sf, "part").select("p_partkey", "p_name")
    return part.join(items, "p_partkey", "left_semi")


@register("embedding_width", Q.with_(Q.WIDE) + """
SELECT feature, card, CAST(least(card, floor(6 * power(card, 0.25))) AS BIGINT) AS width FROM (
  SELECT 'nation' AS feature, CAST(COUNT(DISTINCT nation) AS BIGINT) AS card FROM wide
  UNION ALL SELECT 'segment', CAST(COUNT(DISTINCT segment) AS BIGINT) FROM wide)""")
def embedding_width(spark: SparkSession, sf: str) -> DataFrame:
    """Embedding width min(card, int(6 card^1/4)) per categorical column."""
    w = C.wide(spark, sf)
    card = A.distinct_per_column(w, list(C.WIDE_CATEGORICAL))
    return card.select("feature", "card", X.embedding_width("card").alias("width"))


# ------------------------------------------------------------------ A family
@register("distinct_counts", Q.with_(Q.RATINGS) + """
SELECT CAST(COUNT(DISTINCT user_id) AS BIGINT) AS n_users,
       CAST(COUNT(DISTINCT item_id) AS BIGINT) AS n_items,
       CAST(COUNT(*) AS BIGINT) AS n_ratings FROM ratings""")
def distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A2: number of users, items and ratings."""
    return A.distinct_counts(C.ratings(spark, sf))


@register("distinct_counts_sketch", Q.with_(Q.RATINGS) + """
SELECT CAST(COUNT(*) AS BIGINT) AS n_ratings, TRUE AS users_close, TRUE AS items_close FROM ratings""")
def distinct_counts_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """A2 by sketches: one per rating value, united; whether they are within 2 % of the exact counts."""
    r = C.ratings(spark, sf)
    near = A.united_counts(A.distinct_sketches(r, ["user_id", "item_id"], by=["rating"]), ["user_id", "item_id"])
    exact = F.broadcast(A.distinct_counts(r))
    close = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.col(b) * 0.02
    return near.join(exact, F.col("n_rows") == F.col("n_ratings")).select(
        "n_ratings", close("user_id", "n_users").alias("users_close"), close("item_id", "n_items").alias("items_close"))


@register("id_stats", Q.with_(Q.RATINGS) + """
SELECT 'user' AS kind, CAST(COUNT(*) AS BIGINT) AS n, round(AVG(u), 6) AS mean,
       round(stddev_pop(u), 6) AS stdev, CAST(MAX(u) AS DOUBLE) AS max, CAST(MIN(u) AS DOUBLE) AS min
FROM (SELECT DISTINCT user_id AS u FROM ratings)
UNION ALL
SELECT 'item', CAST(COUNT(*) AS BIGINT), round(AVG(u), 6), round(stddev_pop(u), 6),
       CAST(MAX(u) AS DOUBLE), CAST(MIN(u) AS DOUBLE)
FROM (SELECT DISTINCT item_id AS u FROM ratings)""")
def id_stats(spark: SparkSession, sf: str) -> DataFrame:
    """A3: count, mean, population sd, max, min of the distinct user and item ids."""
    r = C.ratings(spark, sf)
    return A.id_stats(r, "user_id", "user").unionByName(A.id_stats(r, "item_id", "item")).select(
        "kind", "n", r6("mean"), r6("stdev"), "max", "min")


@register("user_history", Q.with_(Q.RATINGS) + """
SELECT user_id, array_to_string(list(item_id ORDER BY item_id), ',') AS items,
       array_to_string(list(rating ORDER BY item_id), ',') AS ratings
FROM ratings GROUP BY user_id""")
def user_history(spark: SparkSession, sf: str) -> DataFrame:
    """A4: each user's (item, rating) history, concatenated in item order."""
    h = A.user_history(C.ratings(spark, sf))
    return h.select("user_id", X.join_ints("items").alias("items"), X.join_ints("ratings").alias("ratings"))


@register("membership_sets", Q.with_(Q.RATINGS) + """
SELECT item_id, array_to_string(list(DISTINCT user_id ORDER BY user_id), ',') AS users
FROM ratings GROUP BY item_id""")
def membership_sets(spark: SparkSession, sf: str) -> DataFrame:
    """A5: the set of raters of each item (sorted array)."""
    m = A.membership_sets(_all(spark, sf), "item_id", "user_id", "users")
    return m.select("item_id", X.join_ints("users").alias("users"))


@register("sparsity", Q.with_(Q.RATINGS) + """
SELECT round(1.0 - COUNT(*) / CAST(COUNT(DISTINCT user_id) * COUNT(DISTINCT item_id) AS DOUBLE), 3)
       AS sparsity FROM ratings""")
def sparsity(spark: SparkSession, sf: str) -> DataFrame:
    """1 - ratings / (users x items), 3 decimals."""
    return A.sparsity(C.ratings(spark, sf))


@register("user_mean", Q.with_(Q.RATINGS) + """
SELECT t.user_id, round(SUM(t.rating) / CAST((SELECT COUNT(DISTINCT item_id) FROM ratings) AS DOUBLE), 6)
       AS mean FROM train t GROUP BY t.user_id""")
def user_mean(spark: SparkSession, sf: str) -> DataFrame:
    """User mean over all item columns, unrated cells counted as 0."""
    m = A.user_mean_dense(_tr(spark, sf), C.ratings(spark, sf))
    return m.select("user_id", r6("mean"))


@register("word_count", """
SELECT token, CAST(COUNT(*) AS BIGINT) AS n FROM (
  SELECT unnest(string_split(text, ' ')) AS token FROM documents) GROUP BY token""")
def word_count(spark: SparkSession, sf: str) -> DataFrame:
    """Count per token over all documents (map-side partial counts)."""
    d = C.table(spark, sf, "documents").select("text")
    return A.word_count(d.select(F.explode(X.tokens("text")).alias("token")))


@register("mean_sq_error", Q.with_(Q.RATINGS, _ITEM_MEAN_PRED) + """
SELECT round(AVG(power(t.rating - m.prediction, 2)), 6) AS mse, CAST(COUNT(*) AS BIGINT) AS n
FROM test t JOIN imean m ON t.item_id = m.item_id""")
def mean_sq_error(spark: SparkSession, sf: str) -> DataFrame:
    """Mean squared error of the train item-mean prediction on test cells."""
    from ..operators.evaluate import mse
    te = C.test(spark, sf).select("user_id", "item_id", "rating")
    pred = te.select("user_id", "item_id").join(_item_mean_pred(spark, sf), "item_id")
    return mse(pred, te).select(r6("mse"), "n")


# ------------------------------------------------------------------ J family
@register("enrich_names", R1_SQL + """
SELECT r.user_id, r.item_id, COALESCE(p.p_name, '') AS name
FROM recs r LEFT JOIN part p ON r.item_id = p.p_partkey""")
def enrich_names(spark: SparkSession, sf: str) -> DataFrame:
    """Item names on R1's recommendations, missing name -> ''."""
    recs = kept(item_cf_recs(spark, sf))        # read for its hot items and for the join
    names = C.item_names(spark, sf)
    return A.enrich(recs.select("user_id", "item_id"), names, "item_id", "name")


@register("ratings_with_predictions", Q.with_(Q.RATINGS, _ITEM_MEAN_PRED) + """
SELECT t.user_id, t.item_id, t.rating, round(m.prediction, 6) AS prediction
FROM test t JOIN imean m ON t.item_id = m.item_id""")
def ratings_with_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Test ratings joined with predictions on (user, item)."""
    te = C.test(spark, sf).select("user_id", "item_id", "rating")
    pred = te.select("user_id", "item_id").join(_item_mean_pred(spark, sf), "item_id")
    return te.join(pred, ["user_id", "item_id"]).select("user_id", "item_id", "rating", r6("prediction"))


@register("pair_by_user", Q.with_(Q.RATINGS) + """
SELECT a.user_id, a.item_id AS i, b.item_id AS j
FROM train a JOIN train b ON a.user_id = b.user_id AND a.item_id < b.item_id""")
def pair_by_user(spark: SparkSession, sf: str) -> DataFrame:
    """Every item pair i < j within a user (block-salted self-join)."""
    from ..operators.pairs import pairs_within
    p = pairs_within(_tr(spark, sf).select("user_id", "item_id"), "user_id", "item_id")
    return p.select("user_id", F.col("item_id_1").alias("i"), F.col("item_id_2").alias("j"))


@register("pair_by_item", Q.with_(Q.RATINGS) + """
SELECT a.item_id, a.user_id AS u, b.user_id AS v
FROM train a JOIN train b ON a.item_id = b.item_id AND a.user_id < b.user_id""")
def pair_by_item(spark: SparkSession, sf: str) -> DataFrame:
    """Every user pair u < v within an item."""
    from ..operators.pairs import pairs_within
    p = pairs_within(_tr(spark, sf).select("user_id", "item_id"), "item_id", "user_id")
    return p.select("item_id", F.col("user_id_1").alias("u"), F.col("user_id_2").alias("v"))


@register("exclude_seen", Q.with_(Q.RATINGS, Q.IMPLICIT) + """
SELECT DISTINCT user_id, item_id FROM implicit i
WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = i.user_id AND r.item_id = i.item_id)""")
def exclude_seen(spark: SparkSession, sf: str) -> DataFrame:
    """Implicit-feedback (user, item) pairs the user has not rated (anti join)."""
    im = C.implicit(spark, sf).select("user_id", "item_id").distinct()
    return R.exclude_seen(im, C.ratings(spark, sf))


@register("hits", R1_SQL + """
SELECT r.user_id, r.item_id FROM recs r
WHERE EXISTS (SELECT 1 FROM test t WHERE t.user_id = r.user_id AND t.item_id = r.item_id)""")
def hits(spark: SparkSession, sf: str) -> DataFrame:
    """R1 recommendations that are in the test set (semi join)."""
    recs = item_cf_recs(spark, sf).select("user_id", "item_id")
    te = C.test(spark, sf).select("user_id", "item_id")
    return recs.join(te, ["user_id", "item_id"], "left_semi")


# ------------------------------------------------------------------ U family
@register("concat_train_test", Q.with_(Q.RATINGS) + """
SELECT user_id, item_id, rating, 'train' AS part FROM train
UNION ALL SELECT user_id, item_id, rating, 'test' AS part FROM test""")
def concat_train_test(spark: SparkSession, sf: str) -> DataFrame:
    """Stack train and test (by name)."""
    tr = _tr(spark, sf).withColumn("part", F.lit("train"))
    te = C.test(spark, sf).select("user_id", "item_id", "rating").withColumn("part", F.lit("test"))
    return U.concat(tr, te)


@register("set_difference", Q.with_(Q.RATINGS) + """
SELECT user_id, item_id, rating FROM ratings
EXCEPT ALL SELECT user_id, item_id, rating FROM train""")
def set_difference(spark: SparkSession, sf: str) -> DataFrame:
    """All ratings minus train (= test), multiset difference."""
    r = C.ratings(spark, sf).select("user_id", "item_id", "rating")
    return U.difference(r, _tr(spark, sf))


@register("set_intersect_size", Q.with_(Q.RATINGS, """
cnt AS (SELECT item_id, COUNT(*) AS n FROM ratings GROUP BY item_id)""") + """
SELECT a.item_id AS i, b.item_id AS j, CAST(COUNT(*) AS BIGINT) AS inter,
       CAST(MIN(ca.n) + MIN(cb.n) - COUNT(*) AS BIGINT) AS uni
FROM ratings a JOIN ratings b ON a.user_id = b.user_id AND a.item_id < b.item_id
JOIN cnt ca ON ca.item_id = a.item_id JOIN cnt cb ON cb.item_id = b.item_id
GROUP BY a.item_id, b.item_id""")
def set_intersect_size(spark: SparkSession, sf: str) -> DataFrame:
    """|A_i ∩ A_j| and |A_i ∪ A_j| of item rater sets, i < j, non-empty intersections."""
    return U.intersect_union_sizes(_all(spark, sf), "user_id", "item_id")


@register("concat_columns", Q.with_(Q.WIDE) + """
SELECT id, segment, nation,
       round((acctbal - AVG(acctbal) OVER ()) / stddev_pop(acctbal) OVER (), 6) AS acctbal,
       round((mean_value - AVG(mean_value) OVER ()) / stddev_pop(mean_value) OVER (), 6) AS mean_value
FROM wide""")
def concat_columns(spark: SparkSession, sf: str) -> DataFrame:
    """U4: categorical columns beside standardised continuous ones, one pass."""
    w = C.wide(spark, sf)
    z = P.standardize(w, ["acctbal", "mean_value"], keep=["id", "segment", "nation"])
    return z.select("id", "segment", "nation", r6("acctbal"), r6("mean_value"))


# ------------------------------------------------------------------ K family
@register("top_n_per_user", Q.with_(Q.RATINGS) + """
SELECT user_id, item_id, rating, CAST(rk AS BIGINT) AS rank FROM (
  SELECT user_id, item_id, rating,
         row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rk FROM ratings)
WHERE rk <= 5""")
def top_n_per_user(spark: SparkSession, sf: str) -> DataFrame:
    """K1: each user's 5 best rated items (ties: item id)."""
    r = C.ratings(spark, sf).select("user_id", "item_id", "rating")
    return K.top_n_per_group(r, "user_id", "rating", "item_id", 5, round_decimals=None)


@register("global_sort_desc", Q.with_(Q.RATINGS) + """
SELECT item_id, CAST(n AS BIGINT) AS n, CAST(row_number() OVER (ORDER BY n DESC, item_id) AS BIGINT) AS pos
FROM (SELECT item_id, COUNT(*) AS n FROM ratings GROUP BY item_id)""")
def global_sort_desc(spark: SparkSession, sf: str) -> DataFrame:
    """K2: all items by popularity descending, with their global position."""
    pop = S.member_counts(C.ratings(spark, sf), "item_id")
    return K.global_sort_desc(pop, "n", "item_id")


@register("take_n", Q.with_(Q.RATINGS) + """
SELECT user_id, item_id, rating FROM ratings ORDER BY user_id, item_id LIMIT 3""")
def take_n(spark: SparkSession, sf: str) -> DataFrame:
    """K3: deterministic 3-row preview (first rows in key order)."""
    r = C.ratings(spark, sf).select("user_id", "item_id", "rating")
    return K.take_n(r, 3, ["user_id", "item_id"])


@register("sort_by_key", Q.with_(Q.RATINGS) + """
SELECT user_id, item_id, CAST(row_number() OVER (ORDER BY user_id, item_id) AS BIGINT) AS pos
FROM ratings""")
def sort_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """K4: ratings in user order with their output position."""
    r = C.ratings(spark, sf).select("user_id", "item_id")
    return K.sort_by_key(r, ["user_id", "item_id"])


@register("sorted_pairs", Q.with_(Q.RATINGS) + """
SELECT user_id, array_to_string(list(item_id ORDER BY item_id), ',') AS items
FROM ratings GROUP BY user_id""")
def sorted_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """K5: each user's train items ascending inside the row."""
    tr = _all(spark, sf)
    g = tr.groupBy("user_id").agg(K.sorted_pairs(F.collect_list("item_id")).alias("items"))
    return g.select("user_id", X.join_ints("items").alias("items"))


@register("set_union_size", Q.with_(Q.RATINGS, """
cnt AS (SELECT item_id, COUNT(*) AS n FROM ratings GROUP BY item_id)""") + """
SELECT a.item_id AS i, b.item_id AS j,
       CAST(MIN(ca.n) + MIN(cb.n) - COUNT(*) AS BIGINT) AS uni
FROM ratings a JOIN ratings b ON a.user_id = b.user_id AND a.item_id < b.item_id
JOIN cnt ca ON ca.item_id = a.item_id JOIN cnt cb ON cb.item_id = b.item_id
GROUP BY a.item_id, b.item_id""")
def set_union_size(spark: SparkSession, sf: str) -> DataFrame:
    """|A_i ∪ A_j| of item rater sets for pairs with a common rater (i < j)."""
    return U.intersect_union_sizes(_all(spark, sf), "user_id", "item_id").select("i", "j", "uni")


@register("first", Q.with_(Q.RATINGS) + """
SELECT user_id, item_id, rating FROM ratings ORDER BY user_id, item_id LIMIT 1""")
def first(spark: SparkSession, sf: str) -> DataFrame:
    """K3: the first rating in key order (a deterministic ``first()``)."""
    r = C.ratings(spark, sf).select("user_id", "item_id", "rating")
    return K.take_n(r, 1, ["user_id", "item_id"])
