"""Preparation queries (P1-P14) on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as X
from ..operators import prep as P
from ..sources import catalog as C
from . import sql as Q
from .registry import register


def r6(c: str):
    return F.round(F.col(c), 6).alias(c)


@register("dedupe_last", Q.with_(Q.RATINGS) + """
SELECT user_id, item_id, rating FROM ratings""")
def dedupe_last(spark: SparkSession, sf: str) -> DataFrame:
    """One rating per (customer, part), the last order line wins."""
    li = C.table(spark, sf, "lineitem")
    od = C.table(spark, sf, "orders")
    j = li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
        F.ceil(F.col("l_quantity") / F.lit(10.0)).cast("int").alias("rating"),
        "o_orderdate", "l_orderkey", "l_linenumber", "l_quantity")
    return P.dedupe_last(j, ["user_id", "item_id"],
                         ["o_orderdate", "l_orderkey", "l_linenumber", "l_quantity"], ["rating"])


@register("build_id_map", Q.with_(Q.RATINGS) + """
SELECT c_name, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS INTEGER) AS idx
FROM (SELECT DISTINCT c.c_name FROM ratings r JOIN customer c ON r.user_id = c.c_custkey)""")
def build_id_map(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct string user (customer name) -> consecutive 32-bit index."""
    cu = C.table(spark, sf, "customer").select("c_custkey", "c_name")
    r = C.ratings(spark, sf).select("user_id")
    names = r.join(cu, r.user_id == cu.c_custkey).select("c_name")
    return P.build_id_map(names, "c_name")


@register("apply_id_map", Q.with_(Q.RATINGS, """
idm AS (SELECT c_name, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS INTEGER) AS idx
        FROM (SELECT DISTINCT c.c_name FROM ratings r JOIN customer c ON r.user_id = c.c_custkey))""") + """
SELECT idm.idx AS user_idx, r.item_id, r.rating
FROM ratings r JOIN customer c ON r.user_id = c.c_custkey JOIN idm ON c.c_name = idm.c_name""")
def apply_id_map(spark: SparkSession, sf: str) -> DataFrame:
    """Ratings keyed by the string user name, mapped through the P2 index."""
    cu = C.table(spark, sf, "customer").select("c_custkey", "c_name")
    r = C.ratings(spark, sf)
    named = r.join(cu, r.user_id == cu.c_custkey).select("c_name", "item_id", "rating")
    idm = P.build_id_map(named, "c_name")
    return P.apply_id_map(named, idm, "c_name").select(
        F.col("idx").alias("user_idx"), "item_id", "rating")


@register("split_bernoulli", Q.with_(Q.RATINGS) + """
SELECT user_id, item_id, (user_id * 31 + item_id * 17) % 10 < 7 AS is_train FROM ratings""")
def split_bernoulli(spark: SparkSession, sf: str) -> DataFrame:
    """70:30 split by arithmetic hash (the RNG form is ``prep.random_split``)."""
    return P.hash_split(C.ratings(spark, sf).select("user_id", "item_id"))


@register("split_mk", Q.with_(Q.RATINGS) + """
SELECT user_id, item_id, rating FROM ratings
WHERE (user_id * 31 + item_id * 17 + 42) % 9 = 3""")
def split_mk(spark: SparkSession, sf: str) -> DataFrame:
    """Test fold k=3 of M=8 (so 9 folds), seed 42."""
    r = C.ratings(spark, sf).select("user_id", "item_id", "rating")
    return r.where(P.split_mk(r, 8, 3, 42))


@register("split_exact", Q.with_(Q.RATINGS) + """
SELECT user_id, item_id, rn <= ceil(0.25 * n) AS in_test FROM (
  SELECT user_id, item_id,
         row_number() OVER (ORDER BY ((user_id % 2147483648) * 2654435761 + item_id * 40503) % 4294967296,
                            user_id, item_id) AS rn,
         COUNT(*) OVER () AS n
  FROM ratings)""")
def split_exact(spark: SparkSession, sf: str) -> DataFrame:
    """P5: exact 25 % test split (ceil), hash order."""
    return P.split_exact(C.ratings(spark, sf).select("user_id", "item_id"), 0.25)


@register("stratified_kfold", """
SELECT doc_id, quality, CAST((rn - 1) % 3 AS BIGINT) AS fold FROM (
  SELECT doc_id, quality,
         row_number() OVER (PARTITION BY quality
                            ORDER BY ((doc_id % 2147483648) * 2654435761) % 4294967296, doc_id) AS rn
  FROM labels)""")
def stratified_kfold(spark: SparkSession, sf: str) -> DataFrame:
    """3 class-balanced folds of ``labels`` by quality."""
    lb = C.table(spark, sf, "labels").select("doc_id", "quality")
    return P.stratified_kfold(lb, "quality", "doc_id", 3)


@register("negative_sample", Q.with_(Q.RATINGS, """
pos AS (SELECT DISTINCT user_id, item_id FROM ratings),
pool AS (SELECT item_id AS pi, row_number() OVER (ORDER BY item_id, user_id) - 1 AS idx FROM pos),
psize AS (SELECT COUNT(*) AS P FROM pos),
nu AS (SELECT user_id, COUNT(*) AS n FROM pos GROUP BY user_id),
d0 AS (SELECT nu.user_id, nu.n, t.t, ((nu.user_id % 2147483648) * 2654435761 + t.t * 40503 + 12345) % 2147483647 AS x
       FROM nu, LATERAL (SELECT unnest(generate_series(1, nu.n * 3)) AS t) t),
d1 AS (SELECT *, (x * (x % 65537 + 1)) % 2147483647 AS a FROM d0),
d2 AS (SELECT *, (a * 48271 + t) % 2147483647 AS y FROM d1),
draws AS (SELECT user_id, n, t, (a * 2147483647 + (y * (y % 65537 + 1)) % 2147483647) % psize.P AS idx FROM d2 CROSS JOIN psize),
drawn AS (SELECT d.user_id, d.n, d.t, pool.pi AS item_id FROM draws d JOIN pool ON d.idx = pool.idx
          WHERE NOT EXISTS (SELECT 1 FROM pos WHERE pos.user_id = d.user_id AND pos.item_id = pool.pi)),
firsts AS (SELECT user_id, item_id, MIN(t) AS t, MIN(n) AS n FROM drawn GROUP BY user_id, item_id),
neg AS (SELECT user_id, item_id FROM (
          SELECT user_id, item_id, n, row_number() OVER (PARTITION BY user_id ORDER BY t) AS r
          FROM firsts) WHERE r <= n + 1)""") + """
SELECT user_id, item_id, 1 AS label FROM pos
UNION ALL SELECT user_id, item_id, 0 AS label FROM neg""")
def negative_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Train positives + up to n+1 popularity-weighted negatives per user."""
    tr = C.ratings(spark, sf).select("user_id", "item_id")
    return P.negative_sample(tr)


@register("ratings_to_sparse", Q.with_(Q.RATINGS) + """
SELECT user_id, (SELECT MAX(item_id) + 1 FROM ratings) AS size,
       array_to_string(list(item_id ORDER BY item_id), ',') AS indices,
       array_to_string(list(printf('%.6f', CAST(rating AS DOUBLE)) ORDER BY item_id), ',') AS "values"
FROM ratings GROUP BY user_id""")
def ratings_to_sparse(spark: SparkSession, sf: str) -> DataFrame:
    """Per user sparse vector (size = max item id + 1, sorted indices, values)."""
    s = P.ratings_to_sparse(C.ratings(spark, sf))
    return s.select("user_id", "size", X.join_ints("indices").alias("indices"),
                    X.join_fixed("values").alias("values"))


_DICT_SQL = """
_cats AS (
  SELECT DISTINCT 'nation' AS feature, 1 AS fp, CAST(nation AS VARCHAR) AS value FROM wide
  UNION ALL SELECT DISTINCT 'segment', 2, segment FROM wide),
_slots AS (
  SELECT feature, fp, COUNT(*) AS slots FROM _cats GROUP BY feature, fp
  UNION ALL SELECT * FROM (VALUES ('acctbal', 0, 1), ('n_events', 3, 1),
                                  ('mean_value', 4, 1), ('n_types', 5, 1)) v(feature, fp, slots)),
_off AS (SELECT feature, fp, slots,
                COALESCE(SUM(slots) OVER (ORDER BY fp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
         FROM _slots),
fdict AS (
  SELECT c.feature, c.value,
         CAST(o.off + row_number() OVER (PARTITION BY c.feature ORDER BY c.value) - 1 AS BIGINT) AS idx
  FROM _cats c JOIN _off o ON c.feature = o.feature
  UNION ALL
  SELECT feature, CAST(NULL AS VARCHAR) AS value, CAST(off AS BIGINT) AS idx
  FROM _off WHERE feature IN ('acctbal', 'n_events', 'mean_value', 'n_types'))"""


@register("feature_dictionary", Q.with_(Q.WIDE, _DICT_SQL) + """
SELECT feature, value, idx FROM fdict""")
def feature_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """P10: slot per numeric column, slot per categorical value, running offsets."""
    w = C.wide(spark, sf)
    return P.feature_dictionary(w, C.WIDE_NUMERIC, C.WIDE_CATEGORICAL, C.WIDE_ORDER)


@register("encode_features", Q.with_(Q.WIDE, _DICT_SQL, """
_long AS (
  SELECT id, 0 AS fp, 'acctbal' AS feature, CAST(NULL AS VARCHAR) AS value, acctbal AS xv FROM wide
  UNION ALL SELECT id, 1, 'nation', CAST(nation AS VARCHAR), 1.0 FROM wide
  UNION ALL SELECT id, 2, 'segment', segment, 1.0 FROM wide
  UNION ALL SELECT id, 3, 'n_events', NULL, CAST(n_events AS DOUBLE) FROM wide
  UNION ALL SELECT id, 4, 'mean_value', NULL, mean_value FROM wide
  UNION ALL SELECT id, 5, 'n_types', NULL, CAST(n_types AS DOUBLE) FROM wide)""") + """
SELECT l.id, array_to_string(list(d.idx ORDER BY l.fp), ',') AS xi,
       array_to_string(list(printf('%.6f', round(l.xv, 6)) ORDER BY l.fp), ',') AS xv
FROM _long l LEFT JOIN fdict d ON l.feature = d.feature AND l.value IS NOT DISTINCT FROM d.value
GROUP BY l.id""")
def encode_features(spark: SparkSession, sf: str) -> DataFrame:
    """Every wide row -> (xi, xv) index/value lists via the P10 dictionary."""
    w = C.wide(spark, sf)
    d = P.feature_dictionary(w, C.WIDE_NUMERIC, C.WIDE_CATEGORICAL, C.WIDE_ORDER)
    e = P.encode_features(w, "id", d, C.WIDE_NUMERIC, C.WIDE_CATEGORICAL, C.WIDE_ORDER)
    return e.select("id", X.join_ints("xi").alias("xi"),
                    X.join_fixed(F.transform("xv", lambda v: F.round(v, 6))).alias("xv"))


@register("onehot_user_item", Q.with_(Q.RATINGS) + """
SELECT t.user_id, t.item_id, t.rating,
       CAST(dense_rank() OVER (ORDER BY t.user_id) - 1 AS BIGINT) AS user_idx,
       CAST((SELECT COUNT(DISTINCT user_id) FROM ratings)
            + dense_rank() OVER (ORDER BY t.item_id) - 1 AS BIGINT) AS item_idx
FROM ratings t""")
def onehot_user_item(spark: SparkSession, sf: str) -> DataFrame:
    """One-hot positions of user and item (two groups) for every train row."""
    tr = C.ratings(spark, sf).select("user_id", "item_id", "rating")
    return P.onehot_user_item(tr).select("user_id", "item_id", "rating", "user_idx", "item_idx")


@register("standardize", Q.with_(Q.WIDE) + """
SELECT id, round((acctbal - AVG(acctbal) OVER ()) / stddev_pop(acctbal) OVER (), 6) AS acctbal,
       round((n_events - AVG(n_events) OVER ()) / stddev_pop(n_events) OVER (), 6) AS n_events,
       round((mean_value - AVG(mean_value) OVER ()) / stddev_pop(mean_value) OVER (), 6) AS mean_value
FROM wide""")
def standardize(spark: SparkSession, sf: str) -> DataFrame:
    """Z-scores (population sd) of the continuous wide columns."""
    z = P.standardize(C.wide(spark, sf), ["acctbal", "n_events", "mean_value"], keep=["id"])
    return z.select("id", r6("acctbal"), r6("n_events"), r6("mean_value"))


@register("onehot_label", """
SELECT vec_id, label,
       array_to_string(list_transform(range(0, (SELECT MAX(label) + 1 FROM embeddings)),
                      lambda k: CAST(label = k AS INTEGER)), ',') AS onehot
FROM embeddings""")
def onehot_label(spark: SparkSession, sf: str) -> DataFrame:
    """Embedding class label -> one-hot array."""
    e = C.table(spark, sf, "embeddings").select("vec_id", "label")
    o = P.onehot_label(e, "label")
    return o.select("vec_id", "label", X.join_ints("onehot").alias("onehot"))


@register("onehot_to_index", """
SELECT vec_id, CAST(list_sum(list_transform(range(0, (SELECT MAX(label) + 1 FROM embeddings)),
                   lambda k: CAST(label = k AS BIGINT) * k)) AS BIGINT) AS label_idx
FROM embeddings""")
def onehot_to_index(spark: SparkSession, sf: str) -> DataFrame:
    """One-hot group -> ordinal (applied to the P14 one-hot labels)."""
    e = P.onehot_label(C.table(spark, sf, "embeddings").select("vec_id", "label"), "label")
    return e.select("vec_id", X.onehot_to_index(array="onehot").alias("label_idx"))


@register("split_random")
def split_random(spark: SparkSession, sf: str) -> DataFrame:
    """P3 (RNG form): seeded Bernoulli 70:30 split with Spark's sampler; each rating
    lands in exactly one side (no oracle: the draws are Spark's own)."""
    r = C.ratings(spark, sf).select("user_id", "item_id", "rating")
    tr, te = P.random_split(r, 0.7, seed=0)
    return tr.withColumn("is_train", F.lit(True)).unionByName(te.withColumn("is_train", F.lit(False)))
