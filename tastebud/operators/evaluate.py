"""Evaluation operators (E1-E11) as aggregates over joined tables.

Each metric is one aggregate (partial on the map side); scalar results are
combined by an equi-join on a constant key of single-row frames, never by a
driver-side loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, kept
from . import pairs as P
from .similarity import member_counts


def _one(df: DataFrame) -> DataFrame:
    return df.withColumn("_k", F.lit(0))


def evaluate_topn(recs: DataFrame, train: DataFrame, test: DataFrame, n: int,
                  user: str = "user_id", item: str = "item_id",
                  denominator: str = "fixed", users_limit: int | None = None) -> DataFrame:
    """E1-E4 in one pass: precision, recall, coverage, popularity.

    ``denominator='fixed'`` divides by N x (#train users) as the classic CF
    evaluation loop does; ``'actual'`` by the number of recommendations made.
    Recall counts test rows of train users only.  Coverage is distinct
    recommended items over distinct train items; popularity is the mean of
    ``ln(1 + #raters)`` (train popularity) per recommendation slot.
    ``users_limit`` evaluates the first so many train users (by id) only.
    """
    users = train.select(user).distinct()
    if users_limit is not None:
        users = users.orderBy(user).limit(users_limit)
        recs, test = (x.join(users, user, "left_semi") for x in (recs, test))
    # read three times below, and often the result of a whole recommender
    recs = kept(recs.select(user, item))
    pop = member_counts(train, item, "_pop")
    t = test.select(user, item).withColumn("_hit", F.lit(1))
    # an item recommended to many users is salted by user
    rr = P.salted_join(recs.select(user, item).join(t, [user, item], "left"), pop, item, user, how="left")
    rec_agg = _one(rr.agg(
        F.coalesce(F.sum("_hit"), F.lit(0)).cast("bigint").alias("hits"),
        F.count(F.lit(1)).cast("bigint").alias("n_recs"),
        F.countDistinct(item).cast("bigint").alias("n_rec_items"),
        F.coalesce(F.sum(F.log1p(F.col("_pop").cast("double"))), F.lit(0.0)).alias("pop_sum")))
    tr_agg = _one(train.agg(F.countDistinct(item).cast("bigint").alias("n_items")))
    us_agg = _one(users.agg(F.count(user).cast("bigint").alias("n_users")))
    te_agg = _one(test.join(users, user, "left_semi").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_test")))
    m = rec_agg.join(tr_agg, "_k").join(us_agg, "_k").join(te_agg, "_k")
    if denominator == "fixed":
        slots = F.col("n_users") * F.lit(n)
    elif denominator == "actual":
        slots = F.col("n_recs")
    else:
        raise ValueError("denominator must be 'fixed' or 'actual'")
    return m.select(
        (F.col("hits") / slots).alias("precision"),
        (F.col("hits") / F.col("n_test")).alias("recall"),
        (F.col("n_rec_items") / F.col("n_items")).alias("coverage"),
        (F.col("pop_sum") / slots).alias("popularity"),
        "hits", "n_recs", "n_users", "n_items", "n_test")


def rmse(pred: DataFrame, truth: DataFrame, keys=("user_id", "item_id"),
         pred_col: str = "prediction", truth_col: str = "rating") -> DataFrame:
    """E5: root mean squared error over cells with a non-zero truth."""
    j = truth.where(F.col(truth_col) != 0).select(*keys, truth_col).join(
        pred.select(*keys, pred_col), list(keys))
    return j.agg(F.sqrt(F.avg((F.col(pred_col) - F.col(truth_col)) ** 2)).alias("rmse"),
                 F.count(F.lit(1)).cast("bigint").alias("n"))


def mse(pred: DataFrame, truth: DataFrame, keys=("user_id", "item_id"),
        pred_col: str = "prediction", truth_col: str = "rating") -> DataFrame:
    """Mean of squared errors over the (inner) join of truth and predictions."""
    j = truth.select(*keys, truth_col).join(pred.select(*keys, pred_col), list(keys))
    return j.agg(F.avg((F.col(truth_col).cast("double") - F.col(pred_col)) ** 2).alias("mse"),
                 F.count(F.lit(1)).cast("bigint").alias("n"))


def accuracy(df: DataFrame, prob_array: str, label_col: str) -> DataFrame:
    """Share of rows whose argmax (first maximum, 0-based) equals the label."""
    argmax = F.array_position(F.col(prob_array), F.array_max(F.col(prob_array))) - 1
    return df.agg(F.avg((argmax == F.col(label_col)).cast("double")).alias("accuracy"),
                   F.count(F.lit(1)).cast("bigint").alias("n"))


LOG_LOSS_EPS = 1e-7


def log_loss(df: DataFrame, p: str, y: str, eps: float = LOG_LOSS_EPS) -> DataFrame:
    """Mean binary cross-entropy, ``eps`` added inside each log."""
    pc, yc = F.col(p).cast("double"), F.col(y).cast("double")
    ll = -(yc * F.log(pc + F.lit(eps)) + (F.lit(1.0) - yc) * F.log(F.lit(1.0) - pc + F.lit(eps)))
    return df.agg(F.avg(ll).alias("log_loss"), F.count(F.lit(1)).cast("bigint").alias("n"))


def auc(df: DataFrame, score: str, y: str, partitions: int | None = None) -> DataFrame:
    """ROC AUC by the rank-sum (Mann-Whitney) form, average ranks for ties.

    Exact and distributed: rows are first collapsed to one row per distinct
    score (partial aggregate), then range-partitioned by score.  Each range
    partition computes its running count locally; the per-partition totals
    (one row per partition, a bounded table) give every partition its offset.
    No step sees all scores in one task.
    """
    spark = df.sparkSession
    g = (df.groupBy(F.col(score).cast("double").alias("_s"))
           .agg(F.count(F.lit(1)).alias("_cnt"), F.sum(F.col(y).cast("long")).alias("_pos")))
    g = g.repartitionByRange(partitions, "_s") if partitions else g.repartitionByRange("_s")
    g = g.withColumn("_pid", F.spark_partition_id())
    # both the totals and the ranks must see the same range bounds: materialise
    # the stamped rows once (two range exchanges would sample bounds separately)
    ensure_checkpoint_dir(spark)
    g = g.checkpoint(eager=True)
    totals = g.groupBy("_pid").agg(F.sum("_cnt").alias("_pcnt"))
    wo = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", F.coalesce(F.sum("_pcnt").over(wo), F.lit(0)).alias("_off"))
    wl = Window.partitionBy("_pid").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (g.withColumn("_local", F.coalesce(F.sum("_cnt").over(wl), F.lit(0)))
               .join(F.broadcast(offsets), "_pid")
               .withColumn("_avg_rank", F.col("_off") + F.col("_local")
                           + (F.col("_cnt") + F.lit(1)) / F.lit(2.0)))
    tot = ranked.agg(F.sum(F.col("_pos") * F.col("_avg_rank")).alias("rs"),
                     F.sum("_pos").alias("npos"), F.sum("_cnt").alias("n"))
    nneg = F.col("n") - F.col("npos")
    return tot.select(((F.col("rs") - F.col("npos") * (F.col("npos") + F.lit(1)) / F.lit(2.0))
                       / (F.col("npos") * nneg)).alias("auc"))


def half_squared_error(df: DataFrame, pred: str, y: str) -> DataFrame:
    """Σ (y - ŷ)² / 2."""
    return df.agg((F.sum((F.col(y).cast("double") - F.col(pred)) ** 2) / F.lit(2.0))
                  .alias("half_squared_error"))
