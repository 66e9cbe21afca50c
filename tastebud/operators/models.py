"""Model-based recommenders: ALS (R10-R13, R16, R17), factorisation machines
(R19, R20), truncated SVD (R14) and NMF (R15).

ALS and FM use Spark ML.  SVD and NMF are written as DataFrame products and
aggregates over the long (user, item, value) matrix, which lies in blocks of
neighbouring keys (``_Blocks``): factor rows are ``k`` double columns, and the only values that reach the driver are k x k
(or l x l) Gram matrices, whatever the number of users and items.
Iterative loops cut their lineage with reliable ``checkpoint()``.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.regression import FMRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir, stored
from . import pairs as P
from .ranking import dense_index
from .threshold import max_inner_product

INT32_MAX = 2**31 - 1


def check_int_ids(df: DataFrame, *cols: str) -> DataFrame:
    """ALS needs 32-bit ids: fail loudly instead of truncating (the classic bug)."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.when((F.col(c) >= 0) & (F.col(c) <= INT32_MAX), F.col(c).cast("int"))
                             .otherwise(F.raise_error(F.concat(F.lit(f"{c} outside the 32-bit range: "),
                                                               F.col(c).cast("string")))))
    return out


# ------------------------------------------------------------------ ALS
def als(rank: int = 50, max_iter: int = 10, reg: float = 1e-4, implicit: bool = False,
        alpha: float = 1.0, user: str = "user_id", item: str = "item_id", rating: str = "rating",
        seed: int = 0, nonnegative: bool = False, item_blocks: int = 10) -> ALS:
    """``item_blocks``: each round sends a user's factors to every block that holds one of the user's items, and solves the
    items in so many tasks.  The random start is dealt by user blocks alone and does not depend on it."""
    return ALS(rank=rank, maxIter=max_iter, regParam=reg, implicitPrefs=implicit, alpha=alpha,
               userCol=user, itemCol=item, ratingCol=rating, seed=seed, nonnegative=nonnegative,
               coldStartStrategy="drop", checkpointInterval=5, numItemBlocks=item_blocks)


def fit_als(df: DataFrame, **kw) -> ALSModel:
    ensure_checkpoint_dir(df.sparkSession)
    user, item = kw.get("user", "user_id"), kw.get("item", "item_id")
    return als(**kw).fit(check_int_ids(df, user, item))


def recommend_for_all(model: ALSModel, n: int, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Top-n items per user with their rank (blocked scoring inside Spark ML)."""
    r = model.recommendForAllUsers(n)
    x = r.select(user, F.posexplode("recommendations").alias("_pos", "_r"))
    return x.select(user, F.col("_r." + item).alias(item), F.col("_r.rating").alias("score"),
                    (F.col("_pos") + 1).cast("bigint").alias("rank"))


def training_mse(model: ALSModel, df: DataFrame, rating: str = "rating") -> float | None:
    pred = model.transform(df)
    return pred.agg(F.avg((F.col(rating).cast("double") - F.col("prediction")) ** 2).alias("mse"))


#: Factors (floats) of the items that ``squared_error`` holds in a task.
ITEM_FACTORS = 8_000_000


def rating_lists(df: DataFrame, user: str = "user_id", item: str = "item_id", rating: str = "rating",
                 block_size: int = P.DEFAULT_BLOCK_SIZE) -> DataFrame:
    """(user, items, ratings): the rated rows of a user as lists, those of the most frequent users in several."""
    rows = df.where(F.col(rating).isNotNull()).select(user, item, F.col(rating).cast("float").alias("_r"))
    hot = P.hot_keys(rows, [user], block_size).collect()
    by = [user]
    if hot:
        blocks = F.create_map(*[F.lit(x) for r in hot for x in (r[user], -(-r["_kn"] // block_size))])
        rows = rows.withColumn("_s", F.pmod(F.monotonically_increasing_id(), F.coalesce(blocks[F.col(user)], F.lit(1))))
        by.append("_s")
    lists = rows.groupBy(*by).agg(F.collect_list(F.struct(item, "_r")).alias("_l"))
    return lists.select(user, F.col(f"_l.{item}").alias("items"), F.col("_l._r").alias("ratings"))


def training_mse_lists(model: ALSModel, lists: DataFrame, user: str = "user_id", item: str = "item_id",
                       limit: int = ITEM_FACTORS) -> float | None:
    """``training_mse`` over ``rating_lists``: a user's factors meet the whole list, and items' factors up to ``limit`` floats
    are broadcast; more are joined by row as in ``training_mse``."""
    spark, items = lists.sparkSession, model.itemFactors
    if items.count() * model.rank > limit:
        rows = lists.select(user, F.inline(F.arrays_zip(F.col("items").alias(item), F.col("ratings").alias("rating"))))
        return training_mse(model, rows).first()[0]
    known = items.orderBy("id").toPandas()
    q = spark.sparkContext.broadcast((known["id"].to_numpy(), np.array(known["features"].tolist(), dtype=np.float32)))

    def errors(batches):
        ids, factors = q.value
        for b in batches:
            own = np.asarray(b.column("features").flatten(), dtype=np.float32).reshape(b.num_rows, -1)
            who = np.repeat(np.arange(b.num_rows), np.asarray(pc.list_value_length(b.column("items"))))
            what, r = np.asarray(b.column("items").flatten()), np.asarray(b.column("ratings").flatten(), dtype=np.float64)
            at = np.minimum(np.searchsorted(ids, what), len(ids) - 1)
            has = ids[at] == what
            total = 0.0
            for k in range(0, len(who), 1 << 13):
                s = slice(k, k + (1 << 13))
                e = r[s] - np.einsum("ij,ij->i", own[who[s]], factors[at[s]])
                total += float(np.square(e[has[s]]).sum())
            yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([int(has.sum())])], names=["e", "n"])

    rows = lists.join(model.userFactors.select(F.col("id").alias(user), "features"), user).select("features", "items", "ratings")
    got = rows.mapInArrow(errors, "e double, n long").agg(F.try_divide(F.sum("e"), F.sum("n")).alias("mse")).first()[0]
    q.unpersist()
    return got


def tune_als(df: DataFrame, ranks: Sequence[int], regs: Sequence[float], alphas: Sequence[float], train_share: float = 0.8,
             user: str = "user_id", item: str = "item_id", rating: str = "rating", seed: int = 0, parallelism: int = 1,
             max_iter: int = 10, item_blocks: int = 10) -> DataFrame:
    """R12 on a holdout: (kind, rank, reg, alpha, mse) on the held-out rows, dealt as by Spark ML's ``TrainValidationSplit``,
    which would also fit the best setting once more on all rows.

    Explicit models over ranks x regs, implicit ones over ranks x regs x alphas; rows whose user or item the training part
    lacks are dropped from the score.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    data = check_int_ids(df.select(user, item, F.col(rating).cast("float").alias(rating)), user, item).withColumn("_u", F.rand(seed)).persist()
    train = data.where(F.col("_u") < train_share).drop("_u")
    held = rating_lists(data.where(F.col("_u") >= train_share), user, item, rating).persist()
    grid = [(kind, rank, reg, alpha) for kind in ("explicit", "implicit") for rank in ranks for reg in regs
            for alpha in (alphas if kind == "implicit" else [None])]

    def score(setting):
        kind, rank, reg, alpha = setting
        model = als(rank, max_iter, reg, kind == "implicit", 1.0 if alpha is None else alpha, user, item, rating, seed,
                    item_blocks=item_blocks).fit(train)
        mse = training_mse_lists(model, held, user, item)
        return (*setting, float("nan") if mse is None else mse)

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        rows = list(pool.map(score, grid))
    held.unpersist()
    data.unpersist()
    return spark.createDataFrame(rows, "kind string, rank int, reg double, alpha double, mse double")


def inspect_users(who: DataFrame, seen: DataFrame, user_factors: DataFrame, item_factors: DataFrame, names: DataFrame, n: int,
                  user: str = "user_id", item: str = "item_id") -> DataFrame:
    """(user, part, item, name, rank, factor) of the asked users: what they have seen and their ``n`` best items.

    ``factor`` is the first user factor; seen items have rank 0; users without factors give no row.  Factors are (key, features), names (item, name).
    """
    asked = user_factors.join(who.select(user).distinct(), user, "left_semi")
    first = asked.select(user, F.element_at("features", 1).cast("double").alias("factor"))
    best = max_inner_product(asked, item_factors, n, user, item).select(user, F.lit("recommended").alias("part"), item, "rank")
    own = seen.join(first.select(user), user, "left_semi").select(user, F.lit("seen").alias("part"), item, F.lit(0).cast("long").alias("rank"))
    named = P.salted_join(best.unionByName(own), names.select(item, "name"), item, user, how="left")
    return named.join(first, user).select(user, "part", item, F.coalesce("name", F.lit("")).alias("name"), "rank", "factor")


# ------------------------------------------------------------------ FM
def onehot_features(df: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """P12 as a Spark ML vector: one-hot user block followed by one-hot item block."""
    u = dense_index(df, user, "_ui")
    i = dense_index(df, item, "_ii")
    x = df.join(u, user).join(i, item)
    enc = OneHotEncoder(inputCols=["_ui", "_ii"], outputCols=["_uv", "_iv"], dropLast=False)
    x = enc.fit(x).transform(x)
    return VectorAssembler(inputCols=["_uv", "_iv"], outputCol="features").transform(x)


def fit_fm(df: DataFrame, label: str = "rating", factor_size: int = 10, reg: float = 0.001,
           step: float = 0.01, max_iter: int = 100, batch_fraction: float = 1.0, seed: int = 0):
    fm = FMRegressor(featuresCol="features", labelCol=label, factorSize=factor_size, regParam=reg,
                     stepSize=step, maxIter=max_iter, miniBatchFraction=batch_fraction, seed=seed)
    return fm.fit(df.withColumn(label, F.col(label).cast("double")))


def fm_score(active: DataFrame, linear: DataFrame, factors: DataFrame, w0: float,
             row: str = "row_id", feat: str = "feature", value: str = "x",
             k: int = 10) -> DataFrame:
    """FM prediction from weights held as tables.

    ``active`` (row, feature, x) lists the non-zero features of each row,
    ``linear`` (feature, w), ``factors`` (feature, v_0..v_{k-1}).
    ŷ = w0 + Σ w_i x_i + ½ Σ_f [(Σ_i v_if x_i)^2 - Σ_i v_if^2 x_i^2], computed
    as one join and one aggregate per row (the O(k n) identity).
    """
    # a feature of many rows is salted by row
    hot = P.hot_keys(active, [feat])
    j = P.salted_join(P.salted_join(active, linear, feat, row, hot=hot, how="left"), factors, feat, row, hot=hot, how="left")
    x = F.col(value).cast("double")
    aggs = [F.sum(F.coalesce(F.col("w"), F.lit(0.0)) * x).alias("_lin")]
    for f in range(k):
        v = F.coalesce(F.col(f"v_{f}"), F.lit(0.0))
        aggs.append(F.sum(v * x).alias(f"_s{f}"))
        aggs.append(F.sum(v * v * x * x).alias(f"_q{f}"))
    g = j.groupBy(row).agg(*aggs)
    pair = sum(((F.col(f"_s{f}") * F.col(f"_s{f}") - F.col(f"_q{f}")) for f in range(k)), F.lit(0.0))
    return g.select(row, (F.lit(float(w0)) + F.col("_lin") + F.lit(0.5) * pair).alias("prediction"))


# ------------------------------------------------------------------ helpers for k-column factors
def _cols(prefix: str, k: int) -> list[str]:
    return [f"{prefix}{f}" for f in range(k)]


def _transform(cols: Sequence[str], m: np.ndarray, out: str) -> list[Column]:
    """Row-wise x @ m for a small literal matrix m (len(cols) x m.shape[1])."""
    res = []
    for j in range(m.shape[1]):
        e = None
        for i, c in enumerate(cols):
            coef = float(m[i, j])
            if coef == 0.0:
                continue
            t = F.col(c) * F.lit(coef)
            e = t if e is None else e + t
        res.append((e if e is not None else F.lit(0.0)).alias(f"{out}{j}"))
    return res


def _gram(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """Σ over rows of x x^T - a len(cols)^2 aggregate, the only driver-side data."""
    n = len(cols)
    aggs = [F.sum(F.col(cols[a]) * F.col(cols[b])).alias(f"g{a}_{b}") for a in range(n) for b in range(a, n)]
    row = df.agg(*aggs).first()
    g = np.zeros((n, n))
    for a in range(n):
        for b in range(a, n):
            g[a, b] = g[b, a] = row[f"g{a}_{b}"] or 0.0
    return g


def _hash_unit(key: Column, f: int, seed: int) -> Column:
    """Deterministic pseudo-random value in (-0.5, 0.5) for (key, f)."""
    h = F.xxhash64(key, F.lit(f), F.lit(seed))
    return (F.pmod(h, F.lit(1_000_003)).cast("double") / F.lit(1_000_003.0)) - F.lit(0.5)


#: Cells of one block.
BLOCK_CELLS = 1_000_000


class _Blocks:
    """Cells (key, out, v) of a sparse matrix, dealt once into blocks of neighbouring keys, for products with factors by key.

    The cells are cut evenly in the order of (key, out), so a frequent key spans several blocks.  A product ships each vector to
    the blocks that hold its key, and sums of a whole block: neighbouring keys that share partners meet there, and no
    exchange carries a vector per cell.  Cells without a key meet no factor.
    """

    def __init__(self, a: DataFrame, key: str, out: str, value: str = "v") -> None:
        self.key, self.out = key, out
        cells = a.select(key, out, F.col(value).cast("double").alias("v")).dropna(subset=[key])
        spark = a.sparkSession
        self.parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-cells.count() // BLOCK_CELLS))
        cells = stored(cells.repartitionByRange(self.parts, key, out).withColumn("_b", F.spark_partition_id()), "cells")
        self.places = stored(cells.select(key, "_b").distinct(), "places")
        # partitioned as every product reads it; a lost block is made anew from the files
        self.cells = cells.repartition(self.parts, "_b").persist()

    def times(self, factors: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
        """(out, ``name``0..) with Σ_key v[out, key] * factors[key] of columns ``cols``; missing values add nothing."""
        key, out, names = self.key, self.out, [f"{name}{i}" for i in range(len(cols))]
        placed = self.places.join(factors.select(key, *cols), key)

        def product(cells: pa.Table, vectors: pa.Table) -> pa.Table:
            at = pc.index_in(cells[key], value_set=vectors[key].combine_chunks())
            met = pc.is_valid(at)
            cells, at = cells.filter(met), at.filter(met).to_numpy()
            owner = cells[out].combine_chunks().dictionary_encode(null_encoding="encode")
            codes, n = owner.indices.to_numpy(), len(owner.dictionary)
            v, given = cells["v"].fill_null(0.0).to_numpy(), pc.is_valid(cells["v"]).to_numpy()
            sums = [owner.dictionary]
            for c in cols:
                there = given & pc.is_valid(vectors[c]).to_numpy()[at]
                x = np.bincount(codes, weights=vectors[c].fill_null(0.0).to_numpy()[at] * v, minlength=n)
                sums.append(pa.array(x, mask=np.bincount(codes, weights=there, minlength=n) == 0))
            return pa.Table.from_arrays(sums, names=[out, *names])

        schema = T.StructType([self.cells.schema[out], *[T.StructField(x, T.DoubleType()) for x in names]])
        sums = self.cells.groupBy("_b").cogroup(placed.groupBy("_b")).applyInArrow(product, schema)
        return sums.groupBy(out).agg(*[F.sum(x).alias(x) for x in names])

    def close(self) -> None:
        self.cells.unpersist()


def _checkpoint(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# ------------------------------------------------------------------ SVD
def truncated_svd(a: DataFrame, k: int = 15, oversample: int = 10, power_iters: int = 2,
                  row: str = "user_id", col: str = "item_id", value: str = "v", seed: int = 7):
    """Randomised truncated SVD of the sparse matrix ``a`` (zeros are observed).

    Range finder Y = A Ω with ``power_iters`` rounds of A Aᵀ, orthonormalised by
    Cholesky-QR (twice) using the l x l Gram matrix; then B = Qᵀ A and the SVD
    of B from the eigen-decomposition of B Bᵀ.  Returns (U, s, V) with U as
    (row, u0..u{k-1}), s a numpy vector, V as (col, v0..v{k-1}).
    """
    l = k + oversample
    # A is read 2 * (power_iters + 1) times, by columns and by rows: both are dealt out once
    a = stored(a.select(row, col, F.col(value).cast("double").alias("v")), "matrix")
    by_col, by_row = _Blocks(a, col, row), _Blocks(a, row, col)
    cols_items = by_col.places.select(col).distinct()
    omega = cols_items.select(col, *[_hash_unit(F.col(col), f, seed).alias(f"o{f}") for f in range(l)])

    def orth(y: DataFrame, prefix: str) -> DataFrame:
        # y is checkpointed on entry; each Cholesky-QR pass is a row-wise
        # projection, so the Gram matrices never recompute a join
        cs = _cols(prefix, l)
        for p in range(2):                          # CholeskyQR2
            g = _gram(y, cs)
            r = np.linalg.cholesky(g + 1e-12 * np.trace(g) * np.eye(l)).T
            y = y.select(row, *_transform(cs, np.linalg.inv(r), prefix))
            if p == 0:
                # materialise between the passes: stacking two l x l projections
                # would exceed the generated-code size limit
                y = _checkpoint(y)
        return y

    y = _checkpoint(by_col.times(omega, _cols("o", l), "y"))
    y = orth(y, "y")
    for _ in range(power_iters):
        z = _checkpoint(by_row.times(y, _cols("y", l), "z"))     # Aᵀ Y : (col, z*)
        y = _checkpoint(by_col.times(z, _cols("z", l), "y"))
        y = orth(y, "y")
    # B = Qᵀ A stored transposed: per column c, b_c = Σ_r Q_r a_rc  (col, b0..b{l-1})
    b = _checkpoint(by_row.times(y, _cols("y", l), "b"))
    by_col.close()
    by_row.close()
    bbt = _gram(b, _cols("b", l))                   # B Bᵀ (l x l)
    evals, evecs = np.linalg.eigh(bbt)
    order = np.argsort(evals)[::-1][:k]
    s = np.sqrt(np.clip(evals[order], 0.0, None))
    ub = evecs[:, order]
    u = y.select(row, *_transform(_cols("y", l), ub, "u"))
    inv_s = np.where(s > 0, 1.0 / np.where(s > 0, s, 1.0), 0.0)
    v = b.select(col, *_transform(_cols("b", l), ub * inv_s[None, :], "v"))
    return u, s, v


def svd_predict_cells(u: DataFrame, s: np.ndarray, v: DataFrame, cells: DataFrame,
                      row: str = "user_id", col: str = "item_id") -> DataFrame:
    """U diag(s) Vᵀ evaluated only at the requested cells; absent rows/cols give 0."""
    k = len(s)
    j = cells.join(u, row, "left").join(v, col, "left")
    dot = sum((F.coalesce(F.col(f"u{f}"), F.lit(0.0)) * F.lit(float(s[f]))
               * F.coalesce(F.col(f"v{f}"), F.lit(0.0)) for f in range(k)), F.lit(0.0))
    return j.select(*cells.columns, dot.alias("prediction"))


# ------------------------------------------------------------------ NMF
def _gram_row(df: DataFrame, cols: Sequence[str], prefix: str) -> DataFrame:
    """One-row frame with the Gram matrix Σ x xᵀ as columns ``{prefix}{a}_{b}`` (a <= b),
    joined back on a constant key: the update stays one Spark plan, no driver round trip."""
    n = len(cols)
    aggs = [F.sum(F.col(cols[a]) * F.col(cols[b])).alias(f"{prefix}{a}_{b}")
            for a in range(n) for b in range(a, n)]
    return F.broadcast(df.agg(*aggs).withColumn("_k", F.lit(0)))


def _times_gram(cols: Sequence[str], prefix: str, out: str) -> list[Column]:
    """Row-wise x @ G for a symmetric Gram matrix held in columns of ``_gram_row``."""
    n = len(cols)
    res = []
    for j in range(n):
        terms = [F.col(cols[i]) * F.col(f"{prefix}{min(i, j)}_{max(i, j)}") for i in range(n)]
        e = terms[0]
        for t in terms[1:]:
            e = e + t
        res.append(e.alias(f"{out}{j}"))
    return res


def nmf(a: DataFrame, k: int = 2, iters: int = 50, row: str = "user_id", col: str = "item_id",
        value: str = "v", seed: int = 3, eps: float = 1e-10, checkpoint_every: int = 5,
        with_losses: bool = True, start: tuple[DataFrame, DataFrame] | None = None):
    """Non-negative factorisation V ≈ W H by multiplicative updates (Frobenius loss).

    H <- H ∘ (Wᵀ V) / ((Wᵀ W) H),  W <- W ∘ (V Hᵀ) / (W (H Hᵀ)).
    Zeros of V are observed values.  Each update is one DataFrame plan (sparse
    product by blocks + aggregate, k x k Gram as a broadcast one-row frame),
    materialised by a checkpoint.  Returns (W, H, losses) with W as
    (row, w0..), H as (col, h0..) and the squared Frobenius loss every
    ``checkpoint_every`` iterations (none without ``with_losses``).
    ``start`` gives the first W and H, hashed numbers if it is missing.
    """
    a = stored(a.select(row, col, F.col(value).cast("double").alias("v")), "matrix")
    by_col, by_row = _Blocks(a, col, row), _Blocks(a, row, col)
    wc, hc = _cols("w", k), _cols("h", k)
    def hashed(key: str, p: str, own_seed: int) -> DataFrame:
        return a.select(key).distinct().select(
            key, *[(_hash_unit(F.col(key), f, own_seed) + F.lit(0.5) + F.lit(0.01)).alias(f"{p}{f}") for f in range(k)])

    w, h = start or (hashed(row, "w", seed), hashed(col, "h", seed + 1))
    w, h = _checkpoint(w), _checkpoint(h)
    vv = (a.agg(F.sum(F.col("v") * F.col("v"))).first()[0] or 0.0) if with_losses else 0.0
    losses = []
    for it in range(iters):
        # H update: numerator WᵀV per column, denominator h_c @ (WᵀW)
        wtv = by_row.times(w, wc, "n")
        g = _gram_row(w, wc, "g")
        hd = h.withColumn("_k", F.lit(0)).join(g, "_k").select(col, *hc, *_times_gram(hc, "g", "d"))
        h = _checkpoint(hd.join(wtv, col, "left")
              .select(col, *[(F.col(f"h{f}") * F.coalesce(F.col(f"n{f}"), F.lit(0.0))
                              / (F.col(f"d{f}") + F.lit(eps))).alias(f"h{f}") for f in range(k)]))
        # W update: numerator V Hᵀ per row, denominator w_r @ (H Hᵀ)
        vht = by_col.times(h, hc, "n")
        g = _gram_row(h, hc, "g")
        wd = w.withColumn("_k", F.lit(0)).join(g, "_k").select(row, *wc, *_times_gram(wc, "g", "d"))
        w = _checkpoint(wd.join(vht, row, "left")
              .select(row, *[(F.col(f"w{f}") * F.coalesce(F.col(f"n{f}"), F.lit(0.0))
                              / (F.col(f"d{f}") + F.lit(eps))).alias(f"w{f}") for f in range(k)]))
        if with_losses and ((it + 1) % checkpoint_every == 0 or it == iters - 1):
            # ||V - WH||² = ||V||² - 2 Σ_obs v (WH) + tr((WᵀW)(HHᵀ))
            wh = (a.join(w, row).join(h, col)
                   .agg(F.sum(F.col("v") * sum((F.col(f"w{f}") * F.col(f"h{f}") for f in range(k)),
                                               F.lit(0.0)))).first()[0] or 0.0)
            losses.append(float(vv - 2.0 * wh + np.trace(_gram(w, wc) @ _gram(h, hc))))
    by_col.close()
    by_row.close()
    return w, h, losses
