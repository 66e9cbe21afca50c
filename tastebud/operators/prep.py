"""Preparation operators (P1-P14): dedupe, id maps, splits, sampling, features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import arith_hash, onehot_array
from ..session import stored
from .pairs import DEFAULT_BLOCK_SIZE, TASK_PAIRS, hot_keys, salted_join
from .ranking import dense_index, row_number, sum_before


def one_row(df: DataFrame) -> DataFrame:
    return df.withColumn("_k", F.lit(0))


def dedupe_last(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                values: Sequence[str]) -> DataFrame:
    """One row per ``keys``; the row with the greatest ``order`` wins.

    ``max_by`` over a struct is a hash aggregate with partial aggregation, so
    duplicates of a hot key are folded on the map side.
    """
    payload = F.struct(*[F.col(v) for v in values])
    o = F.struct(*[F.col(c) for c in order])
    g = df.groupBy(*keys).agg(F.max_by(payload, o).alias("_p"))
    return g.select(*keys, *[F.col("_p." + v).alias(v) for v in values])


def build_id_map(df: DataFrame, key: str, name: str = "idx", start: int = 0) -> DataFrame:
    """Distinct string key -> consecutive int id (key order), range-checked."""
    return dense_index(df, key, name, start=start, check_int32=True)


def apply_id_map(df: DataFrame, id_map: DataFrame, key: str) -> DataFrame:
    """Replace ``key`` by its index.  An inner join; AQE broadcasts the map
    at runtime only when its measured size is under the threshold."""
    return df.join(id_map, key)


def hash_split(df: DataFrame, user: str = "user_id", item: str = "item_id",
               train_below: int = 7, mod: int = 10) -> DataFrame:
    """P3 (oracle form): ``is_train`` = (31 u + 17 i) mod ``mod`` < ``train_below``."""
    b = F.pmod(F.col(user) * 31 + F.col(item) * 17, F.lit(mod))
    return df.withColumn("is_train", b < F.lit(train_below))


def random_split(df: DataFrame, fraction: float = 0.7, seed: int = 0):
    """P3 (random form): Bernoulli split per row with Spark's seeded sampler."""
    return df.randomSplit([fraction, 1.0 - fraction], seed=seed)


def split_mk(df: DataFrame, m: int, k: int, seed: int, user: str = "user_id",
             item: str = "item_id") -> Column:
    """Test iff hash mod (M+1) == k, i.e. ``randint(0, M) == k`` has M+1 folds."""
    return arith_hash((user, 31), (item, 17), offset=seed, mod=m + 1) == F.lit(k)


SPLIT_HASH_USER = 2654435761
SPLIT_HASH_ITEM = 40503


def split_exact(df: DataFrame, test_fraction: float, user: str = "user_id",
                item: str = "item_id") -> DataFrame:
    """P5: exactly ceil(test_fraction * n) rows go to test (``in_test``).

    Rows are ordered by an arithmetic hash then (user, item); the first
    ``ceil(f n)`` positions are the test set.  Positions come from the
    distributed ``row_number`` (no single-task window).
    """
    h = arith_hash((user, SPLIT_HASH_USER), (item, SPLIT_HASH_ITEM))
    ranked = row_number(df.withColumn("_h", h), ["_h", user, item], name="_pos")
    n = one_row(df.agg(F.count(F.lit(1)).alias("_n")))
    out = ranked.withColumn("_k", F.lit(0)).join(F.broadcast(n), "_k")
    quota = F.ceil(F.col("_n") * F.lit(float(test_fraction)))
    return out.withColumn("in_test", F.col("_pos") <= quota).drop("_k", "_n", "_h", "_pos")


def stratified_kfold(df: DataFrame, label: str, key: str, k: int = 3) -> DataFrame:
    """Class-balanced folds: position within the class (hash order) mod k."""
    h = arith_hash((key, SPLIT_HASH_USER))
    ranked = row_number(df.withColumn("_h", h), ["_h", key], groups=[label], name="_pos")
    return ranked.withColumn("fold", F.pmod(F.col("_pos") - 1, F.lit(k)).cast("bigint")).drop("_h", "_pos")


DRAW_CHUNK = 4096

#: Places of the pool that share a row for each of their items.
POOL_PLACES = 32


MERSENNE = (1 << 31) - 1


def draw_hash(user: Column, t: Column, seed: int) -> Column:
    """62 bits from a user and a draw: two rounds of a quadratic mix modulo 2**31 - 1, in arithmetic that SQL engines share."""
    mix = lambda x: (x * (x % 65537 + 1)) % MERSENNE
    x = F.pmod(user.cast("bigint"), F.lit(1 << 31)) * F.lit(SPLIT_HASH_USER) + t * F.lit(SPLIT_HASH_ITEM) + F.lit(seed)
    first = mix(x % MERSENNE)
    return first * MERSENNE + mix((first * 48271 + t) % MERSENNE)


def negative_sample(pos: DataFrame, user: str = "user_id", item: str = "item_id",
                    ratio: int = 3, seed: int = 12345) -> DataFrame:
    """Per user, positives (label 1) plus up to n+1 negatives (label 0).

    Draw t = 1..ratio*n for user u picks ``pool[h(u, t) mod |pool|]`` (``draw_hash``, 62 bits) where the
    pool lists every positive (user, item) row, so popular items are drawn
    more often.  Drawn items the user has, or already drew, are skipped; the
    first n+1 remaining draws are kept.  All steps are joins/aggregates: the
    pool is indexed by the distributed row_number, draws are exploded per
    user, first-draw-per-item is a min aggregate.
    """
    p = pos.select(user, item).distinct()
    pool = row_number(p.select(F.col(item).alias("_pi"), F.col(user).alias("_pu")),
                      ["_pi", "_pu"], name="_idx")
    pool = pool.select((F.col("_idx") - 1).alias("_idx"), "_pi")
    psize = one_row(p.agg(F.count(F.lit(1)).alias("_P")))
    n_u = p.groupBy(user).agg(F.count(F.lit(1)).alias("_n"))
    # Draws are generated in chunks of DRAW_CHUNK, and the chunks are spread
    # over tasks before they are expanded, so a user with a huge history does
    # not expand all of its draws in one task.
    chunks = (n_u.withColumn("_k", F.lit(0)).join(F.broadcast(psize), "_k")
                 .select(user, "_n", "_P", F.explode(F.sequence(
                     F.lit(0), F.ceil(F.col("_n") * ratio / F.lit(float(DRAW_CHUNK))).cast("int") - 1))
                     .alias("_c"))
                 .repartition(user, "_c"))
    draws = chunks.select(user, "_n", "_P", F.explode(F.sequence(
        F.col("_c") * DRAW_CHUNK + 1,
        F.least((F.col("_c") + 1) * DRAW_CHUNK, F.col("_n") * ratio))).alias("_t"))
    draws = draws.withColumn("_idx", F.pmod(draw_hash(F.col(user), F.col("_t"), seed), F.col("_P")))
    # sized by the rows before they are expanded, the draws would be broadcast: the hint keeps the join shuffled
    drawn = draws.hint("merge").join(pool, "_idx").select(user, "_n", "_t", F.col("_pi").alias(item))
    drawn = drawn.join(p, [user, item], "left_anti")
    first = drawn.groupBy(user, item).agg(F.min("_t").alias("_t"), F.first("_n").alias("_n"))
    neg = (row_number(first, ["_t"], groups=[user], name="_r")
                .where(F.col("_r") <= F.col("_n") + 1)
                .select(user, item, F.lit(0).alias("label")))
    return p.select(user, item, F.lit(1).alias("label")).unionByName(neg)


def sample_histories(pos: DataFrame, user: str = "user_id", item: str = "item_id", ratio: int = 3, seed: int = 12345) -> DataFrame:
    """P7 for histories that fit a block: the rows of ``negative_sample``, drawn items travelling once, to their user's partition.

    The pool is held as each item's range of places, and a draw finds its item by a join on blocks of places; the place itself
    isn't shipped.  A user's draws meet the history where they arrive.  With a longer history, ``negative_sample`` does it all.
    """
    # read for the histories' sizes, for the pool and as positives
    p = stored(pos.select(user, item).distinct(), "positives")
    n_u = p.groupBy(user).agg(F.count(F.lit(1)).alias("_n"))
    got = n_u.agg(F.max("_n").alias("most"), F.sum("_n").alias("rows")).first()
    if (got["most"] or 0) > DEFAULT_BLOCK_SIZE:
        return negative_sample(p, user, item, ratio, seed)
    size = got["rows"] or 0
    parts = max(int(pos.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size * (ratio + 1) // TASK_PAIRS))
    pool = sum_before(p.groupBy(F.col(item).alias("_pi")).agg(F.count(F.lit(1)).alias("_c")), ["_pi"], "_c", "_at")
    last = F.col("_at") + F.col("_c") - 1
    pool = pool.select("_pi", "_at", last.alias("_z"), F.explode(F.sequence(
        F.floor(F.col("_at") / POOL_PLACES), F.floor(last / POOL_PLACES))).alias("_b"))
    draws = n_u.repartition(parts, user).select(user, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n") * ratio)).alias("_t"))
    place = F.pmod(draw_hash(F.col(user), F.col("_t"), seed), F.lit(size))
    met = (F.floor(place / POOL_PLACES) == F.col("_b")) & (place >= F.col("_at")) & (place <= F.col("_z"))
    # sized by the rows before they are expanded, the draws would be broadcast: the hint makes the pool the side that is built
    drawn = draws.join(pool.hint("shuffle_hash"), met).select(user, "_t", F.col("_pi").alias(item))
    rows = drawn.unionByName(p, allowMissingColumns=True).repartition(parts, user)
    rows = rows.groupBy(user, item).agg(F.min("_t").alias("_t"), F.bool_or(F.col("_t").isNull()).alias("_has"))
    # a null item equals none that the user has
    new = F.col("_t").isNotNull() & (~F.col("_has") | F.col(item).isNull())
    nth = F.sum(new.cast("int")).over(Window.partitionBy(user).orderBy("_t").rowsBetween(Window.unboundedPreceding, 0))
    n = F.sum(F.col("_has").cast("int")).over(Window.partitionBy(user))
    rows = rows.select(user, item, "_has", (new & (nth <= n + 1)).alias("_new"))
    labels = F.array_compact(F.array(F.when(F.col("_has"), 1), F.when(F.col("_new"), 0)))
    return rows.select(user, item, F.explode(labels).alias("label"))


def ratings_to_sparse(df: DataFrame, user: str = "user_id", item: str = "item_id",
                      value: str = "rating", size=None) -> DataFrame:
    """Per user (id, size, sorted indices, values) - the sparse-vector form.

    ``pyspark.ml.functions.array_to_vector`` or ``SparseVector`` can be built
    from these arrays; they are kept as arrays so SQL engines can compare them.
    """
    g = df.groupBy(user).agg(F.array_sort(F.collect_list(
        F.struct(F.col(item).alias("i"), F.col(value).cast("double").alias("v")))).alias("_e"))
    out = g.select(user, F.col("_e.i").alias("indices"), F.col("_e.v").alias("values"))
    if size is None:
        sz = one_row(df.agg((F.max(item) + 1).alias("size")))
        out = out.withColumn("_k", F.lit(0)).join(F.broadcast(sz), "_k").drop("_k")
    else:
        out = out.withColumn("size", F.lit(size))
    return out.select(user, "size", "indices", "values")


def feature_dictionary(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                       order: Sequence[str]) -> DataFrame:
    """P10: slot per numeric column, slot per distinct categorical value.

    Output (feature, value, idx); ``value`` is NULL for numeric columns.  Slots
    follow the column ``order``; inside a categorical column values are in
    string order.  Offsets are a running sum over the (few) columns.
    """
    pos = {c: i for i, c in enumerate(order)}
    num = df.sparkSession.createDataFrame(
        [(c, pos[c]) for c in numeric], "feature string, _fp int") if numeric else None
    stacked = None
    for c in categorical:
        part = df.select(F.lit(c).alias("feature"), F.lit(pos[c]).alias("_fp"),
                         F.col(c).cast("string").alias("value"))
        stacked = part if stacked is None else stacked.unionByName(part)
    vals = stacked.distinct()
    ranked = row_number(vals, ["value"], groups=["feature"], name="_r")
    counts = ranked.groupBy("feature", "_fp").agg(F.count(F.lit(1)).alias("_slots"))
    if num is not None:
        counts = counts.unionByName(num.withColumn("_slots", F.lit(1).cast("bigint")))
    w = Window.orderBy("_fp").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_slots").over(w), F.lit(0)))
    cat = ranked.join(F.broadcast(offsets.select("feature", "_off")), "feature").select(
        "feature", "value", (F.col("_off") + F.col("_r") - 1).cast("bigint").alias("idx"))
    if num is None:
        return cat
    nums = offsets.join(num.select("feature"), "feature").select(
        "feature", F.lit(None).cast("string").alias("value"), F.col("_off").cast("bigint").alias("idx"))
    return cat.unionByName(nums)


def encode_features(df: DataFrame, id_col: str, dictionary: DataFrame, numeric: Sequence[str],
                    categorical: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row -> (xi, xv) lists in column order; categorical value -> 1.0,
    unseen categorical value -> NULL index.

    Each row stays whole: the numeric slots are a one-row frame, and every
    categorical column is one left join to its part of the dictionary, in
    which a frequent value is salted by the id.
    """
    slots = one_row(dictionary.where(F.col("value").isNull()).agg(
        *[F.max(F.when(F.col("feature") == c, F.col("idx"))).alias(f"_i_{c}") for c in numeric],
        F.count(F.lit(1)).alias("_n")))
    present = lambda v: F.coalesce(F.concat(F.lit("="), v.cast("string")), F.lit(""))
    wide = df.withColumn("_k", F.lit(0)).join(F.broadcast(slots), "_k")
    for c in categorical:
        part = dictionary.where(F.col("feature") == c).select(
            present(F.col("value")).alias(f"_v_{c}"), F.col("idx").alias(f"_i_{c}"))
        wide = salted_join(wide.withColumn(f"_v_{c}", present(F.col(c))), part, f"_v_{c}", id_col,
                           hot=hot_keys(df.select(present(F.col(c)).alias(f"_v_{c}")), [f"_v_{c}"]), how="left")
    xv = [F.col(c).cast("double") if c in numeric else F.lit(1.0) for c in order]
    return wide.select(id_col, F.array(*[F.col(f"_i_{c}") for c in order]).alias("xi"), F.array(*xv).alias("xv"))


def onehot_user_item(df: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """One-hot positions of (user, item) in a two-group space:
    user -> [0, n_users), item -> n_users + [0, n_items)."""
    um = dense_index(df, user, "user_idx")
    im = dense_index(df, item, "_ii")
    nu = one_row(um.agg(F.count(F.lit(1)).alias("_nu")))
    im = (im.withColumn("_k", F.lit(0)).join(F.broadcast(nu), "_k")
            .select(item, (F.col("_nu") + F.col("_ii")).alias("item_idx")))
    # a user or an item of many rows is salted by the other one
    return salted_join(salted_join(df, um, user, item), im, item, user)


def standardize(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Z-score with the population standard deviation (as sklearn)."""
    st = one_row(df.agg(*[F.avg(c).alias("_m_" + c) for c in cols],
                        *[F.stddev_pop(c).alias("_s_" + c) for c in cols]))
    j = df.withColumn("_k", F.lit(0)).join(F.broadcast(st), "_k")
    return j.select(*keep, *[((F.col(c) - F.col("_m_" + c)) / F.col("_s_" + c)).alias(c) for c in cols])


def onehot_label(df: DataFrame, label: str, name: str = "onehot") -> DataFrame:
    """Label -> one-hot int array; the class count is max(label)+1 from the data."""
    k = one_row(df.agg((F.max(label) + 1).alias("_nc")))
    j = df.withColumn("_k", F.lit(0)).join(F.broadcast(k), "_k")
    return j.withColumn(name, onehot_array(F.col(label), F.col("_nc"))).drop("_k", "_nc")


def categorical_indices(kept: Sequence[str], categorical: Sequence[str]) -> list[int]:
    """Positions of the categorical columns inside the kept column list
    (a schema helper evaluated on the driver; it never touches data)."""
    cat = set(categorical)
    return [i for i, c in enumerate(kept) if c in cat]
