"""Pairs of rows that share a group key, generated in bounded blocks.

Co-occurrence and every similarity in this package reduce to "for each user
(or item), all pairs of its items (or users)".  A plain self-join on the group
key sends a whole group to one task, so a single hot user holding a third of
the rows would produce (n/3)^2 pairs in one task.

Instead each group is cut into ``ceil(n / block_size)`` blocks by a hash of
the member key.  The join key is ``(group, block_a, block_b)`` with
``block_a <= block_b``: a row of block ``x`` is sent to the block pairs
``(x, x..nb-1)`` on the left side and ``(0..x, x)`` on the right side.  Each
unordered pair of members meets exactly once, and no join key carries more
than about ``block_size^2`` pairs.  Ordinary groups (``n <= block_size``)
have one block and are not replicated at all.

Hot keys are found by ``hot_keys``, a table that is never longer than the
number of shuffle partitions and so may be broadcast whatever the data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BLOCK_SIZE = 2048

#: Pairs that one task aggregates.
TASK_PAIRS = 2_000_000


def hot_keys(df: DataFrame, keys: Sequence[str], block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """(keys, ``_kn``): the most frequent keys with more than ``block_size`` rows.

    At most one row per shuffle partition.  A key that is left out has no more
    rows than any that is listed, so at most a partition's share of ``df``.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_kn"))
    return sizes.where(F.col("_kn") > F.lit(block_size)).orderBy(F.desc("_kn"), *keys).limit(parts)


def _blocks(n: str, block_size: int):
    return F.ceil(F.col(n) / F.lit(float(block_size))).cast("int")


def with_blocks(df: DataFrame, group: str, member: str,
                block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """Attach ``_nb`` (blocks of the group) and ``_blk`` (block of the row).

    Only groups larger than ``block_size`` need more than one block.  The
    hottest of them come from a broadcast table; rows of those groups take no
    part in the join to the other large groups and are spread by their member,
    so no group meets in one task before it has blocks.
    """
    hot = hot_keys(df, [group], block_size).select(
        F.col(group).alias("_hg"), _blocks("_kn", block_size).alias("_hb"))
    large = (df.groupBy(group).agg(F.count(F.lit(1)).alias("_gn")).where(F.col("_gn") > F.lit(block_size))
             .select(F.col(group).alias("_lg"), F.lit(0).cast("bigint").alias("_ls"),
                     _blocks("_gn", block_size).alias("_lb")))
    known = F.col("_hg").isNotNull()
    marked = (df.join(F.broadcast(hot), F.col(group) == F.col("_hg"), "left")
                .withColumn("_cg", F.when(~known, F.col(group)))
                .withColumn("_cs", F.when(known, F.xxhash64(F.col(member))).otherwise(F.lit(0))))
    j = marked.join(large, (F.col("_cg") == F.col("_lg")) & (F.col("_cs") == F.col("_ls")), "left")
    return (j.withColumn("_nb", F.coalesce("_hb", "_lb", F.lit(1)))
             .withColumn("_blk", F.pmod(F.xxhash64(F.col(member)), F.col("_nb")).cast("int"))
             .select(*df.columns, "_nb", "_blk"))


def pairs_within(df: DataFrame, group: str, member: str, values: Sequence[str] = (),
                 block_size: int = DEFAULT_BLOCK_SIZE,
                 left_suffix: str = "_1", right_suffix: str = "_2") -> DataFrame:
    """Every unordered pair of distinct members of the same group, once.

    Output columns: ``group, member_1, member_2, <values>_1, <values>_2`` with
    ``member_1 < member_2``.  ``df`` must be unique on ``(group, member)``.
    """
    b = with_blocks(df.select(group, member, *values), group, member, block_size)
    m1, m2 = member + left_suffix, member + right_suffix
    left = b.select(
        F.col(group), F.col(member).alias(m1),
        *[F.col(v).alias(v + left_suffix) for v in values],
        F.col("_blk").alias("_a"),
        F.explode(F.sequence(F.col("_blk"), F.col("_nb") - 1)).alias("_b"))
    right = b.select(
        F.col(group), F.col(member).alias(m2),
        *[F.col(v).alias(v + right_suffix) for v in values],
        F.col("_blk").alias("_b"),
        F.explode(F.sequence(F.lit(0), F.col("_blk"))).alias("_a"))
    j = left.join(right, [group, "_a", "_b"]).where(
        (F.col("_a") != F.col("_b")) | (F.col(m1) < F.col(m2)))
    # Pairs that met across two blocks are in arbitrary order: normalise so
    # member_1 < member_2, swapping the attached values with them.
    swap = F.col(m1) > F.col(m2)
    cols = [F.col(group),
            F.when(swap, F.col(m2)).otherwise(F.col(m1)).alias(m1),
            F.when(swap, F.col(m1)).otherwise(F.col(m2)).alias(m2)]
    for v in values:
        a, c = v + left_suffix, v + right_suffix
        cols.append(F.when(swap, F.col(c)).otherwise(F.col(a)).alias(a))
        cols.append(F.when(swap, F.col(a)).otherwise(F.col(c)).alias(c))
    return j.select(*cols)


def narrow_types(df: DataFrame, *cols: str) -> dict[str, str]:
    """The smallest integer type for each of those columns that hold whole numbers below 2**31 only (nulls aside)."""
    sizes = (("tinyint", 7), ("smallint", 15), ("int", 31))
    numeric = [c for c in cols if df.schema[c].dataType.typeName() in ("byte", "short", "integer", "long", "float", "double")]
    if not numeric:
        return {}
    aggs = []
    for k, c in enumerate(numeric):
        # NaN is above all limits, and its comparison with a whole number fails before any cast
        x, inside = F.col(c), F.col(c).between(-(1 << 31), (1 << 31) - 1)
        whole = F.when(x.isNull(), True).when(~inside, False).otherwise(F.floor(x) == x)
        aggs += [F.min(x).alias(f"a{k}"), F.max(x).alias(f"z{k}"), F.bool_and(whole).alias(f"w{k}")]
    got = df.agg(*aggs).first()
    out = {}
    for k, c in enumerate(numeric):
        if got[f"w{k}"] and got[f"a{k}"] is not None:
            out[c] = next(t for t, bits in sizes if -(1 << bits) <= got[f"a{k}"] and got[f"z{k}"] < 1 << bits)
    return out


def partner_rows(df: DataFrame, group: str, member: str, values: Sequence[str] = (), both: bool = False,
                 block_size: int = DEFAULT_BLOCK_SIZE, keys: DataFrame | None = None,
                 types: dict[str, str] | None = None, task_pairs: int = TASK_PAIRS, cells: DataFrame | None = None) -> DataFrame:
    """Pairs of distinct members of the same group, those of one first member in one partition.

    Columns: ``m, n, _salt, <values>_1, <values>_2`` with ``m < n``, or either
    direction with ``both``.  Every row of ``df`` ships the list of its
    partners to the partition of its member, so a pair costs a few bytes of
    shuffle and is aggregated by ``(m, _salt, n)`` where it arrives.  There is a
    partition for every ``task_pairs`` pairs.  The most frequent members above
    ``block_size`` rows (``hot_keys``) have their partners dealt over salts;
    groups above ``block_size`` are cut into blocks as by ``pairs_within``.

    ``types`` narrows columns on the way (``narrow_types``); the result has the
    narrow types.  ``keys`` is (group, member) of ``df`` if that is costly to
    compute.  ``df`` must be unique on ``(group, member)``.

    ``cells`` (group, member) adds, for each of them, the members of the group
    as partners of the cell's member, with its group as ``_g`` (null for the
    pairs) and only the last of ``values``; they meet the pairs of ``(m, n)``.
    ``types`` must hold the cells' members too.
    """
    types = types or {}
    keys = (df if keys is None else keys).select(group, member).dropna()
    sizes = keys.groupBy(group).agg(F.count(F.lit(1)).alias("_gn"))
    asked = F.lit(0.0)
    if cells is not None:
        cells = cells.select(group, member).dropna()
        sizes = sizes.join(cells.groupBy(group).agg(F.count(F.lit(1)).alias("_cn")), group, "left")
        asked = F.coalesce("_cn", F.lit(0)) * F.col("_gn").cast("double")
    sizes = sizes.agg(F.max("_gn").alias("largest"), F.sum(
        F.col("_gn") * (F.col("_gn") - 1.0) / (1 if both else 2) + asked).alias("entries")).first()
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil((sizes["entries"] or 0.0) / task_pairs))
    hot = [r[member] for r in hot_keys(keys, [member], block_size).collect()]
    cut = (sizes["largest"] or 0) > block_size

    def narrow(c: str):
        return F.col(c).cast(types[c]) if c in types else F.col(c)

    vals = [f"_v{k}" for k in range(len(values))]
    names = ["_m", *vals]
    own = df.dropna(subset=[group, member]).select(group, *[narrow(c).alias(x) for c, x in zip([member, *values], names, strict=True)])
    by = [group, "_nb", "_blk"] if cut else [group]
    lists = (with_blocks(own, group, "_m", block_size) if cut else own).groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct(*names))).alias("_l"))
    lists = lists.select(*by, *[F.col(f"_l.{x}").alias(x) for x in names])

    def placed(rows: DataFrame, prefix: str, start) -> DataFrame:
        """A row for each member of the lists ``prefix..``, with the lists ``names`` of its partners from ``start`` on."""
        rows = rows.select(F.posexplode(prefix + "_m").alias("_p", "m"), *[prefix + v for v in vals if prefix], *names)
        rows = rows.withColumn("_from", start)
        return rows.select("m", *[F.get(prefix + v, F.col("_p")).alias("_o" + v) for v in vals],
                           *[F.slice(x, F.col("_from"), F.size("_m")).alias(x) for x in names])

    rows = placed(lists, "", F.lit(1) if both else F.col("_p") + 2)
    if cut:
        others = F.explode(F.filter(F.sequence(F.lit(0), F.col("_nb") - 1), lambda x: x != F.col("_blk")))
        blocks = lists.where(F.col("_nb") > 1)
        left = blocks.select(group, F.col("_blk").alias("_a"), others.alias("_b"), *[F.col(x).alias("_o" + x) for x in names])
        right = blocks.select(group, F.col("_blk").alias("_b"), others.alias("_a"), *names)
        above = F.lit(1) if both else F.size(F.filter("_m", lambda x: x <= F.col("m"))) + 1
        rows = rows.unionByName(placed(left.join(right, [group, "_a", "_b"]), "_o", above))
    tag = []
    if cells is not None:
        tag = ["_g"]
        met = salted_join(cells.select(group, narrow(member).alias("m")), lists.select(group, *names), group, "m")
        nothing = [F.lit(None).cast(rows.schema["_o" + v].dataType).alias("_o" + v) for v in vals]
        fewer = [F.col(x) if x in ("_m", vals[-1]) else F.array().cast(rows.schema[x].dataType).alias(x) for x in names]
        rows = rows.withColumn("_g", F.lit(None).cast(cells.schema[group].dataType)).unionByName(
            met.select("m", *nothing, *fewer, F.col(group).alias("_g")))
    rows = rows.where(F.size("_m") > 0)
    salt = F.lit(0)
    if hot:
        # the partners of such a member travel one by one
        one = F.transform(F.sequence(F.lit(0), F.size("_m") - 1), lambda k: F.struct(
            F.pmod(F.xxhash64(F.get("_m", k)), F.lit(parts)).cast("int").alias("s"), *[F.array(F.get(x, k)).alias(x) for x in names]))
        whole = F.array(F.struct(F.lit(0).alias("s"), *names))
        rows = rows.withColumn("_d", F.explode(F.when(F.col("m").isin(hot), one).otherwise(whole)))
        rows = rows.select("m", F.col("_d.s").alias("_salt"), *tag, *["_o" + v for v in vals], *[F.col(f"_d.{x}").alias(x) for x in names])
        rows, salt = rows.repartition(parts, "m", "_salt"), F.col("_salt")
    else:
        rows = rows.repartition(parts, "m")
    flat = rows.select("m", salt.alias("_salt"), *tag, *["_o" + v for v in vals], F.inline(F.arrays_zip(*names)))
    # a member that a group has twice is no pair
    return flat.where(F.col("m") != F.col("_m")).select(
        "m", F.col("_m").alias("n"), "_salt", *tag, *[F.col("_o" + x).alias(f"{v}_1") for v, x in zip(values, vals, strict=True)],
        *[F.col(x).alias(f"{v}_2") for v, x in zip(values, vals, strict=True)])


def mirror(pairs: DataFrame, a: str, b: str, extra_swaps: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """The pair table together with its transpose (``a`` and ``b`` swapped).

    Both directions come out of one scan (``explode`` of a two-element array),
    so the upstream pair aggregation runs once; a ``union`` of the table with
    a projection of itself would run the whole pair generation twice.
    """
    cols = pairs.columns
    swapped = {a: b, b: a}
    for x, y in extra_swaps:
        swapped[x], swapped[y] = y, x
    same = F.struct(*[F.col(c).alias(c) for c in cols])
    flipped = F.struct(*[F.col(swapped.get(c, c)).alias(c) for c in cols])
    return pairs.select(F.explode(F.array(same, flipped)).alias("_m")).select(
        *[F.col("_m." + c).alias(c) for c in cols])


def salted_join(big: DataFrame, small: DataFrame, key: str | Sequence[str], spread: str | Sequence[str],
                block_size: int = DEFAULT_BLOCK_SIZE, small_spread: str | None = None,
                hot: DataFrame | None = None, how: str = "inner") -> DataFrame:
    """Equi-join on ``key`` where one key may hold a large share of the rows.

    A hot key of ``big`` is split into ``ceil(n / block_size)`` salts by a hash
    of ``spread`` and its rows in ``small`` are sent to every salt; with
    ``small_spread`` a hot key of ``small`` is split likewise, so that the two
    sides meet in a grid of salts, each pair of rows once.  Other keys keep
    salt 0 and are not replicated.  The tables of hot keys are broadcast; see
    ``hot_keys`` for their bound.

    ``hot`` replaces the count of ``big``'s keys by a ``hot_keys`` table over
    some of the key columns, for a ``big`` that is costly to compute.
    ``how='left'`` keeps every row of ``big`` and goes without ``small_spread``.
    """
    if how not in ("inner", "left") or (how == "left" and small_spread):
        raise ValueError("how must be 'inner', or 'left' without small_spread")
    keys = [key] if isinstance(key, str) else list(key)
    by = [spread] if isinstance(spread, str) else list(spread)
    hot = hot_keys(big, keys, block_size) if hot is None else hot
    on = [c for c in hot.columns if c != "_kn"]
    n_a = F.broadcast(hot.select(*on, _blocks("_kn", block_size).alias("_na")))
    a, b = big.join(n_a, on, "left"), small.join(n_a, on, "left")
    if small_spread is None:
        a, b = a.withColumn("_nb", F.lit(1)), b.withColumn("_nb", F.lit(1))
    else:
        n_b = F.broadcast(hot_keys(small, keys, block_size).select(*keys, _blocks("_kn", block_size).alias("_nb")))
        a, b = a.join(n_b, keys, "left"), b.join(n_b, keys, "left")

    def salt(cols: Sequence[str], n: str):
        return F.pmod(F.xxhash64(*cols), F.coalesce(n, F.lit(1))).cast("int")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.coalesce(n, F.lit(1)) - 1))

    a = a.withColumn("_a", salt(by, "_na")).withColumn("_b", every("_nb")).drop("_na", "_nb")
    b = (b.withColumn("_b", salt([small_spread or keys[0]], "_nb")).withColumn("_a", every("_na"))
          .drop("_na", "_nb"))
    return a.join(b, [*keys, "_a", "_b"], how).drop("_a", "_b")
