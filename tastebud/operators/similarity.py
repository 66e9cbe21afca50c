"""Similarity operators (A1, A10, S1-S11) over long (group, member, value) tables.

All of them follow one plan:

1. per-member statistics (count, norm) by a partial + final hash aggregate;
2. the statistics are attached to the *rating rows* (one join on the member
   key) so the pair table never has to be joined again;
3. every row ships the list of its partners to the partition of its member
   (``pairs.partner_rows``), in the smallest types that hold the values;
4. one hash aggregate on ``(member_1, member_2, stats)`` in that partition;
5. optional mirror to both directions / diagonal.

Pairs with no common group are never generated: their Jaccard and cosine are
0 (or distance 1), which callers may treat as "absent".
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from . import pairs as P
from .topk import top_n_per_group


def member_counts(r: DataFrame, member: str, name: str = "n") -> DataFrame:
    """A1 generalised: number of groups (raters) per member."""
    return r.groupBy(member).agg(F.count(F.lit(1)).cast("bigint").alias(name))


def _stats(r: DataFrame, member: str, value: str | None) -> DataFrame:
    aggs = [F.count(F.lit(1)).cast("bigint").alias("_n")]
    if value is not None:
        aggs.append(F.sum(F.col(value).cast("double") * F.col(value).cast("double")).alias("_ss"))
    return r.groupBy(member).agg(*aggs)


def _pair_rows(r: DataFrame, stats: DataFrame | None, group: str, member: str, value: str | None, block_size: int,
               both: bool = False) -> DataFrame:
    """(m, n, <stats>_1, <stats>_2, c[, dot]) per pair m < n, or both directions, all n of an m in one partition
    unless m is hot; m and n in the type that ``narrow_types`` gives."""
    carried = [] if stats is None else [c for c in stats.columns if c != member]
    own = [] if value is None else [value]
    types = P.narrow_types(r, member, *own) | ({} if stats is None else P.narrow_types(stats, *carried))
    rows = r.select(group, member, *own)
    rs = rows if stats is None else P.salted_join(rows, stats, member, group)
    flat = P.partner_rows(rs, group, member, [*carried, *own], both, block_size, keys=r, types=types)
    sides = [f"{c}_{s}" for c in carried for s in (1, 2)]
    aggs = [F.count(F.lit(1)).cast("bigint").alias("c")]
    if value is not None:
        aggs.append(F.sum(F.col(value + "_1").cast("double") * F.col(value + "_2").cast("double")).alias("dot"))
    return flat.groupBy("m", "_salt", "n", *sides).agg(*aggs).select(
        "m", "n", *[F.col(f"{c}_{s}").cast(stats.schema[c].dataType).alias(f"{c}_{s}") for c in carried for s in (1, 2)],
        "c", *(["dot"] if own else []))


def _pair_aggregate(r: DataFrame, group: str, member: str, value: str | None,
                    block_size: int) -> DataFrame:
    """(m_1, m_2, _n_1, _n_2, c) or, with ``value``, (m_1, m_2, _ss_1, _ss_2, c, dot) for m_1 < m_2."""
    stats = _stats(r, member, value).select(member, "_n" if value is None else "_ss")
    agg = _pair_rows(r, stats, group, member, value, block_size)
    ids = [F.col(x).cast(r.schema[member].dataType).alias(f"{member}_{s}") for s, x in ((1, "m"), (2, "n"))]
    return agg.select(*ids, *[c for c in agg.columns if c not in ("m", "n")])


def cooccurrence(r: DataFrame, group: str = "user_id", member: str = "item_id",
                 both: bool = True, block_size: int = P.DEFAULT_BLOCK_SIZE) -> DataFrame:
    """A10: number of groups containing both members, per ordered pair (i != j)."""
    kind = r.schema[member].dataType
    half = _pair_rows(r, None, group, member, None, block_size).select(
        F.col("m").cast(kind).alias("i"), F.col("n").cast(kind).alias("j"), "c")
    return P.mirror(half, "i", "j") if both else half


def cosine_cooc(r: DataFrame, group: str = "user_id", member: str = "item_id",
                block_size: int = P.DEFAULT_BLOCK_SIZE) -> DataFrame:
    """Binary cosine ``c_ij / sqrt(n_i n_j)``, both directions, no diagonal."""
    agg = _pair_aggregate(r, group, member, None, block_size)
    half = agg.select(
        F.col(member + "_1").alias("i"), F.col(member + "_2").alias("j"),
        (F.col("c") / F.sqrt((F.col("_n_1") * F.col("_n_2")).cast("double"))).alias("w"))
    return P.mirror(half, "i", "j")


def cosine_neighbors(r: DataFrame, k: int, group: str = "user_id", member: str = "item_id",
                     block_size: int = P.DEFAULT_BLOCK_SIZE) -> DataFrame:
    """S4/S5 cut to S11: (i, j, w, rank), the ``k`` most similar ``j`` for each ``i`` (ties on j ascending).

    All pairs of an ``i`` are counted in one partition and cut there, so the pair table itself is never shuffled.
    """
    agg = _pair_rows(r, _stats(r, member, None), group, member, None, block_size, both=True)
    w = F.col("c") / F.sqrt((F.col("_n_1") * F.col("_n_2")).cast("double"))
    best = top_n_per_group(agg.select("m", "n", w.alias("w")), "m", "w", "n", k, round_decimals=None)
    kind = r.schema[member].dataType
    return best.select(F.col("m").cast(kind).alias("i"), F.col("n").cast(kind).alias("j"), "w", "rank")


def jaccard(r: DataFrame, group: str = "user_id", member: str = "item_id",
            diagonal: float | None = 1.0, both: bool = True,
            block_size: int = P.DEFAULT_BLOCK_SIZE) -> DataFrame:
    """``|A_i ∩ A_j| / |A_i ∪ A_j|`` on membership sets.

    ``diagonal``: value emitted for i == j (1.0 for S1/S2/S9, 0.0 for S8's
    double loop that never visits the diagonal, None to omit it).
    """
    agg = _pair_aggregate(r, group, member, None, block_size)
    half = agg.select(
        F.col(member + "_1").alias("i"), F.col(member + "_2").alias("j"),
        (F.col("c") / (F.col("_n_1") + F.col("_n_2") - F.col("c")).cast("double")).alias("w"))
    out = P.mirror(half, "i", "j") if both else half
    if diagonal is not None:
        diag = r.select(member).distinct().select(
            F.col(member).alias("i"), F.col(member).alias("j"),
            F.lit(float(diagonal)).alias("w"))
        out = out.unionByName(diag)
    return out


def jaccard_columns(r: DataFrame, group: str = "user_id", member: str = "item_id", block_size: int = P.DEFAULT_BLOCK_SIZE) -> DataFrame:
    """``jaccard`` without the diagonal, both directions counted in place: all rows of a j in one partition unless j is hot; j in a narrow type."""
    agg = _pair_rows(r, _stats(r, member, None), group, member, None, block_size, both=True)
    w = F.col("c") / (F.col("_n_1") + F.col("_n_2") - F.col("c")).cast("double")
    return agg.select(F.col("n").cast(r.schema[member].dataType).alias("i"), F.col("m").alias("j"), w.alias("w"))


def cosine_rated(r: DataFrame, group: str = "user_id", member: str = "item_id",
                 value: str = "rating", both: bool = False, diagonal: bool = False,
                 block_size: int = P.DEFAULT_BLOCK_SIZE) -> DataFrame:
    """Cosine of the rating vectors of two members.

    ``both=False, diagonal=False`` is S3 (upper triangle only, as a column
    similarity matrix); ``both=True, diagonal=True`` is S7 (full symmetric
    matrix with 1 on the diagonal for every member with a non-zero norm).
    """
    agg = _pair_aggregate(r, group, member, value, block_size)
    half = agg.select(
        F.col(member + "_1").alias("i"), F.col(member + "_2").alias("j"),
        (F.col("dot") / (F.sqrt(F.col("_ss_1")) * F.sqrt(F.col("_ss_2")))).alias("w"))
    out = P.mirror(half, "i", "j") if both else half
    if diagonal:
        diag = (r.groupBy(member)
                 .agg(F.sum(F.col(value).cast("double") ** 2).alias("_ss"))
                 .where(F.col("_ss") > 0)
                 .select(F.col(member).alias("i"), F.col(member).alias("j"),
                         F.lit(1.0).alias("w")))
        out = out.unionByName(diag)
    return out


def neighbor_sums(r: DataFrame, cells: DataFrame, group: str, member: str, value: str, extra: DataFrame | None = None,
                  block_size: int = P.DEFAULT_BLOCK_SIZE) -> DataFrame:
    """Sums over the rated cosines s (S3, without the diagonal) of members, from one exchange of lists.

    For each of ``cells`` (group g, member m): (g, m, ``sum``) with Σ_n value(g, n) s(m, n) over the members n of g.  For each
    member: (null, m, ``row``, ``row_<c>``..) with Σ_n s(m, n) and Σ_n s(m, n) c(n) for the columns c of ``extra`` (member, c..).
    The requests travel to their member's partition, where a window over (m, n) brings them the cosine: no pair is shuffled.
    """
    stats, more = _stats(r, member, value).select(member, "_ss"), []
    if extra is not None:
        more = [c for c in extra.columns if c != member]
        stats = P.salted_join(stats, extra, member, member)
    types = P.narrow_types(r.select(member).union(cells.select(member)), member) | P.narrow_types(r, value)
    types |= P.narrow_types(stats, "_ss", *more)
    rows = P.salted_join(r.select(group, member, value), stats, member, group)
    flat = P.partner_rows(rows, group, member, ["_ss", *more, value], True, block_size, keys=r, types=types, cells=cells)
    pair = Window.partitionBy("m", "_salt", "n").orderBy(F.col("_g").isNotNull())       # pairs first, then requests
    whole = pair.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    a, b = F.col(value + "_1").cast("double"), F.col(value + "_2").cast("double")
    norm = lambda k: F.sqrt(F.max(F.col(f"_ss_{k}").cast("double")).over(whole))
    met = flat.select("m", "_g", *[F.col(f"{c}_2").cast(stats.schema[c].dataType).alias(c) for c in more], b.alias("_v"),
                      (F.sum(a * b).over(whole) / (norm(1) * norm(2))).alias("w"), F.row_number().over(pair).alias("_k"))
    once = F.when(F.col("_k") == 1, F.col("w"))
    return met.groupBy("m", "_g").agg(
        F.sum(F.when(F.col("_g").isNotNull(), F.col("_v") * F.col("w"))).alias("sum"), F.sum(once).alias("row"),
        *[F.sum(once * F.col(c)).alias(f"row_{c}") for c in more]).select(
            F.col("_g").alias(group), F.col("m").cast(r.schema[member].dataType).alias(member), "sum", "row", *[f"row_{c}" for c in more])


def rated_row_sums(r: DataFrame, group: str, member: str, value: str, extra: DataFrame | None = None) -> DataFrame:
    """(member, ``row``, ``row_<c>``..): Σ_n s(m, n) and Σ_n s(m, n) c(n) over the rated cosines s (S3, without the diagonal)
    for the columns c of ``extra`` (member, c..), without any pair.

    With x = value / norm of its member, Σ_n s(m, n) c(n) = Σ_g x(g, m) (Σ_n x(g, n) c(n) - x(g, m) c(m)): a sum per group, then one per member.
    """
    more = [] if extra is None else [c for c in extra.columns if c != member]
    stats = _stats(r, member, value).select(member, F.sqrt("_ss").alias("_norm"))
    if extra is not None:
        stats = P.salted_join(stats, extra, member, member)
    rows = r.dropna(subset=[group, member]).select(group, member, F.col(value).cast("double").alias("_v"))
    x = stored(P.salted_join(rows, stats, member, group).select(
        group, member, F.try_divide("_v", "_norm").alias("_x0"), *[(F.try_divide("_v", "_norm") * F.col(c)).alias(f"_x{k}") for k, c in enumerate(more, 1)]), "rows")
    every = [f"_x{k}" for k in range(len(more) + 1)]
    sums = x.groupBy(group).agg(*[F.sum(c).alias("_g" + c) for c in every])
    own = [F.sum(F.col("_x0") * (F.col("_g" + c) - F.coalesce(c, F.lit(0.0)))).alias(name)
           for c, name in zip(every, ["row", *[f"row_{c}" for c in more]], strict=True)]
    return P.salted_join(x, sums, group, member).groupBy(member).agg(*own)


#: Rows of a table that ``near_products`` broadcasts; larger ones are joined by salts.
BROADCAST_ROWS = 200_000


def few_join(big: DataFrame, small: DataFrame, key: str, spread: str, small_spread: str, hot: DataFrame) -> DataFrame:
    """``salted_join`` that leaves ``big`` in place while ``small``, a stored table, has at most ``BROADCAST_ROWS`` rows."""
    if small.count() <= BROADCAST_ROWS:
        return big.join(F.broadcast(small), key)
    return P.salted_join(big, small, key, spread, small_spread=small_spread, hot=hot)


def near_products(r: DataFrame, few: DataFrame, group: str, member: str, value: str, hot: DataFrame) -> DataFrame:
    """(member, j, p) with p = Σ_g w(g, m) v(g, j) over the groups g that a member m of the bounded table ``few`` shares with j.

    v is ``value`` and w the column ``_wv`` of ``r``, whose hot groups are ``hot``.  Only the groups of ``few``'s members are paired.
    """
    own = stored(r.join(F.broadcast(few.select(member)), member).select(group, member, "_wv"), "own")
    others = r.select(group, F.col(member).alias("j"), F.col(value).alias("_v"))
    return few_join(others, own, group, "j", member, hot).groupBy(member, "j").agg(F.sum(F.col("_wv") * F.col("_v")).alias("p"))


#: Metrics over the statistics that one pair aggregate gives: members' counts n_i, n_j and squared sums ss_i, ss_j, common
#: groups c and products dot.  All are 0 without a common group and 1 for a member with itself (where it has values).
METRICS: dict[str, Callable[[Callable[[str], Column]], Column]] = {
    "jaccard": lambda of: of("c") / (of("n_i") + of("n_j") - of("c")),
    "cosine": lambda of: of("c") / F.sqrt((of("n_i") * of("n_j")).cast("double")),
    "dice": lambda of: 2 * of("c") / (of("n_i") + of("n_j")),
    "overlap": lambda of: of("c") / F.least(of("n_i"), of("n_j")),
    "rated_cosine": lambda of: of("dot") / (F.sqrt(of("ss_i")) * F.sqrt(of("ss_j"))),
    "tanimoto": lambda of: of("dot") / (of("ss_i") + of("ss_j") - of("dot")),
}


def pair_statistics(r: DataFrame, group: str = "user_id", member: str = "item_id", value: str | None = None,
                    block_size: int = P.DEFAULT_BLOCK_SIZE) -> DataFrame:
    """(i, j, n_i, n_j, ss_i, ss_j, c, dot) of every pair i < j with a common group; a missing value counts as 1."""
    v = F.lit(1.0) if value is None else F.col(value).cast("double")
    rows = r.select(group, member, v.alias("_v"))
    stats = rows.groupBy(member).agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col("_v") * F.col("_v")).alias("_ss"))
    kind = r.schema[member].dataType
    return _pair_rows(rows, stats, group, member, "_v", block_size).select(
        F.col("m").cast(kind).alias("i"), F.col("n").cast(kind).alias("j"), F.col("_n_1").alias("n_i"), F.col("_n_2").alias("n_j"),
        F.col("_ss_1").alias("ss_i"), F.col("_ss_2").alias("ss_j"), "c", "dot")


def similarity(r: DataFrame, *metrics: str | Callable[[Callable[[str], Column]], Column], group: str = "user_id", member: str = "item_id",
               value: str | None = None, both: bool = True, diagonal: bool = False) -> DataFrame:
    """S9 with pluggable metrics: (i, j, w, w2, ..), one column for each of ``metrics``, all from one pair aggregate.

    A metric is a name in ``METRICS`` or a function of the same form.
    """
    of = [METRICS[m] if isinstance(m, str) else m for m in metrics]
    named = lambda f, k: f(F.col).cast("double").alias("w" if not k else f"w{k + 1}")
    half = pair_statistics(r, group, member, value).select("i", "j", *[named(f, k) for k, f in enumerate(of)])
    out = P.mirror(half, "i", "j") if both else half
    if diagonal:
        v = F.lit(1.0) if value is None else F.col(value).cast("double")
        own = r.groupBy(member).agg(F.count(F.lit(1)).alias("n"), F.sum(v * v).alias("ss"))
        same = {"n_i": "n", "n_j": "n", "c": "n", "ss_i": "ss", "ss_j": "ss", "dot": "ss"}
        out = out.unionByName(own.select(F.col(member).alias("i"), F.col(member).alias("j"), *[
            f(lambda name: F.col(same[name])).cast("double").alias("w" if not k else f"w{k + 1}") for k, f in enumerate(of)]))
    return out


def cosine_distance(sim_with_diag: DataFrame) -> DataFrame:
    """``1 - cosine`` in sparse form.

    The dense matrix is 1 for every pair with no common group; only the pairs
    that differ from 1 are returned (co-rated pairs and the diagonal, which is
    0).  Consumers such as R5/R6 use the sparse algebra instead of the grid.
    """
    return sim_with_diag.select("i", "j", (F.lit(1.0) - F.col("w")).alias("d"))


def sim_row(r: DataFrame, x, group: str = "user_id", member: str = "item_id",
            value: str = "rating") -> DataFrame:
    """(j, w), the rated cosine (S3) of member ``x`` with every member that shares a group.

    Only the groups of ``x`` are paired, with ``x`` alone: the cost is the
    histories of x's raters, not all pairs.
    """
    v = F.col(value).cast("double")
    own = r.where(F.col(member) == F.lit(x)).select(group, v.alias("_vx"))
    norm = F.sqrt(F.lit(own.agg(F.sum(F.col("_vx") * F.col("_vx"))).first()[0]).cast("double"))
    others = r.where(F.col(member) != F.lit(x)).select(group, F.col(member).alias("j"), v.alias("_v"))
    dots = (P.salted_join(others, own, group, "j")
             .groupBy("j").agg(F.sum(F.col("_v") * F.col("_vx")).alias("_dot")))
    norms = r.groupBy(F.col(member).alias("j")).agg(F.sum(v * v).alias("_ss"))
    return dots.join(norms, "j").select("j", (F.col("_dot") / (norm * F.sqrt("_ss"))).alias("w"))


def top_k_neighbors(sim: DataFrame, k: int, rank_col: str = "rank") -> DataFrame:
    """The ``k`` most similar ``j`` for each ``i`` (ties on j ascending)."""
    return top_n_per_group(sim, "i", "w", "j", k, rank_col=rank_col, round_decimals=None)
