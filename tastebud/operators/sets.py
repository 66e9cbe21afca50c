"""Set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .similarity import _pair_aggregate


def concat(a: DataFrame, b: DataFrame) -> DataFrame:
    """Stack by column name; columns missing on one side become NULL."""
    return a.unionByName(b, allowMissingColumns=True)


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Multiset difference (EXCEPT ALL)."""
    return a.exceptAll(b.select(*a.columns))


def intersect_union_sizes(r: DataFrame, group: str, member: str) -> DataFrame:
    """|A_i ∩ A_j| and |A_i ∪ A_j| of the group sets of members i < j.

    Counted from block-salted pairs, not by materialising the sets; pairs with
    an empty intersection are not produced (their union is n_i + n_j).
    """
    agg = _pair_aggregate(r, group, member, None, 2048)
    return agg.select(F.col(member + "_1").alias("i"), F.col(member + "_2").alias("j"),
                      F.col("c").alias("inter"),
                      (F.col("_n_1") + F.col("_n_2") - F.col("c")).cast("bigint").alias("uni"))
