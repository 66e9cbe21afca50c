"""Sort, limit and rank operators.

``top_n_per_group`` is a ``row_number() <= n`` filter.  Spark plans it as a
``WindowGroupLimit``: a partial limit runs on the map side before the shuffle,
so even a hot group ships at most ``n`` rows per map partition, and the final
window only sorts those survivors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranking import row_number

# Scores that come out of floating sums can differ in the last bits between
# engines or summation orders; ranking compares them rounded to this many
# places and breaks the remaining ties on the key ascending.
RANK_DECIMALS = 9


def rank_score(col: str | Column, decimals: int = RANK_DECIMALS) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c, decimals)


def top_n_per_group(df: DataFrame, group: str | Sequence[str], score: str, tiebreak: str,
                    n: int, rank_col: str = "rank", round_decimals: int | None = RANK_DECIMALS,
                    ascending: bool = False) -> DataFrame:
    groups = [group] if isinstance(group, str) else list(group)
    s = rank_score(score, round_decimals) if round_decimals is not None else F.col(score)
    w = Window.partitionBy(*groups).orderBy(s.asc() if ascending else s.desc(),
                                             F.col(tiebreak).asc())
    return (df.withColumn(rank_col, F.row_number().over(w))
              .where(F.col(rank_col) <= n)
              .withColumn(rank_col, F.col(rank_col).cast("bigint")))


def global_sort_desc(df: DataFrame, score: str, tiebreak: str, name: str = "pos") -> DataFrame:
    """K2: total order by score descending (range-partitioned sort), as a position column."""
    return row_number(df, [F.col(score).desc(), F.col(tiebreak).asc()], name=name)


def take_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """K3: deterministic preview of ``n`` rows (global top-n, not an arbitrary take)."""
    return df.orderBy(*[F.col(c).asc() for c in order]).limit(n)


def sort_by_key(df: DataFrame, keys: Sequence[str], name: str = "pos") -> DataFrame:
    """K4: total order by ``keys`` ascending, as a position column."""
    return row_number(df, list(keys), name=name)


def sorted_pairs(arr: Column) -> Column:
    """K5: items ascending inside an array of (item, value) structs."""
    return F.array_sort(arr)
