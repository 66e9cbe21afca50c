"""Distributed global / per-group row numbers.

``row_number() OVER (ORDER BY ..)`` without PARTITION BY runs in a single
task, and ``PARTITION BY g`` puts a hot group in one task.  ``row_number``
below gives the same numbers without either:

1. range-partition by ``(groups, order)`` and sort within partitions;
2. ``monotonically_increasing_id`` evaluated right after the sort encodes
   (partition id, position inside the partition) in one JVM-side expression;
   The stamped rows are checkpointed (reliable checkpoint in the shared
   ``spark.checkpoint.dir``): both the statistics and the final join must see
   the same range bounds, and two separate range exchanges would sample
   different ones.
3. a small statistics table, one row per (partition, group) present in it,
   gives each group's offset from the partitions before it;
4. number = offset + local position - first local position of the group.

The order must be total (include a unique tie-break) for the numbers to be
deterministic, exactly as for the SQL window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_LOCAL_BITS = 33  # monotonically_increasing_id = (partition id << 33) + position


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def row_number(df: DataFrame, order: Sequence[str | Column], groups: Sequence[str] = (),
               name: str = "rn", partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    keys = [F.col(g) for g in groups] + [_c(o) for o in order]
    # Without an explicit count AQE may coalesce neighbouring range partitions;
    # they stay contiguous and in order, so positions remain global.
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    r = (ranged.sortWithinPartitions(*keys)
           .withColumn("_mid", F.monotonically_increasing_id()))
    r = r.checkpoint(eager=True)
    r = (r.withColumn("_pid", F.shiftright(F.col("_mid"), _LOCAL_BITS))
          .withColumn("_loc", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))))
    st = r.groupBy("_pid", *groups).agg(F.count(F.lit(1)).alias("_cnt"), F.min("_loc").alias("_m"))
    w = (Window.partitionBy(*groups) if groups else Window).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    st = st.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    st = st.select("_pid", *groups, "_off", "_m")
    if not groups:
        # one row per range partition: bounded by the partition count
        st = F.broadcast(st)
    out = r.join(st, ["_pid", *groups])
    out = out.withColumn(name, (F.col("_off") + F.col("_loc") - F.col("_m") + F.lit(1)).cast("bigint"))
    return out.select(*df.columns, name)


def sum_before(df: DataFrame, order: Sequence[str], value: str, name: str = "before") -> DataFrame:
    """``df`` with the sum of ``value`` over all rows that come before in ``order``, by the offsets of range partitions."""
    ensure_checkpoint_dir(df.sparkSession)
    r = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_pid", F.spark_partition_id())
    r = r.checkpoint(eager=True)
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = r.groupBy("_pid").agg(F.sum(value).alias("_sum")).select("_pid", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_off"))
    local = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = r.withColumn("_loc", F.coalesce(F.sum(value).over(local), F.lit(0))).join(F.broadcast(offsets), "_pid")
    return out.select(*df.columns, (F.col("_off") + F.col("_loc")).alias(name))


def dense_index(df: DataFrame, key: str, name: str = "idx", start: int = 0,
                check_int32: bool = False) -> DataFrame:
    """Distinct ``key`` values -> consecutive index in key order."""
    d = df.select(key).distinct()
    out = row_number(d, [key], name=name)
    out = out.withColumn(name, F.col(name) - F.lit(1 - start))
    if check_int32:
        out = out.withColumn(name, F.when(F.col(name) <= F.lit(2**31 - 1), F.col(name).cast("int"))
                             .otherwise(F.raise_error(F.lit("id map exceeds the 32-bit range"))))
    return out
