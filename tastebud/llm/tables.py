"""Written intermediate tables in the cluster's shared folder, and joins that keep hot keys apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def unused(name: str, *tables: DataFrame) -> str:
    """``name``, with underscores added until no table has a column of that name."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    The table survives lost executors and cuts the lineage.
    """
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lookup(df: DataFrame, table: DataFrame, key: str, rows_per_key: str, spread: Column) -> DataFrame:
    """Left join of ``df`` to ``table`` (one row per ``key``) without a hot key.

    ``rows_per_key`` is the column of ``table`` that tells how many rows of
    ``df`` have the key.  Keys with more than a partition's share of the rows
    are fewer than there are partitions, so that part of ``table`` is broadcast;
    rows without such a key join by it, and rows that need no join (null or hot
    key) are spread by ``spread``.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = table.agg(F.coalesce(F.sum(rows_per_key), F.lit(0))).first()[0]
    share = max(1000, int(total) // parts)
    others = [c for c in table.columns if c != key]
    hot = F.col(rows_per_key) > share
    first = table.where(hot).select(F.col(key).alias("_hk"), F.struct(*others).alias("_hot"))
    rest = table.where(~hot).select(F.col(key).alias("_rk"), F.struct(*others).alias("_rest"), F.col(rows_per_key).alias("_one"))
    marked = df.join(F.broadcast(first), F.col(key) == F.col("_hk"), "left")
    cold = marked.withColumn("_jk", F.when(F.col("_hk").isNull(), F.col(key)))
    cold = cold.withColumn("_js", F.when(F.col("_jk").isNull(), spread).otherwise(F.lit(0)))
    # always 0, but no literal: the optimizer would put that into the condition and join by the key alone
    rest = rest.withColumn("_rs", F.pmod("_one", F.lit(1)).cast(cold.schema["_js"].dataType)).drop("_one")
    on = F.col("_jk").eqNullSafe(F.col("_rk")) & (F.col("_js") == F.col("_rs"))
    joined = cold.join(rest, on, "left")
    pick = F.coalesce("_hot", "_rest")
    return joined.select(*df.columns, *[pick[c].alias(c) for c in others])
