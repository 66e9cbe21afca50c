"""Hot keys: joins and blocks spread them, and results stay those of the plain join."""

import pytest
from pyspark.sql import functions as F

from tastebud.operators import pairs as P

HUB_ROWS = 20_000


@pytest.fixture
def plain_joins(spark):
    """No runtime help: neither AQE nor automatic broadcasts."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _hub(spark, n, name):
    """Key 0 has ``n`` rows, keys 1..50 have two each."""
    hub = spark.range(n).select(F.lit(0).cast("bigint").alias("k"), F.col("id").alias(name))
    return hub.unionByName(spark.range(100).select((F.col("id") % 50 + 1).alias("k"), F.col("id").alias(name)))


def _largest_share(df):
    per = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(per) / sum(per), sum(per)


def _rows(df):
    return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("k", "x", "y").cast("decimal(38,0)"))).first()


def test_hub_in_the_large_side(spark, plain_joins):
    big, small = _hub(spark, HUB_ROWS, "x"), _hub(spark, 10, "y")
    got = P.salted_join(big, small, "k", "x", block_size=500)
    share, n = _largest_share(got)
    assert n == HUB_ROWS * 10 + 200
    assert share < 0.4
    assert _rows(got) == _rows(big.join(small, "k"))


def test_hub_in_the_small_side(spark, plain_joins):
    big, small = _hub(spark, 10, "x"), _hub(spark, HUB_ROWS, "y")
    got = P.salted_join(big, small, "k", "x", block_size=500, small_spread="y")
    share, n = _largest_share(got)
    assert n == HUB_ROWS * 10 + 200
    assert share < 0.4
    assert _rows(got) == _rows(big.join(small, "k"))


def test_hub_in_both_sides_and_given_hot_table(spark, plain_joins):
    big, small = _hub(spark, 900, "x"), _hub(spark, 700, "y")
    want = _rows(big.join(small, "k"))
    assert _rows(P.salted_join(big, small, "k", "x", block_size=100, small_spread="y")) == want
    assert _rows(P.salted_join(big, small, "k", "x", block_size=100, hot=P.hot_keys(big, ["k"], 100))) == want


def test_left_join_keeps_unmatched_and_null_keys(spark, plain_joins):
    big = _hub(spark, 900, "x").unionByName(spark.createDataFrame([(None, -1), (99, -2)], "k bigint, x bigint"))
    small = spark.createDataFrame([(0, 7), (1, 8)], "k bigint, y bigint")
    got = P.salted_join(big, small, "k", "x", block_size=100, how="left")
    assert got.count() == big.count()
    assert _rows(got) == _rows(big.join(small, "k", "left"))


def test_hot_table_is_bounded_by_the_partitions(spark):
    many = spark.range(100 * 50).select((F.col("id") % 100).alias("k"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert P.hot_keys(many, ["k"], 10).count() == parts
    assert P.hot_keys(many, ["k"], 50).count() == 0


def test_blocks_cover_hot_and_other_large_groups(spark, plain_joins):
    """More large groups than the broadcast table lists: every one still gets its blocks."""
    r = spark.range(100 * 50).select((F.col("id") % 100).alias("g"), F.col("id").alias("m"))
    got = P.with_blocks(r, "g", "m", 10)
    assert got.columns == ["g", "m", "_nb", "_blk"]
    assert got.count() == 5000
    assert [x[0] for x in got.select("_nb").distinct().collect()] == [5]
    assert P.pairs_within(r, "g", "m", block_size=10).count() == 100 * 50 * 49 // 2


def test_left_join_and_small_spread_exclude_each_other(spark):
    one = spark.createDataFrame([(1, 1)], "k bigint, x bigint")
    with pytest.raises(ValueError):
        P.salted_join(one, one.withColumnRenamed("x", "y"), "k", "x", small_spread="y", how="left")
