"""Sharding by extendible hashing.

A key's hash has ``BITS`` bits.  The directory starts at depth zero, and only a
bucket whose rows exceed the byte limit splits on one more bit, so a shard is
the shallowest prefix whose bytes fit.  Bytes are first summed per hash, then per
prefix, level by level: each level reads only the children of oversized buckets,
a histogram that shrinks as buckets settle.  Texts are never shuffled.

Rows of one full hash cannot be told apart by more bits: such a bucket overflows
into chains of pages, filled by running bytes over per-partition sums, so a key
that holds a third of all rows still gives shards within the limit.  A single
row above the limit is a page of its own.

Defined results: null texts have zero bytes; a null key hashes like any other
key; repeated rows each get a shard; an empty table gives no shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import lookup, stored

BITS = 60
#: Bits by which the first histogram is finer than the expected directory.
FINER = 4


def key_hash(key: Column) -> Column:
    """60 bits of the key's MD5 as a non-negative long."""
    text = F.coalesce(key.cast("string"), F.lit("\x00null"))
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


def _prefix(h: Column, depth: Column) -> Column:
    return F.call_function("shiftright", h, (F.lit(BITS) - depth).cast("int"))


def directory(cells: DataFrame, limit: int) -> DataFrame:
    """Leaves (depth, prefix, bytes, rows) over ``cells`` (h, bytes, rows: one row per hash)."""
    leaves, depth = None, 0
    left = cells.select("h", "bytes", "rows")
    total = cells.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    while True:
        # several levels per pass: as many as the remaining bytes can need, and a few more
        ahead = min(BITS, depth + max(1, (int(total) // limit).bit_length() - depth) + FINER)
        fine = left.groupBy(F.shiftright("h", BITS - ahead).alias("p")).agg(
            F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
        fine = stored(fine, "histogram")
        level = fine.select("p", "bytes", "rows", F.explode(F.sequence(F.lit(depth), F.lit(ahead))).alias("depth"))
        sums = level.groupBy("depth", F.call_function("shiftright", F.col("p"), (F.lit(ahead) - F.col("depth")).cast("int")).alias("prefix")).agg(
            F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
        sums = stored(sums, "levels")
        settled = (F.col("bytes") <= limit) | (F.col("depth") == BITS)
        over = sums.where(~settled).select((F.col("depth") + 1).alias("d"), F.col("prefix").alias("parent"))
        # a leaf settles itself and has an oversized parent (the root has none)
        here = sums.where(settled).alias("s")
        kids = here.join(over, (F.col("depth") == F.col("d")) & (F.shiftright("prefix", 1) == F.col("parent")), "left_semi")
        found = kids.unionByName(sums.where(settled & (F.col("depth") == depth))) if depth == 0 else kids
        found = found.select("depth", "prefix", "bytes", "rows")
        leaves = found if leaves is None else leaves.unionByName(found)
        deeper = sums.where(~settled & (F.col("depth") == ahead)).select(F.col("prefix").alias("q"))
        if ahead == BITS or deeper.isEmpty():
            return stored(leaves, "directory")
        left = stored(left.join(deeper, F.shiftright("h", BITS - ahead) == F.col("q"), "left_semi"), "oversized")
        depth = ahead


def shards(df: DataFrame, key: str, limit: int, text: str = "text") -> DataFrame:
    """Per row: key, n_bytes, depth, prefix, page, shard (bits, then the page of an overflowing bucket), shard_bytes."""
    rows = stored(df.select(F.col(key).alias("k"), F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("b")
                            ).withColumn("h", key_hash(F.col("k"))), "keys")
    cells = rows.groupBy("h").agg(F.sum("b").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    leaves = directory(cells, limit)
    depths = [r["depth"] for r in leaves.select("depth").distinct().collect()]       # at most BITS + 1 numbers
    at = F.explode(F.array(*[F.lit(d) for d in sorted(depths)]).cast("array<int>"))
    fits = leaves.where(F.col("bytes") <= limit)
    # one hash per row here: the leaf of a hash is looked up once, not per row
    leaf = cells.select("h", at.alias("depth")).withColumn("prefix", _prefix(F.col("h"), F.col("depth"))).join(
        fits.select("depth", "prefix", F.col("bytes").alias("shard_bytes")), ["depth", "prefix"])
    # a hash without a leaf overflows its last bit; a hash of many rows is looked up apart, its rows stay where they are
    table = stored(cells.select("h", "rows").join(leaf.select("h", "depth", "prefix", "shard_bytes"), "h", "left"), "leaves")
    mapped = lookup(rows, table, "h", "rows", F.xxhash64(F.monotonically_increasing_id()))
    bits = F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("depth"), F.lit("0"))
    plain = mapped.where("depth is not null").select(
        F.col("k").alias(key), F.col("b").alias("n_bytes"), "depth", "prefix", F.lit(0).cast("long").alias("page"),
        F.when(F.col("depth") == 0, F.lit("")).otherwise(bits).alias("shard"), "shard_bytes")
    if leaves.where(F.col("bytes") > limit).isEmpty():
        return plain
    return plain.unionByName(_pages(mapped.where("depth is null").select("k", "b", "h"), key, limit))


def _pages(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """Pages of buckets that no further bit splits."""
    slots = 1024
    placed = stored(rows.withColumn("slot", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(slots))), "pages")
    # rows above half the limit are pages of their own; the others fill pages of at most the limit per slot
    small = placed.where(2 * F.col("b") <= limit)
    large = placed.where(2 * F.col("b") > limit).withColumn("n", F.monotonically_increasing_id()).select(
        "k", "h", "b", F.concat(F.lit("L"), F.col("n").cast("string")).alias("page_key"))
    run = Window.partitionBy("h", "slot").orderBy("b", "k").rowsBetween(Window.unboundedPreceding, -1)
    filled = small.withColumn("before", F.coalesce(F.sum("b").over(run), F.lit(0))).select(
        "k", "h", "b", F.concat_ws("/", "slot", F.floor(F.col("before") * 2 / limit)).alias("page_key"))
    every = stored(filled.unionByName(large), "filled")
    sizes = every.groupBy("h", "page_key").agg(F.sum("b").alias("shard_bytes"))
    number = Window.partitionBy("h").orderBy("page_key")
    named = sizes.withColumn("page", F.row_number().over(number).cast("long"))
    return every.join(named, ["h", "page_key"]).select(
        F.col("k").alias(key), F.col("b").alias("n_bytes"), F.lit(BITS).alias("depth"), F.col("h").alias("prefix"), "page",
        F.concat_ws("/", F.lpad(F.conv(F.col("h").cast("string"), 10, 2), BITS, "0"), F.col("page").cast("string")).alias("shard"),
        "shard_bytes")
