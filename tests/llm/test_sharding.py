import hashlib
from collections import Counter, defaultdict

import duckdb
from pyspark.sql import functions as F

from tastebud.llm import sharding as S
from tastebud.llm.queries import ORACLES, QUERIES


def h(key):
    return int(hashlib.md5(("\x00null" if key is None else str(key)).encode()).hexdigest()[:15], 16)


def brute(rows, limit):
    """Extendible hashing one split at a time: {(depth, prefix): rows}."""
    done, todo = {}, [(0, 0, rows)]
    while todo:
        depth, prefix, own = todo.pop()
        if not own:
            continue
        if sum(b for _, b in own) <= limit or depth == S.BITS:
            done[depth, prefix] = own
            continue
        for bit in (0, 1):
            p = 2 * prefix + bit
            todo.append((depth + 1, p, [r for r in own if h(r[0]) >> (S.BITS - depth - 1) == p]))
    return done


def check(df, limit):
    rows = [(r["doc_id"], len((r["text"] or "").encode())) for r in df.select("doc_id", "text").collect()]
    got = S.shards(df, "doc_id", limit).collect()
    assert Counter((r["doc_id"], r["n_bytes"]) for r in got) == Counter(rows)
    size, count = defaultdict(int), Counter()
    for r in got:
        size[r["shard"]] += r["n_bytes"]
        count[r["shard"]] += 1
    for r in got:
        assert r["shard_bytes"] == size[r["shard"]] and (size[r["shard"]] <= limit or count[r["shard"]] == 1)
    want = {k: sorted(v, key=repr) for k, v in brute(rows, limit).items()}
    found = defaultdict(list)
    for r in got:
        found[r["depth"], r["prefix"]].append((r["doc_id"], r["n_bytes"]))
    assert {k: sorted(v, key=repr) for k, v in found.items()} == want
    return got


def test_matches_splitting_one_bucket_at_a_time(docs):
    for limit in (10 ** 9, 60_000, 25_000):
        check(docs, limit)


def test_odd_rows(odd, odd_clash, no_docs):
    check(odd, 400_000)
    check(odd, 30)
    check(odd_clash, 1000)
    assert S.shards(no_docs, "doc_id", 10).count() == 0


def test_one_hot_key_overflows_into_pages(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id) doc_id", "repeat('x', 100 + id % 50) text")
    got = check(df, 20_000)
    assert len({r["shard"] for r in got if r["doc_id"] == 7}) > 3


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    got = sorted(map(tuple, QUERIES["op8_extendible_sharding"](spark, sf).collect()), key=repr)
    assert got == sorted(con.execute(ORACLES["op8_extendible_sharding"]).fetchall(), key=repr)
    assert len({r[3] for r in got}) > 2


def test_runs_without_python(docs):
    assert "Python" not in S.shards(docs, "doc_id", 50_000)._jdf.queryExecution().toString()


def test_rows_of_a_hot_key_are_looked_up_where_they_are(spark):
    """A key with a third of all rows: no task gets more than its share of the looked-up rows."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.lit("x").alias("text"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(old, ("false", "-1"), strict=True):
            spark.conf.set(k, v)
        got = S.shards(df, "doc_id", 20_000)
        per = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(per) == 30_000 and max(per) < 2 * 30_000 / 8


def test_a_hot_key_beyond_the_limit(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.lit("xy").alias("text"))
    check(df, 1000)
