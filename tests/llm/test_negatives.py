import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tastebud.llm import negatives as N
from tastebud.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def mine(df, **more):
    return N.mine(df, "vec_id", "embedding", F.col("label"), F.col("vec_id") % 10 == 0, **more)


def brute(rows, every=10):
    """The definition over all pairs of rows."""
    used = [(i, [math.floor(256 * float(x)) for x in v], y) for i, v, y in rows
            if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = lambda x: (-x[1], x[0] is None, x[0] or 0)
    out = []
    for n, (i, v, y) in enumerate(used):
        if i is None or i % every:
            continue
        scores = [(j, sum(a * b for a, b in zip(v, w, strict=False)), z == y) for m, (j, w, z) in enumerate(used) if m != n]
        for p, ps, _ in sorted((s for s in scores if s[2]), key=order)[:5]:
            found = sorted((s for s in scores if not s[2] and 30 * ps <= 100 * s[1] <= 90 * ps), key=order)[:10]
            out += [(i, p, k + 1, j, ps, s) for k, (j, s, _) in enumerate(found)]
    return sorted(out, key=repr)


def clustered(n, width, groups, seed=1, spread=0.02):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(groups, width))
    return [(i, (centres[i % groups] + spread * rnd.normal(size=width)).tolist(), int(rnd.integers(4))) for i in range(n)]


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = sorted(con.execute(ORACLES["op11_hard_negatives"]).fetchall(), key=repr)
    assert want and result(QUERIES["op11_hard_negatives"](spark, sf)) == want


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (10, [1.0, 0.5], 2), (1, [0.9, 0.5], 1), (1, [0.9, 0.5], 1), (None, [0.8, 0.6], 1),
            (None, [0.5, 0.4], 2), (2, [0.5, 0.4], 2), (3, [0.5, 0.4], 3), (4, None, 1), (5, [None, 1.0], 1), (6, [nan, 1.0], 2), (7, [inf, 1.0], 2),
            (8, [-inf], 1), (9, [0.4, 0.4], None), (11, [], 1), (12, [0.7], 2), (13, [0.5, 0.1, 3.0], 3), (14, [-1.0, -0.5], 3), (20, [0.0, 0.0], 5),
            (21, [0.0], 5), (30, [-0.3, 0.2], 7), (31, [0.3, -0.2], 7)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert want and result(mine(df)) == want
    names = {c: F.lit("x") for c in ("id", "row", "v", "leaf", "bucket", "anchor", "score", "w", "low", "rank")}
    assert result(mine(df.withColumns(names))) == want
    assert mine(df.limit(0)).count() == 0
    assert mine(df.where("label IS NULL")).count() == 0


def test_ties_and_a_hot_vector(spark, monkeypatch):
    """A third of all rows are one vector: its leaf becomes many blocks and buckets, and nothing is lost."""
    monkeypatch.setattr(N, "BLOCK_ROWS", 16)
    monkeypatch.setattr(N, "BUCKET_ROWS", 40)
    monkeypatch.setattr(N, "SLICE_QUERIES", 9)
    rnd = random.Random(4)
    rows = clustered(400, 6, 8) + [(400 + i, [0.5] * 6, i % 3) for i in range(200)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert result(mine(df)) == brute(rows)
    index = N.Index(df, "vec_id", "embedding", F.col("label"), F.lit(False), 256)
    counts = index.blocks.groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    assert sum(r["n"] for r in counts) == 600 and len(counts) > 8 and max(r["n"] for r in counts) <= 3 * 40
    assert index.blocks.agg(F.max("n")).first()[0] <= 16


def test_large_components(spark):
    """Scores beyond 2**24 and 2**53 stay exact; beyond 2**56 an error says so."""
    for size in (1e3, 3e4, 1e5):
        rows = [(i, [x * size for x in v], y) for i, v, y in clustered(120, 3, 5, seed=int(size))]
        assert result(mine(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    with pytest.raises(ValueError, match="64 bits"):
        mine(spark.createDataFrame([(0, [1e300], 1), (1, [1.0], 1)], SCHEMA))


def test_ranges_eliminate_siblings_and_lose_nothing():
    rows = np.floor(256 * np.array([v for _, v, _ in clustered(3000, 8, 30)]))
    tree = N.Tree(rows[::3])
    leaf = tree.leaf(rows)
    leaves = {}
    for n in np.unique(leaf):
        own = rows[leaf == n]
        d = N.distances(own, tree.points_of(n))
        leaves[int(n)] = (d.min(0), d.max(0), (own ** 2).sum(1).min(), (own ** 2).sum(1).max(), int(n), int(n))
    tree.set_ranges(leaves)
    queries = rows[::50]
    score = queries @ rows.T
    best = np.sort(score, axis=1)[:, -20]
    looked = 0
    for i, found in enumerate(tree.surviving(queries, best, score.max(1))):
        assert set(leaf[score[i] >= best[i]]) <= set(found)
        looked += len(found)
    assert looked < 0.25 * len(queries) * len(leaves)
