"""Hand-computed micro cases for operator semantics and reference quirks."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tastebud.operators import evaluate as E
from tastebud.operators import graph as G
from tastebud.operators import models as M
from tastebud.operators import pairs as P
from tastebud.operators import prep as PR
from tastebud.operators import ranking as RK
from tastebud.operators import similarity as S
from tastebud.operators import topk as K
from tastebud.sources import files as IO


def _ratings(spark):
    rows = [(1, 10, 5), (1, 11, 3), (1, 12, 4), (2, 10, 4), (2, 12, 2), (3, 11, 1), (3, 12, 5),
            (3, 13, 3), (4, 10, 2), (4, 11, 2), (4, 12, 2), (4, 13, 2), (4, 14, 5)]
    return spark.createDataFrame(rows, "user_id long, item_id long, rating int")


def _hot(spark, n_hot=40):
    # user 0 holds most rows: the hot group must be split into blocks
    rows = [(0, i, 1 + i % 5) for i in range(n_hot)] + [(u, (u * 7) % n_hot, 3) for u in range(1, 15)]
    return spark.createDataFrame(rows, "user_id long, item_id long, rating int")


def test_pairs_within_blocks_equal_plain_self_join(spark):
    r = _hot(spark)
    got = P.pairs_within(r.select("user_id", "item_id"), "user_id", "item_id", block_size=4)
    a, b = r.alias("a"), r.alias("b")
    want = a.join(b, (F.col("a.user_id") == F.col("b.user_id")) & (F.col("a.item_id") < F.col("b.item_id"))) \
        .select(F.col("a.user_id"), F.col("a.item_id").alias("item_id_1"), F.col("b.item_id").alias("item_id_2"))
    assert got.count() == want.count() == 40 * 39 // 2 + 0
    assert got.exceptAll(want).count() == 0


def test_similarity_independent_of_block_size(spark):
    r = _hot(spark)
    for fn in (lambda b: S.cosine_cooc(r, block_size=b), lambda b: S.jaccard(r, block_size=b),
               lambda b: S.cosine_rated(r, block_size=b, both=True, diagonal=True)):
        small = fn(3).withColumn("w", F.round("w", 12))
        large = fn(10_000).withColumn("w", F.round("w", 12))
        assert small.exceptAll(large).count() == 0 and large.exceptAll(small).count() == 0


def test_cosine_cooc_by_hand(spark):
    r = _ratings(spark)
    w = {(x.i, x.j): x.w for x in S.cosine_cooc(r).collect()}
    # items 10 and 12 are co-rated by users 1, 2, 4; n_10 = 3, n_12 = 4
    assert math.isclose(w[(10, 12)], 3 / math.sqrt(3 * 4))
    assert math.isclose(w[(12, 10)], w[(10, 12)])
    assert (10, 10) not in w


def test_jaccard_diagonal_variants(spark):
    r = _ratings(spark)
    d1 = {(x.i, x.j): x.w for x in S.jaccard(r, diagonal=1.0).collect()}
    d0 = {(x.i, x.j): x.w for x in S.jaccard(r, diagonal=0.0).collect()}
    assert d1[(10, 10)] == 1.0 and d0[(10, 10)] == 0.0
    # |{1,2,4} ∩ {1,3,4}| / |{1,2,3,4}| = 2/4
    assert d1[(10, 11)] == 0.5


def test_top_k_neighbors_ties_on_id(spark):
    sim = spark.createDataFrame([(1, 5, 0.5), (1, 3, 0.5), (1, 4, 0.9), (1, 2, 0.1)], "i long, j long, w double")
    got = [(x.j, x.rank) for x in S.top_k_neighbors(sim, 2).orderBy("rank").collect()]
    assert got == [(4, 1), (3, 2)]


def test_row_number_matches_window(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("v"), (F.col("id") % 3).alias("g"))
    a = RK.row_number(df, [F.col("v").desc()], groups=["g"], name="rn")
    b = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(F.col("v").desc())).cast("bigint"))
    assert a.exceptAll(b.select(*a.columns)).count() == 0


def test_dedupe_last_wins(spark):
    df = spark.createDataFrame([(1, 1, 3, 1), (1, 1, 5, 2), (1, 2, 4, 1), (1, 1, 2, 0)],
                               "u long, i long, r int, t int")
    got = {(x.u, x.i): x.r for x in PR.dedupe_last(df, ["u", "i"], ["t"], ["r"]).collect()}
    assert got == {(1, 1): 5, (1, 2): 4}


def test_id_map_dense_and_checked(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "name string")
    got = {x.name: x.idx for x in PR.build_id_map(df, "name").collect()}
    assert got == {"a": 0, "b": 1, "c": 2}
    big = spark.createDataFrame([(2**40,)], "user_id long")
    with pytest.raises(Exception):
        M.check_int_ids(big, "user_id").collect()


def test_split_exact_quota(spark):
    df = spark.range(0, 1001).select(F.col("id").alias("user_id"), (F.col("id") % 7).alias("item_id"))
    out = PR.split_exact(df, 0.25)
    assert out.where("in_test").count() == math.ceil(0.25 * 1001)


def test_stratified_kfold_balanced(spark):
    df = spark.range(0, 300).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    out = PR.stratified_kfold(df, "y", "doc_id", 3).groupBy("y", "fold").count().collect()
    assert {(x.y, x.fold): x["count"] for x in out} == {(0, f): 200 // 3 + (1 if f < 200 % 3 else 0) for f in range(3)} | \
        {(1, f): 100 // 3 + (1 if f < 100 % 3 else 0) for f in range(3)}


def test_negative_sample_invariants(spark):
    r = _ratings(spark)
    s = PR.negative_sample(r.select("user_id", "item_id")).collect()
    pos = {(x.user_id, x.item_id) for x in r.collect()}
    negs = [(x.user_id, x.item_id) for x in s if x.label == 0]
    assert not set(negs) & pos
    assert len(negs) == len(set(negs))
    n_u = {}
    for u, _ in pos:
        n_u[u] = n_u.get(u, 0) + 1
    for u in n_u:
        assert sum(1 for x in negs if x[0] == u) <= n_u[u] + 1
    assert {(x.user_id, x.item_id) for x in s if x.label == 1} == pos


def test_item_meta_last_duplicate_wins(spark, tmp_path):
    p = tmp_path / "meta.csv"
    p.write_text("7,8.1,first\n,1.0,skipped\n9,2.0,nine,extra\n7,3.3,second\n")
    got = {x.item_id: x.name for x in IO.read_item_meta(spark, str(p)).collect()}
    assert got == {7: "second", 9: "nine"}


def test_user_movies_trim_and_recode(spark, tmp_path):
    p = tmp_path / "um.csv"
    p.write_text(" alice , 3 , -1 \nbob,4,2\n")
    got = {(x.user, x.item_id): x.rating for x in IO.read_user_movies(spark, str(p)).collect()}
    assert got == {("alice", 3): 3.0, ("bob", 4): 2.0}


def _walk_by_matrix(edges, start, alpha, damping=0.6, rounds=20):
    """Power iteration x <- damping * P x + restart, with the start's in-degree as restart weight."""
    names = sorted({n for e in edges for n in e})
    number = {n: k for k, n in enumerate(names)}
    adjacency = np.zeros((len(names), len(names)))
    for src, dst in edges:
        adjacency[number[dst], number[src]] = 1.0
    transition = adjacency / adjacency.sum(axis=0)
    unit = np.eye(len(names))[number[start]]
    restart = (1 - alpha) * adjacency[number[start]].sum() * unit
    x = unit
    for _ in range(rounds):
        x = damping * transition @ x + restart
    return dict(zip(names, x, strict=True))


def test_personal_rank_per_edge_restart(spark):
    edges = [("A", "a"), ("A", "c"), ("B", "a"), ("B", "b"), ("B", "c"), ("B", "d"), ("C", "c"), ("C", "d")]
    both = edges + [(i, u) for u, i in edges]
    want = _walk_by_matrix(both, "A", 0.8)
    e = spark.createDataFrame(both, "src string, dst string")
    got = {x.node: x.rank for x in G.personal_rank(e, "A", alpha=0.8).collect()}
    assert set(got) == set(want)
    for k in want:
        assert math.isclose(got[k], want[k], rel_tol=1e-9, abs_tol=1e-12)


def test_evaluate_denominators(spark):
    recs = spark.createDataFrame([(1, 11), (1, 13), (2, 11)], "user_id long, item_id long")
    train = spark.createDataFrame([(1, 10), (2, 10), (3, 12)], "user_id long, item_id long")
    test = spark.createDataFrame([(1, 11), (2, 13), (9, 11)], "user_id long, item_id long")
    fixed = E.evaluate_topn(recs, train, test, n=2).first()
    actual = E.evaluate_topn(recs, train, test, n=2, denominator="actual").first()
    assert fixed.hits == 1 and fixed.n_test == 2
    assert math.isclose(fixed.precision, 1 / 6) and math.isclose(actual.precision, 1 / 3)
    assert math.isclose(fixed.recall, 1 / 2)


def test_auc_matches_pairwise(spark):
    rng = np.random.default_rng(0)
    s = rng.integers(0, 20, 300)
    y = (rng.random(300) < 0.4).astype(int)
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(s, y)], "score long, y int")
    got = E.auc(df, "score", "y", partitions=5).first().auc
    pos, neg = s[y == 1], s[y == 0]
    want = np.mean([(p > q) + 0.5 * (p == q) for p, q in itertools.product(pos, neg)])
    assert math.isclose(got, want, rel_tol=1e-12)


def test_nmf_on_demo_matrix(spark):
    # The 4 x 6 rating matrix of the reference's NMF demo.
    demo = [[5, 5, 3, 0, 5, 5], [5, 0, 4, 0, 4, 4], [0, 3, 0, 5, 4, 5], [5, 4, 3, 3, 5, 5]]
    rows = [(u, i, float(v)) for u, r in enumerate(demo) for i, v in enumerate(r)]
    a = spark.createDataFrame(rows, "user_id long, item_id long, v double")
    w, h, losses = M.nmf(a, k=2, iters=40, checkpoint_every=5)
    assert all(b <= a_ + 1e-9 for a_, b in zip(losses, losses[1:]))
    wd = w.toPandas()
    hd = h.toPandas()
    assert (wd[["w0", "w1"]].values >= 0).all() and (hd[["h0", "h1"]].values >= 0).all()
    approx = wd.sort_values("user_id")[["w0", "w1"]].values @ hd.sort_values("item_id")[["h0", "h1"]].values.T
    assert np.linalg.norm(np.array(demo) - approx) < 0.35 * np.linalg.norm(demo)


def test_truncated_svd_recovers_low_rank(spark):
    rng = np.random.default_rng(1)
    A = rng.random((30, 3)) @ rng.random((3, 20))
    rows = [(u, i, float(A[u, i])) for u in range(30) for i in range(20)]
    a = spark.createDataFrame(rows, "user_id long, item_id long, v double")
    u, s, v = M.truncated_svd(a, k=3, oversample=4, power_iters=1)
    assert list(s) == sorted(s, reverse=True)
    assert np.allclose(s, np.linalg.svd(A, compute_uv=False)[:3], rtol=1e-6)
    cells = a.select("user_id", "item_id", "v")
    pred = M.svd_predict_cells(u, s, v, cells).toPandas()
    assert np.abs(pred.prediction - pred.v).max() < 1e-6


def test_als_smaller_lambda_fits_better(spark):
    r = _ratings(spark).withColumn("rating", F.col("rating").cast("float"))
    m1 = M.fit_als(r, rank=4, max_iter=10, reg=1.0)
    m2 = M.fit_als(r, rank=4, max_iter=10, reg=0.01)
    e1 = M.training_mse(m1, r).first()[0]
    e2 = M.training_mse(m2, r).first()[0]
    assert math.isfinite(e1) and e2 < e1


def test_fm_score_matches_formula(spark):
    act = spark.createDataFrame([(1, 0, 1.0), (1, 2, 2.0), (2, 1, 1.0)], "row_id long, feature long, x double")
    lin = spark.createDataFrame([(0, 0.5), (1, -0.25), (2, 0.125)], "feature long, w double")
    fac = spark.createDataFrame([(0, 0.1, 0.2), (1, 0.3, -0.1), (2, -0.2, 0.4)], "feature long, v_0 double, v_1 double")
    got = {x.row_id: x.prediction for x in M.fm_score(act, lin, fac, 0.1, k=2).collect()}
    V = np.array([[0.1, 0.2], [0.3, -0.1], [-0.2, 0.4]])
    x1 = np.array([1.0, 0.0, 2.0])
    want1 = 0.1 + 0.5 + 0.25 + 0.5 * ((x1 @ V) ** 2 - (x1 ** 2) @ (V ** 2)).sum()
    assert math.isclose(got[1], want1)
    assert math.isclose(got[2], 0.1 - 0.25)


def test_take_n_and_sort(spark):
    r = _ratings(spark)
    assert [(x.user_id, x.item_id) for x in K.take_n(r, 2, ["user_id", "item_id"]).collect()] == [(1, 10), (1, 11)]


def test_categorical_indices():
    assert PR.categorical_indices(["acctbal", "nation", "segment", "n_events"], ["segment", "nation"]) == [1, 2]


def test_first_k_not_in(spark):
    from tastebud.operators.threshold import first_k_not_in

    ranking = spark.createDataFrame([(k, k - 100) for k in range(101, 111)], "key long, pos long")
    groups = spark.createDataFrame([(1,), (2,)], "g long")
    excl = spark.createDataFrame([(1, 101), (1, 103), (1, 104)], "g long, key long")
    got = {}
    for x in first_k_not_in(groups, excl, ranking, 3, "g", "key").collect():
        got.setdefault(x.g, []).append(x.key)
    assert sorted(got[1]) == [102, 105, 106] and sorted(got[2]) == [101, 102, 103]


def test_salted_join_equals_plain_join(spark):
    big = _hot(spark).select(F.col("item_id").alias("k"), F.col("user_id").alias("u"), "rating")
    # make key 0 hot on the big side
    big = big.unionByName(spark.range(0, 50).select(F.lit(0).cast("long").alias("k"),
                                                    (F.col("id") + 100).alias("u"),
                                                    F.lit(2).alias("rating")))
    small = spark.createDataFrame([(k, j, 0.5 + j) for k in range(0, 40) for j in range(3)],
                                  "k long, j long, w double")
    got = P.salted_join(big, small, "k", "u", block_size=4)
    want = big.join(small, "k")
    assert got.count() == want.count()
    assert got.select(*want.columns).exceptAll(want).count() == 0


def test_large_ids_hash_without_overflow(spark):
    big = [(15_000_000_000 + u, 20_000_000_000 + i) for u in range(6) for i in range(u, u + 5)]
    r = spark.createDataFrame(big, "user_id long, item_id long")
    assert PR.split_exact(r, 0.25).count() == len(big)
    labelled = spark.createDataFrame([(d, d % 2) for d, _ in set(big)], "doc_id long, quality int").dropDuplicates()
    assert PR.stratified_kfold(labelled, "quality", "doc_id", 3).count() == labelled.count()
    assert PR.negative_sample(r).where("label = 1").count() == len(big)


def test_draws_reach_the_whole_pool(spark):
    """One user's draws over a pool whose size shares every factor of the hash's constants."""
    size = 3 * 23 * 587
    t = spark.range(1, 10 * size + 1).select(PR.draw_hash(F.lit(77), F.col("id"), 12345).alias("h"))
    got = t.agg(F.countDistinct(F.pmod("h", F.lit(size))).alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi")).first()
    assert got["n"] > 0.999 * size and got["lo"] >= 0 and got["hi"] > 1 << 60


def test_evaluation_of_the_first_users(spark):
    train = _ratings(spark)
    recs = spark.createDataFrame([(1, 13), (1, 14), (2, 11), (3, 10), (4, 99)], "user_id long, item_id long")
    test = spark.createDataFrame([(1, 13, 1), (2, 11, 1), (3, 10, 1)], "user_id long, item_id long, rating int")
    got = E.evaluate_topn(recs, train, test, 2, users_limit=2).first()
    assert (got["hits"], got["n_recs"], got["n_users"], got["n_test"]) == (2, 3, 2, 2)
    whole = E.evaluate_topn(recs, train, test, 2).first()
    assert (whole["hits"], whole["n_recs"], whole["n_users"], whole["n_test"]) == (3, 5, 4, 3)


def test_metrics_from_one_pair_aggregate(spark):
    """A metric of one's own and named ones against the definition; a member is 1 to itself."""
    r = _ratings(spark)
    rows = {}
    for x in r.collect():
        rows.setdefault(x["item_id"], {})[x["user_id"]] = x["rating"]
    got = S.similarity(r, "dice", "tanimoto", lambda of: of("c") / (of("n_i") + of("n_j")), value="rating", diagonal=True).collect()
    assert len(got) == sum(bool(set(a) & set(b)) for a in rows.values() for b in rows.values())
    for x in got:
        a, b = rows[x["i"]], rows[x["j"]]
        both = set(a) & set(b)
        dot, ss = sum(a[u] * b[u] for u in both), sum(v * v for v in a.values()) + sum(v * v for v in b.values())
        assert math.isclose(x["w"], 2 * len(both) / (len(a) + len(b))) and math.isclose(x["w2"], dot / (ss - dot))
        assert math.isclose(x["w3"], len(both) / (len(a) + len(b)))


def test_sketches_of_parts_unite(spark):
    from tastebud.operators import aggregate as A

    df = spark.range(200_000).select((F.col("id") % 50_000).alias("user_id"), (F.col("id") % 7).alias("item_id"), (F.col("id") % 5).alias("day"))
    parts = A.distinct_sketches(df, ["user_id", "item_id"], by=["day"])
    assert parts.count() == 5
    got = A.united_counts(parts, ["user_id", "item_id"]).first()
    assert abs(got["user_id"] - 50_000) < 1000 and got["item_id"] == 7 and got["n_rows"] == 200_000
    near = A.distinct_counts(df, approximate=True).first()
    assert abs(near["n_users"] - 50_000) < 1000 and near["n_ratings"] == 200_000


def test_block_products_sum_as_spark_does(spark, monkeypatch):
    """Blocks of 7 cells: a frequent key spans several; missing keys meet no factor, missing values and factors add nothing."""
    import random
    from collections import defaultdict

    monkeypatch.setattr(M, "BLOCK_CELLS", 7)
    rnd = random.Random(3)
    cells = [(f"u{rnd.randint(0, 20)}", 1 if rnd.random() < 0.4 else rnd.randint(0, 30), float(rnd.randint(1, 5))) for _ in range(150)]
    cells += [(None, 1, 2.0), ("u1", None, 3.0), ("only", 5, None), ("nothing", 77, 1.0)]
    factors = [(i, i + 0.5, None if i == 2 else -float(i)) for i in range(31)] + [(None, 9.0, 9.0)]
    blocks = M._Blocks(spark.createDataFrame(cells, "user_id string, item_id long, v double"), "item_id", "user_id")
    assert blocks.parts > 8 and blocks.places.where("item_id = 1").count() > 1
    got = {r["user_id"]: (r["y0"], r["y1"]) for r in blocks.times(
        spark.createDataFrame(factors, "item_id long, f0 double, f1 double"), ["f0", "f1"], "y").collect()}
    blocks.close()
    want = defaultdict(lambda: [None, None])
    for u, i, v in cells:
        for row in (f for f in factors if i is not None and f[0] == i):
            own = want[u]
            for k in (0, 1):
                if v is not None and row[k + 1] is not None:
                    own[k] = (own[k] or 0.0) + v * row[k + 1]
    assert got.keys() == want.keys()
    for u, own in want.items():
        assert all((a is None and b is None) or abs(a - b) < 1e-9 for a, b in zip(got[u], own, strict=True))


def test_personal_rank_ships_reached_nodes_only(spark, monkeypatch):
    """A hub dealt over salts, a part of the graph that the root doesn't reach, an unknown root; ranks as by the plain loop."""
    monkeypatch.setattr(G, "HUB_EDGES", 3)
    pairs = [("A", x) for x in "abcdefgh"] + [("B", "a"), ("B", "b"), ("C", "h"), ("Y", "y"), ("Z", "y")]
    edges = pairs + [(b, a) for a, b in pairs]
    df = spark.createDataFrame(edges, "src string, dst string")
    for root, restart in (("A", "per_edge"), ("C", "once"), ("unknown", "once"), ("unknown", "per_edge")):
        got = {r["node"]: r["rank"] for r in G.personal_rank(df, root, rounds=7, restart=restart).collect()}
        nodes = {x for e in edges for x in e}
        boost = 0.2 * (sum(d == root for _, d in edges) if restart == "per_edge" else 1)
        rank = {x: float(x == root) for x in nodes}
        for _ in range(7):
            new = dict.fromkeys(nodes, 0.0)
            for s, d in edges:
                new[d] += rank.get(s, 0.0) * 0.6 / sum(x == s for x, _ in edges)
            if boost:
                new[root] = new.get(root, 0.0) + boost
            rank = new
        assert got.keys() == rank.keys() and all(abs(got[x] - rank[x]) < 1e-12 for x in rank)
    assert len(G.reached(G.adjacency(df)[0], G.adjacency(df)[1], "A", 0.0, 0.6, 4, 2).collect()) < len({x for e in edges for x in e})
