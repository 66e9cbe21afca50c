"""Pairs by partner lists, candidates by neighbour lists, and draws that are not broadcast, against plain Python."""

import math
import random
from collections import defaultdict

import pytest

from tastebud.operators import pairs as P
from tastebud.operators import prep
from tastebud.operators import recommend as R
from tastebud.operators import similarity as S


def _rows(seed=1, users=30, items=25, share=0.4, shift=0):
    rnd = random.Random(seed)
    rows = [(u, i + shift, rnd.randint(1, 5)) for u in range(users) for i in range(items) if rnd.random() < share]
    return rows + [(u, 7 + shift, 3) for u in range(users) if not any(r[0] == u and r[1] == 7 + shift for r in rows)]


def _df(spark, rows):
    return spark.createDataFrame(rows, "user_id long, item_id long, rating int")


def _histories(rows):
    h = defaultdict(dict)
    for u, i, v in rows:
        h[u][i] = v
    return h


@pytest.mark.parametrize("shift", [0, 2**40])
@pytest.mark.parametrize("both", [False, True])
@pytest.mark.parametrize("block", [4, 2048])
def test_partner_rows_are_all_pairs(spark, both, block, shift):
    """Blocks of 4 cut every group and deal every frequent member; ids beyond 32 bits stay whole."""
    rows = _rows(shift=shift)
    df = _df(spark, rows + [(None, 1, 1), (1, None, 1)])
    types = P.narrow_types(df, "item_id", "rating")
    assert types == ({"item_id": "tinyint", "rating": "tinyint"} if not shift else {"rating": "tinyint"})
    got = P.partner_rows(df, "user_id", "item_id", ["rating"], both, block, types=types).drop("_salt").collect()
    want = [(i, j, a, b) for h in _histories(rows).values() for i, a in h.items() for j, b in h.items() if (i != j if both else i < j)]
    assert sorted((r.m, r.n, r.rating_1, r.rating_2) for r in got) == sorted(want)


def test_pairs_of_a_member_share_a_partition_and_partitions_follow_pairs(spark):
    rows = _rows()
    df = _df(spark, rows)
    flat = P.partner_rows(df, "user_id", "item_id", both=True, task_pairs=50)
    pairs = sum(len(h) * (len(h) - 1) for h in _histories(rows).values())
    assert flat.rdd.getNumPartitions() == math.ceil(pairs / 50) > 8
    where = flat.rdd.mapPartitionsWithIndex(lambda k, it: [(k, r.m) for r in it]).distinct().collect()
    assert len(where) == len({m for _, m in where})


def test_pair_aggregate_shuffles_no_pair(spark):
    """Only lists are exchanged: above the last exchange stand the explode and both aggregates."""
    df = S.cosine_cooc(_df(spark, _rows()))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.index("inline(arrays_zip") < plan.index("Exchange")


def test_narrow_types_keep_what_does_not_fit(spark):
    df = spark.createDataFrame([(1.0, 2.5, 2**31, float("nan"), 300, None), (2.0, 3.0, 1, 1.0, None, None)],
                               "a double, b double, c long, d double, e long, f long")
    assert P.narrow_types(df, *df.columns) == {"a": "tinyint", "e": "smallint"}


def test_cosine_neighbors_equal_the_cut_table(spark):
    df = _df(spark, _rows())
    want = {(r.i, r.j, r.rank): r.w for r in S.top_k_neighbors(S.cosine_cooc(df), 4).collect()}
    for block in (4, 2048):
        assert {(r.i, r.j, r.rank): r.w for r in S.cosine_neighbors(df, 4, block_size=block).collect()} == want


@pytest.mark.parametrize("block", [4, 2048])
def test_recommenders_by_lists_and_by_rows(spark, monkeypatch, block):
    """Both forms give Σ w r over unseen candidates; a row without neighbours and null users are treated alike."""
    rows = _rows(share=0.25) + [(99, 777, 4), (None, 3, 2), (None, 5, 4)]
    df, h = _df(spark, rows), _histories(rows)
    monkeypatch.setattr(P, "DEFAULT_BLOCK_SIZE", block)
    nb = {(r.i, r.j): r.w for r in S.cosine_neighbors(df, 5).collect()}
    want = defaultdict(float)
    for u, own in h.items():
        for i, v in own.items():
            for (a, j), w in nb.items():
                if a == i and (u is None or j not in own):
                    want[u, j] += w * v
    got = {(r.user_id, r.item_id): r.score for r in R.item_cf_scores(df, S.cosine_neighbors(df, 5)).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)

    nb = {(r.i, r.j): r.w for r in S.cosine_neighbors(df, 5, "item_id", "user_id").collect()}
    for weighted in (False, True):
        want = defaultdict(float)
        for (u, v), w in nb.items():
            for i, x in h[v].items():
                if i not in h[u]:
                    want[u, i] += w * (x if weighted else 1)
        got = {(r.user_id, r.item_id): r.score
               for r in R.user_cf_scores(df, S.cosine_neighbors(df, 5, "item_id", "user_id"), weighted).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_draws_are_not_broadcast(spark, monkeypatch):
    """Adaptive execution sizes the draws by the rows before they are expanded; they have to be shuffled all the same."""
    seen = []
    own = prep.row_number
    monkeypatch.setattr(prep, "row_number", lambda df, *a, **k: (seen.append(df), own(df, *a, **k))[1])
    prep.negative_sample(_df(spark, _rows()).select("user_id", "item_id"))
    seen[1].collect()
    plan = seen[1]._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin [_idx" in plan and "BroadcastHashJoin [_idx" not in plan


@pytest.mark.parametrize("block", [4, 2048])
def test_neighbor_sums_against_brute_force(spark, block):
    """Cells of unknown groups and members give no sum; a cell's own member isn't its partner."""
    rows = _rows(users=12, items=15)
    h, ss = _histories(rows), defaultdict(float)
    dot = defaultdict(float)
    for own in h.values():
        for i, a in own.items():
            ss[i] += a * a
            for j, b in own.items():
                if i != j:
                    dot[i, j] += a * b
    s = {(i, j): d / (math.sqrt(ss[i]) * math.sqrt(ss[j])) for (i, j), d in dot.items()}
    cells = [(u, i) for u in range(13) for i in (*range(0, 15, 2), 2**35)]
    weight = {i: i % 4 + 0.5 for i in ss}
    got = S.neighbor_sums(_df(spark, rows), spark.createDataFrame(cells, "user_id long, item_id long"), "user_id", "item_id", "rating",
                          spark.createDataFrame(list(weight.items()), "item_id long, x double"), block).collect()
    sums = {(r.user_id, r.item_id): r.sum for r in got if r.user_id is not None and r.sum is not None}
    want = {(u, i): sum(v * s[i, j] for j, v in h[u].items() if (i, j) in s) for u, i in cells
            if u in h and any((i, j) in s for j in h[u])}
    assert sums.keys() == want.keys() and all(abs(sums[k] - want[k]) < 1e-9 for k in want)
    per = {r.item_id: (r.row, r.row_x) for r in got if r.user_id is None}
    for i in ss:
        want_row = [sum(w * f for (a, _), w, f in ((k, w, 1 if not x else weight[k[1]]) for k, w in s.items()) if a == i) for x in (0, 1)]
        assert all(abs(a - b) < 1e-9 for a, b in zip(per[i], want_row, strict=True))


def _drawn(rows, ratio, seed):
    """Labels by plain Python: the pool lists every row by item, a null item first."""
    def mix(x):
        return (x * (x % 65537 + 1)) % prep.MERSENNE

    pool = sorted(((i is not None, i or 0, u is not None, u or 0, i) for u, i in rows))
    out = sorted([(u, i, 1) for u, i in rows], key=str)
    for u in {u for u, _ in rows if u is not None}:
        own, new = [i for v, i in rows if v == u], []
        for t in range(1, ratio * len(own) + 1):
            x = (u % 2**31) * prep.SPLIT_HASH_USER + t * prep.SPLIT_HASH_ITEM + seed
            first = mix(x % prep.MERSENNE)
            h = first * prep.MERSENNE + mix((first * 48271 + t) % prep.MERSENNE)
            i = pool[h % len(pool)][-1]
            if i not in new and (i is None or i not in own):
                new.append(i)
        out += [(u, i, 0) for i in new[:len(own) + 1]]
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [4, 2048])
@pytest.mark.parametrize("nulls", [False, True])
def test_draws_by_history_and_by_row(spark, monkeypatch, block, nulls):
    """Draws found in ranges of the pool equal those by place, for histories that fit a block and for longer ones."""
    monkeypatch.setattr(prep, "DEFAULT_BLOCK_SIZE", block)
    rows = sorted({(u, i) for u, i, _ in _rows(share=0.2)}) + [(50, 2**40), (51, 7)] + ([(None, 7), (3, None), (None, None)] if nulls else [])
    df = spark.createDataFrame(rows + rows[:5], "user_id long, item_id long")
    got = prep.sample_histories(df, ratio=3, seed=5).collect()
    assert sorted([tuple(r) for r in got], key=str) == _drawn(rows, 3, 5)


def test_drawn_items_travel_once(spark):
    """One exchange by user: neither the draws' places nor a second pass by (user, item) or by draw are shuffled."""
    df = prep.sample_histories(_df(spark, _rows()).select("user_id", "item_id"))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "rangepartitioning" not in plan and plan.count("hashpartitioning(user_id") <= 3


def test_distance_neighbors_store_no_pair(spark, monkeypatch):
    """R8 equals the dense definition, with one row per item instead of a table of pairs; blocks of 4 deal frequent members."""
    from tastebud.operators import dense_topn as DT

    rnd = random.Random(11)
    rows = [(u, i * i, rnd.randint(1, 5)) for u in range(24) for i in range(40) if rnd.random() < (0.7 if i < 12 else 0.08)]
    universe = sorted({i for _, i, _ in rows} | {3, 5, 2000, 2001})
    h, norm, dot = _histories(rows), defaultdict(float), defaultdict(float)
    for own in h.values():
        for i, a in own.items():
            norm[i] += a * a
            for j, b in own.items():
                dot[i, j] += a * b

    def far(i):
        d = {j: max(1 - dot[i, j] / (math.sqrt(norm[i]) * math.sqrt(norm[j])), 0) if (i, j) in dot else 1.0 for j in universe if j != i}
        return [(j, round(d[j], 9)) for j in sorted((j for j in d if d[j]), key=lambda j: (-d[j], j))[:6]]

    every = _df(spark, rows + [(0, i, 1) for i in universe if not any(r[1] == i for r in rows)])
    wrote, real = [], DT.stored
    monkeypatch.setattr(DT, "stored", lambda df, name: wrote.append(name) or real(df, name))
    for block in (4, 2048):
        monkeypatch.setattr(DT.P, "DEFAULT_BLOCK_SIZE", block)
        got = defaultdict(list)
        for r in DT.item_cf_distance_neighbors(_df(spark, rows), every, 6).collect():
            got[r.i].append((r.j, round(r.w, 9)))
        assert {i: sorted(x) for i, x in got.items()} == {i: sorted(far(i)) for i in universe}
    assert "pairs" not in wrote


@pytest.mark.parametrize("rows_at_once,cells", [(8_000_000, 4_000_000), (40, 50)])
def test_binary_scores_exchange_no_sum(spark, monkeypatch, rows_at_once, cells):
    """R9's grid and best cells against plain sums, in one piece and in slices of few users and cells; no join by item or user."""
    rows = _rows(seed=3, share=0.25) + [(None, 3, 1), (None, 4, 1), (2, None, 1)]
    df = _df(spark, rows)
    raters = defaultdict(set)
    for u, i, _ in rows:
        if i is not None and u is not None:
            raters[i].add(u)
    own = defaultdict(set)
    for u, i, _ in rows:
        if i is not None:
            own[u].add(i)
    counts = {i: sum(r[1] == i for r in rows) for i in raters}
    weight = {(i, j): len(raters[i] & raters[j]) / (counts[i] + counts[j] - len(raters[i] & raters[j]))
              for i in raters for j in raters if i != j and raters[i] & raters[j]}
    want = {(u, j): s for u, h in own.items() for j in raters if (u is None or j not in h)
            if (s := sum(weight.get((i, j), 0) for i in h))}

    def refuse(*args, **kw):
        raise AssertionError("join of users with similarities")

    sim = S.jaccard_columns(df)
    assert {(r.i, r.j): pytest.approx(r.w) for r in sim.collect()} == weight
    monkeypatch.setattr(R, "SLICE_ROWS", rows_at_once)
    monkeypatch.setattr(R, "SUM_CELLS", cells)
    monkeypatch.setattr(R.P, "salted_join", refuse)
    got = R.binary_scores(df, sim).collect()
    assert len(got) == len(want) and {(r.user_id, r.item_id): pytest.approx(r.score) for r in got} == want
    top = R.binary_top_n(df, sim, 4).collect()
    for u in own:
        best = sorted((j for v, j in want if v == u), key=lambda j: (-round(want[u, j], 9), j))[:4]
        assert [r.item_id for r in sorted(top, key=lambda r: r["rank"]) if r.user_id == u] == best
