"""Queries without a SQL form: invariants of their whole results at sf0.001."""

import pytest
from pyspark.sql import functions as F

from tastebud.plans.registry import all_queries
from tastebud.sources import catalog as C

from .conftest import SF_SMALL

QUERIES = all_queries()


def _run(spark, name):
    return QUERIES[name].fn(spark, SF_SMALL)


def _count(df, *cols):
    return df.select(*cols).distinct().count()


def test_split_random_is_a_partition_of_the_ratings(spark):
    got = _run(spark, "split_random")
    ratings = C.ratings(spark, SF_SMALL)
    assert got.count() == ratings.count()
    assert _count(got, "user_id", "item_id") == ratings.count()


def test_loaded_model_scores_alike_once_per_pair(spark):
    got = _run(spark, "load_model").collect()
    pairs = C.user_movies(spark, SF_SMALL).select("user", "item_id")
    assert len(got) == pairs.distinct().count()
    assert all(r["same"] for r in got)


def test_saved_model_has_one_factor_row_per_user(spark):
    got = _run(spark, "save_model").collect()
    assert len(got) == len({r["id"] for r in got}) == _count(C.user_movies(spark, SF_SMALL), "user")
    assert {r["rank"] for r in got} == {10}


@pytest.mark.parametrize("name,user,n", [("als_implicit", "user_idx", 5), ("lfm_recommend", "user_id", 10)])
def test_recommendations_are_ranked_per_user(spark, name, user, n):
    rows = _run(spark, name).collect()
    by_user = {}
    for r in rows:
        by_user.setdefault(r[user], []).append((r["rank"], r["score"], r["item_id"]))
    for recs in by_user.values():
        recs.sort()
        assert [r[0] for r in recs] == list(range(1, len(recs) + 1)) and len(recs) <= n
        assert [r[1] for r in recs] == sorted((r[1] for r in recs), reverse=True)
        assert len({r[2] for r in recs}) == len(recs)


def test_lfm_has_one_factor_row_per_user(spark):
    got = _run(spark, "lfm")
    users = _count(C.ratings(spark, SF_SMALL), "user_id")
    assert got.count() == users == _count(got, "user_id")
    assert [r[0] for r in got.select(F.size("features")).distinct().collect()] == [10]


def test_fm_rows_cover_both_sides_of_the_split(spark):
    got = {r["split"]: r for r in _run(spark, "fm_regression").collect()}
    assert got["train"]["n"] == C.train(spark, SF_SMALL).count()
    assert got["test"]["n"] == C.test(spark, SF_SMALL).count()
    assert all(r["rmse"] > 0 for r in got.values())


def test_tuning_on_a_holdout(spark):
    """Low-rank ratings: 6 explicit and 12 implicit settings; strong regularisation is worst for the explicit ones."""
    import numpy as np

    from tastebud.operators import models as M

    rnd = np.random.default_rng(0)
    p, q = rnd.uniform(0.5, 1.5, (40, 2)), rnd.uniform(0.5, 1.5, (30, 2))
    rows = [(u, i, float(p[u] @ q[i])) for u in range(40) for i in range(30) if (u + i) % 3]
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating float")
    got = M.tune_als(df, [2, 4], [1.0, 0.01, 0.0001], [1.0, 40.0], parallelism=4, max_iter=4).collect()
    assert len(got) == 18 and sum(r["alpha"] is None for r in got) == 6 and all(np.isfinite(r["mse"]) for r in got)
    for rank in (2, 4):
        mse = {r["reg"]: r["mse"] for r in got if r["kind"] == "explicit" and r["rank"] == rank}
        assert mse[0.01] < mse[1.0] and mse[0.0001] < mse[1.0]


def _repeated_ratings(spark):
    rows = [(u, i, float((u * 3 + i) % 5 + 1)) for u in range(12) for i in range(9) if (u + i) % 3] + [(0, i % 9, 2.0) for i in range(40)]
    return spark.createDataFrame(rows, "user_id int, item_id int, rating float")


@pytest.mark.parametrize("limit", [0, 8_000_000])
def test_error_over_lists_is_that_over_rows(spark, limit):
    """A user of many rows has several lists; rows without a rating or with an unknown item or user don't count."""
    from tastebud.operators import models as M

    df = _repeated_ratings(spark)
    model = M.fit_als(df, rank=3, max_iter=3, reg=0.1)
    scored = df.union(spark.createDataFrame([(1, 99, 5.0), (99, 1, 5.0), (1, 1, None)], df.schema))
    lists = M.rating_lists(scored, block_size=8)
    assert lists.count() > 13 and max(r[0] for r in lists.select(F.size("items")).collect()) < 46
    want = M.training_mse(model, scored).first()[0]
    assert M.training_mse_lists(model, lists, limit=limit) == pytest.approx(want, rel=1e-5)
    assert M.training_mse_lists(model, lists.where("user_id = 99"), limit=limit) is None


def test_rows_of_ratings_meet_no_factors(spark):
    """Only factors of users are exchanged with the lists, not factors with every rated row."""
    from tastebud.operators import models as M

    df = _repeated_ratings(spark)
    model, seen = M.fit_als(df, rank=3, max_iter=2, reg=0.1), []
    lists = M.rating_lists(df)
    whole = type(lists).mapInArrow

    def watch(self, *args, **kw):
        seen.append(self)
        return whole(self, *args, **kw)

    type(lists).mapInArrow, undo = watch, whole
    try:
        M.training_mse_lists(model, lists)
    finally:
        type(lists).mapInArrow = undo
    assert [d.count() for d in seen] == [12] and set(seen[0].columns) == {"features", "items", "ratings"}


def test_item_blocks_keep_the_start(spark):
    """Fewer item blocks give the same model: the random start is dealt by user blocks."""
    from tastebud.operators import models as M

    df = _repeated_ratings(spark)
    a, b = (M.fit_als(df, rank=3, max_iter=3, reg=0.1, item_blocks=n) for n in (10, 2))
    for side in ("userFactors", "itemFactors"):
        x, y = ({r["id"]: r["features"] for r in getattr(m, side).collect()} for m in (a, b))
        assert x.keys() == y.keys() and all(x[k] == pytest.approx(y[k], abs=1e-3) for k in x)
