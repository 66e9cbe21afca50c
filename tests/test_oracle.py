"""Every SQL-backed registered query equals its DuckDB oracle at sf0.001."""

import math

import pytest

from tastebud.plans.registry import all_queries

from .conftest import SF_SMALL

QUERIES = all_queries()
SQL_NAMES = sorted(n for n, q in QUERIES.items() if q.sql is not None)


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(v)
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=repr)


@pytest.mark.parametrize("name", SQL_NAMES)
def test_matches_duckdb(spark, duck, name):
    q = QUERIES[name]
    got = q.fn(spark, SF_SMALL).toPandas()
    want = duck.execute(q.sql).df()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_registry_contract():
    import __spark_entry__ as E

    qs = E.queries()
    sql = E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 100
    assert set(QUERIES) <= set(qs)


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["user_id", "item_id", "score", "rank"]
    assert df.count() > 0
