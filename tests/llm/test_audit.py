import re
from collections import Counter, defaultdict

import duckdb
import pytest

from tastebud.llm import audit as A
from tastebud.llm.queries import ORACLES, QUERIES

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_docs, top):
    """The definition, term by term; rows are (lang, source, text)."""
    lists = [(lang or "", source or "", TERM.findall((text or "").translate(UPPER))) for lang, source, text in rows]
    docs, total, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, w in lists:
        docs[lang].update(set(w))
        total[lang].update(w)
        groups[lang, source].update(w)
    out = []
    f = lambda p, q: (p - q) ** 2 // (p + q)
    for lang in {x for x, _, _ in lists}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]

        def shares(count, kept=kept):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10 ** 9 * (count[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p = {s: shares(c) for (x, s), c in groups.items() if x == lang}
        q = shares(total[lang])
        for s in p:
            value = {o: sum(f(p[s][t], p[o][t]) for t in kept) for o in p if o != s}
            own = {t: f(p[s][t], q[t]) for t in kept if groups[lang, s][t] and p[s][t] > q[t]}
            for part, values, most in (("pair", value, None), ("term", own, top)):
                order = sorted(values, key=lambda x: (-values[x], x.encode()))[:most]
                out += [(lang, s, part, x, values[x], i + 1) for i, x in enumerate(order)]
    return sorted(out)


def result(df):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect())


def rows_of(df):
    return [(r["lang"], r["source"], r["text"]) for r in df.collect()]


def test_query_equals_brute_force_and_sql(spark, sf):
    got = result(QUERIES["op12_source_divergence"](spark, sf))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert got == sorted(con.execute(ORACLES["op12_source_divergence"]).fetchall())
    assert got == brute(rows_of(spark.read.parquet(f"{sf}/documents.parquet")), 10, 10)


@pytest.mark.parametrize("min_docs", [1, 2, 50])
def test_odd_rows(odd, odd_clash, no_docs, min_docs):
    want = brute(rows_of(odd), min_docs, 10)
    assert result(A.divergence(odd, min_docs=min_docs)) == want
    clash = odd_clash.withColumnsRenamed({"t": "digest", "node": "term", "id": "n", "length": "docs", "block": "s", "k0": "split"})
    assert result(A.divergence(clash, min_docs=min_docs)) == want
    assert A.divergence(no_docs, min_docs=min_docs).count() == 0


@pytest.mark.parametrize("bits", [0, 3, 8])
def test_colliding_digests_are_split(docs, bits):
    """With few bits nearly every digest stands for several terms; the result is the same."""
    some = docs.orderBy("doc_id").limit(60)
    assert result(A.divergence(some, min_docs=2, bits=bits)) == brute(rows_of(some), 2, 10)


def test_tiles_salts_and_flushes(spark, monkeypatch):
    monkeypatch.setattr(A, "TILE", 3)
    monkeypatch.setattr(A, "TILE_COUNTS", 10)
    monkeypatch.setattr(A, "FLUSH_TERMS", 4)
    monkeypatch.setattr(A, "BROADCAST_ROWS", 0)
    rows = [("x", f"s{i % 11}", " ".join(f"w{'abcdefghijklmnopqrstuvwxyz'[(i * j) % 26]}" for j in range(1 + i % 9))) for i in range(300)]
    rows += [("y", "only", "One TWO two"), ("x", "none", "1 2 3"), ("z", "a", ""), ("z", "b", None)]
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(4)
    assert result(A.divergence(df, min_docs=2, top=3)) == brute(rows, 2, 3)


def test_hot_source_gives_no_more_rows_than_others(spark):
    """A third of all rows in one source: partial counts bound what a term of it sends."""
    rows = [("x", "hot" if i % 3 == 0 else f"s{i % 40}", f"common words here term{'abcdef'[i % 6]}") for i in range(3000)]
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(4)
    docs = A._documents(df, "text", "lang", "source")
    assert A.term_counts(docs, ["lang", "source"]).where("source = 'hot'").count() <= 4 * 9
    assert result(A.divergence(df)) == brute(rows, 10, 10)
