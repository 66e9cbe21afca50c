import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastebud.llm import katz as Z
from tastebud.llm.queries import QUERIES

LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
END, BEGIN = object(), object()


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW)), END]


class Model:
    """The definition, word by word."""

    def __init__(self, texts, order=2):
        self.order, self.grams, self.after = order, [Counter() for _ in range(order)], defaultdict(set)
        for t in texts:
            w = tokens(t)
            for k in range(order):
                for h, x in self.histories(w, k):
                    self.grams[k][*h, x] += 1
                    self.after[h].add(x)
        self.uni = Counter({x: c for (x,), c in self.grams[0].items()})
        self.n = sum(self.uni.values())
        self.context = Counter()
        for g in self.grams[1:]:
            for (*h, _), c in g.items():
                self.context[tuple(h)] += c
        self.d = [self.factors([sum(c == r for c in g.values()) for r in range(1, Z.K + 2)]) for g in self.grams]
        self.unknown = 1 - sum(self.keep(0, c) for c in self.uni.values()) / self.n if self.n else 1.0

    @staticmethod
    def histories(w, k):
        full = [BEGIN] * k + w
        return [(tuple(full[i:i + k]), x) for i, x in enumerate(w)]

    @staticmethod
    def factors(n):
        """Good-Turing discount factors of counts 1 .. K, and of those above."""
        out = [1 - Z.FLOOR] * (Z.K + 2)
        for r in range(1, Z.K + 1):
            if n[0] and n[r - 1] and n[r]:
                common = (Z.K + 1) * n[Z.K] / n[0]
                turing = (r + 1) * n[r] / n[r - 1] / r
                if common < 1 and 0 < (turing - common) / (1 - common) < 1:
                    out[r] = min((turing - common) / (1 - common), 1 - Z.FLOOR)
        return out

    def keep(self, k, c):
        return self.d[k][min(c, Z.K + 1)] * c

    def p(self, w, h):
        k = len(h)
        if not k:
            return self.keep(0, self.uni[w]) / self.n if self.uni[w] else self.unknown
        if self.grams[k][*h, w]:
            return self.keep(k, self.grams[k][*h, w]) / self.context[h]
        return self.alpha(h) * self.p(w, h[1:])

    def alpha(self, h):
        if not self.context[h]:
            return 1.0
        left = 1 - sum(self.keep(len(h), self.grams[len(h)][*h, x]) for x in self.after[h]) / self.context[h]
        return left / (1 - sum(self.p(x, h[1:]) for x in self.after[h]))

    def score(self, text):
        return sum(math.log10(self.p(x, h)) for h, x in self.histories(tokens(text), self.order - 1))

    def sums_to_one(self, contexts):
        for h in contexts:
            total = sum(self.p(w, h) for w in self.uni) + self.p(object(), h)
            assert math.isclose(total, 1, rel_tol=1e-9), h


def check(got, docs, learn, order=2):
    m = Model([t for k, t in docs if learn(k)], order)
    v, cache = len(m.uni), {}
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    assert len(got) == len(docs)
    for k, t in docs:
        w = tokens(t)
        if t not in cache:
            cache[t] = (len(w), sum(m.uni[x] > 0 for x in w), sum(math.log10((m.uni[x] + 1) / (m.n + 1 * (v + 1))) for x in w), m.score(t))
        n, known, base, score = cache[t]
        assert any(r["n_tokens"] == n and r["n_known"] == known and r["train_tokens"] == m.n
                   and math.isclose(r["base_score"], base, rel_tol=1e-9, abs_tol=1e-9)
                   and math.isclose(r["score"], score, rel_tol=1e-9, abs_tol=1e-9) for r in by[k]), (k, n, known, base, score, by[k])
    return m


def test_query(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    held = lambda k: zlib.crc32(str(k).encode()) % 7 == 2
    got = QUERIES["op1_katz_backoff"](spark, sf).collect()
    m = check(got, docs, lambda k: not held(k), 3)
    assert all(r["held_out"] == held(r["doc_id"]) for r in got)
    m.sums_to_one(list(m.context)[:40])


def test_longer_order(spark, docs, order=3):
    some = docs.where("doc_id % 3 = 0").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in some.collect()]
    got = Z.score(some, ["doc_id"], F.col("doc_id") % 7 != 2, order=order).collect()
    m = check(got, rows, lambda k: k % 7 != 2, order)
    m.sums_to_one([h for h in m.context if len(h) == order - 1][:40])


@pytest.mark.parametrize(("block_tokens", "order"), [(3, 2), (10 ** 6, 2), (3, 3), (3, 4)])
def test_small_blocks_and_hot_words(spark, monkeypatch, block_tokens, order):
    monkeypatch.setattr(Z, "BLOCK_TOKENS", block_tokens)
    monkeypatch.setattr(Z, "HOME_TOKENS", 7)
    texts = ["a b a b c", "A B", "a a a a a a a b", None, "", "d e f a b c", "x y z", "a b c d e f"] * 3
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    m = check(Z.score(df, ["doc_id"], F.col("doc_id") % 5 != 1, order=order).collect(), docs, lambda k: k % 5 != 1, order)
    m.sums_to_one(m.context)


def test_passes(spark, docs):
    some = docs.where("doc_id % 3 = 1").select("doc_id", "text")
    train = F.col("doc_id") % 7 != 2
    one, many = ({r["doc_id"]: r for r in Z.score(some, ["doc_id"], train, order=3, passes=n).collect()} for n in (1, 5))
    assert one.keys() == many.keys() and one
    for k, r in one.items():
        assert r["n_known"] == many[k]["n_known"] and math.isclose(r["score"], many[k]["score"], rel_tol=1e-9)


def test_words_and_integers_pack_to_themselves():
    rng = np.random.default_rng(3)
    for n in (0, 1, 1000, 200_000):
        v = rng.integers(0, 1 << 48, max(1, n // 2), dtype=np.uint64)[rng.integers(0, max(1, n // 2), n)]
        assert (Z._open_words(Z._pack_words(v)) == v).all()
        assert (Z._open_planes(Z._planes(v.astype(np.uint32)), np.uint32) == v.astype(np.uint32)).all()


def test_ends_and_their_contexts_are_dealt(spark):
    """Two-word texts: a third of the tokens are ends, a third follow the text's beginning."""
    df = spark.range(20_000).selectExpr("id AS doc_id", "concat('a', id % 5000, ' b', id % 7001) AS text")
    hot = Z._hot_words(df.select(F.col("text").alias("t")))
    assert Z.END in hot
    rows = df.selectExpr("doc_id AS k0", "true AS train", "text AS t")
    by = Z._blocks(rows, 1, 16, hot, 2).where("kind = 0").groupBy("bucket").agg(F.sum(F.length("docs")).alias("n")).collect()
    n = sorted(r["n"] for r in by)
    assert len(n) == 16 and n[-1] <= 2 * n[8]


def test_odd_rows(odd, odd_clash, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    train = F.col("doc_id") % 2 == 1
    learn = lambda k: k is not None and k % 2 == 1
    check(Z.score(odd, ["doc_id"], train).collect(), docs, learn)
    check(Z.score(odd, ["doc_id"], train, order=3).collect(), docs, learn, 3)
    check(Z.score(odd_clash, ["doc_id"], train).collect(), docs, learn)
    assert Z.score(no_docs, ["doc_id"], train).count() == 0


def test_base_score_of_one_text(spark):
    """Tokens a, b and the end, each once: N = 3, V = 3, so each gives log10(2 / 7)."""
    got = Z.score(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), ["doc_id"], F.lit(True)).first()
    assert math.isclose(got["base_score"], 3 * math.log10(2 / 7), rel_tol=1e-12) and round(got["base_score"], 4) == -1.6322


def test_base_columns_equal_sql(spark, sf):
    import duckdb

    want = duckdb.sql(f"""
        WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM '{sf}/documents.parquet'),
        t AS (SELECT doc_id, unnest(list_append(w, ' ')) AS w FROM d),
        c AS (SELECT t.w, count(*) AS c FROM t SEMI JOIN (SELECT column0 AS id FROM learned) l ON l.id = t.doc_id GROUP BY 1),
        s AS (SELECT sum(c) AS n, count(*) AS v FROM c)
        SELECT doc_id, count(*), count(c.c), any_value(s.n), sum(log10((coalesce(c.c, 0) + 1) / (s.n + 1 * (s.v + 1))))
        FROM t LEFT JOIN c ON c.w = t.w CROSS JOIN s GROUP BY 1""".replace("learned", f"""(SELECT UNNEST({
            [k for (k,) in duckdb.sql(f"SELECT doc_id FROM '{sf}/documents.parquet'").fetchall() if zlib.crc32(str(k).encode()) % 7 != 2]
        }) AS column0)""")).fetchall()
    got = {r["doc_id"]: r for r in QUERIES["op1_katz_backoff"](spark, sf).collect()}
    assert len(got) == len(want)
    for k, n, known, total, base in want:
        r = got[k]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total), k
        assert math.isclose(r["base_score"], base, rel_tol=1e-9), k


def test_nothing_to_learn_from(odd):
    got = Z.score(odd, ["doc_id"], F.lit(False)).collect()
    assert {(r["score"], r["train_tokens"], r["n_known"]) for r in got} == {(0.0, 0, 0)}


def test_references_reach_beyond_65536_blocks():
    one = {"bucket": 0, "words": np.array([5], np.uint64).tobytes(), "contexts": [Z._pack_words(np.array([7], np.uint64))],
           "pairs": [Z._pack(np.ones(1, np.uint32))], "times": Z._pack(np.ones(1, np.uint32)),
           "docs": Z._planes(np.zeros(1, np.uint16)), "train": Z._pack(np.ones(1, bool))}
    none = np.zeros(0, np.uint64)
    merged = Z._merge([{**one, "block": b} for b in range(65_537)], none)
    names = [x.strip().split(" ")[0] for x in Z._MERGED.split(",")]
    refs = Z._refs(dict(zip(names, merged, strict=True)))[1]
    assert sorted((refs >> 16).tolist()) == list(range(65_537))
