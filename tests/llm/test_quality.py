import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from tastebud.llm import quality as Q
from tastebud.llm.queries import ORACLES, QUERIES


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    covered = {p for i, g in enumerate(grams) if n[g] > 1 for p in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def check(df):
    got = Q.quality_rules(df).select("text", "quality.*").collect()
    for r in got:
        want = brute(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r["base_failed"] == failed
        assert r["kept"] == (not r["failed"]) and not (failed and r["kept"])
    return got


def test_matches_brute_force(docs):
    assert len(check(docs)) == docs.count()


def test_odd_rows(odd, odd_clash):
    assert len(check(odd)) == odd.count()
    out = Q.quality_rules(odd_clash)
    assert out.columns == [*odd_clash.columns, "quality"] and out.count() == odd.count()


def test_kept_rows_equal_the_verdict(docs):
    want = {r["doc_id"] for r in Q.quality_rules(docs).where("quality.kept").collect()}
    kept = Q.kept_rows(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == want


def test_empty_table(no_docs):
    assert Q.quality_rules(no_docs).count() == 0 and Q.kept_rows(no_docs).count() == 0


def test_no_user_function_and_no_shuffle(docs):
    plan = Q.quality_rules(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    got = sorted(map(tuple, QUERIES["op6_quality_rules"](spark, sf).collect()), key=repr)
    assert got == sorted(con.execute(ORACLES["op6_quality_rules"]).fetchall(), key=repr)


def test_thresholds_are_a_parameter(docs):
    strict = (Q.Rule("short", "n_words", smallest=10 ** 9),)
    assert Q.quality_rules(docs, rules=strict).where(F.col("quality.kept")).isEmpty()


def test_the_pipeline_keeps_clean_long_texts(spark, docs):
    import corpus_pipeline

    words = " ".join(f"the word{i} of line{i}" for i in range(30_000))
    long = spark.createDataFrame([(1, words), (2, "x " * 120_000)], "doc_id long, text string")
    assert [r["doc_id"] for r in corpus_pipeline.quality_stage(spark, long, "").collect()] == [1]
    assert Q.quality_rules(long, rules=(*Q.RULES, Q.MAX_WORDS)).where("doc_id = 1").first()["quality"]["failed"] == ["max_words"]
