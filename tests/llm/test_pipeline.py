"""The pipeline against its five stages by brute force, and on odd tables."""

import duckdb
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tastebud.llm.queries import ORACLES, tokenizer_path

from . import test_decontam, test_nearjoin, test_packing, test_secrets

#: Column names that stages use inside, or did.
CLASHES = ("_text", "_secrets", "_i", "_h", "secrets", "secrets_id", "secrets_rules", "text_key", "found_secrets", "class_first", "class_hash",
           "node", "block", "id", "t", "k0", "n")


def masked(text):
    out, at = [], 0
    for a, _, b in test_secrets.brute(text):
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        at = max(at, b)
    return "".join(out) + (text or "")[at:] if out else text


def brute(docs, items):
    """(doc_id, text) that the first four stages keep, for distinct ids."""
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    good = {k for k, kept in con.execute(f"SELECT doc_id, kept FROM ({ORACLES['op6_quality_rules']})").fetchall() if kept}
    docs = [d for d in docs if d[0] in good]
    first = {k for k, c, _, _ in test_nearjoin.brute(docs) if k == c or c is None}
    docs = [d for d in docs if d[0] in first]
    bad = {k for k, *_, contaminated in test_decontam.brute(docs, items) if contaminated}
    return [(k, masked(t)) for k, t in docs if k not in bad]


def kept_by_stages(spark, docs, sf):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
    return docs


def test_run_equals_brute_force(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute(docs, items)
    assert 0 < len(want) < len(docs)
    pieces = corpus_pipeline.run(spark, sf).collect()
    test_packing.check(Tokenizer.from_file(tokenizer_path()), pieces, want)


@pytest.fixture(scope="module")
def long_rows(spark):
    """Texts that pass the quality rules, with secrets, copies, repeated rows and nulls."""
    prose = lambda i, n=20: " ".join(f"the word{i}x{j} of line{i}y{j} and more{i}z{j}" for j in range(n))
    rows = [(1, prose(1)), (2, prose(2) + " password=hunter2hunter2"), (3, prose(2) + " password=hunter2hunter2"), (4, None), (5, ""),
            (None, prose(6)), (7, prose(7)), (7, prose(7)), (8, prose(8) + " é token: abcdefgh12"), (9, prose(9, 20_000))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long")})


def test_odd_rows_through_all_stages(spark, long_rows, sf):
    got = kept_by_stages(spark, long_rows, sf)
    assert got.columns == long_rows.columns
    rows = got.collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == [(False, 1), (False, 2), (False, 7), (False, 8), (False, 9), (True, 0)]
    text = {r["doc_id"]: r["text"] for r in rows}
    assert text[2].endswith("[SECRET]") and text[8].endswith("é [SECRET]") and all(r["n_chars"] == len(r["text"]) for r in rows)
    assert corpus_pipeline.packing_stage(spark, got, sf).count() >= len(rows)


def test_clashing_columns_come_through_unchanged(spark, long_rows, sf):
    extra = long_rows.withColumns({c: F.lit(f"own {c}") for c in CLASHES})
    got = kept_by_stages(spark, extra, sf)
    assert got.columns == extra.columns
    rows = got.collect()
    assert len(rows) == 6 and all(r[c] == f"own {c}" for r in rows for c in CLASHES)


def test_empty_table(spark, long_rows, sf):
    got = kept_by_stages(spark, long_rows.limit(0), sf)
    assert got.columns == long_rows.columns and got.count() == 0
    assert corpus_pipeline.packing_stage(spark, got, sf).count() == 0
