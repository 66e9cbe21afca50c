import hashlib
import re

from pyspark.sql import functions as F

from tastebud.llm import decontam as D
from tastebud.llm.queries import QUERIES

LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))


def brute(docs, items):
    grams = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            grams.setdefault(tuple(w[i:i + 13]), set()).add(str(item))
    sizes = {len(g) for g in grams}
    out = []
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (g := tuple(w[i:i + n])) in grams:
                    hit.update(range(i, i + n))
                    found |= grams[g]
        out.append((key, len(w), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def spark_rows(df, items, **options):
    found = D.contamination(df, items, ["doc_id"], **options).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in found), key=repr)


def test_query_matches_brute_force(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = [(k, n, h, len(f), hashlib.sha256(",".join(f).encode()).hexdigest(), c) for k, n, h, f, c in brute(docs, items)]
    got = QUERIES["op9_decontamination"](spark, sf).drop("n_near_items").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert any(c for *_, c in want)


def test_short_items_overlaps_and_odd_rows(spark, odd):
    items = [(1, "same text"), (2, "One!"), (3, None), (4, ""), (5, "word " * 30), (6, "word " * 30), (None, "no id"),
             (8, "ünïcödé 日本語"), (9, "absent everywhere"), (10, "x" * 200_000)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    want = brute(rows, [(i, t) for i, t in items if i is not None])
    assert spark_rows(odd, bench.where("item_id is not null")) == want
    assert len(spark_rows(odd, bench)) == len(rows)


def test_many_chunks_and_blocks_give_the_same(spark, docs):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    one = D.search(D.build_index(docs, ["doc_id"]), bench)
    many = D.search(D.build_index(docs, ["doc_id"], block_words=500), bench, item_bytes=500)
    key = lambda df: sorted((r["item_id"], r["exact"], str(r["spans"])) for r in df.where("exact").collect())
    assert key(one) == key(many)


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x beta y gamma"), (2, "alpha " + "z " * 99 + "beta gamma")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "gamma alpha beta")], "item_id long, text string")
    near = {r["doc_id"]: r["near_items"] for r in D.contamination(docs, bench, ["doc_id"]).collect()}
    assert near == {1: ["7"], 2: []}


def test_empty_tables(spark, docs, no_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert spark_rows(no_docs, bench) == []
    assert all(r[2] == 0 for r in spark_rows(docs, bench))


def test_clashing_columns(spark, odd, odd_clash):
    bench = spark.createDataFrame([(1, "same text")], "item_id long, text string")
    assert spark_rows(odd_clash, bench) == spark_rows(odd, bench)


def test_proximity_does_not_depend_on_blocks(spark):
    rows = [(1, "alpha beta gamma delta"), (2, "delta delta alpha"), (3, "alpha beta gamma"), (4, "delta beta"), (5, "gamma " * 9),
            (6, "delta " * 9), (7, "alpha alpha alpha")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([(7, "delta gamma alpha beta")], "item_id long, text string")

    def near(block_words):
        index = D.build_index(docs, ["doc_id"], block_words=block_words)
        found = D.search(index, bench).where("not exact")
        named = index.select("block", F.posexplode("docs").alias("doc", "d")).join(found, ["block", "doc"])
        return sorted(r["k0"] for r in named.select("d.k0").collect())

    assert near(10 ** 6) == near(1) == near(8) == [1, 3]


def test_proximity_stays_inside_a_document(spark):
    docs = spark.createDataFrame([(1, "alpha beta"), (2, "gamma x"), (3, "alpha beta gamma")], "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([(7, "gamma alpha beta")], "item_id long, text string")
    near = {r["doc_id"]: r["near_items"] for r in D.contamination(docs, bench, ["doc_id"]).collect()}
    assert near == {1: [], 2: [], 3: ["7"]}


def test_hashes_of_words_do_not_depend_on_their_place():
    """Powers counted from a stretch's start give each word the hash it has alone, also past many stretches."""
    import numpy as np
    import pyarrow as pa

    from tastebud.llm import wordbytes as W

    rnd = np.random.default_rng(5)
    words = ["".join(chr(97 + x) for x in rnd.integers(0, 26, n)) for n in rnd.integers(1, 12, 40_000)]
    words[7], words[20_000] = "é" * 50_000, "x" * (W.STRETCH + 3)
    texts = [" ".join(words), "", None, words[1], " \n" + words[20_000] + "\t" + words[3]]
    got = W.words(*W.text_bytes(pa.array(texts)), W.SPACED)
    assert got.counts.tolist() == [len(words), 0, 0, 1, 2]
    alone = W.words(*W.text_bytes(pa.array(words)), W.SPACED)
    assert got.hashes.tolist() == [*alone.hashes.tolist(), alone.hashes[1], alone.hashes[20_000], alone.hashes[3]]
    place = [int(c) for c in W.CODES[np.frombuffer(b"abc", np.uint8)]]
    total = sum(c * int(W.STEP) ** i for i, c in enumerate(place)) + 3
    assert W.words(*W.text_bytes(pa.array(["zz abc"])), W.SPACED).hashes[1] == W.mix(np.array([total % 2**64], np.uint64))[0]
