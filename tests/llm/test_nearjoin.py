import random
import re

import numpy as np
import pytest

from tastebud.llm import nearjoin as J
from tastebud.llm.queries import QUERIES

LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingles(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    n = min(5, len(w))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def brute(docs):
    """(id, class, copies, links) of each row."""
    sets = [shingles(t) for _, t in docs]
    near = [[j for j, b in enumerate(sets) if j != i and a and b and 5 * len(a & b) >= 4 * len(a | b)] for i, a in enumerate(sets)]
    seen, out = [None] * len(docs), []
    for i in range(len(docs)):
        if seen[i] is None:
            stack, members = [i], {i}
            while stack:
                for j in near[stack.pop()]:
                    if j not in members:
                        members.add(j)
                        stack.append(j)
            ids = [docs[m][0] for m in members if docs[m][0] is not None]
            for m in members:
                seen[m] = min(ids) if ids else None
    for i, (key, _) in enumerate(docs):
        out.append((key, seen[i], 1 + sum(sets[j] == sets[i] for j in near[i]), len(near[i])))
    return sorted(out, key=repr)


def rows(found):
    return sorted(((r["doc_id"], r["class_id"], r["copies"], r["n_links"]) for r in found.collect()), key=repr)


def test_query(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = rows(QUERIES["op5_jaccard_join"](spark, sf))
    assert got == brute(docs) and any(r[3] for r in got)


def family(rnd, size, words=60, edits=2):
    base = [f"w{rnd.randint(0, 10 ** 6)}" for _ in range(words)]
    for _ in range(size):
        w = list(base)
        for _ in range(rnd.randint(0, edits)):
            w[rnd.randrange(words)] = f"e{rnd.randint(0, 10 ** 6)}"
        yield " ".join(w)


@pytest.fixture(scope="module")
def families():
    rnd = random.Random(5)
    texts = [t for n in (150, 40, 2, 3, 5, 1, 1) for t in family(rnd, n)]
    return list(enumerate(texts))


def test_families(spark, families):
    df = spark.createDataFrame(families, "doc_id long, text string")
    assert rows(J.near_duplicates(df)) == brute(families)


def test_components_beyond_a_task_are_split(spark, families, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_NODES", 16)
    df = spark.createDataFrame(families, "doc_id long, text string")
    assert rows(J.near_duplicates(df)) == brute(families)


def test_odd_rows(odd, odd_clash, no_docs):
    want = brute([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert rows(J.near_duplicates(odd)) == want and rows(J.near_duplicates(odd_clash)) == want
    assert rows(J.near_duplicates(no_docs)) == []


def test_keep_one(spark, families, odd):
    df = spark.createDataFrame([*families, families[0], families[0]], "doc_id long, text string")
    kept = J.keep_one(df, J.near_duplicates(df)).collect()
    classes = {c for _, c, _, _ in brute(families)}
    assert sorted(r["doc_id"] for r in kept) == sorted(classes)
    assert J.keep_one(odd, J.near_duplicates(odd)).count() == 11


def test_prefix_is_shortened_until_the_recall():
    assert J.prefix_length(0.8, 0.5) > J.prefix_length(0.8, 0.9995) >= J.prefix_length(0.6, 0.9995)
    n = J.prefix_length(0.8, 0.9995)
    assert 1 - (1 - 0.8 ** n) ** J.TREES >= 0.9995


def test_intersections():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 50_000, 4000).astype(np.uint64)) for _ in range(30)]
    a, b = np.triu_indices(30, 1)
    want = [len(set(sets[i]) & set(sets[j])) for i, j in zip(a, b, strict=True)]
    assert J._intersections(sets, a, b).tolist() == want
