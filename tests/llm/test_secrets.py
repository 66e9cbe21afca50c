import hashlib
import re

from tastebud.llm import secrets as S
from tastebud.llm.queries import QUERIES


def brute(text, rules=S.RULES):
    found = []
    for k, r in enumerate(rules):
        for m in re.finditer(r.pattern, text or "", re.ASCII):
            if len(m[r.group]) >= r.min_length:
                found.append((m.start(), k, m.end()))
    return sorted(found)


def render(found, rules=S.RULES):
    return ",".join(f"{rules[k].kind}:{a}:{b}" for a, k, b in found)


def check(df):
    rows = S.scan(df).collect()
    for r in rows:
        assert [tuple(x) for x in r["secrets"]] == brute(r["text"]), r["doc_id"]
    return rows


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op3_secret_scans"](spark, sf).collect()
    assert len(got) == len(texts) and sum(r["n_assign"] + r["n_access"] + r["n_hex"] for r in got) > 5
    for r in got:
        found = brute(texts[r["doc_id"]])
        own = [x for x in found if x[1] < 3]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(x[1] == k for x in own) for k in range(3))
        assert r["base_sha256"] == hashlib.sha256(render(own).encode()).hexdigest() and r["spans"] == render(found)


TEXTS = [
    "password=hunter2hunter2", "token: secret: abcdefgh12", "PASSWD : 'aaaaaaaa' apikey==abcdefgh", "API_KEY=short x",
    "AKIA1234567890123 xAKIAAKIAAKIAAKIA AKIA12", "f" * 31, "f" * 32, "é日 " + "0a" * 20 + "\U0001f600 token=12345678",
    "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a" * 36 + " xoxb-1234567890-a AIza" + "b" * 35,
    "eyJhbGciOiJI.eyJ1c2VyIjoxMQ.c2lnbmF0dXJl", "sk_live_" + "A1" * 10, "postgres://user:pass@host/db", None, "",
    "ſecret=abcdefgh1 toKen=abcdefgh1", "secret=password=12345678", "passwd=1234567 secret = \"12345678\"" * 50,
]


def test_edge_texts(spark):
    rows = check(spark.createDataFrame([(i % 7 or None, t) for i, t in enumerate(TEXTS)], "doc_id long, text string"))
    assert {k for r in rows for _, k, _ in r["secrets"]} == set(range(len(S.RULES)))


def test_odd_rows(odd, odd_clash, no_docs):
    assert len(check(odd)) == odd.count() and len(check(odd_clash)) == odd.count() and check(no_docs) == []


def test_queries_hold_for_matches():
    for r in S.RULES:
        for t in filter(None, TEXTS):
            if re.search(r.pattern, t, re.ASCII):
                low = t.lower()
                assert all(any(all(g in low for g in alt) for alt in clause) for clause in S.trigram_query(r.pattern))
    assert S.trigram_query("[0-9a-f]+") == [] and len(S.trigram_query("abc.*def")) == 2


def test_redact(spark):
    df = S.redact(S.scan(spark.createDataFrame([(1, "x token=12345678 y " + "ab" * 16), (2, "é"), (3, None)], "doc_id long, text string")))
    assert {r["doc_id"]: r["text"] for r in df.collect()} == {1: "x [SECRET] y [SECRET]", 2: "é", 3: None}


def test_redact_overlaps_and_long_texts(spark):
    texts = ["token=" + "0a" * 20 + " é " + "\U0001f600" * 1500 + " password=12345678",
             "".join(f"é {'日' * (i % 2100)} token={i:08d}" for i in range(600)), "secret=password=12345678\n\n" * 3, "é" * 5000]

    def masked(text):
        out, at = [], 0
        for a, _, b in brute(text):
            if a >= at:
                out += [text[at:a], "[SECRET]"]
            at = max(at, b)
        return "".join(out) + text[at:]

    df = S.redact(S.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    assert {r["doc_id"]: r["text"] for r in df.collect()} == {i: masked(t) for i, t in enumerate(texts)}


def test_many_matches_in_one_text(spark):
    """Spans and the masked text of 40,000 matches; the steps grow with matches, not with their square."""
    text = "".join(f"é{i} token={i:08d}\n" for i in range(40_000))
    (row,) = check(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    assert len(row["secrets"]) == 40_000
    (row,) = S.redact(S.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"))).collect()
    assert row["text"] == re.sub(r"token=\d+", "[SECRET]", text)


def test_runs_without_python(docs):
    assert "Python" not in S.scan(docs)._jdf.queryExecution().toString()
