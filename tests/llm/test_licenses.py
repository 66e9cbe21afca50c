import re

import duckdb

from tastebud.llm import licenses as N
from tastebud.llm.queries import QUERIES

LOW = str.maketrans(N.UPPER, N.LOWER)


def brute(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    at, labels = [], set()
    for phrase, label in N.BASE_PHRASES:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def brute_labels(text):
    """Labels and score by trying every template at every place."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    line, known = f" {' '.join(w)} ", set(N.vocabulary())
    base = {x for x in brute(text)[4].split(",") if x}
    labels, best = set(base), 0.5 if base else 0.0
    for t in N.TEMPLATES:
        if f" {t.phrase} " in line:
            own = [(p, x) for p, x in enumerate(t.text.split()) if x in known]
            for begin in range(-len(t.text.split()), len(w)):
                share = sum(0 <= begin + p < len(w) and w[begin + p] == x for p, x in own) / len(own)
                if share >= N.COVERAGE:
                    labels.add(t.label)
                    best = max(best, share)
    return ",".join(sorted(labels)), best


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op7_license_scans"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(texts[r["doc_id"]])
        assert (r["labels"], r["score"]) == brute_labels(texts[r["doc_id"]])
        for notice, label in (("Released under the MIT License", "mit"), ("under the Apache License, Version 2.0", "apache-2.0"),
                              ("CC BY-NC 4.0", "cc-by-nc")):
            assert (notice in texts[r["doc_id"]]) == (label in r["labels"].split(","))
    assert sum(r["n_base"] for r in got) > 5


TEXTS = [
    "Released under the MIT License.", "the MIT school has a license", "License MIT the under released", "CC BY, CC-by cc by cc  BY",
    "All rights reserved. " * 3, "all rights\nRESERVED all rights", "General Public Licenſe general public LICENSE",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated files",
    "Redistribution and use in source and binary forms, with or without modification, are permitted", "Kcc by", None, "",
    "license " * 5000,
]


def test_labels(spark):
    got = {r["doc_id"]: r for r in N.scan(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string"), ["doc_id"]).collect()}
    assert [got[i]["labels"] for i in (0, 1, 2, 7, 8)] == [["mit"], [], [], ["mit"], ["bsd"]]
    assert got[0]["score"] == 1 and got[1]["score"] == 0 and 0.7 <= got[7]["score"] < 1
    for i, t in enumerate(TEXTS):
        at = [x["i"] for x in got[i]["base"]]
        want = brute(t)
        assert (got[i]["n_words"], len(at), min(at, default=None), max(at, default=None), ",".join(got[i]["base_labels"])) == want
        assert (",".join(got[i]["labels"]), got[i]["score"]) == brute_labels(t)


def test_odd_rows(odd, odd_clash, no_docs):
    key = lambda df: sorted(map(repr, N.scan(df, ["doc_id"]).collect()))
    assert len(key(odd)) == odd.count() and key(odd_clash) == key(odd) and key(no_docs) == []


def test_runs_without_python(docs):
    assert "Python" not in N.scan(docs, ["doc_id"])._jdf.queryExecution().toString()


def test_duckdb_counts_the_same_places(spark, sf):
    con = duckdb.connect()
    want = con.execute(f"""SELECT doc_id, len(regexp_extract_all(lower(text), '\\ball[^a-z0-9\\x80-\\x{{10FFFF}}]+rights[^a-z0-9\\x80-\\x{{10FFFF}}]+reserved\\b')) AS n
                           FROM '{sf}/documents.parquet' WHERE n > 0 ORDER BY 1""").fetchall()
    got = N.scan(spark.read.parquet(f"{sf}/documents.parquet"), ["doc_id"]).collect()
    mine = sorted((r["doc_id"], sum(x["label"] == "reserved" for x in r["base"])) for r in got if any(x["label"] == "reserved" for x in r["base"]))
    assert mine == want


def test_every_notice_of_a_file_is_found(spark):
    notices = " ; ".join(t.text for t in N.TEMPLATES)
    stray = "charge person forms source copy " * 3
    rows = [(0, notices), (1, f"{stray} {'x ' * 5000} released under the MIT license"),
            (2, "licensed under the apache license version 2 0. released under the mit license. " + N.TEMPLATES[2].text)]
    rows += [(i, "mit license apache released licensed version") for i in range(3, 30)]
    got = {r["doc_id"]: r for r in N.scan(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()}
    assert set(got[0]["labels"]) == {t.label for t in N.TEMPLATES}
    assert got[1]["labels"] == ["mit"] and got[1]["score"] == 1
    assert got[2]["labels"] == ["apache-2.0", "bsd", "mit"] and got[2]["score"] == 1


def test_many_notices_in_one_text(spark):
    """20,000 notices: every alignment is looked up by its own places, not in the whole file."""
    rows = [(1, "released under the MIT license; all rights reserved. " * 20_000), (2, "the gnu general public license as published")]
    got = {r["doc_id"]: r for r in N.scan(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()}
    assert got[1]["labels"] == ["mit", "reserved"] and got[1]["score"] == 1 and len(got[1]["base"]) == 20_000
    assert (",".join(got[2]["labels"]), got[2]["score"]) == brute_labels(rows[1][1])


def test_anchors_suffice_for_every_alignment():
    found = N._anchors({})
    for n, t in enumerate(N.TEMPLATES):
        own = sum(w in set(N.vocabulary()) for w in t.text.split())
        kept = min(k for k in range(own + 1) if k / own >= N.COVERAGE)
        assert sum(m == n for _, m, _ in found) - (own - kept) >= 2
