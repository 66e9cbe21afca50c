import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastebud.llm import langid as L
from tastebud.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: (r["lang"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op4_language_id"](spark, sf).collect()
    assert len(got) == len(truth)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in truth[r["doc_id"]][1] or ""))
    held = [r for r in got if r["held_out"] and r["lang_pred"] != "und"]
    assert sum(r["lang_pred"] == truth[r["doc_id"]][0] for r in held) >= 0.97 * len(held)


def brute(docs, train):
    """{doc_id: (language, score)} by the definition, one word at a time; docs and train are (doc_id, lang, text)."""
    words, grams = {}, {n: {} for n in (4, 3, 2, 1)}
    for _, lang, text in train:
        if lang is not None and text is not None:
            for w in L.letters(text):
                words.setdefault(w, Counter())[lang] += 1
                for n, table in grams.items():
                    padded = f" {w} "
                    for i in range(len(padded) - n + 1):
                        table.setdefault(padded[i:i + n], Counter())[lang] += 1
    langs = sorted({x for c in words.values() for x in c})
    total = lambda table: {x: sum(c[x] for c in table.values()) for x in langs}
    sums = {0: total(words), **{n: total(t) for n, t in grams.items()}}
    logs = lambda c, n: np.array([math.log((c[x] or 0.5) / (sums[n][x] + 1)) for x in langs])

    def word(w):
        if w in words:
            return logs(words[w], 0)
        padded, out = f" {w} ", np.zeros(len(langs))
        for i in range(1, len(padded) - 1):
            n = next((n for n in (4, 3, 2, 1) if i + n <= len(padded) and padded[i:i + n] in grams[n]), None)
            out += 0 if n is None else logs(grams[n][padded[i:i + n]], n)
        return out / len(w)

    out = {}
    for k, _, text in docs:
        found = L.letters(text)
        if not found or not langs:
            out[k] = ("und", 0.0)
            continue
        v = sum(word(w) for w in found)
        out[k] = (langs[int(v.argmax())], 1 / np.exp(v - v.max()).sum())
    return out


@pytest.mark.parametrize("entries", [L.MODEL_ENTRIES, 50])
def test_equals_brute_force(spark, sf, entries):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text").collect()]
    held = lambda k: zlib.crc32(str(k).encode()) % 3 == 1
    want = brute(docs, [d for d in docs if not held(d[0])])
    if entries == L.MODEL_ENTRIES:
        got = QUERIES["op4_language_id"](spark, sf).collect()
    else:
        df = spark.createDataFrame(docs, "doc_id long, lang string, text string")
        got = L.predict(df, L.learn(df.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1), entries=entries), ["doc_id"]).collect()
    assert len(got) == len(want)
    for r in got:
        assert r["lang_pred"] == want[r["doc_id"]][0] and abs(r["score"] - want[r["doc_id"]][1]) < 1e-9, r["doc_id"]


@pytest.fixture(scope="module")
def model(spark):
    rows = [("en", "the cat and the dog"), ("de", "der hund und die katze"), ("de", None), (None, "ignored words"), ("fr", "½ 12")]
    return L.learn(spark.createDataFrame(rows, "lang string, text string"))


def test_model(model):
    assert model.langs == ["de", "en"] and "ignored" not in model.words
    assert model.word("the").argmax() == 1 and model.word("hunde").argmax() == 0
    assert model.word("qqq").tolist() == [0, 0]


def test_shorter_grams_stand_in_for_unknown_ones(model):
    assert "unds" not in model.grams[4] and "und" in model.grams[3]
    m = L.Model(model.langs, {}, {**model.grams, 4: {}, 3: {}, 2: {}})
    assert abs(m.unseen("du") - (model.grams[1]["d"] + model.grams[1]["u"]) / 2).max() < 1e-12


def test_odd_rows(model, odd, odd_clash, no_docs):
    got = L.predict(odd, model, ["doc_id"]).collect()
    assert len(got) == odd.count()
    by = {(r["doc_id"], r["lang_pred"]) for r in got}
    assert {(1, "und"), (2, "und"), (3, "und"), (None, "und")} <= by
    assert L.predict(odd_clash, model, ["doc_id"]).collect() == got
    assert L.predict(no_docs, model, ["doc_id"]).count() == 0


def test_nothing_learned(odd, no_docs):
    empty = L.learn(no_docs)
    assert {(r["lang_pred"], r["score"]) for r in L.predict(odd, empty, ["doc_id"]).collect()} == {("und", 0.0)}


def test_predictions_do_not_use_the_language_column(model, odd):
    other = odd.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("zz"))
    assert L.predict(other, model, ["doc_id"]).collect() == L.predict(odd, model, ["doc_id"]).collect()


def test_letters():
    assert L.letters("Ab1c_d ½ Ⅷx É́") == ["ab", "c", "d", "x", "é"] and L.letters(None) == []


def test_no_count_is_lost_beyond_the_broadcast_entries(spark):
    rows = [("en", "the cat and the dog saw a rareword once"), ("en", "the rareword"), ("de", "der hund und die katze sah rareword"),
            ("fr", "le chat et le chien")]
    texts = [(0, "rareword"), (1, "the der chien"), (2, "katze katzen unsaw"), (3, "qqq 日本"), (4, None), (5, "dog"), (6, "le le sah")]
    train = spark.createDataFrame(rows, "lang string, text string")
    df = spark.createDataFrame(texts, "doc_id long, text string")
    whole, small = L.learn(train), L.learn(train, entries=2)
    assert len(small.words) <= 2 < len(whole.words)
    want, got = ({r["doc_id"]: r for r in L.predict(df, m, ["doc_id"]).collect()} for m in (whole, small))
    assert got.keys() == want.keys() and want[0]["lang_pred"] == "en"
    for i, r in want.items():
        assert got[i]["lang_pred"] == r["lang_pred"] and abs(got[i]["score"] - r["score"]) < 1e-12


def test_frequent_entries_have_the_counts_of_all_languages(spark):
    rows = [("aa", "big " * 50 + "shared " * 20), ("bb", "shared " * 3)]
    m = L.learn(spark.createDataFrame(rows, "lang string, text string"), entries=2)
    assert abs(m.words["shared"] - [np.log(20 / 71), np.log(3 / 4)]).max() < 1e-12
