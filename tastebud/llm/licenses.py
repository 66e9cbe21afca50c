"""License scans with a positional rare-token index.

The postings (word, template, position) of the templates' rarest places are the
index.  Each file keeps the places of licence words only (words of a key phrase
or of a template that are no function words); their document frequencies over
all files tell a template's rarest places.  An alignment leaves at most a share
1 - ``COVERAGE`` of the places unmatched, so a template has as many anchors as
that and two more: every alignment has two of them.  Postings are intersected by
relative position: anchors that agree on where the template would begin.
Such an alignment is verified against every
place of the template, and its mandatory key phrase must stand in the file.

All of it runs on built-in functions.  Files are shuffled as places of licence
words, by file; templates are a fixed list, so their joins are broadcast.

Defined results: null and empty texts have no words, no labels and score 0;
every row is a file of its own, whatever its id; repeated phrases each count;
an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import stored

#: Separators of words, before lower-casing.
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: str


#: The contract's phrases and labels (fixed values).
BASE_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Notices of public licences with their mandatory key phrases (fixed values).
TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    Template("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license",
             "in compliance with the license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    Template("cc-by", "licensed under cc by 4 0", "cc by"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
             "creative commons attribution"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("gpl", "this work is licensed under the gnu general public license version 3", "general public license"),
    Template("gpl", "redistribute it and or modify it under the terms of the gnu general public license as published by the "
             "free software foundation", "gnu general public license"),
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
             "associated documentation files", "permission is hereby granted"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("reserved", "all rights reserved", "all rights reserved"),
)

#: Function words that are no licence words unless a key phrase needs them (fixed values).
COMMON = frozenset("a an and any are as except from in is it its may not of on or that the this to under with without you use".split())
#: Share of a template's licence words that must stand at their places.
COVERAGE = 0.7


def _phrases() -> list[tuple[str, ...]]:
    return sorted({tuple(p.split()) for p, _ in BASE_PHRASES} | {tuple(t.phrase.split()) for t in TEMPLATES})


def vocabulary() -> list[str]:
    words = {w for t in TEMPLATES for w in t.text.split() if w not in COMMON}
    return sorted(words | {w for p in _phrases() for w in p})


def _starts(hits: Column, phrase: tuple[str, ...]) -> Column:
    """Places where the phrase's words stand consecutively; hits: array<struct<i, t>> by i."""
    def stands(x: Column, k: Column) -> Column:
        ok = x["t"] == phrase[0]
        for j, w in enumerate(phrase[1:], 1):
            after = F.get(hits, k + j)
            ok = ok & F.coalesce((after["t"] == w) & (after["i"] == x["i"] + j), F.lit(False))
        return ok
    return F.transform(F.filter(hits, stands), lambda x: x["i"])


def _labelled(at: Column, label: str) -> Column:
    return F.transform(at, lambda i: F.struct(i.alias("i"), F.lit(label).alias("label")))


def places(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Per row: keys, row, n_words, hits (places of licence words), stored once."""
    t = F.coalesce(F.col(text), F.lit(""))
    split = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)],
                      F.explode(F.array(F.array_remove(F.split(t, SEPARATOR, -1), ""))).alias("w"))
    known = vocabulary()
    # lower() also folds a few letters beyond A-Z, so its matches are compared again with A-Z folded only
    maybe = F.filter(F.transform("w", lambda x, i: F.struct(i.alias("i"), x.alias("t"))),
                     lambda x: F.lower(x["t"]).isin(*known))
    folded = F.transform(maybe, lambda x: F.struct(x["i"].alias("i"), F.translate(x["t"], UPPER, LOWER).alias("t")))
    hits = F.filter(folded, lambda x: x["t"].isin(*known))
    return stored(split.select(*[f"k{i}" for i in range(len(keys))], F.monotonically_increasing_id().alias("row"),
                               F.size("w").cast("long").alias("n_words"), hits.alias("hits")), "places")


def _templates(spark) -> DataFrame:
    whole = []
    for n, t in enumerate(TEMPLATES):
        own = [(p, w) for p, w in enumerate(t.text.split()) if w in set(vocabulary())]
        whole.append((n, t.label, t.phrase, [p for p, _ in own], [w for _, w in own]))
    return spark.createDataFrame(whole, "template int, label string, phrase string, at array<int>, words array<string>")


def _anchors(df: dict[str, int]) -> list[tuple[str, int, int]]:
    """(word, template, place): per template the rarest places, enough that every alignment has two of them."""
    out = []
    for n, t in enumerate(TEMPLATES):
        own = [(p, w) for p, w in enumerate(t.text.split()) if w in set(vocabulary())]
        least = next(k for k in range(1, len(own) + 1) if k / len(own) >= COVERAGE)
        rare = sorted(own, key=lambda x: (df.get(x[1], 0), x[0]))[:len(own) - least + 2]
        out += [(w, n, p) for p, w in rare]
    return out


def alignments(files: DataFrame) -> DataFrame:
    """Verified (row, label, score): templates whose licence words stand in the file at their relative places."""
    spark = files.sparkSession
    whole = _templates(spark)
    seen = files.select(F.explode(F.array_distinct(F.transform("hits", lambda x: x["t"]))).alias("t"))
    df = {r["t"]: r["n"] for r in seen.groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()}   # at most the vocabulary
    found = _anchors(df)
    postings = spark.createDataFrame(found, "t string, template int, place int")
    anchors = files.select("row", F.explode(F.filter("hits", lambda x: x["t"].isin(*sorted({w for w, _, _ in found})))).alias("hit"))
    begun = (anchors.select("row", F.col("hit.t").alias("t"), F.col("hit.i").alias("i")).join(F.broadcast(postings), "t")
             .groupBy("row", "template", (F.col("i") - F.col("place")).alias("begin"))
             .agg(F.count(F.lit(1)).alias("agree")).where("agree >= 2"))
    begun = stored(begun, "alignments")
    # only files with an alignment: their places one by one, their phrases once per file
    aligned = files.join(begun.select("row").distinct(), "row", "left_semi").select("row", "hits")
    standing = F.filter(F.array(*[F.when(F.size(_starts(F.col("hits"), p)) > 0, F.lit(" ".join(p))) for p in _phrases()]),
                        lambda x: x.isNotNull())
    phrased = aligned.select("row", F.explode(standing).alias("phrase"))
    wanted = begun.join(F.broadcast(whole), "template").join(phrased, ["row", "phrase"]).select(
        "row", "template", "label", "begin", F.size("words").alias("places"),
        F.explode(F.arrays_zip("at", "words")).alias("want"))
    stand = aligned.select("row", F.explode("hits").alias("hit")).select(
        "row", F.col("hit.i").alias("i"), F.col("hit.t").alias("t"))
    met = (wanted.select("row", "template", "label", "begin", "places", (F.col("begin") + F.col("want.at")).alias("i"),
                         F.col("want.words").alias("t"))
           .join(stand, ["row", "i", "t"]).groupBy("row", "template", "label", "begin", "places")
           .agg(F.count(F.lit(1)).alias("n")))
    return (met.withColumn("score", F.col("n") / F.col("places")).where(F.col("score") >= COVERAGE)
            .groupBy("row", "label").agg(F.max("score").alias("score")))


def scan(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Per row: keys, n_words, base (array<struct<i, label>> of all base places), base_labels, labels, score.

    ``score`` is the best alignment's share of places, 0.5 at least where a base phrase stands, else 0.
    """
    files = places(df, keys, text)
    found = alignments(files).groupBy("row").agg(F.collect_set("label").alias("aligned"), F.max("score").alias("score"))
    base = F.concat(*[_labelled(_starts(F.col("hits"), tuple(p.split())), label) for p, label in BASE_PHRASES])
    based = files.select(*[F.col(f"k{i}") for i in range(len(keys))], "row", "n_words", F.explode(F.array(F.array_sort(base))).alias("base"))
    joined = based.join(found, "row", "left")
    own = F.sort_array(F.array_distinct(F.transform("base", lambda x: x["label"])))
    every = F.sort_array(F.array_distinct(F.concat(own, F.coalesce("aligned", F.array().cast("array<string>")))))
    least = F.when(F.size("base") > 0, 0.5).otherwise(0.0)
    return joined.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], "n_words", "base", own.alias("base_labels"),
                         every.alias("labels"), F.greatest(F.coalesce("score", F.lit(0.0)), least).alias("score"))
