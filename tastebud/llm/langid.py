"""Language identification, words first.

``learn`` counts words per language over all training rows, and character
n-grams (orders ``ORDERS``) over those words, into tables that keep every count.
``predict`` scores known words by their log frequency per language; an unseen
word falls back, at each of its letters, to the longest known n-gram, down to
single letters.  The most frequent entries (``MODEL_ENTRIES``) are broadcast, with
their counts in all languages; documents' other words are joined to the tables.

Defined results: null texts and texts without a letter are ``und`` with score 0,
as is every text if nothing was learned; rows without language or text teach
nothing; ties go to the alphabetically first language; whole texts are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import lookup, stored

ORDERS = (4, 3, 2, 1)
#: Words, and n-grams per order, that are broadcast; the others are looked up in the tables.
MODEL_ENTRIES = 200_000
#: Different words that a task counts or remembers at a time.
HELD = 200_000
UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")


def letters(text: str | None) -> list[str]:
    """Lower-case runs of letters."""
    found = _LETTERS.findall(text.lower()) if text else []
    if all(map(str.isalpha, found)):
        return found
    return [x for w in found if (x := "".join(filter(str.isalpha, w)))]


def _counted(batches: Iterator[pa.RecordBatch], keys) -> Iterator[pa.RecordBatch]:
    """(lang, key, n) sums of the (lang, key, n) that ``keys`` yields per batch."""
    held: dict[str, Counter] = {}

    def emit() -> pa.RecordBatch:
        rows = [(lang, k, n) for lang, c in held.items() for k, n in c.items()]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
                                           pa.array([r[2] for r in rows], pa.int64())], names=["lang", "key", "n"])

    for batch in batches:
        for lang, counts in keys(batch):
            held.setdefault(lang, Counter()).update(counts)
            if sum(map(len, held.values())) > HELD:
                yield emit()
    yield emit()


def _word_counts(batch: pa.RecordBatch):
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        yield lang, Counter(letters(text))


def _gram_counts(order: int):
    def run(batch: pa.RecordBatch):
        for lang, word, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            padded = f" {word} "
            counts: Counter = Counter()
            for i in range(len(padded) - order + 1):
                counts[padded[i:i + order]] += n
            yield lang, counts
    return run


def word_counts(df: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, key, n): how often each word occurs per language."""
    rows = df.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).cast("string"), text)
    parts = rows.mapInArrow(lambda it: _counted(it, _word_counts), "lang string, key string, n long")
    return parts.groupBy("lang", "key").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Log frequencies of the frequent entries: entry -> vector over ``langs``; ``words`` first, then one table per order.

    ``tables`` holds (key, v) of every entry, words at 0 and n-grams by order;
    without it the entries here are all there are.
    """

    langs: list[str]
    words: dict[str, np.ndarray]
    grams: dict[int, dict[str, np.ndarray]]
    tables: dict[int, DataFrame] | None = None

    def word(self, w: str) -> np.ndarray:
        known = self.words.get(w)
        return known if known is not None else self.unseen(w)

    def unseen(self, w: str, rare: dict[str, np.ndarray] | None = None) -> np.ndarray:
        """Mean over the word's letters of the longest known n-gram's log frequency, shorter ones when longer fail.

        ``rare`` has the n-grams of the word that are known but not frequent.
        """
        padded, total = f" {w} ", np.zeros(len(self.langs))
        for i in range(1, len(padded) - 1):
            for order in ORDERS:
                g = padded[i:i + order]
                v = self.grams[order].get(g)
                if v is None and rare and len(g) == order:
                    v = rare.get(g)
                if v is not None:
                    total += v
                    break
        return total / len(w)

    def asked(self, w: str) -> set[str]:
        """The n-grams that decide about the unseen word ``w`` and aren't frequent."""
        padded, out = f" {w} ", set()
        for i in range(1, len(padded) - 1):
            for order in ORDERS:
                g = padded[i:i + order]
                if g in self.grams[order]:
                    break
                if len(g) == order:
                    out.add(g)
        return out


def _vectors(counts: DataFrame, langs: list[str], totals: dict[str, int]) -> DataFrame:
    """(key, n, v): an entry's count in all, and its log relative frequency per language, half a count where one lacks it."""
    per = counts.groupBy("key").agg(F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("c"))
    logs = [F.log(F.coalesce(F.col("c")[x].cast("double"), F.lit(0.5)) / F.lit(totals.get(x, 0) + 1)) for x in langs]
    return per.select("key", "n", (F.array(*logs) if logs else F.array().cast("array<double>")).alias("v"))


def _frequent(table: DataFrame, size: int) -> dict[str, np.ndarray]:
    """Entries above a count that at most ``size`` entries reach (bounded, so collected)."""
    step = F.floor(F.log2("n") * 8).cast("int")
    least, sum_ = None, 0
    for r in sorted(table.groupBy(step.alias("s")).count().collect(), key=lambda r: -r["s"]):
        sum_ += r["count"]
        if sum_ > size:
            break
        least = r["s"]
    if least is None:
        return {}
    top = table.where(step >= least).select("key", "v").toArrow()
    vectors = np.asarray(pa.concat_arrays(top.column("v").chunks).flatten()).reshape(top.num_rows, -1) if top.num_rows else []
    return dict(zip(top.column("key").to_pylist(), vectors, strict=True))


def learn(df: DataFrame, text: str = "text", lang: str = "lang", entries: int = MODEL_ENTRIES) -> Model:
    """Count all rows with text and language; ``entries`` bounds what the model holds in memory, not what it knows."""
    words = stored(word_counts(df, text, lang), "words")
    totals_of = lambda counts: {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    totals = totals_of(words)
    langs = sorted(totals)
    tables = {0: stored(_vectors(words, langs, totals), "words")}
    for order in ORDERS:
        counts = words.mapInArrow(lambda it, order=order: _counted(it, _gram_counts(order)), "lang string, key string, n long")
        grams = stored(counts.groupBy("lang", "key").agg(F.sum("n").alias("n")), "grams")
        tables[order] = stored(_vectors(grams, langs, totals_of(grams)), "grams")
    held = {k: _frequent(t, max(1, entries)) for k, t in tables.items()}
    return Model(langs, held[0], {k: held[k] for k in ORDERS}, {k: t.select("key", "v") for k, t in tables.items()})


def _answered(asked: DataFrame, table: DataFrame, key: str, spread: str) -> DataFrame:
    """``asked`` with the vector ``v`` of its ``key`` in ``table``, null where it has none; frequent keys are kept apart."""
    keys = asked.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    found = stored(keys.join(table, keys[key] == table["key"], "left").select(key, "rows", "v"), "answers")
    return lookup(asked, found, key, "rows", F.xxhash64(spread)).drop("rows")


def _rare_scores(asked: DataFrame, model: Model, shared) -> DataFrame:
    """(word, v) of the distinct words in ``asked`` (word): from the table of words, else from their n-grams."""
    words = stored(asked.join(model.tables[0].withColumnRenamed("key", "word"), "word", "left"), "rare-words")
    known, unseen = words.where("v is not null"), words.where("v is null").select("word")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                rows = [(w, g) for w in batch.slice(lo, 500).column(0).to_pylist() for g in shared.value.asked(w)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(2)], names=["word", "gram"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                rows = batch.slice(lo, 500)
                v = [shared.value.unseen(w, {x["gram"]: np.array(x["v"]) for x in found or []}).tolist()
                     for w, found in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(v, pa.list_(pa.float64()))], names=["word", "v"])

    wanted = stored(unseen.mapInArrow(grams, "word string, gram string"), "rare-grams")
    every = model.tables[ORDERS[0]]
    for order in ORDERS[1:]:
        every = every.unionByName(model.tables[order])
    found = _answered(wanted, every, "gram", "word").where("v is not null")
    per = found.groupBy("word").agg(F.collect_list(F.struct("gram", "v")).alias("found"))
    return known.unionByName(unseen.join(per, "word", "left").select("word", "found").mapInArrow(score, "word string, v array<double>"))


def predict(df: DataFrame, model: Model, keys: list[str], text: str = "text") -> DataFrame:
    """Per row: ``keys``, lang_pred, score (probability of the prediction among the learned languages).

    A row's frequent words are summed up where its text is; its other words are
    looked up in the model's tables and their sums join the row.
    """
    langs, whole = model.langs, model.tables is None
    shared = df.sparkSession.sparkContext.broadcast(Model(model.langs, model.words, model.grams))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        number: dict[str, int] = {}
        scores = np.zeros((1024, len(langs)))
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                rows = batch.slice(lo, 500)
                if len(number) > HELD:
                    number = {}
                sums, rare = [], []
                for text in rows.column(rows.num_columns - 1).to_pylist():
                    found = letters(text) if langs else []
                    if not found:
                        sums.append(None)
                        rare.append(None)
                        continue
                    other: Counter = Counter()
                    for w in set(found).difference(number):
                        if not whole and w not in m.words:
                            other[w] = 0
                            continue
                        k = number[w] = len(number)
                        if k == len(scores):
                            scores = np.concatenate([scores, np.zeros_like(scores)])
                        scores[k] = m.word(w)
                    if other:
                        other = Counter(w for w in found if w in other)
                        found = [w for w in found if w not in other]
                    sums.append(scores[np.fromiter(map(number.__getitem__, found), np.int64, len(found))].sum(axis=0).tolist())
                    rare.append([{"word": w, "times": n} for w, n in other.items()])
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:-1], pa.array(sums, pa.list_(pa.float64())),
                     pa.array(rare, pa.list_(pa.struct([("word", pa.string()), ("times", pa.int64())])))],
                    names=[*rows.schema.names[:-1], "sums", "rare"])

    narrow = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(text).alias("t"))
    kinds = "".join(f"k{i} {narrow.schema[f'k{i}'].dataType.simpleString()}, " for i in range(len(keys)))
    out = narrow.mapInArrow(run, f"{kinds}sums array<double>, rare array<struct<word:string,times:long>>")
    if langs and not whole:
        out = stored(out.withColumn("row", F.monotonically_increasing_id()), "sums")
        rare = out.select("row", F.explode("rare").alias("x")).select("row", "x.word", "x.times")
        words = rare.groupBy("word").agg(F.count(F.lit(1)).alias("rows"))
        table = stored(words.join(_rare_scores(words.select("word"), model, shared), "word", "left"), "rare-scores")
        per = lookup(rare, table, "word", "rows", F.xxhash64("row")).groupBy("row").agg(
            F.array(*[F.sum(F.col("times") * F.col("v")[i]) for i in range(len(langs))]).alias("more"))
        out = out.drop("rare").join(per, "row", "left").withColumn(
            "sums", F.when(F.col("more").isNull(), F.col("sums")).otherwise(F.zip_with("sums", "more", lambda a, b: a + b)))
    top = F.array_max("sums")
    best = F.get(F.array(*[F.lit(x) for x in langs]), (F.array_position("sums", top) - 1).cast("int")) if langs else F.lit(None)
    share = 1 / F.aggregate(F.transform("sums", lambda x: F.exp(x - top)), F.lit(0.0), lambda a, x: a + x)
    return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)],
                      F.coalesce(best.cast("string"), F.lit(UNKNOWN)).alias("lang_pred"), F.coalesce(share, F.lit(0.0)).alias("score"))
