"""How the sources of each language differ, term by term.

Every language keeps the terms of at least ``min_docs`` of its documents; every
(language, source) group and every language turns its counts of the kept terms
into integer shares, and shares are compared by ``floor((p-q)^2 / (p+q))``.

Terms are materialised late.  What is shuffled to count them is the 64-bit
digest of a term; the smallest and largest string behind each kept digest are
then gathered, a digest with two strings is counted anew by its strings, and
text is joined back to the terms that the result names.

Pairs of sources are compared in tiles of ``TILE`` x ``TILE`` sources and salts
of terms: a task holds one salt's counts as a terms x sources matrix and emits
one sum per pair.  Terms that no source of a tile has are added by formula.

Defined results: null text, language and source are ''; a group without terms
has every kept term zero times; a language that keeps no term has pairs of
value 0; every row is a document, also one that repeats; ties go by UTF-8; an
empty table gives an empty table; a text of any length is read whole (one row
at a time is in memory); other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored

#: Different terms of all groups that a worker counts before it passes them on.
FLUSH_TERMS = 500_000
#: Sources on each side of a tile, and counts that one task compares at once.
TILE, TILE_COUNTS = 64, 32_768
#: Rows up to which a table of candidates or groups is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 1_000_000
SCALE = 1_000_000_000

#: Bytes between terms become spaces, A-Z become a-z, all other bytes stay.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _documents(df: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return df.select(blank(lang).alias("lang"), blank(source).alias("source"), blank(text).alias("text"))


def term_counts(docs: DataFrame, by: list[str], bits: int = 64, strings: bool = False) -> DataFrame:
    """Partial counts: ``by``, digest, n (occurrences), docs and, on request, term; a term may have several rows."""
    longs = [F.lit(0).cast("long").alias(c) for c in ("digest", "n", "docs")]
    schema = docs.select(*by, *longs, *([F.lit("").alias("term")] if strings else [])).schema
    mask = (1 << bits) - 1

    def batch(counts: dict[tuple, tuple[Counter, Counter]]) -> pa.RecordBatch:
        keys = [[] for _ in by]
        terms, n, seen = [], [], []
        for key, (times, docs_with) in counts.items():
            for out, part in zip(keys, key, strict=True):
                out.extend([part] * len(times))
            terms.extend(times)
            n.extend(times.values())
            seen.extend(map(docs_with.__getitem__, times))
        digest = np.fromiter(map(xxhash.xxh64_intdigest, terms), np.uint64, len(terms)) & np.uint64(mask)
        arrays = [*[pa.array(k, pa.string()) for k in keys], pa.array(digest.view(np.int64)), pa.array(n, pa.int64()), pa.array(seen, pa.int64())]
        if strings:
            arrays.append(pa.array(terms, pa.binary()).cast(pa.string()))
        return pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, tuple[Counter, Counter]] = {}
        held = 0
        for rows in batches:
            groups = zip(*[c.to_pylist() for c in rows.columns[:-1]], strict=True) if by else repeat(())
            for key, text in zip(groups, rows.columns[-1].to_pylist(), strict=False):
                found = text.translate(_TERMS).split()
                if not found:
                    continue
                times, docs_with = counts.get(key) or counts.setdefault(key, (Counter(), Counter()))
                held -= len(times)
                times.update(found)
                docs_with.update(set(found))
                held += len(times)
                if held > FLUSH_TERMS:
                    yield batch(counts)
                    counts, held = {}, 0
        if counts:
            yield batch(counts)

    return docs.select(*by, F.col("text").cast("binary")).mapInArrow(count, schema)


def _small(df: DataFrame) -> DataFrame:
    """``df`` to be broadcast if it has few rows, else as it is."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def kept_counts(docs: DataFrame, min_docs: int, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """Counts (lang, source, digest, split, n, lang_n) of the kept terms, and the string of each digest.

    ``split`` is '' but for a digest that several strings share: there it is the string, counted anew.
    """
    sums = [F.sum("n").alias("n"), F.sum("docs").alias("docs")]
    counts = stored(term_counts(docs, ["lang", "source"], bits).groupBy("lang", "source", "digest").agg(*sums), "audit-counts")
    enough = lambda df, key: df.groupBy(*key).agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("d")).where(
        F.col("d") >= min_docs).drop("d")
    terms = stored(enough(counts, ["lang", "digest"]), "audit-terms")
    strings = term_counts(docs, [], bits, strings=True).join(_small(terms.select("digest").distinct()), "digest", "left_semi")
    names = stored(strings.groupBy("digest").agg(F.min("term").alias("low"), F.max("term").alias("high")), "audit-names")
    collided = names.where("low <> high").select("digest")
    columns = ["lang", "source", "digest", "split", "n", "lang_n"]
    kept = counts.join(_small(terms), ["lang", "digest"]).withColumn("split", F.lit("")).select(*columns)
    if not collided.isEmpty():
        again = term_counts(docs, ["lang", "source"], bits, strings=True).join(_small(collided), "digest", "left_semi")
        again = stored(again.withColumnRenamed("term", "split").groupBy("lang", "source", "digest", "split").agg(*sums), "audit-split")
        key = ["lang", "digest", "split"]
        kept = kept.join(_small(collided), "digest", "left_anti").unionByName(again.join(enough(again, key), key).select(*columns))
    return stored(kept, "audit-kept"), names.select("digest", "low")


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)), exactly; null where the language keeps no term."""
    wide = lambda c: c.cast("decimal(19,0)")
    above = wide(F.lit(SCALE)) * wide(n + 2)
    return F.lit(1).cast("long") + F.call_function("div", above, F.nullif(wide(total + 2 * terms), wide(F.lit(0))))


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) of shares up to SCALE + 1."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _ranked(df: DataFrame, order: list[Column]) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))


def _tiles(df: DataFrame) -> DataFrame:
    """Rows with ``s`` (number of the source in its language) once for each tile that has it; ``tiles``: tiles a side."""
    own, other = F.floor(F.col("s") / TILE).cast("int"), F.col("other").cast("int")
    spread = df.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return spread.withColumns({"lo": F.least(own, other), "hi": F.greatest(own, other)}).drop("other")


def _compare(counts: pa.Table, sources: pa.Table, tile: int) -> pa.Table:
    """Sums over the terms in ``counts`` for all pairs of the tile; ``seen`` is the number of terms."""
    names = ["lang", "i", "j", "total", "seen"]
    who = np.sort(sources["s"].to_numpy())
    zero = sources["p0"].to_numpy()[np.argsort(sources["s"].to_numpy())]
    lang, lo, hi = (sources[c][0].as_py() for c in ("lang", "lo", "hi"))
    sums, terms = np.zeros((len(who), len(who)), np.int64), 0
    if counts.num_rows:
        keys = pd.DataFrame({"d": counts["digest"].to_numpy(), "x": counts["split"].to_pylist()})
        term = keys.groupby(["d", "x"], sort=False).ngroup().to_numpy()
        at, p, terms = np.searchsorted(who, counts["s"].to_numpy()), counts["p"].to_numpy(), int(term.max()) + 1
        order = np.argsort(term, kind="stable")
        term, at, p = term[order], at[order], p[order]
        for first in range(0, terms, 4096):
            a, b = np.searchsorted(term, [first, first + 4096])
            rows = np.repeat(zero[None, :], min(4096, terms - first), axis=0)
            rows[term[a:b] - first, at[a:b]] = p[a:b]
            for i in range(len(who) - 1):
                d, both = rows[:, i + 1:] - rows[:, i:i + 1], rows[:, i + 1:] + rows[:, i:i + 1]
                sums[i, i + 1:] += (d * d // both).sum(axis=0)
    i, j = np.triu_indices(len(who), 1)
    if lo != hi:
        apart = (who[i] // tile == lo) & (who[j] // tile == hi)
        i, j = i[apart], j[apart]
    return pa.Table.from_arrays([pa.array([lang] * len(i), pa.string()), pa.array(who[i]), pa.array(who[j]), pa.array(sums[i, j]),
                                 pa.array(np.full(len(i), terms, np.int64))], names=names)


def divergence(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 10, top: int = 10,
               bits: int = 64) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair``: every other source of the language by divergence, summed over its kept terms.  Part ``term``: the ``top``
    terms that the group uses more than its language does.  ``bits`` of the digests are used (fewer make collisions, for tests).
    """
    docs = _documents(df, text, lang, source)
    kept, names = kept_counts(docs, min_docs, bits)
    by_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_total"), F.count(F.lit(1)).alias("own"))
    by_lang = kept.groupBy("lang", "digest", "split").agg(F.first("lang_n").alias("n")).groupBy("lang").agg(
        F.sum("n").alias("lang_total"), F.count(F.lit(1)).alias("v"))
    every = docs.groupBy("lang", "source").agg(F.lit(0).alias("z")).drop("z")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    groups = every.join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left").select(
        "lang", "source", *[zero(c) for c in ("group_total", "own", "lang_total", "v")])
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    of_lang = Window.partitionBy("lang")
    groups = groups.select(
        "*", nth.cast("long").alias("s"), F.ceil(F.count(F.lit(1)).over(of_lang) / TILE).cast("int").alias("tiles"),
        (F.floor(F.sum("own").over(of_lang) / TILE_COUNTS) + 1).cast("int").alias("salts"),
        F.coalesce(share(F.lit(0).cast("long"), F.col("group_total"), F.col("v")), F.lit(1)).alias("p0"))
    groups = stored(groups, "audit-sources")
    shared = kept.join(_small(groups.drop("own", "p0")), ["lang", "source"]).withColumns({
        "p": share(F.col("n"), F.col("group_total"), F.col("v")), "q": share(F.col("lang_n"), F.col("lang_total"), F.col("v"))})
    return _pairs(groups, shared).unionByName(_terms(shared, names, top))


def _pairs(groups: DataFrame, shared: DataFrame) -> DataFrame:
    salt = F.pmod(F.xxhash64("digest", "split"), F.col("salts")).cast("int").alias("salt")
    entries = _tiles(shared.select("lang", "digest", "split", "s", "p", "tiles", salt)).drop("tiles")
    sides = _tiles(groups.select(*[F.col(c).alias(c) for c in ("lang", "s", "p0", "tiles", "salts")])).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("tiles", "salts")
    key, tile = ["lang", "lo", "hi", "salt"], TILE

    def compare(counts: pa.Table, sources: pa.Table) -> pa.Table:
        return _compare(counts, sources, tile)

    sums = entries.groupBy(*key).cogroup(sides.groupBy(*key)).applyInArrow(compare, "lang string, i long, j long, total long, seen long")
    totals = sums.groupBy("lang", "i", "j").agg(F.sum("total").alias("total"), F.sum("seen").alias("seen"))
    side = lambda n: groups.select("lang", F.col("s").alias(n), F.col("source").alias(f"{n}_source"), F.col("p0").alias(f"{n}_p0"), *(["v"] * (n == "i")))
    both = totals.join(_small(side("i")), ["lang", "i"]).join(_small(side("j")), ["lang", "j"])
    value = F.col("total") + (F.col("v") - F.col("seen")) * gap(F.col("i_p0"), F.col("j_p0"))
    turned = F.explode(F.array(*[F.struct(F.col(f"{a}_source").alias("source"), F.col(f"{b}_source").alias("item")) for a, b in ("ij", "ji")]))
    pairs = both.select("lang", turned.alias("x"), value.alias("value")).select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    return _ranked(pairs, [F.desc("value"), F.asc("item")])


def _terms(shared: DataFrame, names: DataFrame, top: int) -> DataFrame:
    more = shared.where("n > 0 AND p > q").select("lang", "source", "digest", "split", gap(F.col("p"), F.col("q")).alias("value"))
    # ties at the last rank stay until their text is known
    best = more.withColumn("at", F.rank().over(Window.partitionBy("lang", "source").orderBy(F.desc("value")))).where(F.col("at") <= top)
    named = best.join(names, "digest").select("lang", "source", F.lit("term").alias("part"),
                                              F.when(F.col("split") == "", F.col("low")).otherwise(F.col("split")).alias("item"), "value")
    return _ranked(named, [F.desc("value"), F.asc("item")]).where(F.col("rank") <= top)
