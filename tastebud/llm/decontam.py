"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` stores the corpus as blocks of documents: each row of the
index table holds one block's sorted term hashes and, per term, the ascending
positions of its postings.  ``search`` takes test items in chunks of bounded
size; every task intersects, for each window of an item, the offset-adjusted
posting lists from the block's rarest term to its most frequent one.  A block
answers for its own documents only, so nothing but the hits is shuffled and no
term, however frequent, gathers in one task.  Proximity matches go by an item's
three rarest terms of the whole index, whose counts a first pass sums up.

Terms are 64-bit hashes of lower-cased words (wrong matches of a 13-word window
would need 13 simultaneous collisions).

Defined results: null and empty texts have no words and no hits; items without
words match nothing; items of fewer words than a window are one window; items
that repeat each count; repeated rows and null ids each keep their own row;
an empty corpus or test set gives no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import wordbytes as W
from .tables import stored

#: Words of one index block (a longer document makes a larger block of its own).
BLOCK_WORDS = 1_000_000
#: Bytes of test text that one broadcast may hold.
#: A word of the contract.
HAS_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
ITEM_BYTES = 16 << 20
#: Words between the rarest terms of a proximity match.
SLOP = 26


class _Block:
    """Documents gathered until they fill one row of the index."""

    def __init__(self) -> None:
        self.keys: list[pa.Table] = []
        self.counts: list[np.ndarray] = []
        self.hashes: list[np.ndarray] = []
        self.words = 0

    def add(self, keys: pa.RecordBatch, w: W.Words) -> None:
        self.keys.append(pa.Table.from_batches([keys]))
        self.counts.append(w.counts)
        self.hashes.append(w.hashes)
        self.words += len(w.hashes)

    def row(self, block: int) -> pa.RecordBatch:
        counts, hashes = np.concatenate(self.counts), np.concatenate(self.hashes)
        # one position stays free after each document: no window reaches into the next
        place = np.arange(len(hashes)) + np.repeat(np.arange(len(counts)), counts)
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, np.int64)
        keys = pa.concat_tables(self.keys).combine_chunks()
        docs = pa.StructArray.from_arrays([c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in keys.columns],
                                          names=keys.column_names)
        return pa.RecordBatch.from_arrays([
            pa.array([block], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
            pa.array([counts.astype(np.int64)], pa.list_(pa.int64())),
            pa.array([ranked[first].tobytes()], pa.binary()),
            pa.array([first.astype(np.uint32).tobytes()], pa.binary()),
            pa.array([place[order].astype(np.uint32).tobytes()], pa.binary()),
        ], names=["block", "docs", "counts", "terms", "firsts", "postings"])


def build_index(df: DataFrame, keys: list[str], text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Store all token postings of ``text``; ``keys`` are carried per document."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        made, block = 0, _Block()
        for batch in batches:
            names = batch.schema.names[:-1]
            for lo in range(0, batch.num_rows, 500):
                rows = batch.slice(lo, 500)
                raw, off = W.text_bytes(rows.column(len(names)))
                block.add(rows.select(names), W.words(raw, off, W.ALNUM))
                if block.words >= block_words:
                    yield block.row(part + made)
                    made, block = made + 1, _Block()
        if block.keys:
            yield block.row(part + made)

    narrow = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(text).alias("t"))
    doc = T.StructType(narrow.schema.fields[:-1])
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("docs", T.ArrayType(doc)),
        T.StructField("counts", T.ArrayType(T.LongType())), T.StructField("terms", T.BinaryType()),
        T.StructField("firsts", T.BinaryType()), T.StructField("postings", T.BinaryType())])
    return stored(narrow.mapInArrow(blocks, schema), "postings")


class _Postings:
    """One block's index."""

    def __init__(self, counts, terms: bytes, firsts: bytes, postings: bytes) -> None:
        self.terms = np.frombuffer(terms, np.uint64)
        self.places = np.frombuffer(postings, np.uint32)
        counts = np.asarray(counts, np.int64)
        self.first = np.r_[np.frombuffer(firsts, np.uint32).astype(np.int64), counts.sum()]
        self.doc_at = np.cumsum(counts) - counts + np.arange(len(counts))

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Term number of each hash and the length of its posting list (0: absent)."""
        if not len(self.terms):
            return np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        return at, np.where(self.terms[at] == h, self.first[at + 1] - self.first[at], 0)

    def list(self, term: int) -> np.ndarray:
        return self.places[self.first[term]:self.first[term + 1]].astype(np.int64)

    def numbers(self, h: np.ndarray) -> list[int] | None:
        """Term numbers of hashes that all occur."""
        at, size = self.find(h)
        return at.tolist() if size.all() else None

    def doc(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_at, place, side="right") - 1


def _intersect(index: _Postings, terms: np.ndarray, sizes: np.ndarray, lo: int, width: int, lists: dict) -> np.ndarray:
    """Places in the block where item words lo .. lo + width stand consecutively."""
    order = lo + np.argsort(sizes[lo:lo + width], kind="stable")
    found: np.ndarray | None = None
    for j in order.tolist():
        t = int(terms[j])
        if t not in lists:
            lists[t] = index.list(t)
        if found is None:
            found = lists[t] - j
        else:
            want = found + j
            at = np.minimum(np.searchsorted(lists[t], want), len(lists[t]) - 1)
            found = found[lists[t][at] == want]
        if not len(found):
            break
    return found + lo


def _near(index: _Postings, rare: list[int], slop: int, lists: dict) -> np.ndarray:
    """Documents where the terms ``rare`` stand within ``slop`` words of the first one."""
    for t in rare:
        if t not in lists:
            lists[t] = index.list(t)
    place = lists[rare[0]]
    for t in rare[1:]:
        other, of = lists[t], index.doc(place)
        right = np.searchsorted(other, place)
        near = np.zeros(len(place), bool)
        for beside in (np.minimum(right, len(other) - 1), np.maximum(right - 1, 0)):
            near |= (np.abs(other[beside] - place) <= slop) & (index.doc(other[beside]) == of)
        place = place[near]
    return np.unique(index.doc(place))


def _term_counts(index: DataFrame, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the ``wanted`` terms that occur and their postings over all blocks."""
    shared = index.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                _, sizes = _Postings(row["counts"], row["terms"], row["firsts"], b"").find(shared.value)
                total += sizes
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["at", "n"])

    rows = index.select("counts", "terms", "firsts").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).orderBy("at").toArrow()
    return wanted[rows.column("at").to_numpy()], rows.column("n").to_numpy()


def _rarest(hashes: np.ndarray, bounds: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Per item: its three rarest terms of the whole index, none if fewer than three of its words occur."""
    at = np.minimum(np.searchsorted(terms, hashes), max(0, len(terms) - 1))
    known = terms[at] == hashes if len(terms) else np.zeros(len(hashes), bool)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        own = at[a:b][known[a:b]]
        distinct = np.unique(own)
        out.append(terms[distinct[np.argsort(counts[distinct], kind="stable")][:3]] if len(own) >= 3 else terms[:0])
    return out


def _spans(start: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Merge [s, s + width) for ascending s."""
    cut = np.flatnonzero(np.r_[True, start[1:] > start[:-1] + width])
    last = np.r_[cut[1:], len(start)] - 1
    return list(zip(start[cut].tolist(), (start[last] + width).tolist(), strict=True))


def search(index: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text", width: int = 13,
           slop: int = SLOP, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """Matches of ``items``: (block, doc, item_id, exact, spans).

    ``exact`` rows carry the merged word spans [start, end) of the item's windows
    in the document; the others are proximity matches without spans.  Items are
    searched in chunks of about ``item_bytes``, one pass over the index each.
    """
    spark = index.sparkSession
    # items without a word match nothing; ids count like text
    wanted = items.select(F.col(item_id).cast("string").alias("id"), F.col(text).alias("t")).where(F.col("t").rlike(HAS_WORD))
    size = F.octet_length("t") + F.coalesce(F.octet_length("id"), F.lit(0)) + 16
    total = wanted.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    chunks = max(1, -(-int(total) // item_bytes))
    parts = []
    for c in range(chunks):
        rows = wanted.where(F.pmod(F.xxhash64("id", "t"), F.lit(chunks)) == c).toArrow()
        raw, off = W.text_bytes(rows.column("t"))
        w = W.words(raw, off, W.ALNUM)
        rare = _rarest(w.hashes, w.bounds, *_term_counts(index, np.unique(w.hashes)))
        query = spark.sparkContext.broadcast((rows.column("id").to_pylist(), w.hashes, w.bounds, rare))

        def probe(batches: Iterator[pa.RecordBatch], query=query) -> Iterator[pa.RecordBatch]:
            ids, hashes, bounds, rare = query.value
            for batch in batches:
                for row in batch.to_pylist():
                    yield _probe(row, ids, hashes, bounds, rare, width, slop)

        parts.append(index.select("block", "counts", "terms", "firsts", "postings").mapInArrow(
            probe, "block long, doc long, item_id string, exact boolean, spans array<struct<start:long,end:long>>"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _probe(row: dict, ids: list, hashes: np.ndarray, bounds: np.ndarray, rare: list, width: int, slop: int) -> pa.RecordBatch:
    index = _Postings(row["counts"], row["terms"], row["firsts"], row["postings"])
    terms, sizes = index.find(hashes)
    lists: dict[int, np.ndarray] = {}
    out: list[tuple] = []
    for k, item in enumerate(ids):
        a, b = int(bounds[k]), int(bounds[k + 1])
        n = min(width, b - a)
        if not n or not sizes[a:b].any():
            continue
        t, s = terms[a:b], sizes[a:b]
        lacking = np.r_[0, np.cumsum(s == 0)]
        whole = np.flatnonzero(lacking[n:] == lacking[:len(lacking) - n])
        hits = [x for x in (_intersect(index, t, s, int(lo), n, lists) for lo in whole) if len(x)]
        exact: set[int] = set()
        if hits:
            at = np.unique(np.concatenate(hits))
            of = index.doc(at)
            edges = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            for x, y in zip(edges, np.r_[edges[1:], len(of)], strict=True):
                d = int(of[x])
                exact.add(d)
                out.append((d, item, True, _spans(at[x:y] - index.doc_at[d], n)))
        if len(rare[k]) and (of_rare := index.numbers(rare[k])):
            out.extend((int(d), item, False, []) for d in _near(index, of_rare, slop, lists) if d not in exact)
    return pa.RecordBatch.from_arrays([
        pa.array([row["block"]] * len(out), pa.int64()), pa.array([x[0] for x in out], pa.int64()),
        pa.array([x[1] for x in out], pa.string()), pa.array([x[2] for x in out], pa.bool_()),
        pa.array([[{"start": p, "end": q} for p, q in x[3]] for x in out],
                 pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
        names=["block", "doc", "item_id", "exact", "spans"])


def contamination(df: DataFrame, items: DataFrame, keys: list[str], text: str = "text", width: int = 13,
                  share: int = 20) -> DataFrame:
    """Per row of ``df``: keys, n_words, n_hit, items (sorted ids), near_items, spans, contaminated.

    A row is contaminated if at least 1 / ``share`` of its words lie in an
    occurrence of a test window.
    """
    index = build_index(df, keys, text)
    found = stored(search(index, items, width=width), "matches")
    span = F.array_sort(F.flatten(F.collect_list("spans")))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    covered = F.aggregate(
        F.col("s"), zero,
        lambda a, x: F.struct((a["n"] + F.greatest(x["end"] - F.greatest(x["start"], a["end"]), F.lit(0))).alias("n"),
                              F.greatest(a["end"], x["end"]).alias("end")), lambda a: a["n"])
    hits = (found.groupBy("block", "doc")
            .agg(span.alias("s"), F.array_sort(F.collect_set(F.when(F.col("exact"), F.col("item_id")))).alias("items"),
                 F.array_sort(F.collect_set(F.when(~F.col("exact"), F.col("item_id")))).alias("near_items"))
            .select("block", "doc", covered.alias("n_hit"), "items", "near_items", F.col("s").alias("spans")))
    docs = index.select("block", F.posexplode(F.arrays_zip("docs", "counts")).alias("doc", "x"))
    docs = docs.select("block", F.col("doc").cast("long").alias("doc"), "x.docs", F.col("x.counts").alias("n_words"))
    joined = docs.join(hits, ["block", "doc"], "left")
    none = F.array().cast("array<string>")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        *[F.col(f"docs.k{i}").alias(k) for i, k in enumerate(keys)], "n_words", n_hit.alias("n_hit"),
        F.coalesce("items", none).alias("items"), F.coalesce("near_items", none).alias("near_items"), "spans",
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"))
