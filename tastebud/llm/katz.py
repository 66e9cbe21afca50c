"""Katz backoff n-gram model of any order over whole corpora.

For a word w after the context h of the last k words, h' being h without its
first word: P(w | h) = d(c(hw)) c(hw) / c(h) where hw is seen in training, else
alpha(h) P(w | h'), down to P(w) = d(c(w)) c(w) / N; the unigram mass that the
discounts free is the probability of an unknown word.  Discounts are Good-Turing
for counts up to ``K`` and made for each order apart; every count gives up at
least ``FLOOR`` of its mass, so that each context has mass for unseen words.
alpha(h) makes the words and the unknown word sum to one after h exactly: both
sums of its definition run over all of h's successors.  Contexts of no training
text have weight one.  Texts begin with contexts of their own and end with an end token.

How it runs.  Tasks turn documents into blocks; a block sends each of its
distinct n-grams once, with the documents where it occurs, to the bucket of its
predicted word, as a trie of the word, its last context word, the two last ones
and so on.  A bucket so knows the counts of every order for its words (``counts``
table, partitioned by kind; words above ``HOT_SHARE`` of all tokens, the end
token included, are dealt over all buckets by their context and their counts
summed apart).  Buckets send each context's sums, and the tokens whose n-gram is
unseen, to the bucket of the last context word, where the contexts of all orders
meet, alpha is made (``weights`` table, one kind for each order) and the
recursion ends.  Contexts that end in a hot word are at most 1 / ``HOT_SHARE``:
their own weights are summed first and known everywhere, their longer contexts are
dealt by two words, and tokens that need no longer one are scored in place.  Both
send sums per document back to the document's block.  Every exchange is a Spark
shuffle of compressed columns; a bucket's share falls with ``spark.sql.shuffle.partitions``.

Words are 64-bit hashes; contexts keep 48 of these bits.

Defined results: null and empty texts are the end token alone; with no training
rows every token is unknown and costs nothing (score 0); repeated rows count as
often as they occur; null ids are scored and not learned from.
"""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from . import wordbytes as W
from .tables import stored

K = 5
FLOOR = 1e-4
BLOCK_TOKENS = 2_000_000
BLOCK_DOCS = 50_000
HOT_SHARE = 0.01
#: Training tokens for each bucket of contexts, up to half as many of these as there are buckets of words.
HOME_TOKENS = 1_000_000
END = np.uint64(0xE17A1465_0B5E9A1D)
BEGIN = np.uint64(0x6A09E667F3BCC908)
_48 = np.uint64((1 << 48) - 1)


def _pack(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def _ref_kind(blocks: list) -> type:
    """Integers that hold references (block number << 16) + document into ``blocks``."""
    return np.uint32 if len(blocks) <= 1 << 16 else np.uint64


def _open(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def _pack48(v: np.ndarray) -> bytes:
    """The low 6 bytes of each value, byte by byte: the high ones of sorted values compress well."""
    return _pack(np.ascontiguousarray(v).view(np.uint8).reshape(-1, 8)[:, :6].T)


def _open48(b: bytes) -> np.ndarray:
    planes = _open(b, np.uint8).reshape(6, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :6] = planes.T
    return out.reshape(-1).view(np.uint64)


def _planes(x: np.ndarray) -> bytes:
    """Integers byte by byte: each byte's few values compress apart from the others."""
    return _pack(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T)


def _open_planes(b: bytes, kind) -> np.ndarray:
    planes = _open(b, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _pack_words(v: np.ndarray) -> bytes:
    """48-bit words as places in their sorted distinct values."""
    own, place = np.unique(v, return_inverse=True)
    table = _pack48(own)
    return len(table).to_bytes(4, "little") + table + _planes(place.astype(_place_kind(own)))


def _open_words(b: bytes) -> np.ndarray:
    n = int.from_bytes(b[:4], "little") + 4
    own = _open48(b[4:n])
    return own[_open_planes(b[n:], _place_kind(own))]


def _place_kind(own: np.ndarray) -> type:
    return np.uint16 if len(own) <= 1 << 16 else np.uint32


def _starts(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, np.int64)


def _runs(x: np.ndarray) -> list[tuple[int, int]]:
    """[begin, end) of each run of equal values."""
    at = _starts(x).tolist()
    return list(zip(at, [*at[1:], len(x)], strict=True)) if at else []


def _deal(x: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Bucket of each ``bits``-bit value, ascending with the value."""
    return ((x >> np.uint64(bits - 31)) * np.uint64(buckets) >> np.uint64(31)).astype(np.int64)


def _tokens(w: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word and document of every token, ends included, and where each document begins."""
    sizes = w.counts + 1
    last = np.cumsum(sizes) - 1
    word = np.empty(int(sizes.sum()), np.uint64)
    inner = np.ones(len(word), bool)
    inner[last] = False
    word[inner] = w.hashes
    word[last] = END
    return word, np.repeat(np.arange(len(sizes)), sizes), last - w.counts


def _context(word: np.ndarray, place: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The k-th word before the tokens ``at``, each the ``place``-th of its document."""
    return np.where(place < k, BEGIN, word[np.maximum(at - k, 0)]) & _48


def _chain(words: list[np.ndarray]) -> list[np.ndarray]:
    """Keys of contexts of 1, 2, ... words (the last word first)."""
    keys = words[:1]
    for w in words[1:]:
        keys = [*keys, W.mix(keys[-1] * W.STEP + w) & _48]
    return keys


def _levels(word: np.ndarray, contexts: list[np.ndarray]) -> list[np.ndarray]:
    """Where the nodes of each level of the trie begin: words, then words with ever longer contexts (sorted input)."""
    new = np.r_[True, word[1:] != word[:-1]] if len(word) else np.zeros(0, bool)
    starts = [np.flatnonzero(new)]
    for h in contexts:
        if len(h):
            new = new | np.r_[True, h[1:] != h[:-1]]
        starts.append(np.flatnonzero(new))
    return starts


def _fold(word: np.ndarray, contexts: list[np.ndarray], starts: list[np.ndarray]) -> tuple[bytes, list[bytes], list[bytes]]:
    """Columns of the trie: words, and for each level the children per node above and their contexts."""
    children = [np.diff(np.r_[np.searchsorted(low, high), len(low)]) for high, low in zip(starts, starts[1:], strict=False)]
    return (word[starts[0]].tobytes(), [_pack(n.astype(np.uint32)) for n in children],
            [_pack_words(h[at]) for h, at in zip(contexts, starts[1:], strict=True)])


def _unfold(r: dict) -> tuple[np.ndarray, list[np.ndarray]]:
    """Word and contexts of every n-gram of a trie's columns."""
    word, contexts = np.frombuffer(r["words"], np.uint64), []
    for children, h in zip(r["pairs"], r["contexts"], strict=True):
        n = _open(children, np.uint32)
        word, contexts = np.repeat(word, n), [*(np.repeat(x, n) for x in contexts), _open_words(h)]
    return word, contexts


_SENT = ("kind int, bucket int, block long, train binary, words binary, pairs array<binary>, contexts array<binary>, "
         "times binary, docs binary")


def _hot_words(rows: DataFrame) -> np.ndarray:
    """Words above HOT_SHARE of all tokens, ends included: at most 1 / HOT_SHARE."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                raw, off = W.text_bytes(batch.slice(lo, 2000).column(0))
                w = W.words(raw, off, W.SPACED)
                word, n = np.unique(np.r_[w.hashes, np.full(len(w.counts), END)], return_counts=True)
                some = n >= HOT_SHARE / 2 * max(1, n.sum())
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.r_[word[some].view(np.int64), 0]), pa.array(np.r_[n[some], 0].astype(np.int64)),
                    pa.array(np.r_[np.zeros(int(some.sum()), np.int64), n.sum()])], names=["word", "n", "total"])

    parts = rows.select("t").mapInArrow(run, "word long, n long, total long").groupBy("word").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"))
    parts = stored(parts, "frequent")
    total = parts.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    found = parts.where(F.col("n") > HOT_SHARE * int(total)).select("word").collect()
    return np.sort(np.array([r["word"] for r in found], np.int64).view(np.uint64))


def _blocks(rows: DataFrame, keys: int, buckets: int, hot: np.ndarray, order: int, first: int = 0,
            end: int | None = None) -> DataFrame:
    """Each block's n-grams by bucket (kind 0) and its documents (kind 1), for the buckets from ``first`` to before ``end``."""
    end = buckets if end is None else end
    doc = T.StructType(rows.schema.fields[:keys])
    schema = T.StructType([*T._parse_datatype_string(_SENT).fields, T.StructField("keys", T.ArrayType(doc)),
                           T.StructField("sizes", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId() << 32, 0
        held: list[tuple[pa.RecordBatch, W.Words]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            block = part + made
            table = pa.Table.from_batches([b for b, _ in held]).combine_chunks()
            train = np.array(table.column(keys).to_pylist(), bool)
            w = W.Words(np.concatenate([x.hashes for _, x in held]), np.concatenate([x.counts for _, x in held]))
            word, docs, begin = _tokens(w)
            bucket = _deal(word, 64, buckets)
            if len(hot):
                spread = np.flatnonzero(hot[np.minimum(np.searchsorted(hot, word), len(hot) - 1)] == word)
                bucket[spread] = _deal(W.mix(_context(word, spread - begin[docs[spread]], spread, 1)), 64, buckets)
            flags = _pack(train)
            # only this pass's tokens get their contexts
            own = np.flatnonzero((bucket >= first) & (bucket < end))
            docs, bucket = docs[own], bucket[own]
            place = own - begin[docs]
            word, contexts = word[own], [_context(word, place, own, k) for k in range(1, order)]
            sort = np.lexsort((*contexts[::-1], word, bucket))
            word, contexts, docs, bucket = word[sort], [h[sort] for h in contexts], docs[sort].astype(np.uint16), bucket[sort]
            gram = _levels(bucket, [word, *contexts])[-1]
            times = np.diff(np.r_[gram, len(word)])
            for a, b in _runs(bucket[gram]):
                at = gram[a:b]
                own, above = word[at], [h[at] for h in contexts]
                lo, hi = gram[a], gram[b] if b < len(gram) else len(word)
                yield row(0, int(bucket[lo]), block, flags, *_fold(own, above, _levels(own, above)),
                          _pack(times[a:b].astype(np.uint32)), _planes(docs[lo:hi]), None, None)
            if not first <= block % buckets < end:
                return
            of = pa.StructArray.from_arrays([table.column(i).chunk(0) for i in range(keys)], names=table.column_names[:keys])
            yield row(1, block % buckets, block, flags, None, None, None, None, None, of, (w.counts + 1).tolist())

        def row(kind, bucket, block, train, words, pairs, contexts, times, docs, of, sizes) -> pa.RecordBatch:
            listed = pa.ListArray.from_arrays(pa.array([0, len(of)], pa.int32()), of) if of is not None else \
                pa.nulls(1, pa.list_(pa.struct(kinds)))
            return pa.RecordBatch.from_arrays(
                [pa.array([kind], pa.int32()), pa.array([bucket], pa.int32()), pa.array([block], pa.int64()),
                 pa.array([train], pa.binary()), pa.array([words], pa.binary()), pa.array([pairs], pa.list_(pa.binary())),
                 pa.array([contexts], pa.list_(pa.binary())), pa.array([times], pa.binary()), pa.array([docs], pa.binary()), listed,
                 pa.array([sizes], pa.list_(pa.int64()))], names=schema.fieldNames())

        kinds: list[tuple[str, pa.DataType]] = []
        for batch in batches:
            kinds = [(f"k{i}", batch.schema.field(i).type) for i in range(keys)]
            for lo in range(0, batch.num_rows, 500):
                some = batch.slice(lo, 500)
                raw, off = W.text_bytes(some.column(keys + 1))
                held.append((some.select(list(range(keys + 1))), W.words(raw, off, W.SPACED)))
                if sum(len(x.hashes) for _, x in held) >= BLOCK_TOKENS or sum(b.num_rows for b, _ in held) >= BLOCK_DOCS:
                    yield from flush()
                    held, made = [], made + 1
        if held:
            yield from flush()

    return rows.mapInArrow(run, schema)


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """Rows of equal ``key``; the input is sorted by it."""
    held: list[dict] = []
    for batch in batches:
        for i in range(batch.num_rows):
            r = batch.slice(i, 1).to_pylist()[0]
            if held and held[0][key] != r[key]:
                yield held
                held = []
            held.append(r)
    if held:
        yield held


def _of_counts(c: np.ndarray) -> list[int]:
    """How many counts are 1 .. K + 1."""
    return [int((c == r).sum()) for r in range(1, K + 2)]


_MERGED = ("kind int, bucket int, blocks array<long>, words binary, pairs array<binary>, contexts array<binary>, counts binary, "
           "times binary, refs binary, hot array<long>, unigrams array<long>, grams array<long>, tokens long, vocabulary long")


def _merge(rows: list[dict], hot: np.ndarray) -> tuple:
    """One bucket's n-grams over all blocks, with counts and the documents of every occurrence."""
    word, context, times, count, refs = [], [], [], [], []
    for k, r in enumerate(rows):
        t = _open(r["times"], np.uint32).astype(np.int64)
        docs = _open_planes(r["docs"], np.uint16).astype(np.int64)
        own, above = _unfold(r)
        word.append(own)
        context.append(above)
        times.append(t)
        count.append(np.add.reduceat(_open(r["train"], bool)[docs].astype(np.int64), np.cumsum(t) - t))
        refs.append((k << 16) + docs)
    w, t, c, ref = (np.concatenate(x) for x in (word, times, count, refs))
    above = [np.concatenate(x) for x in zip(*context, strict=True)]
    order = np.lexsort((*above[::-1], w))
    begin = np.cumsum(t) - t
    w, above, t, c, begin = w[order], [h[order] for h in above], t[order], c[order], begin[order]
    at = np.arange(int(t.sum())) - np.repeat(np.cumsum(t) - t, t) + np.repeat(begin, t)
    ref = ref[at]
    first = _levels(w, above)[-1]
    w, above, t, c = w[first], [h[first] for h in above], np.add.reduceat(t, first), np.add.reduceat(c, first)
    starts = _levels(w, above)
    words, unigram = w[starts[0]], np.add.reduceat(c, starts[0])
    is_hot = np.isin(words, hot)
    at_hot = np.zeros(len(hot), np.int64)
    at_hot[np.searchsorted(hot, words[is_hot])] = unigram[is_hot]
    own = unigram[~is_hot]
    grams = [n for s in starts[1:] for n in _of_counts(np.add.reduceat(c, s))]
    return (0, rows[0]["bucket"], [r["block"] for r in rows], *_fold(w, above, starts), _pack(c.astype(np.uint32)),
            _pack(t.astype(np.uint32)), _planes(ref.astype(_ref_kind(rows))), at_hot.tolist(), _of_counts(own), grams,
            int(c.sum()), int((own > 0).sum()))


class Discounts:
    """Discount factor by count."""

    def __init__(self, n: list[int]) -> None:
        self.factor = np.full(K + 2, 1 - FLOOR)
        common = (K + 1) * n[K] / n[0] if n[0] else 1.0
        for r in range(1, K + 1):
            if n[r - 1] and n[r] and common < 1:
                d = ((r + 1) * n[r] / (r * n[r - 1]) - common) / (1 - common)
                if 0 < d < 1:
                    self.factor[r] = min(d, 1 - FLOOR)

    def __call__(self, c: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        return self.factor[np.minimum(c, K + 1)] * c


class Weights:
    """Backoff weights (log10) and counts of contexts."""

    def __init__(self, context: np.ndarray, alpha: np.ndarray, count: np.ndarray) -> None:
        sort = np.argsort(context, kind="stable")
        self.context, self.alpha, self.count = context[sort], alpha[sort], count[sort]

    def find(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each context is known, its weight (else 0, the logarithm of 1) and its count (else 1)."""
        if not len(self.context):
            return np.zeros(len(context), bool), np.zeros(len(context)), np.ones(len(context), np.int64)
        at = np.minimum(np.searchsorted(self.context, context), len(self.context) - 1)
        known = self.context[at] == context
        return known, np.where(known, self.alpha[at], 0.0), np.where(known, self.count[at], 1)


def _log_alpha(kept: np.ndarray, mass: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Weights from the discounted counts, lower-order probabilities and counts of all successors."""
    return np.log10(np.maximum(1 - kept / np.maximum(count, 1), 1e-12) / np.maximum(1 - mass, 1e-12))


class Unigrams:
    """Counts and discounts that every task needs."""

    def __init__(self, stats: dict, hot: np.ndarray) -> None:
        self.hot, self.hot_counts = hot, np.array(stats["hot"], np.int64)
        n1 = [a + b for a, b in zip(stats["unigrams"], _of_counts(self.hot_counts), strict=True)]
        self.tokens, self.vocabulary = stats["tokens"], stats["vocabulary"] + int((self.hot_counts > 0).sum())
        self.discount = Discounts(n1)
        #: Of n-grams with contexts of 1, 2, ... words.
        self.of_grams = [Discounts(stats["grams"][i:i + K + 1]) for i in range(0, len(stats["grams"]), K + 1)]
        self.hot_contexts = Weights(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.int64))
        kept = sum(n1[r - 1] * r * self.discount.factor[r] for r in range(1, K + 1))
        rest = self.tokens - sum(n1[r - 1] * r for r in range(1, K + 1))
        #: Probability of an unknown word.
        self.unknown = 1 - (kept + rest * self.discount.factor[K + 1]) / self.tokens if self.tokens else 1.0

    def counts(self, words: np.ndarray, c: np.ndarray) -> np.ndarray:
        """c(w) of a bucket's words, ``c`` being what the bucket counted."""
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, words), len(self.hot) - 1)
            c = np.where(self.hot[at] == words, self.hot_counts[at], c)
        return c

    def probability(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.discount(c) / max(1, self.tokens), self.unknown)


class Bucket:
    """A stored bucket: word, contexts and the counts of every order (0: words) for each of its n-grams."""

    def __init__(self, r: dict, u: Unigrams) -> None:
        self.word, self.contexts = _unfold(r)
        c = _open(r["counts"], np.uint32).astype(np.int64)
        self.starts = _levels(self.word, self.contexts)
        level = [np.add.reduceat(c, s) if len(s) else c for s in self.starts]
        level[0] = u.counts(self.word[self.starts[0]], level[0])
        #: Counts per node of each level, and the same per n-gram.
        self.level = level
        self.count = [np.repeat(n, np.diff(np.r_[s, len(c)])) for n, s in zip(level, self.starts, strict=True)]
        #: Words of the longest context after which the word is seen.
        self.seen = sum((n > 0 for n in self.count[1:]), np.zeros(len(c), np.int64))

    def sums(self, k: int, u: Unigrams) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """Of contexts of k words: their words, discounted counts, lower orders' share and counts of successors here.

        That share is a probability for k = 1, else a discounted count: the count of the shorter context divides it later.
        """
        at = self.starts[k]
        c = self.level[k]
        some = c > 0
        at, c = at[some], c[some]
        below = self.count[k - 1][at]
        share = u.probability(below) if k == 1 else u.of_grams[k - 2](below)
        above = [h[at] for h in self.contexts[:k]]
        sort = np.lexsort(above[::-1])
        above = [h[sort] for h in above]
        head = _levels(above[0], above[1:])[-1]
        if not len(head):
            return above, np.zeros(0), np.zeros(0), c
        return ([h[head] for h in above], np.add.reduceat(u.of_grams[k - 1](c)[sort], head), np.add.reduceat(share[sort], head),
                np.add.reduceat(c[sort], head))


def _refs(r: dict) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences per n-gram and the document of each."""
    return _open(r["times"], np.uint32).astype(np.int64), _open_planes(r["refs"], _ref_kind(r["blocks"])).astype(np.int64)


_TO_CONTEXT = ("bucket int, kind int, blocks array<long>, contexts array<binary>, seen binary, kept binary, count binary, refs binary")
_PARTS = "kind int, block long, docs binary, score binary, base binary, known binary, contexts array<binary>, alpha binary, count binary"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kind = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
            "array<binary>": pa.list_(pa.binary())}
    named = [x.strip().split(" ") for x in schema.split(",")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind[t]) for i, (_, t) in enumerate(named)],
                                      names=[n for n, _ in named])


def _home(contexts: list[np.ndarray], u: Unigrams, buckets: int) -> np.ndarray:
    """Bucket of contexts: by the last word, by the last two where that one is hot."""
    to = _deal(contexts[0], 48, buckets)
    if len(contexts) > 1:
        hot, _, _ = u.hot_contexts.find(contexts[0])
        to[hot] = _deal(_chain(contexts[:2])[1][hot], 48, buckets)
    return to


def _to_contexts(r: dict, u: Unigrams, buckets: int) -> Iterator[tuple]:
    """Sums over contexts' successors here (kind: words of the context), and the tokens whose n-gram is unseen (kind 0)."""
    b = Bucket(r, u)
    for k in range(1, len(b.contexts) + 1):
        above, kept, mass, count = b.sums(k, u)
        to = _home(above, u, buckets)
        sort = np.argsort(to, kind="stable")
        to = to[sort]
        for lo, hi in _runs(to):
            at = sort[lo:hi]
            yield (int(to[lo]), k, None, [_pack_words(h[at]) for h in above], _pack(mass[at]), _pack(kept[at]),
                   _planes(count[at]), None)
    times, refs = _refs(r)
    lost = b.seen < len(b.contexts)
    if len(b.contexts) == 1:
        lost &= ~u.hot_contexts.find(b.contexts[0])[0]
    tokens = np.repeat(lost, times)
    if not tokens.any():
        return
    above, seen, refs = [np.repeat(h, times)[tokens] for h in b.contexts], np.repeat(b.seen, times)[tokens], refs[tokens]
    to = _home(above, u, buckets)
    sort = np.lexsort((*above[::-1], to))
    to = to[sort]
    for lo, hi in _runs(to):
        at = sort[lo:hi]
        used, number = np.unique(refs[at] >> 16, return_inverse=True)
        blocks = [r["blocks"][i] for i in used.tolist()]
        yield (int(to[lo]), 0, blocks, [_pack_words(h[at]) for h in above], _pack(seen[at].astype(np.uint8)), None, None,
               _planes(((number << 16) + (refs[at] & 0xFFFF)).astype(_ref_kind(blocks))))


def _per_block(blocks: list[int], refs: np.ndarray, *values: np.ndarray) -> Iterator[tuple]:
    """(block, docs, sums of each value) from values per reference."""
    docs, number = np.unique(refs, return_inverse=True)
    sums = [np.bincount(number, x, len(docs)) for x in values]
    for a, b in _runs(docs >> 16):
        yield (blocks[int(docs[a] >> 16)], _pack((docs[a:b] & 0xFFFF).astype(np.uint16)), *[_pack(s[a:b]) for s in sums])


def _weigh(rows: list[dict], u: Unigrams) -> Iterator[tuple]:
    """Backoff weights of a bucket's contexts, and what unseen n-grams add to their documents."""
    tables: list[Weights] = []
    for k in range(1, len(u.of_grams) + 1):
        sums = [r for r in rows if r["kind"] == k]
        words = [np.concatenate([_open_words(r["contexts"][i]) for r in sums]) if sums else np.zeros(0, np.uint64) for i in range(k)]
        sort = np.lexsort(words[::-1])
        words = [w[sort] for w in words]
        head = _levels(words[0], words[1:])[-1]
        mass, kept, count = (np.add.reduceat(np.concatenate([read(r[n], t) for r in sums])[sort], head) if sums else np.zeros(0, t)
                             for n, t, read in (("seen", float, _open), ("kept", float, _open), ("count", np.int64, _open_planes)))
        words = [w[head] for w in words]
        keys = _chain(words)
        if k > 1:
            mass = mass / _with_hot(tables, k - 1, keys[-2], u)[1]
        alpha = _log_alpha(kept, mass, count)
        tables.append(Weights(keys[-1], alpha, count))
        yield (k, None, None, None, None, None, [_pack_words(w) for w in words], _pack(alpha), _planes(count))
    lost = [r for r in rows if r["kind"] == 0]
    if not lost:
        return
    seen = np.concatenate([_open(r["seen"], np.uint8) for r in lost])
    blocks = np.unique(np.concatenate([r["blocks"] for r in lost]))
    refs = []
    for r in lost:      # one row per block: number the blocks of all senders alike
        ref = _open_planes(r["refs"], _ref_kind(r["blocks"])).astype(np.int64)
        refs.append((np.searchsorted(blocks, r["blocks"])[ref >> 16] << 16) + (ref & 0xFFFF))
    add = np.zeros(len(seen))
    keys = _chain([np.concatenate([_open_words(r["contexts"][i]) for r in lost]) for i in range(len(tables))])
    for k, key in enumerate(keys, 1):
        alpha, count = _with_hot(tables, k, key, u)
        add += np.where(seen < k, alpha, 0.0) - np.where(seen == k, np.log10(count), 0.0)
    # the longest context's count was already divided by
    add += np.log10(count)
    for block, docs, score in _per_block(blocks.tolist(), np.concatenate(refs), add):
        yield (0, block, docs, score, None, None, None, None, None)


def _with_hot(tables: list[Weights], k: int, context: np.ndarray, u: Unigrams) -> tuple[np.ndarray, np.ndarray]:
    """Weight and count of contexts of k words."""
    _, alpha, count = tables[k - 1].find(context)
    if k == 1:
        hot, hot_alpha, hot_count = u.hot_contexts.find(context)
        alpha, count = np.where(hot, hot_alpha, alpha), np.where(hot, hot_count, count)
    return alpha, count


def _score(r: dict, u: Unigrams) -> Iterator[tuple]:
    """What a bucket's tokens add to their documents, contexts' counts as denominators included."""
    b = Bucket(r, u)
    times, refs = _refs(r)
    unigram = b.count[0]
    own = np.log10(np.maximum(u.probability(unigram), 1e-300))
    for k, discount in enumerate(u.of_grams, 1):
        own = np.where(b.seen == k, np.log10(np.maximum(discount(b.count[k]), 1e-300)), own)
    # this token ends the next one's longest context: its count divides the next probability (given back where unseen)
    before = b.count[len(b.contexts) - 1]
    own -= np.where((before > 0) & (b.word != END), np.log10(np.maximum(before, 1)), 0.0)
    if len(b.contexts) == 1:
        hot, alpha, count = u.hot_contexts.find(b.contexts[0])
        own += np.where(hot & (b.seen == 0), alpha + np.log10(count), 0.0)
    base = np.log10((unigram + 1) / (u.tokens + u.vocabulary + 1))
    known = (unigram > 0).astype(float)
    yield from ((0, *x, None, None, None)
                for x in _per_block(r["blocks"], refs, *[np.repeat(x, times) for x in (own, base, known)]))


def _hot_contexts(merged: DataFrame, u: Unigrams) -> Weights:
    """Weights of the contexts of one word that end in a hot word, or begin a text."""
    wanted = np.unique(np.r_[u.hot[u.hot != END], BEGIN] & _48)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                (h,), *sums = Bucket(r, u).sums(1, u)
                some = np.isin(h, wanted)
                yield pa.RecordBatch.from_arrays([pa.array(h[some].view(np.int64)), *[pa.array(x[some]) for x in sums]],
                                                 names=["h", "kept", "mass", "n"])

    found = merged.select("words", "pairs", "contexts", "counts").mapInArrow(run, "h long, kept double, mass double, n long").groupBy(
        "h").agg(F.sum("kept").alias("kept"), F.sum("mass").alias("mass"), F.sum("n").alias("n")).collect()
    h, kept, mass, n = (np.array([r[k] for r in found], t) for k, t in (("h", np.int64), ("kept", float), ("mass", float), ("n", np.int64)))
    return Weights(h.view(np.uint64), _log_alpha(kept, mass, n), n)


def _total(rows: list[dict], begun: int) -> tuple:
    """Scores of one block's documents."""
    home = next(r for r in rows if r["keys"] is not None)
    n = len(home["sizes"])
    score, base, known = np.full(n, -np.log10(begun) if begun else 0.0), np.zeros(n), np.zeros(n)
    for r in rows:
        if r["docs"] is not None:
            at = _open(r["docs"], np.uint16)
            score[at] += _open(r["score"], float)
            if r["base"] is not None:
                base[at] += _open(r["base"], float)
                known[at] += _open(r["known"], float)
    return home["keys"], home["sizes"], known, base, score


def _forget(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the files of shuffles that nothing refers to any more."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def score(df: DataFrame, keys: list[str], train, text: str = "text", order: int = 2, passes: int = 1) -> DataFrame:
    """Per row: keys, n_tokens, n_known, train_tokens, base_score, score; learns from rows where ``train`` is true.

    ``order``: words of the longest n-gram, 2 or more.  ``passes``: n-grams are counted
    for that many ranges of buckets one after the other, so that only one range's exchange is on
    disk; more than one pass needs a ``df`` that gives the same rows in the same order each time, as files do.
    """
    if order < 2:
        raise ValueError("order has to be 2 or more")
    spark = df.sparkSession
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.coalesce(train, F.lit(False)).alias("train"),
                     F.col(text).alias("t"))
    hot = _hot_words(rows)
    n_keys = len(keys)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "bucket"):
            grams = [r for r in group if r["kind"] == 0]
            for r in group:
                if r["kind"] == 1:
                    yield whole(_batch([(1, r["bucket"], [r["block"]], *[None] * 11)], _MERGED), r)
            if grams:
                yield whole(_batch([_merge(grams, hot)], _MERGED), None)

    def whole(batch: pa.RecordBatch, home: dict | None) -> pa.RecordBatch:
        own = pa.array([home and home["keys"]], pa.list_(pa.struct([(f"k{i}", arrow[i]) for i in range(n_keys)])))
        return pa.RecordBatch.from_arrays([*batch.columns, own, pa.array([home and home["sizes"]], pa.list_(pa.int64()))],
                                          names=schema.fieldNames())

    arrow = [to_arrow_type(f.dataType) for f in rows.schema.fields[:n_keys]]
    schema = T.StructType([*T._parse_datatype_string(_MERGED).fields, T.StructField("keys", T.ArrayType(T.StructType(
        rows.schema.fields[:n_keys]))), T.StructField("sizes", T.ArrayType(T.LongType()))])
    tables = []
    for p in range(passes):
        sent = _blocks(rows, n_keys, buckets, hot, order, p * buckets // passes, (p + 1) * buckets // passes)
        tables.append(stored(sent.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(merge, schema),
                             "counts", ("kind",)))
        del sent
        _forget(spark)
    table = reduce(DataFrame.unionAll, tables)
    merged = table.where("kind = 0")
    homes = table.where("kind = 1").select(F.get("blocks", F.lit(0)).alias("block"), "keys", "sizes")
    total = lambda name, size: [F.coalesce(F.sum(F.get(name, F.lit(i))), F.lit(0)).alias(f"{name}{i}") for i in range(size)]
    got = merged.agg(*total("hot", len(hot)), *total("unigrams", K + 1), *total("grams", (order - 1) * (K + 1)),
                     F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("vocabulary"), F.lit(0)).alias("vocabulary")).first()
    stats = {"hot": [got[f"hot{i}"] for i in range(len(hot))], "unigrams": [got[f"unigrams{i}"] for i in range(K + 1)],
             "grams": [got[f"grams{i}"] for i in range((order - 1) * (K + 1))], "tokens": got["tokens"], "vocabulary": got["vocabulary"]}
    begun = rows.where("train").count()
    u = Unigrams(stats, hot)
    u.hot_contexts = _hot_contexts(merged, u)
    n_homes = max(1, min(buckets // 2, -(-int(u.tokens) // HOME_TOKENS)))

    def to_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                for out in _to_contexts(r, u, n_homes):
                    yield _batch([out], _TO_CONTEXT)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "bucket"):
            for out in _weigh(group, u):
                yield _batch([out], _PARTS)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield _batch(list(_score(r, u)), _PARTS)

    weights = stored(merged.mapInArrow(to_contexts, _TO_CONTEXT).repartition(n_homes, "bucket")
                     .sortWithinPartitions("bucket").mapInArrow(weigh, _PARTS), "weights", ("kind",))
    _forget(spark)
    parts = merged.mapInArrow(tokens, _PARTS).unionByName(weights.where("kind = 0")).select("block", "docs", "score", "base", "known")
    names = [*[f"k{i}" for i in range(n_keys)], "n_tokens", "n_known", "base_score", "score"]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "block"):
            own, sizes, known, base, value = _total(group, begun)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([k[f"k{i}"] for k in own], arrow[i]) for i in range(n_keys)], pa.array(sizes, pa.int64()),
                 pa.array(known.astype(np.int64)), pa.array(base), pa.array(value)], names=names)

    out = T.StructType([*rows.schema.fields[:n_keys], T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
                        T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
    everything = homes.select("block", "keys", "sizes").unionByName(parts, allowMissingColumns=True)
    done = everything.repartition(buckets, "block").sortWithinPartitions("block").mapInArrow(finish, out)
    return done.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], "n_tokens", "n_known",
                       F.lit(int(u.tokens)).cast("long").alias("train_tokens"), "base_score", "score")
