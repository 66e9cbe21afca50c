"""Best-fit packing planned over a histogram of lengths.

Documents are tokenised, ended with ``end_id`` and cut only where they exceed a
sequence.  Best-fit decreasing then runs over the histogram (at most one count
per length, so the driver sees ``capacity`` numbers whatever the corpus), which
gives a plan of slots: runs of equal places for one length.  Every piece takes
the slot of its rank within its length; ranks come from per-block counts, so no
length gathers in one task.

Plan size: each step of the planner uses up a class of equally full sequences
or ends a length, and a sequence holds at most sqrt(2 * capacity) different
lengths, so the plan depends on ``capacity`` alone and may be broadcast.

Defined results: null and empty texts are the end id alone; null ids, repeated
rows and ties each get their own slot; an empty table gives no pieces.
"""

from __future__ import annotations

import bisect
import json
import zlib
from collections.abc import Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import stored

#: Entries of each of the two generations of a worker's word memo.
MEMO_WORDS = 800_000

#: Bytes of the longest word that ``Merges`` takes, and words that it takes at a time.
MERGE_BYTES, MERGE_WORDS = 32, 8192


class Merges:
    """The tokenizer's own merges applied to many words at once; a word must be one pre-token.

    Every round merges the lowest-ranked, leftmost pair of each word, as the tokenizer does word by word.
    """

    NONE = 1 << 25

    def __init__(self, model: dict) -> None:
        from tokenizers import pre_tokenizers

        vocab = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.made = np.array([vocab[a + b] for a, b in merges], np.int32)
        #: Token of every byte that UTF-8 has in letters; -1 for others.
        self.bytes = np.full(256, -1, np.int32)
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        for c in map(chr, range(0x250)):
            spelled = level.pre_tokenize_str(c)[0][0]
            for b, x in zip(c.encode(), spelled, strict=True):
                self.bytes[b] = vocab.get(x, -1)

    @classmethod
    def of(cls, path: str) -> Merges | None:
        """None where the model isn't a plain byte-level BPE."""
        with open(path, encoding="utf-8") as f:
            all_ = json.load(f)
        model, plain = all_["model"], ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        level = all_.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or any(model.get(x) for x in plain) or all_.get("normalizer"):
            return None
        return cls(model) if level.get("type") == "ByteLevel" and not level.get("add_prefix_space") and level.get("use_regex", True) else None

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` without a merge; -1 is no token."""
        pair = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where((a >= 0) & (b >= 0) & (self.keys[at] == pair), self.ranks[at], self.NONE).astype(np.int32)

    def _merge(self, ids: np.ndarray) -> np.ndarray:
        """Tokens of words, a word in each column, -1 below its end."""
        height, n = ids.shape
        out, of = np.empty((height, n), np.int32), np.arange(n)
        rank = np.full((height, n), self.NONE, np.int32)
        rank[:-1] = self._rank(ids[:-1].ravel(), ids[1:].ravel()).reshape(height - 1, n)
        places = np.arange(height, dtype=np.int32)[:, None]
        while len(of):
            first = ((rank << 5) + places).min(axis=0)
            done = first >= self.NONE << 5
            if done.any():
                out[:, of[done]] = ids[:, done]
                more = ~done
                ids, rank, of, first = ids[:, more], rank[:, more], of[more], first[more]
                if not len(of):
                    break
            at, which = first & 31, np.arange(len(of))
            ids[at, which] = self.made[first >> 5]
            for j in range(1, height - 1):
                behind = j > at
                ids[j] = np.where(behind, ids[j + 1], ids[j])
                rank[j] = np.where(behind, rank[j + 1], rank[j])
            ids[-1], rank[-1] = -1, self.NONE
            rank[at, which] = self._rank(ids[at, which], ids[at + 1, which])
            left = np.flatnonzero(at)
            before = at[left] - 1
            rank[before, left] = self._rank(ids[before, left], ids[before + 1, left])
        return out

    def tokens(self, words: list[str], space: bool) -> list[bytes]:
        """Ids of each word, with a space before it if ``space``; words hold no space and at most ``MERGE_BYTES`` - 2 bytes."""
        text = np.frombuffer((" " + " ".join(words) + " ").encode(), np.uint8)
        starts = np.flatnonzero(text == 32).astype(np.int64)
        size = np.diff(starts) - (not space)
        starts = starts[:-1] + (not space)
        order = np.argsort(size, kind="stable")
        out: list[bytes] = [b""] * len(words)
        for lo in range(0, len(words), MERGE_WORDS):
            some = order[lo:lo + MERGE_WORDS]
            places = np.arange(size[some[-1]] + 1)[:, None]
            inside = places < size[some]
            ids = np.where(inside, self.bytes[text[np.minimum(starts[some] + places, len(text) - 1)]], -1).astype(np.int32)
            merged = np.ascontiguousarray(self._merge(ids).T)
            real = merged >= 0
            flat, ends = merged[real].astype("<u4").tobytes(), (4 * np.cumsum(real.sum(axis=1))).tolist()
            at = 0
            for k, end in zip(some.tolist(), ends, strict=True):
                out[k] = flat[at:end]
                at = end
        return out


class WordEncoder:
    """Token ids of whole texts, one tokenizer call per different word.

    The pre-tokenizer of a byte-level BPE puts a single space before a visible
    character at the head of a new token and makes a single line feed between
    visible characters a token of its own.  Texts whose white space is of these
    two kinds only are encoded word by word and their ids joined; the others go
    to the tokenizer whole.  Memo keys: a word after a space is itself, a word
    after a line feed starts with that line feed.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Added tokens' strings: texts that hold one go to the tokenizer whole.
        self.added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        (self.feed,) = self._ids(["\n"])[0]
        self.merges = Merges.of(path)
        self.marks: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _lines(self, words: list[str]) -> list[bytes]:
        """Ids of many words by few calls: each starts a line, so line feeds part them again."""
        out: list[bytes] = []
        for ids in self._ids(["".join(words[i:i + 256]) for i in range(0, len(words), 256)]):
            at = [*(4 * np.flatnonzero(ids == self.feed)).tolist(), 4 * len(ids)]
            flat = ids.tobytes()
            out.extend(flat[a:b] for a, b in zip(at, at[1:], strict=False))
        return out

    def _learn(self, words: set[str]) -> None:
        """Bring ``words`` into the memo."""
        if len(self.memo) > MEMO_WORDS:
            self.older, self.memo = self.memo, {}
        new, ended = set(), []
        for w in words.difference(self.memo):
            if w in self.older:
                self.memo[w] = self.older[w]
            # a run of letters and the marks that close the word are pre-tokens apart
            elif (core := w.rstrip(punctuation)) != w and core.isalpha() and max(core) < "\u0250":
                ended.append((w, core, w[len(core):]))
                if core not in self.memo:
                    new.add(core)
            else:
                new.add(w)
        if self.merges and new:
            # a word of letters is one pre-token
            easy = [w for w in new if len(w) <= MERGE_BYTES // 2 - 1 and (w if w[0] != "\n" else w[1:]).isalpha() and max(w) < "\u0250"]
            new.difference_update(easy)
            headed = [w for w in easy if w[0] == "\n"]
            spaced = [w for w in easy if w[0] != "\n"]
            feed = self.feed.tobytes()
            self.memo.update(zip(headed, (feed + x for x in self.merges.tokens([w[1:] for w in headed], False)), strict=True))
            self.memo.update(zip(spaced, self.merges.tokens(spaced, True), strict=True))
        headed = [w for w in new if w[0] == "\n"]
        spaced = [w for w in new if w[0] != "\n"]
        self.memo.update(zip(headed, self._lines(headed), strict=True))
        self.memo.update(zip(spaced, (x[4:] for x in self._lines([f"\n {w}" for w in spaced])), strict=True))
        for w, core, mark in ended:
            if mark not in self.marks:
                if len(self.marks) > 10_000:
                    self.marks.clear()
                self.marks[mark] = self._ids([mark])[0].tobytes()
            self.memo[w] = self.memo[core] + self.marks[mark]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids per text."""
        plain = [bool(t) and " ".join(t.split()) == t.replace("\n", " ") and not any(x in t for x in self.added) for t in texts]
        split = [f"\n{t}".replace("\n", " \n").split(" ")[1:] if p else [] for t, p in zip(texts, plain, strict=True)]
        self._learn(set().union(*split))
        of = self.memo.__getitem__
        whole = iter(self._ids([t for t, p in zip(texts, plain, strict=True) if not p]))
        return [b"".join(map(of, s))[4:] if p else next(whole).tobytes() for s, p in zip(split, plain, strict=True)]


_ENCODERS: dict[str, WordEncoder] = {}


def cut(n: int, capacity: int) -> list[int]:
    """Piece lengths of a document of ``n`` tokens: the shorter piece comes first."""
    whole, rest = divmod(n, capacity)
    return ([rest] if rest else []) + [capacity] * whole


def tokenize_pieces(df: DataFrame, keys: list[str], tokenizer: str, text: str = "text", capacity: int = 2048,
                    end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces of every row with ``block`` and ``nth`` (rank among the block's pieces of that length)."""
    ended = np.array([end_id], dtype="<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = _ENCODERS.get(tokenizer) or _ENCODERS.setdefault(tokenizer, WordEncoder(tokenizer))
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                rows = batch.slice(lo, 500)
                col = rows.column(rows.num_columns - 1)
                encoded = encoder.encode([x or "" for x in col.to_pylist()])
                take, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, e in enumerate(encoded):
                    e += ended
                    at = 0
                    for k, n in enumerate(cut(len(e) // 4, capacity)):
                        part = e[4 * at:4 * (at + n)]
                        take.append(i)
                        piece.append(k)
                        start.append(at)
                        length.append(n)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(np.frombuffer(part, "<u4").astype(np.int64))
                        at += n
                size = np.array(length, np.int64)
                order = np.argsort(size, kind="stable")
                ranked = size[order]
                first = np.searchsorted(ranked, ranked)
                nth = np.empty(len(size), np.int64)
                nth[order] = np.arange(len(size)) - first
                kept = rows.select(rows.schema.names[:-1]).take(pa.array(take, pa.int64()))
                arrays = [*kept.columns, pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                          pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                          pa.array([block] * len(size), pa.int64()), pa.array(nth)]
                if with_ids:
                    arrays.append(pa.array(ids, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())
                block += 1

    narrow = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(text).alias("t"))
    longs = [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "block", "nth")]
    schema = T.StructType([*narrow.schema.fields[:-1], T.StructField("piece", T.IntegerType()), *longs]
                          + ([T.StructField("ids", T.ArrayType(T.LongType()))] if with_ids else []))
    return narrow.mapInArrow(pieces, schema)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts.

    Slots as (length, first rank, end rank, first sequence, pieces per sequence,
    offset): the pieces of that length and rank fill consecutive sequences.
    """
    slots: list[tuple[int, int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = {}        # tokens left -> runs (first sequence, sequences)
    left: list[int] = []                               # sorted keys of room
    opened = 0

    def put(remaining: int, first: int, number: int) -> None:
        if number and remaining:
            if remaining not in room:
                room[remaining] = []
                bisect.insort(left, remaining)
            room[remaining].append((first, number))

    for length in sorted(histogram, reverse=True):
        rank, n = 0, histogram[length]
        while n:
            at = bisect.bisect_left(left, length)
            if at < len(left):
                remaining = left[at]
                first, number = room[remaining].pop()
                if not room[remaining]:
                    del room[remaining]
                    left.pop(at)
            else:
                remaining, first, number = capacity, opened, -(-n // (capacity // length))
                opened += number
            fit = remaining // length
            full = min(number, n // fit)
            if full:
                slots.append((length, rank, rank + full * fit, first, fit, capacity - remaining))
                put(remaining - fit * length, first, full)
                rank, n, first, number = rank + full * fit, n - full * fit, first + full, number - full
            if n and number:
                slots.append((length, rank, rank + n, first, n, capacity - remaining))
                put(remaining - n * length, first, 1)
                rank, n, first, number = rank + n, 0, first + 1, number - 1
            put(remaining, first, number)
    return slots


def pack(df: DataFrame, keys: list[str], tokenizer: str, text: str = "text", capacity: int = 2048, end_id: int = 0,
         with_ids: bool = False) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; with ``with_ids`` also their token ids."""
    spark = df.sparkSession
    pieces = stored(tokenize_pieces(df, keys, tokenizer, text, capacity, end_id, with_ids), "pieces")
    blocks = pieces.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    # a length's blocks are numbered within each input partition, its partitions by their sums: no length gathers its blocks
    earlier = lambda by, order: F.coalesce(F.sum("n").over(
        Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = F.shiftright("block", 32).alias("part")
    parts = blocks.groupBy("length", part).agg(F.sum("n").alias("n")).select(
        "length", "part", earlier(["length"], "part").alias("of_parts"))
    ranks = blocks.select("length", "block", part, "n").select(
        "length", "block", "part", earlier(["length", "part"], "block").alias("of_blocks")).join(parts, ["length", "part"]).select(
        "length", "block", (F.col("of_parts") + F.col("of_blocks")).alias("before"))
    slots = spark.createDataFrame(plan(histogram, capacity), "slot_length long, first long, last long, "
                                  "sequence long, per_sequence long, at long")
    ranked = pieces.join(ranks, ["length", "block"]).withColumn("rank", F.col("before") + F.col("nth"))
    placed = ranked.join(F.broadcast(slots), (F.col("length") == F.col("slot_length"))
                         & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))
    nth = F.col("rank") - F.col("first")
    return placed.select(
        *[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.floor(nth / F.col("per_sequence"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(nth, F.col("per_sequence")) * F.col("length")).alias("offset"),
        *(["ids"] if with_ids else []))
