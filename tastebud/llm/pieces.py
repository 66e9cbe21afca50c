"""SentencePiece encoding that keeps the source place of every piece, and decoding.

A model's compiled character map is a double-array trie over source strings and
a blob of replacements.  ``Normalizer`` replaces the longest source string at
every place and records, for each byte it writes, the byte of the text that it
came from; a piece's bytes in the normalised text are thus projected to a span
of the original bytes.  ``Pieces`` cuts normalised text where no piece can
reach across and segments each different part once.

Spans are offsets into the text's UTF-8 bytes, end exclusive, one per id before
the end id; in order they cover the whole text where the map drops nothing.
A byte piece in the middle of a character has an empty span, the last one has
the character.

Defined results: null and empty texts are the end id alone and decode to ''; a
text of any length is encoded whole (one row at a time is in memory); ties and
repeated rows each get a row; null keys are kept; an empty table gives an empty
table; other columns than ``keys`` and ``text`` are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
#: Entries of each of the two generations of a worker's memo of segmented parts.
MEMO_PARTS = 300_000
#: Kinds of pieces in a model file.
NORMAL, UNKNOWN, USER_DEFINED, BYTE, UNUSED = 1, 2, 4, 6, 5


def wire_fields(message: bytes) -> Iterator[tuple[int, int, int | bytes, int, int]]:
    """Fields of one protocol-buffer message: number, wire type, value, begin and end."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(message):
        begin = at
        key = varint()
        kind = key & 7
        if kind == 0:
            value: int | bytes = varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            value = message[at:at + size]
            at += size
        yield key >> 3, kind, value, begin, at


def _message(number: int, payload: bytes) -> bytes:
    size, n = b"", len(payload)
    while n > 0x7F:
        size, n = size + bytes([n & 0x7F | 0x80]), n >> 7
    return bytes([number << 3 | 2]) + size + bytes([n]) + payload


class CharMap:
    """The compiled character map: uint32 size of the trie, its units, then zero-ended replacements."""

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units: list[int] = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.replacements = blob[4 + size:]
        #: Bytes that begin a source string.
        self.heads = {b for b in range(256) if self.units and self._step(self._root(), b) is not None}

    def _root(self) -> int:
        return self._below(0, self.units[0])

    @staticmethod
    def _below(at: int, unit: int) -> int:
        return at ^ (unit >> 10 << ((unit & 0x200) >> 6))

    def _step(self, at: int, byte: int) -> int | None:
        """Place of the unit that ``byte`` leads to, or none."""
        at ^= byte
        return at if at < len(self.units) and self.units[at] & 0x800000FF == byte else None

    def longest(self, data: bytes, at: int) -> tuple[int, bytes]:
        """Length of the longest source string at ``at`` (0: none) and its replacement."""
        found, value = 0, 0
        if self.units and data[at] in self.heads:
            node: int | None = self._root()
            for end in range(at, len(data)):
                node = self._step(node, data[end])
                if node is None:
                    break
                unit = self.units[node]
                node = self._below(node, unit)
                if unit >> 8 & 1:
                    found, value = end + 1 - at, self.units[node] & 0x7FFFFFFF
        return found, self.replacements[value:self.replacements.index(b"\0", value)] if found else b""


class Normalizer:
    """Normalised text with, for each of its bytes and its end, the source byte that it came from."""

    def __init__(self, spec: bytes, suffix: bool = False, kept_whole: list[str] | None = None) -> None:
        fields = {number: value for number, _, value, _, _ in wire_fields(spec)}
        self.chars = CharMap(fields.get(2, b""))
        self.dummy, self.squeeze, self.escape = (bool(fields.get(k, 1)) for k in (3, 4, 5))
        self.suffix = suffix
        self.space = SPACE.encode() if self.escape else b" "
        whole = sorted((x.encode() for x in kept_whole or []), key=len, reverse=True)
        self.whole = re.compile(b"|".join(map(re.escape, whole))) if whole else None
        #: Texts that change in spaces only: each becomes a mark, with one more in front.
        self.plain = not self.chars.units and not self.squeeze and not suffix and self.escape and not whole

    def _next(self, data: bytes, at: int) -> tuple[bytes, int]:
        """Replacement of what stands at ``at`` and the number of source bytes."""
        if self.whole and (m := self.whole.match(data, at)):
            return m[0], len(m[0])
        n, out = self.chars.longest(data, at)
        if n:
            return out, n
        byte = data[at]
        n = 1 if byte < 0x80 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
        return data[at:at + n], n

    def aligned(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes and the source offset of each of them and of the end."""
        data = text.encode()
        if not data:
            return b"", np.zeros(1, np.int64)
        if self.plain:
            return self._aligned_plain(data)
        out, source, at = bytearray(), [], 0

        def put(part: bytes) -> None:
            out.extend(part)
            source.extend([at] * len(part))

        if self.squeeze:
            while at < len(data) and (step := self._next(data, at))[0] == b" ":
                at += step[1]
            if at == len(data):
                return b"", np.array([at])
        if self.dummy and not self.suffix:
            put(self.space)
        after_space = self.squeeze
        while at < len(data):
            part, n = self._next(data, at)
            if after_space:
                part = part.lstrip(b" ")
            if part:
                after_space = self.squeeze and part.endswith(b" ")
                put(part.replace(b" ", self.space))
            at += n
        if self.squeeze:
            while out.endswith(self.space):
                at = source[len(out) - len(self.space)]
                del out[len(out) - len(self.space):], source[len(source) - len(self.space):]
        if self.dummy and self.suffix:
            put(self.space)
        return bytes(out), np.array([*source, at], np.int64)

    def _aligned_plain(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """A space gives three bytes of its own offset, each byte of a character its first one's."""
        raw = np.frombuffer(data, np.uint8)
        place = np.arange(len(raw))
        first = np.maximum.accumulate(np.where((raw & 0xC0) == 0x80, 0, place))
        source = np.repeat(first, np.where(raw == 0x20, len(self.space), 1))
        head = np.zeros(len(self.space) if self.dummy else 0, np.int64)
        return (self.space if self.dummy else b"") + data.replace(b" ", self.space), np.concatenate([head, source, [len(raw)]])

    def normalized(self, text: str) -> str:
        """The normalised text alone."""
        if self.plain and text:
            return (SPACE if self.dummy else "") + text.replace(" ", SPACE)
        return self.aligned(text)[0].decode()


class Pieces:
    """Ids, spans and decoded texts under one model file."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        with open(path, "rb") as f:
            model = f.read()
        self.model = SentencePieceProcessor(model_proto=model)
        texts, kinds, spec, trainer, rest = [], [], b"", {}, []
        for number, _, value, begin, end in wire_fields(model):
            if number == 1:
                piece = {k: v for k, _, v, _, _ in wire_fields(value)}
                texts.append(piece[1].decode())
                kinds.append(piece.get(3, NORMAL))
            if number == 2:
                trainer = {k: v for k, _, v, _, _ in wire_fields(value)}
            if number == 3:
                spec = value
            else:
                rest.append(model[begin:end])
        own = [t for t, k in zip(texts, kinds, strict=True) if k == USER_DEFINED]
        self.normalizer = Normalizer(spec, bool(trainer.get(24, 0)), own)
        # the same model without a normaliser segments what this one's normaliser has made
        bare = _message(1, b"identity") + b"\x18\x00\x20\x00\x28\x00"
        self.segmenter = SentencePieceProcessor(model_proto=b"".join(rest) + _message(3, bare))
        self.size = np.array([1 if k == BYTE else -1 if k == UNKNOWN else len(t.encode()) for t, k in zip(texts, kinds, strict=True)])
        self.end = self.model.eos_id()
        self.unknown = self.model.unk_id()
        self.name = [str(i).encode() for i in range(len(texts))]
        usable = [t for t, k in zip(texts, kinds, strict=True) if k in (NORMAL, USER_DEFINED, UNUSED)]
        #: Whether a part may begin before every space mark that follows another character: pieces have it at their head only,
        #: and no unknown piece joins its neighbour.
        self.cuts = trainer.get(3, 1) == 2 and bool(trainer.get(35, 0)) and all(SPACE not in t.lstrip(SPACE) for t in usable)
        self.feed = self.cuts and all("\n" not in t for t in usable)
        self.memo: dict[str, tuple[bytes, bytes]] = {"": (b"", b"")}
        self.older: dict[str, tuple[bytes, bytes]] = {}

    def parts(self, normal: str) -> list[str]:
        """Parts of the normalised text that are segmented apart."""
        if not self.cuts:
            return [normal]
        if SPACE * 2 in normal or "\0" in normal:
            found = re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", normal)
            return [x for p in found for x in re.split("(\n)", p)] if self.feed else found
        marked = normal.replace(SPACE, f"\0{SPACE}")
        return (marked.replace("\n", "\0\n\0") if self.feed else marked).split("\0")

    def learn(self, parts: set[str]) -> None:
        """Bring ``parts`` into the memo."""
        if len(self.memo) > MEMO_PARTS:
            self.older, self.memo = self.memo, {"": (b"", b"")}
        new = []
        for p in parts.difference(self.memo):
            if p in self.older:
                self.memo[p] = self.older[p]
            else:
                new.append(p)
        name = self.name.__getitem__
        for p, ids in zip(new, self.segmenter.encode(new, num_threads=1), strict=True):
            self.memo[p] = (b" ".join(map(name, ids)), np.array(ids, "<u2" if len(self.name) <= 1 << 16 else "<u4").tobytes())

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, np.ndarray]]:
        """Per text: its ids as decimals joined by spaces, and the ids, without the end id."""
        kind = "<u2" if len(self.name) <= 1 << 16 else "<u4"
        split = [self.parts(self.normalizer.normalized(t)) if t else [] for t in texts]
        self.learn(set().union(*split))
        for parts in split:
            found = list(map(self.memo.__getitem__, parts))
            yield b" ".join([x for x, _ in found if x]), np.frombuffer(b"".join([x for _, x in found]), kind)

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Source bytes of every piece."""
        normal, source = self.normalizer.aligned(text)
        size = self.size[ids]
        if (size < 0).any():     # unknown pieces have no length of their own
            size = np.array([len(p.encode()) if i == self.unknown else n for p, i, n in
                             zip(self.segmenter.encode(normal.decode(), out_type=str), ids.tolist(), size.tolist(), strict=True)], np.int64)
        ends = np.cumsum(size)
        return source[ends - size], source[ends]

    def decode(self, ids: list[list[int]]) -> list[str]:
        """Texts of the ids."""
        return self.model.decode(ids, num_threads=1) if ids else []


_LOADED: dict[str, Pieces] = {}


def _loaded(path: str) -> Pieces:
    return _LOADED.get(path) or _LOADED.setdefault(path, Pieces(path))


def encode(df: DataFrame, keys: list[str], model: str, text: str = "text", with_ids: bool = False, with_spans: bool = False) -> DataFrame:
    """Per row: ``keys``, n_tokens, ids_sha256, n_bytes (of the text), covered_bytes (by spans) and the decoded text.

    ``with_ids`` adds the ids, end id last; ``with_spans`` adds ``begin`` and ``end`` of every id but the last.
    ``model`` is a path that every executor can read.
    """
    narrow = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(text).alias("t"))
    extra = [("ids", with_ids, T.ArrayType(T.IntegerType())), ("begin", with_spans, T.ArrayType(T.LongType())),
             ("end", with_spans, T.ArrayType(T.LongType()))]
    fields = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("n_bytes", T.LongType()), ("covered_bytes", T.LongType()),
              ("decoded", T.StringType()), *[(n, kind) for n, on, kind in extra if on]]
    schema = T.StructType([*narrow.schema.fields[:-1], *[T.StructField(n, kind) for n, kind in fields]])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _loaded(model)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [x or "" for x in part.column(part.num_columns - 1).to_pylist()]
                out: dict[str, list] = {n: [] for n, _ in fields}
                plain = []
                for t, (decimals, ids) in zip(texts, pieces.encode(texts), strict=True):
                    begin, end = pieces.spans(t, ids)
                    plain.append(ids.tolist())
                    closed = decimals + b" " if decimals else b""
                    out["n_tokens"].append(len(ids) + 1)
                    out["ids_sha256"].append(hashlib.sha256(closed + pieces.name[pieces.end]).hexdigest())
                    out["n_bytes"].append(len(t.encode()))
                    out["covered_bytes"].append(int((end - begin).sum()))
                    if with_ids:
                        out["ids"].append([*plain[-1], pieces.end])
                    if with_spans:
                        out["begin"].append(begin)
                        out["end"].append(end)
                out["decoded"] = pieces.decode([[*x, pieces.end] for x in plain])
                own = part.columns[:-1]
                yield pa.RecordBatch.from_arrays([*own, *[pa.array(out[n], kinds[n]) for n, _ in fields]], names=schema.fieldNames())

    kinds = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "n_bytes": pa.int64(), "covered_bytes": pa.int64(), "decoded": pa.string(),
             "ids": pa.list_(pa.int32()), "begin": pa.list_(pa.int64()), "end": pa.list_(pa.int64())}
    done = narrow.mapInArrow(rows, schema)
    return done.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], *[n for n, _ in fields])


def decode(df: DataFrame, keys: list[str], model: str, ids: str = "ids") -> DataFrame:
    """Per row: ``keys`` and the decoded text; a null list of ids decodes to ''."""
    narrow = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(ids).alias("t"))
    schema = T.StructType([*narrow.schema.fields[:-1], T.StructField("decoded", T.StringType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _loaded(model)
        for batch in batches:
            texts = pieces.decode([x or [] for x in batch.column(batch.num_columns - 1).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=schema.fieldNames())

    return narrow.mapInArrow(rows, schema).select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], "decoded")
