"""WARC archives: writing and sequential reading.

Every record is one gzip member.  ``write`` decides per payload which page
keeps it (the smallest id; hot payloads are looked up apart, see
``tables.lookup``), compresses records inside tasks and writes real archive
files below the shared folder.  ``read`` walks each archive from its start:
one incremental zlib stream per member, header lines up to the blank line,
``Content-Length`` bytes of block, and a check of the payload digest.

An archive file holds up to ``ARCHIVE_ROWS`` records and about ``ARCHIVE_BYTES``
of payload: larger payloads are written by size class, fewer to a file, so the
reader's memory is bounded by that and not by the table.  The largest record is
a payload of 2 GiB less its headers, the most that a cell can hold.

Defined results: a null payload is empty; rows whose id equals the smallest of
their payload are all responses, so repeated rows are too; null ids are no
smallest id (a payload that only they have is a response without id); an empty
table writes no record.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .tables import lookup, stored

ARCHIVE_ROWS = 2000
#: Payload bytes that an archive file holds, unless it is a single record.
ARCHIVE_BYTES = 256 << 20
#: Payloads shorter than this are never revisits.
REVISIT_BYTES = 0
_DATE = "2024-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _line(value: str) -> str:
    """A header value on one line."""
    return " ".join(value.split())


def record(page_id, url: str | None, payload: bytes, refers_to, revisit: bool) -> bytes:
    """One WARC/1.1 record as a gzip member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if revisit else http + payload
    named = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", _line(url or "")),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if revisit:
        named.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        named.append(("WARC-Refers-To", f"<urn:page:{refers_to}>"))
    named += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in named) + "\r\n"
    data = head.encode("utf-8") + block + b"\r\n\r\n"
    gz = zlib.compressobj(3, zlib.DEFLATED, 31)
    return gz.compress(data) + gz.flush()


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        return self.block.partition(b"\r\n\r\n")[2]


class WarcError(ValueError):
    """An archive that breaks the format or a record that fails its digest."""


def members(data: bytes, chunk: int = 1 << 16) -> Iterator[bytes]:
    """Contents of each gzip member, decompressed a chunk at a time."""
    at, n, view = 0, len(data), memoryview(data)
    while at < n:
        inflate = zlib.decompressobj(31)
        parts = []
        while not inflate.eof:
            if at >= n:
                raise WarcError("the archive ends inside a gzip member")
            piece = view[at:at + chunk]
            try:
                parts.append(inflate.decompress(piece))
            except zlib.error as e:
                raise WarcError(f"damaged gzip member: {e}") from e
            at += len(piece) - len(inflate.unused_data)
        yield b"".join(parts)


def parse(member: bytes) -> Record:
    """Frame one record by its header lines and Content-Length."""
    head, blank, rest = member.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if not blank or not version.startswith("WARC/"):
        raise WarcError("no WARC header")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    size = int(headers["Content-Length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise WarcError("Content-Length doesn't frame the record")
    return Record(headers, rest[:size])


def records(data: bytes) -> Iterator[Record]:
    """All records of an archive, digests verified (a revisit has no payload of its own)."""
    for member in members(data):
        if not member:
            continue
        r = parse(member)
        if r.headers["WARC-Type"] == "response" and f"sha1:{digest(r.payload)}" != r.headers["WARC-Payload-Digest"]:
            raise WarcError(f"digest mismatch in {r.headers['WARC-Record-ID']}")
        yield r


def _first_pages(pages: DataFrame, id_col: str, payload: str, revisit_bytes: int) -> tuple[DataFrame, DataFrame]:
    """``pages`` with its payload hash, and per repeated hash the smallest id and the number of rows."""
    hashed = pages.withColumn("_h", F.sha2(F.coalesce(F.col(payload), F.lit("")), 256))
    narrow = hashed.where(F.octet_length(F.coalesce(F.col(payload), F.lit(""))) >= revisit_bytes)
    first = narrow.groupBy("_h").agg(F.min(id_col).alias("_first"), F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    return hashed, stored(first, "payloads")


def write(pages: DataFrame, path: str, id_col: str = "page_id", url: str = "url", payload: str = "html",
          revisit_bytes: int = REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write one record per row to archive files below ``path``, one folder for each size class of payloads."""
    hashed, first = _first_pages(pages.select(id_col, url, payload), id_col, payload, revisit_bytes)
    rows = lookup(hashed, first, "_h", "_rows", F.xxhash64(id_col, "_h")).select(
        F.col(id_col).alias("id"), F.col(url).alias("u"), F.col(payload).alias("p"), F.col("_first").alias("first"))
    size = F.coalesce(F.octet_length("p"), F.lit(0))
    largest = pages.agg(F.max(F.octet_length(payload))).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                out = []
                for r in batch.slice(lo, 200).to_pylist():
                    revisit = r["first"] is not None and r["id"] != r["first"]
                    gz = record(r["id"], r["u"], (r["p"] or "").encode("utf-8"), r["first"], revisit)
                    # a member ends with the length's high byte, zero below 16 MB; an empty member ends the others
                    if gz[-1]:
                        last = zlib.compressobj(3, zlib.DEFLATED, 31)
                        gz += last.compress(b"") + last.flush()
                    out.append(gz[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    below, above = -1, max(1, archive_bytes // ARCHIVE_ROWS)
    while below < largest or below < 0:
        # The text writer copies a string's bytes as they are and ends each row with the separator: here the zero byte
        # that every member ends with, so the files are plain concatenations of gzip members.
        part = rows.where((size > below) & (size <= above))
        (part.mapInArrow(run, "member binary").select(F.col("member").cast("string").alias("value"))
         .write.option("lineSep", "\x00").option("maxRecordsPerFile", max(1, archive_bytes // above)).text(f"{path}/{above}"))
        below, above = above, 8 * above


def read(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """Records of all archives below ``path``: page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def page(x: str | None):
            name = (x or "")[len("<urn:page:"):-1]
            return (int(name) if id_type == "long" else name) if name else None

        def batch(found: list[Record]) -> pa.RecordBatch:
            h = [r.headers for r in found]
            return pa.RecordBatch.from_arrays([
                pa.array([page(x["WARC-Record-ID"]) for x in h], kind), pa.array([x["WARC-Target-URI"] for x in h]),
                pa.array([x["WARC-Type"] for x in h]), pa.array([page(x.get("WARC-Refers-To")) for x in h], kind),
                pa.array([x["WARC-Payload-Digest"].removeprefix("sha1:") for x in h]),
                pa.array([int(x["X-Payload-Length"]) for x in h], pa.int64()),
                pa.array([r.payload if r.headers["WARC-Type"] == "response" else None for r in found], pa.binary())],
                names=["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"])

        kind = pa.int64() if id_type == "long" else pa.string()
        for b in batches:
            for row in range(b.num_rows):
                held: list[Record] = []
                for r in records(b.column(0)[row].as_py()):
                    held.append(r)
                    if len(held) == 200:
                        yield batch(held)
                        held = []
                if held:
                    yield batch(held)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", True).load(path).select("content")
    return files.mapInArrow(run, f"page_id {id_type}, url string, record_type string, refers_to {id_type}, "
                            "payload_digest string, payload_bytes long, payload binary")


def round_trip(pages: DataFrame, id_col: str = "page_id", url: str = "url", payload: str = "html",
               revisit_bytes: int = REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all rows to archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write(pages, path, id_col, url, payload, revisit_bytes, archive_bytes)
    kind = "string" if pages.schema[id_col].dataType.simpleString() == "string" else "long"
    return read(spark, path, kind)
