import gzip
import zlib

import pytest

from tastebud.llm import warc as K
from tastebud.llm.queries import QUERIES


def brute(pages):
    first = {}
    for key, html in pages:
        first.setdefault(html or "", []).append(key)
    out = []
    for key, html in pages:
        data = (html or "").encode()
        ids = [i for i in first[html or ""] if i is not None]
        revisit = bool(ids) and len(first[html or ""]) > 1 and key != min(ids)
        out.append((key, len(data), K.digest(data), "revisit" if revisit else "response", min(ids) if revisit else None))
    return sorted(out, key=repr)


def rows(found):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in found.collect()), key=repr)


def test_query(spark, sf):
    pages = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op10_warc"](spark, sf).collect()), key=repr) == brute(pages)


ODD = [(1, "u", "a"), (2, None, "a"), (3, "u\nv", None), (4, "", ""), (None, "u", "a"), (None, "u", "z"), (6, "é", "日本\r\n\r\n\x00"),
       (6, "é", "日本\r\n\r\n\x00"), (7, "u", "long " * 4_000_000), (8, "u", "z2")]


def test_odd_rows(spark):
    df = spark.createDataFrame(ODD, "page_id long, url string, html string")
    want = brute([(a, c) for a, _, c in ODD])
    assert rows(K.round_trip(df)) == want
    from pyspark.sql import functions as F

    assert rows(K.round_trip(df.withColumns({"id": F.lit(1), "p": F.lit("x"), "_h": F.lit(2)}))) == want
    assert rows(K.round_trip(df.limit(0))) == []


def test_payloads_and_files(spark, tmp_path):
    from tastebud.session import ensure_checkpoint_dir

    df = spark.createDataFrame(ODD[:7], "page_id long, url string, html string")
    path = f"{tmp_path}/archives"
    ensure_checkpoint_dir(spark)
    K.write(df, path)
    got = K.read(spark, path).where("record_type = 'response'").collect()
    assert (6, "日本\r\n\r\n\x00".encode()) in {(r["page_id"], bytes(r["payload"])) for r in got}
    for f in tmp_path.joinpath("archives").rglob("part-*"):
        assert gzip.decompress(f.read_bytes()).startswith(b"WARC/1.1\r\n") or not f.stat().st_size


def test_archives_are_closed_by_bytes(spark, tmp_path):
    """Payloads of 1, 100 and 5,000 bytes under a limit of 4,000 bytes a file."""
    pages = [(i, "u", str(i) * n) for i, n in enumerate([1] * 6 + [100] * 60 + [5000] * 5, 1)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    K.write(df, path := f"{tmp_path}/archives", archive_bytes=4000)
    files = [gzip.decompress(f.read_bytes()) for f in tmp_path.joinpath("archives").rglob("part-*")]
    held = [[len(r.payload) for r in K.records(gzip.compress(f))] if f.count(b"WARC/1.1") == 1 else f.count(b"WARC/1.1") for f in files if f]
    assert len(held) > 10 and rows(K.read(spark, path)) == brute([(a, c) for a, _, c in pages])
    assert all(len(f) <= 4000 + 400 * f.count(b"WARC/1.1") or f.count(b"WARC/1.1") == 1 for f in files)


def test_reader_frames_and_verifies():
    a, b = K.record(1, "u", b"x" * 300_000, None, False), K.record(2, "u", b"x" * 300_000, 1, True)
    first, second = K.records(a + b)
    assert first.payload == b"x" * 300_000 and second.headers["WARC-Refers-To"] == "<urn:page:1>"
    assert len(list(K.members(a + b, chunk=7))) == 2
    for bad in (a[:-20], a[:40] + b"\x00" * 9 + a[49:]):
        with pytest.raises(K.WarcError):
            list(K.records(bad))
    forged = zlib.decompress(a, 31).replace(b"xxxx", b"xxxy", 1)
    with pytest.raises(K.WarcError, match="digest"):
        list(K.records(gzip.compress(forged)))
    with pytest.raises(K.WarcError, match="Content-Length"):
        list(K.records(gzip.compress(zlib.decompress(a, 31) + b"?")))
