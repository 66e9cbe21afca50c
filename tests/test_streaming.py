"""Streams over several files: running totals, recovery, one file as the source."""

from tastebud.streaming import tokens as T

BATCHES = (["a b x", "x y"], ["c c a"], ["z"])


def _write(spark, path, texts):
    spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1).write.mode("append").parquet(path)


def test_running_total_grows_batch_by_batch(spark, tmp_path):
    src, sink, dropped, total = (str(tmp_path / n) for n in ("src", "sink", "dropped", "total"))
    schema = "text string"
    for texts in BATCHES:
        _write(spark, src, texts)
        T.token_count_stream(spark, src, schema, sink, str(tmp_path / "ckpt"),
                             blocklist=T.BLOCKLIST, dropped_sink=dropped, max_files=1)
        T.dropped_total_stream(spark, src, schema, total, str(tmp_path / "state"), max_files=1)
    assert sorted(tuple(r) for r in T.running_dropped(spark, total).collect()) == [(0, 2, 2), (1, 3, 5), (2, 0, 5)]
    assert sorted((r["batch_id"], r["dropped"]) for r in T.read_batches(spark, dropped).collect()) == [(0, 2), (1, 3), (2, 0)]
    assert {r["token"]: r["n"] for r in T.total_counts(spark, sink).collect()} == {"x": 2, "y": 1, "z": 1}


def test_running_total_after_a_replayed_batch(spark, tmp_path):
    """The last batch's commit and output are lost: the restarted query replays it from the state before it."""
    src, total, ckpt = tmp_path / "src", tmp_path / "total", tmp_path / "state"
    for texts in BATCHES:
        _write(spark, str(src), texts)
        T.dropped_total_stream(spark, str(src), "text string", str(total), str(ckpt), max_files=1)
    want = sorted(tuple(r) for r in T.running_dropped(spark, str(total)).collect())
    for f in [*ckpt.joinpath("commits").glob("*2*"), *total.joinpath("batch_id=2").iterdir()]:
        f.unlink()
    T.dropped_total_stream(spark, str(src), "text string", str(total), str(ckpt), max_files=1)
    _write(spark, str(src), ["a"])
    T.dropped_total_stream(spark, str(src), "text string", str(total), str(ckpt), max_files=1)
    assert sorted(tuple(r) for r in T.running_dropped(spark, str(total)).collect()) == [*want, (3, 1, 6)]


def test_one_file_per_batch(spark, tmp_path):
    src, sink = str(tmp_path / "src"), str(tmp_path / "sink")
    for texts in BATCHES:
        _write(spark, src, texts)
    T.copy_stream(spark, src, "text string", sink, str(tmp_path / "ckpt"), max_files=1)
    got = T.read_batches(spark, sink)
    assert got.select("batch_id").distinct().count() == 3
    assert sorted(r["text"] for r in got.collect()) == sorted(t for b in BATCHES for t in b)


def test_summary_of_a_single_file(spark, tmp_path):
    src, sink = tmp_path / "src", str(tmp_path / "sink")
    _write(spark, str(src), ["p", "p", "q"])
    part = next(src.glob("part-*.parquet"))
    T.append_summary_stream(spark, str(part).replace(".parquet", ".{parquet}"), "text string", sink, str(tmp_path / "ckpt"), "text")
    assert {r["text"]: r["n"] for r in T.read_batches(spark, sink).collect()} == {"p": 2, "q": 1}


def test_batches_by_the_clock_and_by_event_time(spark, tmp_path):
    """Batches of ten seconds of event time, triggered twice a second; a restart goes on where the first run stopped."""
    sink = str(tmp_path / "sink")
    for batches in (2, 4):
        T.summarise_every(T.rate_stream(spark, 50), sink, str(tmp_path / "ckpt"), seconds=0.5, batches=batches)
    rows = sorted((r["batch_id"], r["first"].timestamp(), r["n"], r["total"]) for r in T.read_batches(spark, sink).collect())
    assert len(rows) >= 4
    for k, first, n, total in rows:
        assert n == 50 and total == sum(range(50 * k, 50 * k + 50))
        assert first - rows[0][1] == 10 * k
