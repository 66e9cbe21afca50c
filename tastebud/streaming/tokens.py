"""Structured Streaming operators (T1-T4, IO13, IO14).

The reference's stream is a micro-batch word count whose counts are
*per batch* (stateless), filtered by a blocklist, with a running count of
dropped words and recovery from a checkpoint.  Here:

* source: a file stream straight on the table's path (``readStream.parquet``),
  a folder or a pattern; Kafka or sockets plug in the same way;
* per-batch aggregation: ``foreachBatch`` runs an ordinary (partially
  aggregated) ``groupBy`` on each micro-batch, so state never grows;
* sinks: every batch writes ``<sink>/batch_id=<id>`` with overwrite, so a
  replayed batch after a failure replaces its own output (idempotent,
  exactly-once end to end together with the checkpointed offsets);
* dropped counter: each batch's count is a row of its own sink, and the running
  total is keyed state (one row per blocked word) in the query's state store,
  so a replayed batch starts from the state before it and a restart goes on
  from the last committed one (an accumulator would count retried tasks twice).

``max_bytes`` bounds a micro-batch by input bytes, so the number of batches
follows from the input; ``max_files`` bounds it by files instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import tokens

# The blocklist of the reference's stream job.
BLOCKLIST = ("a", "b", "c")

BATCH_BYTES = 64 << 30


def file_stream(spark: SparkSession, source: str, schema, max_bytes: int = BATCH_BYTES,
                max_files: int | None = None) -> DataFrame:
    """IO13: Parquet file stream with bounded micro-batches.

    ``source`` is a folder or a pattern; a stream takes a plain path for a
    folder, so a single file is given as a pattern (``t.{parquet}``).
    """
    r = spark.readStream.schema(schema)
    r = r.option("maxFilesPerTrigger", max_files) if max_files else r.option("maxBytesPerTrigger", max_bytes)
    return r.parquet(source)


def rate_stream(spark: SparkSession, rows_per_batch: int, milliseconds_per_batch: int = 10_000, start: int = 0, partitions: int = 1) -> DataFrame:
    """IO13, second source: (timestamp, value) rows, ``rows_per_batch`` to a batch; every batch is the same when replayed.

    Event time goes on by ``milliseconds_per_batch`` from ``start`` (milliseconds), whatever the wall clock does.
    """
    r = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch).option("numPartitions", partitions)
    return r.option("advanceMillisPerBatch", milliseconds_per_batch).option("startTimestamp", start).load()


def summarise_every(stream: DataFrame, sink: str, checkpoint: str, seconds: float = 10, batches: int | None = None) -> None:
    """T1 by the clock: one row (first, last, n, total) for each batch, a batch every ``seconds``; stops after ``batches``."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last"), F.count(F.lit(1)).alias("n"),
                  F.sum("value").alias("total")).write.mode("overwrite").parquet(_batch_path(sink, batch_id))

    q = (stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(processingTime=f"{int(seconds * 1000)} milliseconds").start())
    while q.isActive and (batches is None or (q.lastProgress or {"batchId": -1})["batchId"] < batches - 1):
        q.awaitTermination(1)
    q.stop()


def _batch_path(base: str, batch_id: int) -> str:
    return f"{base.rstrip('/')}/batch_id={batch_id}"


def _drain(stream: DataFrame, per_batch, checkpoint: str) -> None:
    q = (stream.writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def token_count_stream(spark: SparkSession, source: str, schema, sink: str, checkpoint: str,
                       text_col: str = "text", blocklist=None, dropped_sink: str | None = None,
                       max_files: int | None = None) -> None:
    """Per-batch token counts with optional blocklist and dropped counter.

    Runs until the source is drained (``availableNow``); restarting with the
    same ``checkpoint`` resumes after the last committed batch (T4).
    """
    stream = file_stream(spark, source, schema, max_files=max_files)
    toks = stream.select(F.explode(tokens(F.col(text_col))).alias("token"))
    block = None
    if blocklist is not None:
        block = spark.createDataFrame([(t,) for t in blocklist], "token string")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy("token").agg(F.count(F.lit(1)).cast("bigint").alias("n")).persist()
        kept = counts
        if block is not None:
            kept = counts.join(block, "token", "left_anti")
            if dropped_sink is not None:
                dropped = counts.join(block, "token", "left_semi").agg(
                    F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("dropped"))
                dropped.write.mode("overwrite").parquet(_batch_path(dropped_sink, batch_id))
        kept.write.mode("overwrite").parquet(_batch_path(sink, batch_id))
        counts.unpersist()

    _drain(toks, per_batch, checkpoint)


def read_batches(spark: SparkSession, sink: str) -> DataFrame:
    """All batch outputs of a sink (``batch_id`` comes back as a partition column)."""
    return spark.read.parquet(sink)


def total_counts(spark: SparkSession, sink: str) -> DataFrame:
    """Sum of the per-batch counts = the count over the whole input."""
    return read_batches(spark, sink).groupBy("token").agg(F.sum("n").cast("bigint").alias("n"))


def dropped_total_stream(spark: SparkSession, source: str, schema, sink: str, checkpoint: str, text_col: str = "text",
                         blocklist=BLOCKLIST, max_files: int | None = None) -> None:
    """Running number of blocked tokens after each batch, from state keyed by the blocked word."""
    stream = file_stream(spark, source, schema, max_files=max_files)
    blocked = stream.select(F.explode(tokens(F.col(text_col))).alias("token")).where(F.col("token").isin(list(blocklist)))
    counts = blocked.groupBy("token").agg(F.count(F.lit(1)).cast("bigint").alias("n"))

    def per_batch(state: DataFrame, batch_id: int) -> None:
        total = state.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total"))
        total.write.mode("overwrite").parquet(_batch_path(sink, batch_id))

    q = (counts.writeStream.outputMode("complete").foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def running_dropped(spark: SparkSession, total_sink: str) -> DataFrame:
    """(batch_id, dropped, total): the running total after each batch and its step."""
    before = F.coalesce(F.lag("total").over(Window.orderBy("batch_id")), F.lit(0))
    return read_batches(spark, total_sink).select("batch_id", (F.col("total") - before).alias("dropped"), "total")


def copy_stream(spark: SparkSession, source: str, schema, sink: str, checkpoint: str,
                max_files: int | None = None) -> None:
    """IO13: file-stream source copied batch by batch into an idempotent sink."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_path(sink, batch_id))

    _drain(file_stream(spark, source, schema, max_files=max_files), per_batch, checkpoint)


def append_summary_stream(spark: SparkSession, source: str, schema, sink: str, checkpoint: str,
                          key: str, max_files: int | None = None) -> None:
    """IO14: one summary row per (batch, key) appended per batch (idempotent by batch id)."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        s = batch.groupBy(key).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
        s.write.mode("overwrite").parquet(_batch_path(sink, batch_id))

    _drain(file_stream(spark, source, schema, max_files=max_files), per_batch, checkpoint)
