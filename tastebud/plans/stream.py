"""Streaming queries: the documents / events tables read as file streams.

Each query streams the given table from its own path, runs to completion
(``availableNow``) and returns the sink read back.  The results do not depend
on the batch boundaries, so they compare with whole-table SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import catalog as C
from ..streaming import tokens as T
from .registry import register

_WC_SQL = """
SELECT token, CAST(COUNT(*) AS BIGINT) AS n FROM (
  SELECT unnest(string_split(text, ' ')) AS token FROM documents) GROUP BY token"""
_BLOCK = ", ".join(f"'{t}'" for t in T.BLOCKLIST)
_DROPPED_SQL = f"""
SELECT CAST(COUNT(*) AS BIGINT) AS dropped FROM (
  SELECT unnest(string_split(text, ' ')) AS token FROM documents)
WHERE token IN ({_BLOCK})"""


def _source(spark, sf, name, *cols):
    # a pattern, for a table may be one file or a folder of files
    return f"{sf.rstrip('/')}/{name}.{{parquet}}", C.table(spark, sf, name).select(*cols).schema


@register("stream_token_count", _WC_SQL)
def stream_token_count(spark: SparkSession, sf: str) -> DataFrame:
    """Per-micro-batch token counts (stateless), summed over the batches."""
    src, schema = _source(spark, sf, "documents", "text")
    sink = scratch_path(spark, "wc-sink")
    T.token_count_stream(spark, src, schema, sink, scratch_path(spark, "wc-ckpt"))
    return T.total_counts(spark, sink)


@register("stream_blocklist_filter", f"""
SELECT token, CAST(COUNT(*) AS BIGINT) AS n FROM (
  SELECT unnest(string_split(text, ' ')) AS token FROM documents)
WHERE token NOT IN ({_BLOCK}) GROUP BY token""")
def stream_blocklist_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Per-batch token counts with the blocklisted words removed."""
    src, schema = _source(spark, sf, "documents", "text")
    sink = scratch_path(spark, "wcb-sink")
    T.token_count_stream(spark, src, schema, sink, scratch_path(spark, "wcb-ckpt"),
                         blocklist=T.BLOCKLIST)
    return T.total_counts(spark, sink)


def _dropped(spark, sf):
    src, schema = _source(spark, sf, "documents", "text")
    sink, dsink = scratch_path(spark, "wcd-sink"), scratch_path(spark, "wcd-dropped")
    T.token_count_stream(spark, src, schema, sink, scratch_path(spark, "wcd-ckpt"),
                         blocklist=T.BLOCKLIST, dropped_sink=dsink)
    return T.read_batches(spark, dsink)


@register("stream_dropped_counter", _DROPPED_SQL)
def stream_dropped_counter(spark: SparkSession, sf: str) -> DataFrame:
    """Number of dropped (blocklisted) tokens, the sum of the exact counts per batch."""
    return _dropped(spark, sf).agg(F.coalesce(F.sum("dropped"), F.lit(0)).cast("bigint").alias("dropped"))


@register("running_dropped", f"""
SELECT dropped AS last_total, TRUE AS running FROM ({_DROPPED_SQL})""")
def running_dropped(spark: SparkSession, sf: str) -> DataFrame:
    """The running total after the last batch, by keyed state, and whether its steps are the counts of the batches."""
    src, schema = _source(spark, sf, "documents", "text")
    sink = scratch_path(spark, "wct-sink")
    T.dropped_total_stream(spark, src, schema, sink, scratch_path(spark, "wct-ckpt"))
    steps = T.running_dropped(spark, sink)
    counted = _dropped(spark, sf).select("batch_id", F.col("dropped").alias("_counted"))
    same = F.coalesce(F.col("dropped") == F.col("_counted"), F.col("dropped") == 0, F.lit(False))
    return steps.join(counted, "batch_id", "left").agg(F.max_by("total", "batch_id").alias("last_total"), F.every(same).alias("running"))


@register("stream_recover", _WC_SQL)
def stream_recover(spark: SparkSession, sf: str) -> DataFrame:
    """T4: the stream stops after half of the input, more files arrive, and the restarted
    query resumes from its checkpoint; the sink equals the one-shot result."""
    docs = C.table(spark, sf, "documents").select("doc_id", "text")
    src = scratch_path(spark, "rec-src")
    odd = F.coalesce(F.pmod("doc_id", F.lit(2)) == 1, F.lit(False))
    docs.where(~odd).write.mode("append").parquet(src)
    sink, ckpt = scratch_path(spark, "rec-sink"), scratch_path(spark, "rec-ckpt")
    T.token_count_stream(spark, src, docs.schema, sink, ckpt)
    docs.where(odd).write.mode("append").parquet(src)
    T.token_count_stream(spark, src, docs.schema, sink, ckpt)
    return T.total_counts(spark, sink)


@register("stream_source", """
SELECT event_id, user_id, event_type, value FROM events""")
def stream_source(spark: SparkSession, sf: str) -> DataFrame:
    """IO13: the events table consumed as a file stream, batch by batch."""
    src, schema = _source(spark, sf, "events", "event_id", "user_id", "event_type", "value")
    sink = scratch_path(spark, "ev-sink")
    T.copy_stream(spark, src, schema, sink, scratch_path(spark, "ev-ckpt"))
    return T.read_batches(spark, sink).drop("batch_id")


@register("stream_append_sink", """
SELECT event_type, CAST(COUNT(*) AS BIGINT) AS n FROM events GROUP BY event_type""")
def stream_append_sink(spark: SparkSession, sf: str) -> DataFrame:
    """IO14: one summary line per (batch, event type) appended per batch; summed back."""
    src, schema = _source(spark, sf, "events", "event_id", "event_type")
    sink = scratch_path(spark, "evs-sink")
    T.append_summary_stream(spark, src, schema, sink, scratch_path(spark, "evs-ckpt"), "event_type")
    return (T.read_batches(spark, sink).groupBy("event_type")
            .agg(F.sum("n").cast("bigint").alias("n")))
