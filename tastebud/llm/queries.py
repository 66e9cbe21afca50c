"""Registered queries of the subpackage and their DuckDB oracles.

Each ``opN_*`` applies its operator to the whole table it is meant for and
derives the columns of its contract from the operator's own results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, decontam, katz, langid, licenses, nearjoin, negatives, packing, pieces, quality, secrets, sharding, sql, warc

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics and verdict of every document."""
    q = quality.quality_rules(_table(spark, sf_dir, "documents"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return q.select("doc_id", *[F.col(f"quality.{n}").alias(n) for n in names],
                    F.array_join("quality.failed", ",").alias("failed_rules"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _fold(folds: int, fold: int) -> Column:
    """Whether the CRC-32 of doc_id as text leaves ``fold``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string")) % folds == fold


def op1_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document; rows without an id are neither held out nor learned from."""
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.coalesce(_fold(7, 2), F.lit(False)).alias("held_out"), (~_fold(7, 2)).alias("learn"))
    return katz.score(docs, ["doc_id", "held_out"], F.col("learn"), order=3, passes=4)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in sequences of 2048 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), ["doc_id"], tokenizer_path())


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All secret spans of every document."""
    found = secrets.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [r.kind for r in secrets.BASE_RULES]
    of = lambda k: F.filter("secrets", lambda x: x["kind"] == k)
    counts = [F.size(of(k)).cast("long").alias(f"n_{name}") for k, name in enumerate(base)]
    own = F.filter("secrets", lambda x: x["kind"] < len(base))
    return found.select("doc_id", *counts, F.sha2(secrets.render(own), 256).alias("base_sha256"),
                        secrets.render(F.col("secrets")).alias("spans"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; rows without an id are neither held out nor learned from."""
    docs = _table(spark, sf_dir, "documents")
    model = langid.learn(docs.where(~_fold(3, 1)))
    held = docs.select("doc_id", F.coalesce(_fold(3, 1), F.lit(False)).alias("held_out"), "text")
    return langid.predict(held, model, ["doc_id", "held_out"])


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class, copies and links of every document."""
    return nearjoin.near_duplicates(_table(spark, sf_dir, "documents")).drop("text_hash", "class_node")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    found = decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
                        F.size("near_items").cast("long").alias("n_near_items"))


def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document."""
    found = licenses.scan(_table(spark, sf_dir, "documents"), ["doc_id"])
    at = F.transform("base", lambda x: x["i"].cast("long"))
    return found.select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(at).alias("first_word"),
                        F.array_max(at).alias("last_word"), F.array_join("base_labels", ",").alias("base_labels"),
                        F.array_join("labels", ",").alias("labels"), "score")


#: Bytes that one shard may hold in ``op8_extendible_sharding``.
SHARD_BYTES = 1 << 20


def op8_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document."""
    return sharding.shards(_table(spark, sf_dir, "documents"), "doc_id", SHARD_BYTES).select(
        "doc_id", "n_bytes", "depth", "shard", "shard_bytes")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back."""
    return warc.round_trip(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label, F.col("vec_id") % 100 == 0)


#: Documents of a language that a term needs, and terms named for each group, in ``op12_source_divergence``.
MIN_DOCS, TOP_TERMS = 10, 10


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of each language's sources from each other, and their own terms."""
    return audit.divergence(_table(spark, sf_dir, "documents"), min_docs=MIN_DOCS, top=TOP_TERMS)


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests; the spans of its pieces cover ``covered_bytes``."""
    found = pieces.encode(_table(spark, sf_dir, "documents"), ["doc_id"], tokenizer_path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"), "n_bytes", "covered_bytes")


QUERIES: dict[str, Query] = {
    "op1_katz_backoff": op1_katz_backoff,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_secret_scans": op3_secret_scans,
    "op4_language_id": op4_language_id,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_quality_rules": op6_quality_rules,
    "op7_license_scans": op7_license_scans,
    "op8_extendible_sharding": op8_extendible_sharding,
    "op9_decontamination": op9_decontamination,
    "op10_warc": op10_warc,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_source_divergence": op12_source_divergence,
    "op13_sentencepiece": op13_sentencepiece,
}

ORACLES: dict[str, str] = {
    "op6_quality_rules": sql.quality_rules(),
    "op8_extendible_sharding": sql.extendible_sharding(SHARD_BYTES),
    "op11_hard_negatives": sql.hard_negatives(),
    "op12_source_divergence": sql.source_divergence(MIN_DOCS, TOP_TERMS),
}
