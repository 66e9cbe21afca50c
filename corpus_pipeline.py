"""Corpus preparation: five stages from raw documents to packed sequences.

Each stage gets the documents that its predecessor kept, and all but the last
return the columns of documents.  Rejected by ``quality``; all but one of each
group of near duplicates by ``near_duplicates``; contaminated ones by
``decontamination``; ``secrets`` replaces every secret in the text by a mark
and brings ``n_chars`` in line; ``packing`` returns the pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastebud.llm import decontam, nearjoin, packing, quality, secrets
from tastebud.llm.queries import tokenizer_path
from tastebud.llm.tables import stored, unused


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule; no length is too much."""
    return quality.kept_rows(docs)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return nearjoin.keep_one(docs, nearjoin.near_duplicates(docs))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    key = unused("text_key", docs)
    keyed = docs.withColumn(key, F.md5(F.coalesce("text", F.lit(""))))
    found = decontam.contamination(keyed, items, [key])
    bad = found.where("contaminated").select(key).distinct()
    return keyed.join(bad, key, "left_anti").select(*docs.columns)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    found = unused("found_secrets", docs)
    clean = secrets.redact(secrets.scan(docs, out=found), found=found)
    masked = F.size(found) > 0
    return clean.withColumn("n_chars", F.when(masked, F.length("text").cast(docs.schema["n_chars"].dataType))
                            .otherwise(F.col("n_chars"))).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents and their places in sequences."""
    return packing.pack(docs, ["doc_id"], tokenizer_path())


STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]
#: Tokenising and near-duplicate search have no SQL form; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs
