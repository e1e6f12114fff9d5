"""Corpus pipeline: quality rules, near-duplicate removal, decontamination, secret redaction, token ids.

Every stage works on all rows its predecessor kept. Between stages the rows are written as Parquet to the shared folder
and read again, so a lost executor never costs more than the stage at work. No stage can be written in SQL as a whole
(perplexity model, suffix arrays, byte-pair merges), so ``ORACLE_SQL`` is None; tests hold ``run`` against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfroll.llm import bpe, decontaminate, near_dups, quality, secret_scan
from shelfroll.llm.common import stored, temporary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose perplexity lies inside their language's band."""
    return quality.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five-word shingles, similarity 0.8 or more."""
    return near_dups.deduplicated(docs, width=5, percent=80)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of a benchmark item."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mask; ``n_chars`` follows the new text (0 for a null text)."""
    out = secret_scan.redacted(docs)
    if "n_chars" not in docs.columns:
        return out
    kind = docs.schema["n_chars"].dataType
    # a null text has no characters
    return out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document; ``decoded_sha256`` is the digest of the text decoded from them."""
    out = bpe.encoded(docs.select("doc_id", "lang", "source", "text"), keep=["doc_id", "lang", "source"])
    return out.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("secrets", secrets),
    ("token_ids", token_ids),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; rows of the last stage. Stored rows go when the stages are through;
    those of the last but one stay for the result, which is read lazily."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with temporary(spark) as lasting:
        for name, stage in STAGES[:-2]:
            docs = stored(stage(spark, docs, sf_dir), name)
        name, stage = STAGES[-2]
        docs = lasting(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
