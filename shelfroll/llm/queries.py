"""Registered queries of the operators: name -> (query, DuckDB SQL or None where SQL can't express it)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, filter_audit, lang_id, license_scan, near_dups, ppm, quality, secret_scan, token_alignment, token_files, toxicity, warc
from .common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by error-correcting output codes."""
    return lang_id.op1(documents(spark, sf_dir))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document, by numpy merge rounds."""
    return bpe.op2(documents(spark, sf_dir))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base patterns and literals bound to sensitive names."""
    return secret_scan.op3(documents(spark, sf_dir))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as token files with Elias-Fano boundaries, read back."""
    return token_files.op4(documents(spark, sf_dir))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisit records of the pages' captures, resolved to the latest earlier response."""
    return warc.op5(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdict of every document: base rules and perplexity bands by language."""
    return quality.op6(documents(spark, sf_dir))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and labels of every document by a positional index of rare words."""
    return license_scan.op7(documents(spark, sf_dir))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark hits of every document, by suffix arrays."""
    return decontaminate.op8(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op9_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document: MinHash bands, exact confirmation, star contraction."""
    return near_dups.op9(documents(spark, sf_dir))


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code length of every document under a PPM model of the training documents."""
    return ppm.op10(documents(spark, sf_dir))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters keep and remove in each order, per source, by decision diagrams."""
    return filter_audit.op11(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers aligned by lockstep merging, with corpus-wide counts of linked ids."""
    return token_alignment.op12(documents(spark, sf_dir))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a subsequence-kernel machine with Nyström landmarks."""
    return toxicity.op13(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


REGISTRY: dict[str, tuple[Query, str | None]] = {
    "op1_lang_id": (op1_lang_id, None),
    "op2_bpe": (op2_bpe, None),
    "op3_secrets": (op3_secrets, None),
    "op4_token_files": (op4_token_files, None),
    "op5_warc": (op5_warc, warc.OP5_SQL),
    "op6_quality": (op6_quality, None),
    "op7_licenses": (op7_licenses, license_scan.OP7_SQL),
    "op8_decontaminate": (op8_decontaminate, decontaminate.OP8_SQL),
    "op9_near_dups": (op9_near_dups, None),
    "op10_lm_scores": (op10_lm_scores, None),
    "op11_filter_audit": (op11_filter_audit, filter_audit.OP11_SQL),
    "op12_token_alignment": (op12_token_alignment, None),
    "op13_toxicity": (op13_toxicity, None),
}
