"""One query per training-data operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer() -> tuple[str, str]:
    """The vocabulary file and its splitting pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm import scored

    return scored(table(spark, sf_dir, "documents"), *tokenizer())


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import judged

    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import packed, tokenised

    pieces = tokenised(table(spark, sf_dir, "documents"), *tokenizer())
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packed(pieces)


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import matched

    return matched(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import linked

    return linked(table(spark, sf_dir, "documents")).drop("row", "component_row")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_extract import extracted

    return extracted(table(spark, sf_dir, "pages"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring import digest

    return digest(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import without_boilerplate

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_boilerplate(docs)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import digest, found_in

    return digest(found_in(table(spark, sf_dir, "documents")))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import digest, scanned

    return digest(scanned(table(spark, sf_dir, "documents")))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_lm_scoring, op2_quality_rules, op3_best_fit_packing, op4_benchmark_decontamination, op5_ngram_jaccard_join, op6_html_extraction, op7_substring_dedup, op8_line_dedup, op9_pii, op10_secret_scans)}


def oracle_sql() -> dict[str, str]:
    from .oracles import SQL

    return dict(SQL)
