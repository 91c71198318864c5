"""From raw documents to packed training sequences, in five stages.

Each stage takes all rows that the one before it kept; all but the last return
the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm.common import table, written
from shardloom.llm.decontam import without_leaks
from shardloom.llm.jaccard import one_of_each
from shardloom.llm.line_dedup import without_boilerplate
from shardloom.llm.packing import packed, tokenised
from shardloom.llm.quality import kept_rows
from shardloom.llm.queries import tokenizer

#: Words of a shingle and hundredths of similarity of the near-copy stage; op5 has values of its own.
SHINGLE, PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return kept_rows(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go, but for the first; n_chars follows the text."""
    held = without_boilerplate(docs)
    length = F.when(F.col("n_dropped") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return held.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by word shingles of five and 0.8, stays."""
    return one_of_each(docs, SHINGLE, PERCENT)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a test item go."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    pieces = tokenised(docs, *tokenizer())
    return packed(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Tokenisation, alignment and the cascade's learned rules are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
