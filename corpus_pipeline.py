"""Corpus pipeline: language, boilerplate lines, near-duplicates, contamination, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. `run` writes every stage's
result to the shared folder and rereads it, so that a lost executor costs a re-read; what a stage wrote on its way goes with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from devsignals.llm import decontamination, language_id, queries, sentence_pieces, simhash, site_lines
from devsignals.llm.common import table
from devsignals.session import fresh_path, intermediates_dropped


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return site_lines.without_boilerplate(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentence_pieces.with_tokens(docs, queries.piece_model())


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_documents),
    ("benchmark_decontamination", decontaminate),
    ("sentencepiece", tokenise),
]

# near-duplicates and token ids have no SQL form; tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        with intermediates_dropped(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
