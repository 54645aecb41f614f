"""Corpus cleaning pipeline: the stages in order, each over all that the one before kept.

1. quality: base rules and outliers by language and source; rejected documents go.
2. language: documents whose language can't be told go.
3. near_duplicates: one document of each SimHash component stays.
4. benchmark: documents that hold a test item go.
5. encoding: the token ids of the rest, with the outcome of decoding them.

All but the last return the columns of ``documents``.  Every stage handles
null, empty and very long texts, repeated rows, extra columns and empty tables
as its operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import read_table, via_table
from tessera.llm.decontaminate import drop_contaminated
from tessera.llm.langid import keep_identified
from tessera.llm.piece_codec import encode
from tessera.llm.quality import keep_good
from tessera.llm.simhash import drop_near_duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, token_ids, n_tokens, round_trip)"""
    slim = docs.select("doc_id", "lang", "source", "text")
    return encode(slim, check="round_trip").select(
        "doc_id", "lang", "source", "token_ids",
        F.coalesce(F.size("token_ids"), F.lit(0)).cast("long").alias("n_tokens"), "round_trip")


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates),
          ("benchmark", benchmark), ("encoding", encoding)]

#: The stages estimate, learn and search; tests/llm compares each with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; what each returns is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = via_table(stage(spark, docs, sf_dir), name)
    return docs
