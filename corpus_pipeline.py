"""The corpus pipeline: raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs.

Edge cases: documents without a letter, null and empty texts among them, go in
the first stage.  Documents without id pass all stages as documents; line
dedup takes them for one document, as it does rows that repeat an id.  Of
equal or near rows the one with the smallest id stays, also where ids repeat.
Long texts are worked on whole.  An empty table gives an empty table after
each stage and no pieces.  Other columns pass through up to the last stage;
lang, where there is one, holds the language that the first stage has found.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillhouse.llm import decontaminate, langid, linededup, packing, simhash
from tillhouse.llm.common import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, with that language."""
    return langid.keep_identified(spark, docs)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that recur across documents."""
    return linededup.remove_recurring(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_first(spark, docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.remove_contaminated(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, one row per piece."""
    return packing.pack(spark, docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_recurring_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", decontaminate_benchmark),
    ("packing", pack_sequences),
]

# Cross-parsing, XXH64 fingerprints and tokenizer ids are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(spark, step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
