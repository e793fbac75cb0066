"""Corpus preparation as stages, each over everything that the stage before it kept."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.llm import decontaminate, line_dedup, ngram_join, packing, quality_rules
from tidewake.llm.frames import read
from tidewake.session import staging_root


def _like_documents(df: DataFrame) -> DataFrame:
    """The columns of documents; n_chars follows the text."""
    return df.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.lit(0).cast("long")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.drop_low_quality(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _like_documents(line_dedup.drop_repeated_lines(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.drop_similar(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _like_documents(decontaminate.remove_contamination(docs, read(spark, sf_dir, "benchmark")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("packing", pack),
]

# Edit distances by segments, chosen paths and tokenizer ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again as the next one's input."""
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        path = f"{staging_root(spark)}/pipeline-{name.replace(' ', '-')}-{uuid.uuid4().hex}"
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
