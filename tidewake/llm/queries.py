"""The registered queries of this package: each applies one operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.llm import (
    byte_dedup,
    decontaminate,
    importance,
    lattice,
    line_dedup,
    nearest,
    ngram_join,
    packing,
    passage_dedup,
    quality_rules,
    secrets,
    spelling,
    token_counts,
)
from tidewake.llm.frames import read
from tidewake.llm.oracles import ORACLES


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.repeated_lines(read(spark, folder, "documents")).drop("key")


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_contamination(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_documents(read(spark, folder, "documents")).drop("key", "leads")


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_lattice_score(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.score_documents(read(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_passage_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return passage_dedup.drop_repeated_passages(read(spark, folder, "documents")).drop("kept_text")


def op8_byte_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return byte_dedup.find_repeated_bytes(read(spark, folder, "documents"), keep_first=False).drop("removed")


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan_secrets(read(spark, folder, "documents"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.score_quality(read(spark, folder, "documents"))


def op11_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.nearest(read(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op12_resample(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(read(spark, folder, "documents"), read(spark, folder, "benchmark")).drop("key")


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_token_counts": op3_token_counts,
    "op4_ngram_join": op4_ngram_join,
    "op5_packing": op5_packing,
    "op6_lattice_score": op6_lattice_score,
    "op7_passage_dedup": op7_passage_dedup,
    "op8_byte_dedup": op8_byte_dedup,
    "op9_secrets": op9_secrets,
    "op10_quality_rules": op10_quality_rules,
    "op11_nearest": op11_nearest,
    "op12_resample": op12_resample,
    "op13_spelling": op13_spelling,
}

__all__ = ["ORACLES", "QUERIES"]
