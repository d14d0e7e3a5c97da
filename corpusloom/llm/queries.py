"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import decontamination, disclosure, language_id, line_dedup, ngram_join, piece_sampling, quality_model, quality_rules, revisits, token_files
from corpusloom.llm.texts import table
from corpusloom.scratch import Scratch


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"), Scratch(spark, "op1"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.read_token_files(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), Scratch(spark, "op2"))


def op3_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisits.query(table(spark, sf_dir, "pages"), Scratch(spark, "op4"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark, "op5"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"), Scratch(spark, "op6")).select("doc_id", "text", "gone_lines")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_languages(table(spark, sf_dir, "documents"), Scratch(spark, "op7"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark, "op8"))


def op9_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampled segmentations themselves stay out of the digest: doc_id, n_pieces, ids_crc32, lossless."""
    return piece_sampling.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")).drop("decoded")


def op10_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.digest(table(spark, sf_dir, "documents"), Scratch(spark, "op10"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_token_files, op2_quality_rules, op3_quality_model, op4_revisits, op5_decontamination, op6_line_dedup, op7_language_id, op8_ngram_join, op9_piece_sampling, op10_disclosure)}


def oracle_sql() -> dict[str, str]:
    return {"op2_quality_rules": quality_rules.oracle(), "op4_revisits": revisits.oracle(), "op5_decontamination": decontamination.oracle(), "op6_line_dedup": line_dedup.oracle(), "op8_ngram_join": ngram_join.oracle()}
