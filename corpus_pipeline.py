"""Five stages that turn raw documents into token sequences; each is written as Parquet and read again for the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import decontamination, line_dedup, ngram_join, piece_sampling, quality_model
from corpusloom.llm.texts import table
from corpusloom.scratch import Scratch


def _fresh(spark: SparkSession, name: str) -> Scratch:
    """Scratch of a stage that begins with the memory of the one before given back."""
    scratch = Scratch(spark, name)
    scratch.release()
    return scratch


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    _fresh(spark, "quality")
    return quality_model.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs; those of which nothing is left go."""
    return line_dedup.drop_lines(docs, _fresh(spark, "lines"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates."""
    return ngram_join.keep_one(docs, _fresh(spark, "near"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), _fresh(spark, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with sampled piece ids, and their text as decoded from these."""
    _fresh(spark, "pieces")
    return piece_sampling.tokenise(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding and decoding", tokenise),
]
#: A trained classifier and sampled segmentations can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage-{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
