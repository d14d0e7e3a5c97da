"""Score, length and line rules."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.sources.io import non_empty

SCORE, LENGTH, LINES = 0.4, 200, 1
#: Weights of the default scorer: a bias, share of letters, share of white space, and length in thousands of code points up to 5.
WEIGHTS = (0.1, 0.9, -0.2, 0.05)


def linear_score(t: Column) -> Column:
    """A fixed-weight score between 0 and 1 in built-in functions, for lack of a model file."""
    n = F.length(t)
    letters = F.length(F.regexp_replace(t, "[^A-Za-z]", "")) / n
    spaces = (n - F.length(F.translate(t, " \n\t", ""))) / n
    bias, a, b, c = WEIGHTS
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), bias + a * letters + b * spaces + c * F.least(n / 1000, F.lit(5.0))))


def model_score(load: Callable[[], Callable[[list[str]], list[float | None]]]) -> Callable[[Column], Column]:
    """A score column from a model that ``load`` opens once for each task; a text it fails on gets null, and goes."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = load()
        for batch in batches:
            try:
                yield pd.Series(predict([t.replace("\n", " ") for t in batch]), dtype="float64")
            except Exception:
                yield pd.Series([_one(predict, t) for t in batch], dtype="float64")

    return lambda t: score(t)


def _one(predict: Callable[[list[str]], list[float | None]], t: str) -> float | None:
    try:
        return predict([t.replace("\n", " ")])[0]
    except Exception:
        return None


def length_rule(t: Column, least: int = LENGTH) -> Column:
    return text.stripped_length(t) >= least


def line_rule(t: Column, least: int = LINES) -> Column:
    return text.line_count(t) >= least


def clean(docs: DataFrame, score: Callable[[Column], Column] = linear_score, min_score: float = SCORE, min_length: int = LENGTH, min_lines: int = LINES, text_column: str = "text") -> DataFrame:
    """Rows that pass all rules, cheap rules first; columns pass through."""
    t = F.col(text_column)
    rows = docs.where(non_empty(text_column)).where(length_rule(t, min_length))
    if min_lines > 1:
        rows = rows.where(line_rule(t, min_lines))
    return rows.where(score(t) >= min_score)


def keep_ratio(docs: DataFrame, kept: Column, text_column: str = "text") -> DataFrame:
    """num_doc (non-empty), num_kept, ratio in one pass; null on an empty corpus."""
    counts = docs.where(non_empty(text_column)).agg(F.count("*").alias("num_doc"), F.count_if(kept).alias("num_kept"))
    return counts.withColumn("ratio", F.try_divide(F.col("num_kept").cast("double"), F.col("num_doc").cast("double")))
