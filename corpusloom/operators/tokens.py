"""Token totals, samples and reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import body_lines, human
from corpusloom.sources.io import require_column, resolve_text_column

BATCH = 100


def regex_tokens(text: Column) -> Column:
    """Tokens by a fixed pattern: runs of letters and digits, and single other marks."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"))


def library_tokens(path: str) -> Callable[[Column], Column]:
    """Tokens by a tokenizers file, opened once for each task; a file that doesn't load fails the job. Falsy texts have none."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        for batch in batches:
            texts, out = [t or "" for t in batch], []
            for i in range(0, len(texts), BATCH):
                out += [len(e.ids) for e in tokenizer.encode_batch_fast(texts[i : i + BATCH], add_special_tokens=False)]
            yield pd.Series(out, dtype="int64")

    return lambda text: count(text)


def target(docs: DataFrame, text_key: str = "text", line_id_key: str | None = None) -> DataFrame:
    """One column ``text``: the resolved text column, or its body lines."""
    name = resolve_text_column(docs.columns, text_key)
    if line_id_key is None:
        return docs.select(F.col(name).cast("string").alias("text"))
    require_column(docs, line_id_key)
    return docs.select(body_lines(F.coalesce(F.col(name).cast("string"), F.lit("")), F.col(line_id_key).cast("string")).alias("text"))


def totals(texts: DataFrame, count: Callable[[Column], Column] = regex_tokens) -> DataFrame:
    """total_docs (empty bodies too) and total_tokens, summed in partitions before the shuffle."""
    n = F.when(F.length("text") > 0, count(F.col("text"))).otherwise(0).cast("long")
    return texts.agg(F.count("*").alias("total_docs"), F.coalesce(F.sum(n), F.lit(0)).alias("total_tokens"))


def sample(docs: DataFrame, n: int = 3, order: str | None = None) -> DataFrame:
    return (docs.orderBy(order) if order else docs).limit(n)


def report(docs: DataFrame, meta: dict, tools: tuple[str, ...] = ("sample", "count_tokens"), count: Callable[[Column], Column] = regex_tokens, sample_n: int = 3, text_key: str = "text", line_id_key: str | None = None) -> dict:
    texts = target(docs, text_key, line_id_key)
    found = totals(texts, count).first() if "count_tokens" in tools else texts.agg(F.count("*").alias("total_docs")).first()
    details: dict = {}
    if "count_tokens" in tools:
        details |= {"total_tokens": found["total_tokens"], "total_tokens_human": human(found["total_tokens"])}
    if "sample" in tools:
        details["samples"] = [{"text": r["text"]} for r in sample(texts, sample_n).collect()]
    return {"meta": meta, "total_docs": found["total_docs"], "details": details}
