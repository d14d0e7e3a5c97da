"""Helpers that several operators share: words, document frames, Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: White space for str.split() that isn't a separator here.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
#: Rows of an Arrow batch: whole texts can be long, so few of them travel together.
BATCH_ROWS = 512


def words_of(text: str) -> list[str]:
    """Maximal runs of characters other than space and U+0009 to U+000D."""
    if _OTHER_SPACE.search(text):
        return _WORD.findall(text)
    return text.split()


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for Python workers that see whole texts."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string) of any documents frame, whatever other columns it has; a null text becomes empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def rows_of(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names), strict=True)


_KEPT: dict[Hashable, Any] = {}


def forget() -> None:
    """Give back the memory of what this worker process has kept for another operator."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)


def kept_by_worker(key: Hashable, make: Callable[[], Any]) -> Any:
    """A model or cache that a worker process keeps between the tasks of one operator; that of another operator goes."""
    if key not in _KEPT:
        forget()
        _KEPT[key] = make()
    return _KEPT[key]


def as_rows(docs: DataFrame, *columns: Column) -> DataFrame:
    """``docs`` as one column ``row``, whose fields can't clash with ``columns`` or those of other frames."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *columns)


def from_rows(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` from ``row``, but for those changed, then new ones."""
    kept = [changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns]
    return rows.select(*kept, *(v.alias(c) for c, v in changed.items() if c not in docs.columns))
