"""Scans, sinks and partition planning."""

from __future__ import annotations

import json
import math
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_A_PARTITION = 500_000
SPREAD = 32 * 2**20


def scan(spark: SparkSession, path: str | list[str], file_type: str = "parquet", schema: T.StructType | str | None = None, recursive: bool = False, ignore_corrupt: bool = False) -> DataFrame:
    """Parquet or JSON lines (gzip too), with globs. A schema spares JSON its inference pass."""
    if file_type not in {"parquet", "json"}:
        raise ValueError(f"file type {file_type!r} is neither parquet nor json")
    reader = spark.read.format(file_type).option("recursiveFileLookup", recursive).option("ignoreCorruptFiles", ignore_corrupt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under a path or glob, on the path's own file system; 0 if nothing matches."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return sum(fs.getContentSummary(s.getPath()).getLength() for s in fs.globStatus(hadoop) or [])


def partitions_for(num_partitions: int = 0, partition_size_mb: int = 0, n_bytes: int = 0, rows: int = 0) -> int | None:
    """An explicit number; else by input bytes; else, if negative, by rows; else None (leave as it is). At least 1."""
    if num_partitions > 0:
        return num_partitions
    if partition_size_mb > 0:
        return max(1, math.ceil(n_bytes / (partition_size_mb * 2**20))) if n_bytes > 0 else None
    return max(1, math.ceil(rows / ROWS_A_PARTITION)) if num_partitions < 0 else None


def plan_partitions(df: DataFrame, num_partitions: int = 0, partition_size_mb: int = 0, n_bytes: int = 0) -> DataFrame:
    rows = df.count() if num_partitions < 0 and partition_size_mb <= 0 else 0
    n = partitions_for(num_partitions, partition_size_mb, n_bytes, rows)
    return df if n is None else df.repartition(n)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt to all cores if it's small: a small file can be one split, which leaves all but one idle. At most SPREAD bytes a core are shuffled."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size <= cores * SPREAD else df


def sink(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_report(spark: SparkSession, report: dict, path: str) -> None:
    """Pretty JSON to a local path, one line of JSON to any other store."""
    if "://" in path:
        spark.createDataFrame([(json.dumps(report, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(report, f, ensure_ascii=False, indent=2)


def resolve_text_column(columns: list[str], wanted: str = "text") -> str:
    """The wanted column; else the first whose name holds text or content; else the first."""
    if wanted in columns:
        return wanted
    return next((c for c in columns if "text" in c.lower() or "content" in c.lower()), columns[0])


def require_column(df: DataFrame, name: str) -> DataFrame:
    if name not in df.columns:
        raise ValueError(f"column {name!r} isn't among {df.columns}")
    return df


def non_empty(text: str = "text"):
    return F.col(text).isNotNull() & (F.col(text) != "")
