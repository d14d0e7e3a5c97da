"""Raw datasets to the canonical document: declarative adapters, validation, routing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S = T.StringType()
META = T.StructType([T.StructField("source", _S, False), T.StructField("doc_id", _S, False), T.StructField("chunk_id", _S, False), T.StructField("others", T.MapType(_S, _S), False)])
DOCUMENT = T.StructType([T.StructField("text", _S, False), T.StructField("meta", META, False)])


@dataclass(frozen=True)
class Adapter:
    source: str
    others: tuple[str, ...]


#: Sources and the raw columns that go to ``others`` (fixed values).
ADAPTERS = {
    "fineweb": Adapter("fineweb", ("dump", "url", "date", "file_path", "language", "language_score", "token_count")),
    "fineweb_edu": Adapter("fineweb_edu_sample_100bt", ("id", "file_path", "language", "language_score", "token_count", "score", "int_score")),
    "dclm": Adapter("dclm-baseline-1.0", ("previous_word_count", "url", "warcinfo")),
    "dolma3_mix_cc": Adapter("dolma3_mix-6T-1025-cc", ("metadata",)),
    "dolma3_mix_code": Adapter("dolma3_mix-6T-1025-stack-edu", ("metadata",)),
    "dolma3_mix_ocr": Adapter("dolma3_mix-6T-1025-olmocr", ("metadata",)),
    "dolma3_mix_math": Adapter("dolma3_mix-6T-1025-math", ("metadata",)),
    "dolma3_mix_wiki": Adapter("dolma3_mix-6T-1025-wiki", ("metadata",)),
}
#: Prefixes of task names and their adapters (fixed values).
ROUTES = {"common_crawl": "dolma3_mix_cc", "dolma1_7": "dolma3_mix_wiki", "finemath": "dolma3_mix_math", "olmocr_science_pdfs": "dolma3_mix_ocr", "stack_edu": "dolma3_mix_code"}


def doc_id(source: str, order: Column, text: Column) -> Column:
    """SHA-256 of source, order, and the text's first and last ten characters."""
    t = F.coalesce(text, F.lit(""))
    tail = F.when(F.length(t) > 10, F.right(t, F.lit(10))).otherwise(t)
    return F.coalesce(F.sha2(F.concat(F.lit(source), F.coalesce(order.cast("string"), F.lit("")), F.substring(t, 1, 10), tail).cast("binary"), 256), F.lit(""))


def _written(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    value = F.to_json(F.col(name)) if isinstance(kind, T.StructType | T.MapType | T.ArrayType) else F.col(name).cast("string")
    return F.coalesce(value, F.lit("None"))


def adapt(raw: DataFrame, name: str, order: Column, on_error: str = "fail") -> DataFrame:
    """Canonical documents. Invalid ones fail the job, or with ``on_error="quarantine"`` are marked in a column ``invalid``."""
    adapter = ADAPTERS[name]
    if missing := [c for c in ("text", *adapter.others) if c not in raw.columns]:
        raise ValueError(f"{name} needs the columns {missing}")
    others = F.map_from_arrays(F.array(*map(F.lit, adapter.others)), F.array(*(_written(raw, c) for c in adapter.others)))
    meta = F.struct(F.lit(adapter.source).alias("source"), doc_id(adapter.source, order, F.col("text")).alias("doc_id"), F.lit("0").alias("chunk_id"), others.alias("others"))
    bad = F.col("text").isNull() | (F.col("text") == "")
    if on_error == "quarantine":
        return raw.select("text", meta.alias("meta"), bad.alias("invalid"))
    checked = F.coalesce(F.when(bad, F.raise_error(F.lit("empty text")).cast("string")).otherwise(F.col("text")), F.lit(""))
    return raw.select(checked.alias("text"), meta.alias("meta"))


def invalid(documents: DataFrame) -> Column:
    """Which part of a canonical document is missing; null if none is."""
    parts = {"text": F.col("text"), "source": F.col("meta.source"), "doc_id": F.col("meta.doc_id"), "chunk_id": F.col("meta.chunk_id")}
    found = F.when(F.col("meta").isNull(), "meta")
    for name, value in parts.items():
        found = found.when(value.isNull() | (value == ""), name)
    return found


def route(task: Column) -> Column:
    """The adapter of a task by its name's beginning; null if there's none."""
    found = F.lit(None).cast("string")
    for prefix, name in ROUTES.items():
        found = F.when(F.startswith(task, F.lit(prefix)), name).otherwise(found)
    return found


def adapter_for(task: str) -> str:
    for prefix, name in ROUTES.items():
        if task.startswith(prefix):
            return name
    raise ValueError(f"no adapter for {task!r}")


def batch_commands(tasks: list[str], template: str) -> list[str]:
    """A job's command for every task; ``template`` has {task} and {adapter}."""
    return [template.format(task=t, adapter=adapter_for(t)) for t in tasks]


def crawl_snapshot(names: list[str], index: int | None = None, name: str | None = None) -> str:
    """A crawl's snapshot by name, else by index."""
    chosen = name or (names[index] if index is not None and 0 <= index < len(names) else "")
    if not chosen:
        raise ValueError("no snapshot is selected")
    return chosen
