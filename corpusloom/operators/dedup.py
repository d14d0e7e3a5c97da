"""Exact and near deduplication."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import minhash, text
from corpusloom.operators.graph import connected_components
from corpusloom.scratch import Scratch
from corpusloom.sources.io import spread


@dataclass(frozen=True)
class DedupConfig:
    threshold: float = 0.85
    num_perm: int = 128
    ngram: int = 5
    min_length: int = 2
    b: int | None = 8
    r: int | None = 16
    split_ideographs: bool = False
    unicode_form: bool = True
    isolate_short: bool = False

    def banding(self) -> tuple[int, int]:
        """Given bands and rows, or those that suit the threshold."""
        return (self.b, self.r) if self.b and self.r else minhash.band_parameters(self.threshold, self.num_perm)


def exact_dedup(docs: DataFrame, key: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of every distinct text: that of the least key, nulls last, then of the least hash of its other columns. Null texts count as one.

    Only a 256-bit digest, the key and a hash are shuffled to find survivors, never the text; of texts that occur more than once
    the survivors are dealt once more, as rows that are equal in all columns can't be told apart.
    """
    others = [c for c in docs.columns if c != text_column]
    digest = F.coalesce(F.sha2(F.col(text_column).cast("binary"), 256), F.lit(""))
    tie = F.xxhash64(F.to_json(F.struct(*(F.col(f"`{c}`") for c in others))))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), digest.alias("digest"), F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), tie.alias("tie")).alias("place"))
    least = rows.groupBy("digest").agg(F.min("place").alias("least"), F.count("*").alias("copies")).withColumnRenamed("digest", "of")
    kept = rows.join(least, F.col("digest") == F.col("of")).where(F.col("place").eqNullSafe(F.col("least"))).select("row", "digest", "copies")
    out = kept.where("copies = 1").unionByName(kept.where("copies > 1").dropDuplicates(["digest"]))
    return out.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def hashed_shingles(docs: DataFrame, config: DedupConfig, key: str = "doc_id") -> DataFrame:
    """uid, hashes of the distinct shingles."""
    tokens = text.tokens(text.normalize(F.col("text"), config.split_ideographs, config.unicode_form))
    return docs.select(F.col(key).alias("uid"), F.transform(text.shingles(tokens, config.ngram, config.min_length), text.hash32).alias("hashes"))


def signatures(docs: DataFrame, config: DedupConfig, key: str = "doc_id") -> DataFrame:
    """uid, signature. Shingles and their hashes are made in the Arrow node that takes the minima: they never become rows or columns."""
    texts = spread(docs.select(F.col(key).cast("long").alias("uid"), F.lower("text").alias("lower")))
    return minhash.text_signatures(texts, config.num_perm, config.ngram, config.min_length, config.split_ideographs, config.unicode_form, config.isolate_short)


def band_rows(signed: DataFrame, config: DedupConfig) -> DataFrame:
    b, r = config.banding()
    return signed.select("uid", F.explode(minhash.bands("signature", b, r)).alias("x")).select("uid", "x.band", "x.key")


def candidate_edges(banded: DataFrame) -> DataFrame:
    """(src, dst): every member of a bucket but the least is tied to the least. Counts and minima only; no bucket is gathered.

    ``banded`` is read twice: give a written table, or its signatures are computed twice."""
    slim = banded.select("uid", F.xxhash64("band", "key").alias("bucket"), F.xxhash64(F.lit(1), "key", "band").alias("digest"))  # 128 bits
    least = slim.groupBy("bucket", "digest").agg(F.min("uid").alias("dst"), F.count("*").alias("n")).where("n > 1").select("bucket", "digest", "dst")
    return slim.join(least, ["bucket", "digest"]).where("uid <> dst").select(F.col("uid").alias("src"), "dst").distinct()


@dataclass
class DedupResult:
    """The four outputs: exactly deduplicated documents, components, removed and kept documents."""

    dedup: DataFrame
    components: DataFrame
    dup: DataFrame
    result: DataFrame

    def write(self, root: str) -> None:
        for name in ("dedup", "wcc", "dup", "result"):
            (self.components if name == "wcc" else getattr(self, name)).write.mode("overwrite").parquet(f"{root}/{name}")


def near_dedup(docs: DataFrame, config: DedupConfig, scratch: Scratch, key: str = "doc_id") -> DedupResult:
    """Exact deduplication, candidate edges, components, and the least member of each component kept.

    Branch points are written tables: survivors' ids and signatures, edges, and each round of the components.
    """
    docs = exact_dedup(docs, key)
    signed = scratch.save(signatures(docs, config, key), "signed")
    edges = scratch.save(candidate_edges(band_rows(signed, config)), "edges")
    components = scratch.save(connected_components(edges, scratch, "wcc"), "wcc")
    gone = components.where("vid > component").select(F.col("vid").alias(key))
    return DedupResult(docs, components, docs.join(gone, key, "left_semi").select(docs.columns), docs.join(gone, key, "left_anti").select(docs.columns))


def duplicate_rate(raw: DataFrame, dup: DataFrame) -> DataFrame:
    """num_doc, num_dup and their percentage; null on an empty corpus."""
    counts = raw.agg(F.count("*").alias("num_doc")).crossJoin(dup.agg(F.count("*").alias("num_dup")))  # one row each
    return counts.withColumn("rate", F.try_divide(F.col("num_dup") * 100.0, F.col("num_doc")))
