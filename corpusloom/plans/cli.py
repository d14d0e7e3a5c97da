"""Jobs from the command line: python -m corpusloom.plans.cli JOB --help."""

from __future__ import annotations

import argparse
import time

from pyspark.sql import functions as F

from corpusloom.operators import dedup, filters, standardize, tokens
from corpusloom.scratch import Scratch
from corpusloom.session import build_session
from corpusloom.sources import io


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="corpusloom")
    jobs = top.add_subparsers(dest="job", required=True)
    for name in ("standardize", "filter", "dedup", "tokens"):
        p = jobs.add_parser(name)
        p.add_argument("--input", required=True)
        p.add_argument("--output", required=True)
        p.add_argument("--file-type", choices=["parquet", "json"], default="parquet")
        p.add_argument("--text-key", default="text")
        p.add_argument("--recursive", action=argparse.BooleanOptionalAction, default=False)
        if name == "standardize":
            p.add_argument("--adapter", choices=list(standardize.ADAPTERS), required=True)
            p.add_argument("--num-partitions", type=int, default=0)
            p.add_argument("--partition-size-mb", type=int, default=0)
        elif name == "filter":
            p.add_argument("--min-score", type=float, default=filters.SCORE)
            p.add_argument("--min-length", type=int, default=filters.LENGTH)
            p.add_argument("--min-lines", type=int, default=filters.LINES)
        elif name == "dedup":
            p.add_argument("--threshold", type=float, default=0.85)
            p.add_argument("--ngram", type=int, default=5)
            p.add_argument("--min-length", type=int, default=2)
            p.add_argument("--num-perm", type=int, default=128)
            p.add_argument("--b", type=int, default=8)
            p.add_argument("--r", type=int, default=16)
            p.add_argument("--split-ideographs", action=argparse.BooleanOptionalAction, default=False)
        else:
            p.add_argument("--line-id-key")
            p.add_argument("--tokenizer", help="a tokenizers file; without it a fixed pattern counts")
            p.add_argument("--tools", nargs="+", choices=["sample", "count_tokens"], default=["sample", "count_tokens"])
            p.add_argument("--sample-n", type=int, default=3)
    return top


def main(args: list[str] | None = None) -> None:
    a = parser().parse_args(args)
    spark, began = build_session(f"corpusloom-{a.job}"), time.time()
    raw = io.scan(spark, a.input, a.file_type, recursive=a.recursive, ignore_corrupt=a.job in {"standardize", "filter"})
    if a.job == "standardize":
        keyed = raw.withColumnRenamed(a.text_key, "text")
        order = F.xxhash64(*(F.col(c).cast("string") for c in keyed.columns if c != "metadata"))
        out = standardize.adapt(keyed, a.adapter, order)
        size = io.input_bytes(spark, a.input) if a.partition_size_mb > 0 else 0
        io.sink(io.plan_partitions(out, a.num_partitions, a.partition_size_mb, size), a.output)
    elif a.job == "filter":
        io.sink(filters.clean(raw, min_score=a.min_score, min_length=a.min_length, min_lines=a.min_lines, text_column=a.text_key), a.output)
    elif a.job == "dedup":
        scratch = Scratch(spark, "dedup")
        keyed = raw if "doc_id" in raw.columns else scratch.save(raw.withColumn("doc_id", F.monotonically_increasing_id()), "ids")
        config = dedup.DedupConfig(a.threshold, a.num_perm, a.ngram, a.min_length, a.b, a.r, a.split_ideographs)
        found = dedup.near_dedup(keyed.withColumnRenamed(a.text_key, "text"), config, scratch)
        found.write(a.output)
        print(dedup.duplicate_rate(keyed, found.dup).first().asDict())
    else:
        count = tokens.library_tokens(a.tokenizer) if a.tokenizer else tokens.regex_tokens
        io.write_report(spark, tokens.report(raw, vars(a), tuple(a.tools), count, a.sample_n, a.text_key, a.line_id_key), a.output)
    print(f"{a.job}: {time.time() - began:.1f} s")


if __name__ == "__main__":
    main()
