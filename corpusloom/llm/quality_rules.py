"""Operator 2: quality rules with thresholds that adapt to each language and source.

Fixed cutoffs are replaced by fences around the quartiles of each (lang, source) group. Quartiles come from mergeable
sketches: every metric is an integer and falls into a log-linear cell that keeps its six leading bits (relative error
below 1/32), and a sketch is the count of each cell. Sketches merge by adding counts, so partial aggregation happens
before any shuffle, a hot group costs no more rows than its cells, and (lang) and global sketches are sums of the finer
ones. A group of fewer than ``min_group`` documents takes the fences of its language, and a small language the global ones.

Metrics (integer division): characters per 100 words, symbols, repeated lines and words in repeated windows per 10,000
words. A document is dropped if a metric lies above upper quartile + ``reach`` * spread + slack, or the first one below
lower quartile - ``reach`` * spread - slack. The spread is the distance of the quartiles.

Defined cases: a null or empty text has no words and fails the base rule; null lang or source form groups of their own;
repeated rows are judged alike, each counting in the sketches; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.texts import bounded_batches, forget, rows_of, words_of
from corpusloom.scratch import Scratch

SYMBOLS = "#*$%&|<>"
#: metric: (numerator column, scale, slack)
METRICS = {"length": ("word_chars", 100, 100), "symbols": ("n_symbols", 10_000, 1000), "lines": ("n_dup_lines", 10_000, 300), "repeats": ("n_repeat_words", 10_000, 2500)}
MIN_GROUP, REACH, MIN_WORDS = 200, 3, 50
#: Groups whose fences may be broadcast: each has nine numbers, so this is under 20 MB.
BROADCAST_GROUPS = 100_000
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measure(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    words = words_of(text)
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    repeats = 0
    if len(words) > 3:
        windows = list(zip(words, words[1:], words[2:], strict=False))
        if len(set(windows)) < len(windows):
            seen, reach = Counter(windows), 0
            for i, w in enumerate(windows):
                if seen[w] > 1:
                    repeats += i + 3 - max(i, reach)
                    reach = i + 3
    return len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeats


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every document."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            got = [measure(t) for (t,) in rows_of(batch, "text")]
            columns = {n: batch.column(batch.schema.get_field_index(n)) for n in ("doc_id", "lang", "source")}
            yield pa.RecordBatch.from_pydict(columns | {n: pa.array([g[i] for g in got], pa.int64()) for i, n in enumerate(COUNTS)})

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return slim.mapInArrow(run, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS))


def cell(value: Column) -> Column:
    """The lower bound of a value's cell: its six leading bits."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def metric(name: str) -> Column:
    count, scale, _ = METRICS[name]
    return F.call_function("div", F.lit(scale) * F.col(count), F.greatest(F.col("n_words"), F.lit(1))).cast("long")


def sketches(counted: DataFrame) -> DataFrame:
    """lang, source, metric, cell, n: the mergeable sketches of the documents that pass the base rule."""
    cells = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), cell(metric(m)).alias("cell")) for m in METRICS))).alias("x")
    return counted.where(~base_failed()).select("lang", "source", cells).groupBy("lang", "source", "x.metric", "x.cell").agg(F.count("*").alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Per group of ``keys``: members, and low_<metric>, high_<metric>."""
    merged = sketch.groupBy(*keys, "metric", "cell").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "metric")  # as many rows as a sketch has cells
    ranked = merged.withColumn("below", F.sum("n").over(group.orderBy("cell"))).withColumn("total", F.sum("n").over(group))
    quartiles = ranked.groupBy(*keys, "metric").agg(F.first("total").alias("members"), *(F.min(F.when(4 * F.col("below") >= q * F.col("total"), F.col("cell"))).alias(f"q{q}") for q in (1, 3)))
    spread = REACH * (F.col("q3") - F.col("q1"))
    out = [F.max("members").alias("members")]
    for m, (_, _, slack) in METRICS.items():
        out += [F.max(F.when(F.col("metric") == m, F.col("q3") + spread + slack)).alias(f"high_{m}"), F.max(F.when(F.col("metric") == m, F.col("q1") - spread - slack)).alias(f"low_{m}")]
    return quartiles.groupBy(*keys).agg(*out)


def judge(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every document."""
    counted = scratch.save(measures(docs), "counts")
    sketch = scratch.save(sketches(counted), "sketches")
    own, by_lang, all_ = (scratch.save(fences(sketch, k), n) for k, n in ((["lang", "source"], "own"), (["lang"], "by_lang"), ([], "all")))
    limits = ["members", *(f"{s}_{m}" for m in METRICS for s in ("high", "low"))]
    out = counted
    for i, (t, keys) in enumerate(((own, ["lang", "source"]), (by_lang, ["lang"]))):
        t = t.select(*(F.col(k).alias(f"k{i}_{k}") for k in keys), *(F.col(c).alias(f"l{i}_{c}") for c in limits))
        if t.count() <= BROADCAST_GROUPS:
            t = F.broadcast(t)  # beyond that the join shuffles, and adaptive execution splits hot groups
        on = F.lit(True)
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"k{i}_{k}"))
        out = out.join(t, on, "left")
    last = all_.first()
    limit = lambda c: F.when(F.col("l0_members") >= MIN_GROUP, F.col(f"l0_{c}")).when(F.col("l1_members") >= MIN_GROUP, F.col(f"l1_{c}")).otherwise(F.lit(last[c] if last else None).cast("long"))
    odd = metric("length") < limit("low_length")
    for m in METRICS:
        odd = odd | (metric(m) > limit(f"high_{m}"))
    failed = base_failed()
    return out.select("doc_id", *COUNTS, failed.alias("base_failed"), (~failed & ~F.coalesce(odd, F.lit(False))).alias("kept"))


def oracle() -> str:
    """The same in DuckDB's SQL."""
    cells = " union all ".join(f"select lang, source, '{m}' metric, ({s} * {c}) // n_words v from c where not base_failed" for m, (c, s, _) in METRICS.items())
    pick = lambda level: ", ".join(f"max(case when metric = '{m}' then q3 + {REACH} * (q3 - q1) + {k} end) high_{m}, max(case when metric = '{m}' then q1 - {REACH} * (q3 - q1) - {k} end) low_{m}" for m, (_, _, k) in METRICS.items())
    levels = {"own": "lang, source,", "by_lang": "lang,", "al": ""}
    parts = []
    for n, keys in levels.items():
        k = keys.rstrip(",")
        parts.append(f"{n}_r as (select {keys} metric, cell, sum(n) over (partition by {keys} metric order by cell) below, sum(n) over (partition by {keys} metric) total from (select {keys} metric, cell, sum(n) n from sk group by all)), {n} as (select {keys} max(total) members, {pick(n)} from (select {keys} metric, max(total) total, min(case when 4 * below >= total then cell end) q1, min(case when 4 * below >= 3 * total then cell end) q3 from {n}_r group by {keys} metric) {'group by ' + k if k else ''})")
    limit = lambda c: f"case when o.members >= {MIN_GROUP} then o.{c} when b.members >= {MIN_GROUP} then b.{c} else a.{c} end"
    value = lambda m: f"(({METRICS[m][1]} * {METRICS[m][0]}) // greatest(n_words, 1))"
    odd = f"{value('length')} < {limit('low_length')}" + "".join(f" or {value(m)} > {limit(f'high_{m}')}" for m in METRICS)
    return rf"""
with d as (select doc_id, lang, source, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
u as (select doc_id, unnest(range(1, len(w) + 1)) i, w from d),
x as (select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) n from u where i + 2 <= len(w)),
r as (select doc_id, count(distinct i + k) n from (select doc_id, i, unnest([0, 1, 2]) k from x where n > 1) group by 1),
l as (select doc_id, sum(n - 1) n from (select doc_id, s, count(*) n from (select doc_id, unnest(string_split(t, chr(10))) s from d) where regexp_matches(s, '[^\x20\x09-\x0D]') group by 1, 2) group by 1),
b0 as (select d.doc_id, lang, source, len(w)::bigint n_words, coalesce(list_sum(list_transform(w, lambda z: length(z))), 0)::bigint word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint n_symbols, coalesce(l.n, 0)::bigint n_dup_lines, coalesce(r.n, 0)::bigint n_repeat_words from d left join r using (doc_id) left join l using (doc_id)),
c as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words base_failed from b0),
v as ({cells}),
sk as (select lang, source, metric, (v >> greatest(length(bin(v)) - 6, 0)::bigint) << greatest(length(bin(v)) - 6, 0)::bigint cell, count(*) n from v group by all),
{', '.join(parts)}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (not base_failed and not coalesce({odd}, false)) kept
from c left join own o on c.lang is not distinct from o.lang and c.source is not distinct from o.source left join by_lang b on c.lang is not distinct from b.lang, al a"""
