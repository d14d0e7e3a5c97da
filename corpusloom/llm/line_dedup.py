"""Operator 6: line deduplication by a suffix array over line ids, built by distributed prefix doubling.

The corpus is the sequence of its lines' ids, document by document; lines without a word take no part. A run of consecutive
lines of at least ``MIN_CHARS`` characters that occurred before, in an earlier document or earlier in the same one, is deleted;
its first copy, in order of (doc_id, text's hash, line), stays.

* Lines that occur once can be in no repeated run and leave at once. The rest get ranks in the order of their ids: global
  prefix sums over ranges of the distinct ids.
* Prefix doubling: a suffix's rank by its first 2 ** (k + 1) lines comes from its rank by 2 ** k lines and that of the suffix 2 ** k lines on. A new
  rank is the place in the suffix array of repeated runs where its class begins: the sizes of the classes before it, in the order of the
  old rank and the next, by prefix sums over ranges. Classes of one suffix are dropped in every round, so the rounds shrink.
* A longest-common-prefix interval is a stretch of the suffix array whose suffixes share their first m lines. For every suffix the
  shortest prefix of MIN_CHARS characters has some m; two overlapping ranks of 2 ** floor(log2 m) lines name the interval. The
  same goes for the shortest runs ending at each line. All members of an interval but the earliest are later copies, and the union
  of their runs is that of all later copies of maximal repeated runs: a line of such a run lies in the shortest run from its
  beginning or in the shortest run ending at that line. Rounds end where no interval needs longer prefixes.

All of it is DataFrame functions; no group of lines is ever gathered: classes are counts and minima, combined before the shuffle.

Defined cases: null text counts as empty and stays null; rows of equal doc_id and text are one document and get the same
result; null doc_ids come first; blank lines between deleted ones stay; other columns are kept; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.texts import as_rows, from_rows
from corpusloom.scratch import Scratch

MIN_CHARS = 160
#: Documents whose deletions may be broadcast, and lines in them.
BROADCAST_DOCS, BROADCAST_LINES = 200_000, 3_000_000
_WORD = r"[^\x20\x09-\x0D]"
_SUFFIX = ["doc_id", "text_hash", "pos"]


def _reach(weights: Column, own: Column) -> Column:
    """How many leading elements sum to MIN_CHARS or more; null if all don't."""

    def within(n: int) -> Column:
        zero = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("m"))
        step = lambda s, w: F.when(s["sum"] >= MIN_CHARS, s).otherwise(F.struct((s["sum"] + w).alias("sum"), (s["m"] + 1).alias("m")))
        return F.aggregate(F.slice(weights, 1, n), zero, step, lambda s: F.when(s["sum"] >= MIN_CHARS, s["m"]))

    return F.when(own >= MIN_CHARS, F.lit(1)).otherwise(F.coalesce(within(4), within(MIN_CHARS)))


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, pos, line_no, h1, h2 (the line's id), ahead and back: lines of the shortest run from or to here."""
    cut = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("line_no"), x.alias("line"))).alias("all"))
    cut = cut.select("doc_id", "text_hash", F.filter("all", lambda x: x["line"].rlike(_WORD)).alias("lines"))
    cut = cut.select("doc_id", "text_hash", "lines", F.transform("lines", lambda x: F.length(x["line"]).cast("long")).alias("w"))
    rows = cut.select("doc_id", "text_hash", "w", F.size("w").alias("n"), F.posexplode("lines").alias("pos", "x"))
    own = F.get(F.col("w"), F.col("pos"))
    ahead = _reach(F.slice(F.col("w"), F.col("pos") + 1, MIN_CHARS), own)
    start = F.greatest(F.col("pos") + 2 - MIN_CHARS, F.lit(1))
    back = _reach(F.reverse(F.slice(F.col("w"), start, F.col("pos") + 2 - start)), own)
    return rows.select("doc_id", "text_hash", F.col("pos").cast("long").alias("pos"), F.col("x.line_no").alias("line_no"), F.xxhash64("x.line").alias("h1"), F.xxhash64(F.lit(1), "x.line").alias("h2"), ahead.cast("int").alias("ahead"), back.cast("int").alias("back"))


def ranks_in_order(distinct: DataFrame, keys: list[str], scratch: Scratch, name: str) -> DataFrame:
    """``distinct`` with order, the sum of n over all rows before in the order of ``keys``: ranges, sums within, bases of ranges."""
    ranged = scratch.save(distinct.repartitionByRange(*keys).withColumn("range", F.spark_partition_id()), name)
    order = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    bases = ranged.groupBy("range").agg(F.sum("n").alias("n")).select("range", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    within = Window.partitionBy("range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn("order", F.coalesce(F.sum("n").over(within), F.lit(0)))
    return summed.join(F.broadcast(bases), "range").withColumn("order", F.col("order") + F.col("base")).drop("range", "base", "n")


def at_suffix(left: DataFrame, right: DataFrame, *columns: str) -> DataFrame:
    """``left`` with ``columns`` of the row of ``right`` that has the same suffix."""
    keyed = right.select(*(F.col(c).alias(f"at_{c}") for c in _SUFFIX), *columns)
    on = F.col("doc_id").eqNullSafe(F.col("at_doc_id")) & (F.col("text_hash") == F.col("at_text_hash")) & (F.col("pos") == F.col("at_pos"))
    return left.join(keyed, on).drop(*(f"at_{c}" for c in _SUFFIX))


def double(ranks: DataFrame, length: int, scratch: Scratch, name: str) -> DataFrame:
    """Ranks by 2 * length lines from ranks by ``length`` lines, of suffixes that share them with others."""
    pairs = at_suffix(ranks, ranks.select("doc_id", "text_hash", (F.col("pos") - length).alias("pos"), F.col("rank").alias("next")), "next").select(*_SUFFIX, "rank", "next")
    # tables on their own, so that a class of very many suffixes, as a very common line makes, is a skewed join that can be split
    classes = scratch.save(pairs.groupBy("rank", "next").agg(F.count("*").alias("n")).where("n > 1"), f"{name}-classes")
    named = ranks_in_order(classes, ["rank", "next"], scratch, f"{name}-ranged").withColumnRenamed("order", "new")
    return scratch.save(pairs.join(named, ["rank", "next"]).select(*_SUFFIX, F.col("new").alias("rank")), name)


def deletions(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, text_hash, gone (ascending line numbers, from 0) of the documents that lose lines."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    lines = scratch.save(lines_of(texts), "lines")
    repeated = lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1")
    ids = scratch.save(ranks_in_order(repeated, ["h1", "h2"], scratch, "ranged").withColumnRenamed("order", "rank"), "ids")
    suffixes = lines.join(ids, ["h1", "h2"]).select(*_SUFFIX, "line_no", "rank", "ahead", "back").dropDuplicates(_SUFFIX)
    suffixes = scratch.save(suffixes, "suffixes")
    runs = suffixes.select("doc_id", "text_hash", "pos", F.col("ahead").alias("m")).unionByName(suffixes.select("doc_id", "text_hash", (F.col("pos") - F.col("back") + 1).alias("pos"), F.col("back").alias("m")))
    runs = scratch.save(runs.where("m is not null").distinct(), "runs")
    most = runs.agg(F.max("m")).first()[0] or 0
    ranks, k, keyed = suffixes.select(*_SUFFIX, "rank"), 0, None
    while 2**k <= most:
        if k:
            ranks = double(ranks, 2 ** (k - 1), scratch, f"ranks-{k}")
        of_k = runs.where((F.col("m") >= 2**k) & (F.col("m") < 2 ** (k + 1)))
        named = at_suffix(of_k, ranks.withColumnRenamed("rank", "first_rank"), "first_rank")
        if k:
            shifted = named.select("doc_id", "text_hash", (F.col("pos") + F.col("m") - 2**k).alias("pos"), "m", "first_rank")
            named = at_suffix(shifted, ranks.withColumnRenamed("rank", "last_rank"), "last_rank").withColumn("pos", F.col("pos") - F.col("m") + 2**k)
        else:
            named = named.withColumn("last_rank", F.col("first_rank"))
        named = scratch.save(named, f"runs-{k}")
        keyed = named if keyed is None else keyed.unionByName(named)
        k += 1
    if keyed is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, text_hash long, gone array<int>")
    interval = ["m", "first_rank", "last_rank"]
    earliest = keyed.groupBy(*interval).agg(F.min(F.struct(*_SUFFIX)).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    earliest = scratch.save(earliest, "earliest")  # a table on its own: an interval of very many runs is a skewed join that can be split
    later = keyed.join(earliest, interval).where(F.struct(*_SUFFIX) > F.col("first"))
    covered = later.select("doc_id", "text_hash", F.explode(F.sequence("pos", F.col("pos") + F.col("m") - 1)).alias("pos")).distinct()
    gone = at_suffix(covered, suffixes, "line_no")
    return gone.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("line_no")).alias("gone"))  # one document's lines


def _deduped(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, Column, Column]:
    """Rows of ``docs`` (as ``row``), their text without later copies, and how many lines are gone."""
    gone = scratch.save(deletions(docs, scratch), "gone")
    size = gone.agg(F.count("*").alias("docs"), F.coalesce(F.sum(F.size("gone")), F.lit(0)).alias("lines")).first()
    few = gone.withColumnsRenamed({"doc_id": "gone_id", "text_hash": "gone_hash"})
    if size["docs"] <= BROADCAST_DOCS and size["lines"] <= BROADCAST_LINES:
        few = F.broadcast(few)
    rows = as_rows(docs, F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"))
    own = F.col("row").getField("text")
    joined = rows.join(few, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("hash") == F.col("gone_hash")) & own.isNotNull(), "left")
    joined = joined.select("row", "gone", F.when(F.col("gone").isNotNull(), F.split(own, "\n")).alias("lines"))
    # the lines between one deleted line and the next, for each gap
    n = F.size("gone")
    gap = lambda j: F.slice(F.col("lines"), F.when(j == 0, 1).otherwise(F.get(F.col("gone"), F.greatest(j - 1, F.lit(0))) + 2), F.when(j == n, F.size("lines")).otherwise(F.get(F.col("gone"), j)) - F.when(j == 0, 0).otherwise(F.get(F.col("gone"), F.greatest(j - 1, F.lit(0))) + 1))
    left = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), n), gap)), "\n")
    left = F.when(left.rlike(_WORD), left).otherwise(F.lit(""))
    return joined, F.when(F.col("gone").isNotNull(), left).otherwise(own), F.coalesce(n.cast("long"), F.lit(0))


def dedup_lines(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs`` with later copies deleted from text, and gone_lines (how many; a column of that name is replaced); a document that
    loses all its words has an empty text."""
    rows, text, n = _deduped(docs, scratch)
    return from_rows(rows, docs, text=text, gone_lines=n)


def drop_lines(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Documents without later copies of line runs, n_chars (if there is one) made true again; those of which nothing is left go."""
    rows, text, n = _deduped(docs, scratch)
    rows = rows.select("row", text.alias("text"), n.alias("n")).where((F.col("n") == 0) | (F.col("text") != ""))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("n") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row").getField("n_chars"))
    return from_rows(rows, docs, **changed)


def oracle() -> str:
    return rf"""
with a as (select doc_id, text, string_split(text, chr(10)) al from documents where text is not null),
l0 as (select doc_id, unnest(al) line, unnest(range(0, len(al))) line_no from a),
l as (select doc_id, line, line_no, row_number() over (partition by doc_id order by line_no) pos, sum(length(line)) over (partition by doc_id order by line_no) c, length(line) w from l0 where regexp_matches(line, '[^\x20\x09-\x0D]')),
r as (select x.doc_id, x.pos, min(y.pos) to_pos from l x join l y on x.doc_id = y.doc_id and y.pos >= x.pos and y.c - x.c + x.w >= {MIN_CHARS} group by 1, 2
 union select x.doc_id, max(y.pos), x.pos from l x join l y on x.doc_id = y.doc_id and y.pos <= x.pos and x.c - y.c + y.w >= {MIN_CHARS} group by x.doc_id, x.pos),
k as (select r.doc_id, r.pos, r.to_pos, array_to_string(list(l.line order by l.pos), chr(10)) s from r join l on l.doc_id = r.doc_id and l.pos between r.pos and r.to_pos group by all),
e as (select *, first_value(doc_id) over o fd, first_value(pos) over o fp from k window o as (partition by s order by doc_id, pos)),
g as (select distinct l.doc_id, l.line_no from e join l on l.doc_id = e.doc_id and l.pos between e.pos and e.to_pos where (e.doc_id, e.pos) <> (fd, fp)),
t as (select l0.doc_id, count(g.line_no) n, array_to_string(list(l0.line order by l0.line_no) filter (g.line_no is null), chr(10)) s from l0 left join g on g.doc_id = l0.doc_id and g.line_no = l0.line_no group by 1)
select d.doc_id, case when coalesce(n, 0) = 0 then text when regexp_matches(coalesce(s, ''), '[^\x20\x09-\x0D]') then s else '' end as text, coalesce(n, 0)::bigint gone_lines from documents d left join t using (doc_id)"""
