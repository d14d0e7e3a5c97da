"""Operator 5: benchmark decontamination by size-partitioned MinHash containment search, with exact verification.

A short item inside a long document has a tiny Jaccard similarity, so sketches must grow with the document: documents fall into
partitions by size, each of twice the shingles of the one before, and a document of partition p has a one-permutation
MinHash sketch of 2 ** (p + fine) bins (the leading bits of a shingle's hash choose its bin; the bin keeps its least hash).
An item collides with a document in a bin if both have the same minimum there. A minimum in some bins is one in all finer
ones, so a shingle of either side carries the coarsest number of bins in which it is a minimum, and every pair is compared at the
document's resolution.

Items fall into partitions by size too. Of the shingles that an item shares with a document, the share that collides is at
least (1 - exp(-x)) / x with x = 2 ** -fine shingles a bin. ``fineness`` takes the coarsest sketch for which an item with 0.8 of its m shingles in a document
collides in a third of m bins or more, with a chance of ``RECALL`` at least: fine = 0 for items of many shingles, whose sketches
keep two shingles in three, up to 8 for an item of one shingle. As a third must collide, one of any m - ceil(m / 3) + 1 shingles does; an item
is founded on its rarest ones among all items, so that a passage that many items and many documents share makes no candidates.

Candidates are then verified: the share of the item's distinct shingles that the document has must be 0.8 or more, counted on the
shingles' words, not on hashes. Words are runs of letters and digits, lower-cased; shingles have five words, and items of fewer
words are one shingle of that many words, looked up among the documents' shingles of the same length. Documents are hashed once
for all lengths.

All of it is DataFrame functions. Items are broadcast behind a check of their number, else joined by shuffle.

Defined cases: null or empty texts and items without words match nothing; rows of equal doc_id are searched each for itself and reported
once, with the largest count; equal (item_id, text) rows count once; null ids are matched like others; other columns are
ignored (or kept, by decontaminate), whatever their names; empty tables give no rows.
"""

from __future__ import annotations

import math
from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.texts import as_rows, from_rows
from corpusloom.scratch import Scratch

SHINGLE, NUM, DEN = 5, 80, 100
#: Chance at least that an item that a document contains becomes a candidate; bits of fineness at most; sizes of items told apart.
RECALL, FINEST, SIZES = 0.995, 9, 200
#: Rows that may be broadcast: item shingles (about 100 bytes each) and ids of documents (16 bytes each).
BROADCAST_SHINGLES, BROADCAST_DOCS = 500_000, 1_000_000
_DOC, _ITEM = ["doc_id", "text_hash"], ["item_id", "item_hash"]


def least_collisions(m: int) -> int:
    """Bins that a contained item of m shingles is expected to share at least."""
    return -(-m // 3)


@cache
def fineness(m: int) -> int:
    """Bits by which a document's bins exceed its shingles for items of m shingles."""
    shared = -(-NUM * m // DEN)
    for fine in range(FINEST):
        x = 2.0**-fine
        p = (1 - math.exp(-x)) / x
        if sum(math.comb(shared, k) * p**k * (1 - p) ** (shared - k) for k in range(least_collisions(m), shared + 1)) >= RECALL:
            return fine
    return FINEST


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_hashes(hashes: str, n: int) -> Column:
    """Hashes of all n-word shingles of an array of word hashes, repeats included."""
    at = lambda i, k: F.get(F.col(hashes), i + k)
    positions = F.sequence(F.lit(0), F.size(hashes) - n)
    return F.when(F.size(hashes) >= n, F.transform(positions, lambda i: F.xxhash64(*(at(i, k) for k in range(n))))).otherwise(F.array().cast("array<long>"))


def shingle_texts(words_: str, n: int) -> Column:
    positions = F.sequence(F.lit(1), F.size(words_) - n + 1)
    return F.when(F.size(words_) >= n, F.array_distinct(F.transform(positions, lambda i: F.array_join(F.slice(F.col(words_), i, n), " ")))).otherwise(F.array().cast("array<string>"))


def bits(value: Column) -> Column:
    """Bits of an unsigned value up to its highest one."""
    return F.when(value == 0, 0).otherwise(F.length(F.bin(value)))


def coarsest(h: Column, before: Column) -> Column:
    """The fewest bits of bins in which a hash is the minimum, by the next smaller hash of its set (null: none)."""
    return F.when(before.isNull(), 0).otherwise(F.lit(65) - bits(h.bitwiseXOR(before))).cast("int")


def bin_of(value: Column, p: Column) -> Column:
    return F.call_function("shiftrightunsigned", value, (F.lit(64) - p).cast("int"))


def minima(docs: DataFrame, fine: dict[int, int]) -> DataFrame:
    """doc_id, text_hash, n, p, h, before: for shingles of n words, the sketch of every document at the finest resolution that items of n need."""
    hashed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("words"))
    hashed = hashed.select(*_DOC, F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    sorted_ = hashed.select(*_DOC, *(F.sort_array(shingle_hashes("hashes", n)).alias(f"s{n}") for n in fine))
    # no filter on these arrays: Spark would push it below and compute them anew for each element
    sized = sorted_.select(*_DOC, *(f"s{n}" for n in fine), *(bits((F.size(f"s{n}") - 1).cast("long")).cast("int").alias(f"p{n}") for n in fine))

    def sketch(n: int, most: int) -> Column:
        s, p = F.col(f"s{n}"), F.col(f"p{n}") + most
        before = lambda i: F.get(s, i - 1)
        kept = F.filter(F.transform(s, lambda x, i: F.struct(F.lit(n).alias("n"), F.col(f"p{n}").alias("p"), x.alias("h"), F.when(i > 0, before(i)).alias("before"))), lambda e: e["before"].isNull() | (bin_of(e["h"], p) != bin_of(e["before"], p)))
        return kept

    rows = sized.select(*_DOC, F.explode(F.concat(*(sketch(n, most) for n, most in fine.items()))).alias("x"))
    return rows.select(*_DOC, "x.n", "x.p", "x.h", "x.before")


def item_shingles(items: DataFrame, scratch: Scratch) -> DataFrame:
    """item_id, item_hash, n (words of a shingle), size (distinct shingles), shingle, h, coarsest (of h among the item's), fine, founds.

    founds: whether the shingle is among those rare ones that candidates are founded on.
    """
    split = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct().select("item_id", F.xxhash64("text").alias("item_hash"), words(F.col("text")).alias("words"))
    cut = None
    for n in range(1, SHINGLE + 1):
        part = split.where(F.size("words") == n) if n < SHINGLE else split.where(F.size("words") >= n)
        part = part.select(*_ITEM, F.lit(n).alias("n"), shingle_texts("words", n).alias("shingles"))
        cut = part if cut is None else cut.unionByName(part)
    rows = cut.select(*_ITEM, "n", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle"))
    h = F.lit(None).cast("long")
    for n in range(1, SHINGLE + 1):
        h = F.when(F.col("n") == n, F.xxhash64(*(F.xxhash64(F.get(F.split("shingle", " "), F.lit(k))) for k in range(n)))).otherwise(h)
    rows = scratch.save(rows.withColumn("h", h), "cut")
    held = rows.groupBy("n", "shingle").agg(F.count("*").alias("items"))
    own = Window.partitionBy(*_ITEM)  # an item's own shingles
    fine = F.element_at(F.array(*(F.lit(fineness(m)) for m in range(1, SIZES + 1))), F.least("size", F.lit(SIZES)).cast("int"))
    found = F.row_number().over(own.orderBy("items", "h")) <= F.col("size") - F.ceil(F.col("size") / 3) + 1
    marked = rows.join(held, ["n", "shingle"]).withColumn("coarsest", coarsest(F.col("h"), F.lag("h").over(own.orderBy("h")))).withColumn("founds", found).withColumn("fine", fine)
    return scratch.save(marked, "items")


def candidates(texts: DataFrame, known: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, text_hash, item_id, item_hash) of documents and items that collide in a founding shingle."""
    fine = {r["n"]: r["fine"] for r in known.groupBy("n").agg(F.max("fine").alias("fine")).orderBy("n").collect()}  # five rows at most
    probe = known.where("founds").select(F.col("h").alias("item_h"), F.col("n").alias("item_n"), *_ITEM, "coarsest", "fine")
    small = F.broadcast(probe) if probe.count() <= BROADCAST_SHINGLES else probe
    resolution = F.col("p") + F.col("fine")
    found = minima(texts, fine).join(small, (F.col("h") == F.col("item_h")) & (F.col("n") == F.col("item_n")))
    found = found.where((F.col("coarsest") <= resolution) & (coarsest(F.col("h"), F.col("before")) <= resolution))
    return scratch.save(found.select(*_DOC, *_ITEM).distinct(), "candidates")


def contaminated(docs: DataFrame, items: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, item_id, n_item (distinct shingles of the item), n_shared: the pairs whose containment is 0.8 or more."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    known = item_shingles(items, scratch)
    lengths = sorted(r["n"] for r in known.select("n").distinct().collect())  # five at most
    if not lengths:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, n_item long, n_shared long")
    pairs = candidates(texts, known, scratch)
    which = scratch.save(pairs.select(F.col("doc_id").alias("c_id"), F.col("text_hash").alias("c_hash")).distinct(), "suspects")
    few = F.broadcast(which) if which.count() <= BROADCAST_DOCS else which
    suspects = texts.withColumn("text_hash", F.xxhash64("text")).join(few, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_hash") == F.col("c_hash")), "left_semi")
    of_length = lambda n: F.transform(shingle_texts("words", n), lambda x: F.struct(F.lit(n).alias("n"), x.alias("shingle")))
    cut = suspects.select(*_DOC, words(F.col("text")).alias("words")).select(*_DOC, F.explode(F.concat(*map(of_length, lengths))).alias("x")).select(*_DOC, "x.n", "x.shingle")
    # of a document's shingles those of any item, once each; then each candidate's own shingles are looked up among them
    any_item = known.select("n", "shingle").distinct()
    held = cut.join(F.broadcast(any_item) if any_item.count() <= BROADCAST_SHINGLES else any_item, ["n", "shingle"], "left_semi").distinct()
    own = F.broadcast(known) if known.count() <= BROADCAST_SHINGLES else known
    wanted = pairs.alias("pairs").join(own.alias("known"), [F.col(f"pairs.{c}").eqNullSafe(F.col(f"known.{c}")) for c in _ITEM])
    wanted = wanted.select("pairs.doc_id", "pairs.text_hash", "pairs.item_id", "pairs.item_hash", "n", "size", "shingle")
    on = [F.col(f"w.{c}").eqNullSafe(F.col(f"h.{c}")) for c in (*_DOC, "n", "shingle")]
    shared = wanted.alias("w").join(held.alias("h"), on).groupBy(*(f"w.{c}" for c in (*_DOC, *_ITEM)), "w.size").agg(F.count("*").alias("n_shared"))
    enough = shared.where(DEN * F.col("n_shared") >= NUM * F.col("size"))
    best = enough.groupBy("doc_id", "item_id").agg(F.max(F.struct("n_shared", "size")).alias("best"))
    return best.select("doc_id", "item_id", F.col("best.size").cast("long").alias("n_item"), F.col("best.n_shared").cast("long").alias("n_shared"))


def decontaminate(docs: DataFrame, items: DataFrame, scratch: Scratch) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    gone = scratch.save(contaminated(docs, items, scratch).select(F.col("doc_id").alias("gone_id")).distinct(), "gone")
    rows = as_rows(docs, F.col("doc_id").cast("long").alias("id"))
    return from_rows(rows.join(F.broadcast(gone) if gone.count() <= BROADCAST_DOCS else gone, F.col("id").eqNullSafe(F.col("gone_id")), "left_anti"), docs)


def oracle() -> str:
    cut = lambda t, i: rf"select {i}, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda z: z <> '') w from {t}"
    return rf"""
with i as ({cut('benchmark', 'item_id')}), d as ({cut('documents', 'doc_id')}),
si as (select distinct item_id, least(5, len(w)) n, array_to_string(w[k:k + least(5, len(w)) - 1], ' ') s from (select item_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) k from i where len(w) > 0)),
m as (select distinct n from si),
sd as (select distinct doc_id, n, array_to_string(w[k:k + n - 1], ' ') s from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) k from d, m where len(w) >= n)),
z as (select item_id, count(*) size from si group by 1)
select doc_id, item_id, max(size)::bigint n_item, count(*)::bigint n_shared from si join sd using (n, s) join z using (item_id) group by 1, 2 having 100 * count(*) >= 80 * max(size)"""
