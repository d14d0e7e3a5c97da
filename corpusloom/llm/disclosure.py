"""Operator 10: personal data, and the terms that would reveal it.

Base spans are e-mail addresses, IP addresses, card and phone numbers, found by fixed patterns. Each value is a protected entity.
A corpus-wide estimate then tells which words of a text give its entities away: with N distinct texts, n(c) of them holding
entity c, n(t) holding term t (a word with a letter), and n(c, t) holding both, however far apart,

    P(c | t) = (n(c, t) + n(c) / N) / (n(t) + 1),    PMI(c; t) = log2(P(c | t) N / n(c)),    IC(c) = log2(N / n(c)),

and the share PMI / IC of c's information that t discloses nears 1 if t occurs only beside c. P is smoothed by one text at c's own
rate: every pair that was seen is scored, those of a single text too, and more texts say more. Where the share reaches ``DISCLOSURE``,
all occurrences of t in the texts of c become spans of kind ``term``: removed if the share reaches ``REMOVAL``, else generalised. Distinct texts
count once, so that copies aren't evidence.

As n(c, t) <= n(c), the share can only reach ``DISCLOSURE`` for n(t) < (n(c) + 1) (N / n(c)) ** (1 - DISCLOSURE); other terms are
never paired. Entities of one text only have the same figures with each of its terms and are paired as one.

All of it is DataFrame functions. Patterns run only on texts that hold their necessary characters, are possessive and begin where a
run of their characters begins, which keeps them linear in the text.

Defined cases: a null text counts as empty and has no spans; rows of equal doc_id and text get equal results; null ids are kept; terms
that overlap a base span are dropped; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.texts import as_rows, from_rows
from corpusloom.scratch import Scratch

#: kind: (pattern, what a text must match to be searched). A possessive form of the fixed patterns that finds the same matches.
PATTERNS = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "[0-9]"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", "[0-9]"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
}
DISCLOSURE, REMOVAL = 0.8, 0.95
#: Common terms that may be broadcast (under 100 bytes each) to leave them out before the shuffle; terms are common in one of so many texts.
BROADCAST_TERMS, COMMON = 200_000, 1_000
#: Copied texts whose counts may be broadcast (16 bytes each).
BROADCAST_COPIES = 1_000_000
_WORD = r"[\p{L}\p{N}]+"
_KEY = ["doc_id", "text_hash"]


def located(pieces: str | Column, matches: str | Column, keep: Callable[[Column], Column] | None = None) -> Column:
    """array of (start, end, value) from a text's pieces between matches and the matches, or those of them to keep."""
    pieces, matches = (F.col(x) if isinstance(x, str) else x for x in (pieces, matches))
    kind = "struct<at:int,out:array<struct<start:int,end:int,value:string>>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out")).cast(kind)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["piece"])
        end = start + F.length(x["value"])
        more = F.array_append(acc["out"], F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value")))
        return F.struct(end.alias("at"), (more if keep is None else F.when(keep(x["value"]), more).otherwise(acc["out"])).alias("out")).cast(kind)

    pairs = F.filter(F.arrays_zip(pieces.alias("piece"), matches.alias("value")), lambda x: x["value"].isNotNull())
    return F.aggregate(pairs, zero, step, lambda a: a["out"])


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits pass Luhn's check."""

    def worth(c: Column, i: Column) -> Column:
        d = F.ascii(c) - 48
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.transform(F.filter(F.split(F.reverse(number), ""), lambda c: c != ""), worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    n = F.length(digits(value))
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(F.split(value, r"\."), lambda p: F.when(F.length(part(p)) <= 3, part(p).cast("int") <= 255).otherwise(False))
    if kind == "card":
        return F.when((n >= 12) & (n <= 19), luhn(digits(value))).otherwise(False)
    if kind == "phone":
        return (n >= 9) & (n <= 15)
    return F.lit(True)


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_<kind>, spans (start, kind_no, end, kind, value) of every document, and the text of those that have any."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    none = F.array().cast("array<string>")
    cut = texts.select("doc_id", "text", *(x for k, (p, need) in PATTERNS.items() for x in (
        F.when(F.col("text").rlike(need), F.split("text", p)).otherwise(none).alias(f"{k}_pieces"),
        F.when(F.col("text").rlike(need), F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(none).alias(f"{k}_values"),
    )))

    def full(k: str, number: int) -> Column:
        context = lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind_no"), s["end"].alias("end"), F.lit(k).alias("kind"), s["value"].alias("value"))
        good = F.filter(located(f"{k}_pieces", f"{k}_values"), lambda s: valid(k, s["value"]))
        return F.transform(good, context)

    found = cut.select("doc_id", "text", F.xxhash64("text").alias("text_hash"), *(full(k, i).alias(k) for i, k in enumerate(PATTERNS)))
    return found.select("doc_id", "text_hash", *(F.size(k).cast("long").alias(f"n_{k}") for k in PATTERNS), F.array_sort(F.concat(*PATTERNS)).alias("spans"), F.when(F.size(F.concat(*PATTERNS)) > 0, F.col("text")).alias("text"))


def words(text: str) -> Column:
    """A text's distinct words, in lower case."""
    return F.array_distinct(F.transform(F.split(text, r"[^\p{L}\p{N}]+"), F.lower))


def spoken(docs: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """term, n_t of all terms."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # each of c copies of a text counts 1 / c, so that sums in partitions do for counts of distinct texts
    copies = scratch.save(found.groupBy("text_hash").agg(F.count("*").alias("c")).where("c > 1").withColumnRenamed("text_hash", "copied"), "copies")
    if copies.count() <= BROADCAST_COPIES:
        copies = F.broadcast(copies)
    weighed = docs.select(text.alias("text"), F.xxhash64(text).alias("text_hash")).join(copies, F.col("text_hash") == F.col("copied"), "left").select("text", (1 / F.coalesce("c", F.lit(1))).alias("weight"))
    return weighed.select("weight", F.explode(words("text")).alias("term")).groupBy("term").agg(F.round(F.sum("weight")).alias("n_t")).where(F.col("term").rlike(r"\p{L}"))


def disclosing(docs: DataFrame, found: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """text_hash, shares: for each text with entities, the terms whose share with one of them reaches DISCLOSURE, and the greatest."""
    n = float(max(found.select("text_hash").distinct().count(), 1))
    spans = found.select("text_hash", F.explode("spans").alias("s"))
    value = F.when(F.col("s.kind").isin("card", "phone"), digits(F.col("s.value"))).otherwise(F.lower("s.value"))
    held = scratch.save(spans.select("text_hash", F.concat_ws(":", "s.kind", value).alias("entity")).distinct(), "held")
    entities = held.groupBy("entity").agg(F.count("*").alias("n_c")).where(F.col("n_c") < n)
    name = F.when(F.col("n_c") > 1, F.col("entity")).otherwise(F.col("text_hash").cast("string"))
    held = scratch.save(held.join(entities, "entity").select("text_hash", name.alias("entity"), "n_c").distinct(), "named")
    most = (F.col("n_c") + 1) * F.pow(F.lit(n) / F.col("n_c"), F.lit(1 - DISCLOSURE))
    limit = held.agg(F.max(most)).first()[0] or 0.0
    common = max(limit, n / COMMON)
    heard = scratch.save(spoken(docs, found, scratch).where((F.col("n_t") <= limit) | (F.col("n_t") > common)), "heard")
    said = texts.select("text_hash", F.explode(words("text")).alias("term"))
    often = heard.where(F.col("n_t") > common).select("term")
    if often.count() <= BROADCAST_TERMS:
        said = said.join(F.broadcast(often), "term", "left_anti")
    pairs = said.join(heard.where(F.col("n_t") <= limit), "term").join(held, "text_hash").where(F.col("n_t") <= most)
    pairs = scratch.save(pairs.select("entity", "term", "text_hash", "n_c", "n_t"), "pairs")
    rate = F.col("n_c") / F.lit(n)
    pmi = F.log2((F.col("n_ct") + rate) / (F.col("n_t") + 1) / rate)
    scored = pairs.groupBy("entity", "term", "n_c", "n_t").agg(F.count("*").alias("n_ct")).select("entity", "term", (pmi / -F.log2(rate)).alias("share"))
    # a table on its own: an entity of very many texts is a skewed join that can be split
    scored = scratch.save(scored.where(F.col("share") >= DISCLOSURE), "scored")
    bad = pairs.select("entity", "term", "text_hash").join(scored, ["entity", "term"]).groupBy("text_hash", "term").agg(F.max("share").alias("share"))
    return scratch.save(bad.groupBy("text_hash").agg(F.map_from_entries(F.collect_list(F.struct("term", "share"))).alias("shares")), "disclosing")  # one text's


def personal_data(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, text_hash, n_<kind>, base and all: arrays of spans (start, kind_no, end, kind, removed) in order."""
    found = scratch.save(base_spans(docs), "found")
    texts = scratch.save(found.where("text is not null").select("text_hash", "text").dropDuplicates(["text_hash"]), "texts")
    bad = disclosing(docs, found, texts, scratch)
    places = located(F.split("text", _WORD), F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)), lambda w: F.map_contains_key("shares", F.lower(w)))
    terms = texts.join(bad, "text_hash").select(F.col("text_hash").alias("t_hash"), "shares", places.alias("places"))
    term = lambda s: F.struct(s["start"].alias("start"), F.lit(len(PATTERNS)).alias("kind_no"), s["end"].alias("end"), F.lit("term").alias("kind"), (F.element_at("shares", F.lower(s["value"])) >= REMOVAL).alias("removed"))
    terms = scratch.save(terms.select("t_hash", F.transform("places", term).alias("terms")), "terms")
    base = F.transform("spans", lambda s: F.struct(s["start"], s["kind_no"], s["end"], s["kind"], F.lit(False).alias("removed")))
    rows = found.select(*_KEY, *(f"n_{k}" for k in PATTERNS), base.alias("base"))
    rows = rows.join(terms, F.col("text_hash") == F.col("t_hash"), "left")
    free = F.filter("terms", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return rows.select(*_KEY, *(f"n_{k}" for k in PATTERNS), "base", F.array_sort(F.concat("base", F.coalesce(free, F.array().cast("array<struct<start:int,kind_no:int,end:int,kind:string,removed:boolean>>")))).alias("all"))


def written(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame, scratch: Scratch) -> DataFrame:
    rows = personal_data(docs, scratch)
    return rows.select("doc_id", *(f"n_{k}" for k in PATTERNS), F.sha2(written("base").cast("binary"), 256).alias("base_sha256"), written("all").alias("spans"))


def sanitise(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs`` with base spans replaced by their kind in brackets and disclosing terms removed or generalised to [TERM].

    Other columns are kept, whatever their names; null texts stay null.
    """
    spans = personal_data(docs, scratch).where(F.size("all") > 0).select(F.col("doc_id").alias("s_id"), F.col("text_hash").alias("s_hash"), "all").dropDuplicates(["s_id", "s_hash"])
    rows = as_rows(docs, F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"))
    joined = rows.join(spans, F.col("id").eqNullSafe(F.col("s_id")) & (F.col("hash") == F.col("s_hash")), "left")
    own = F.col("row").getField("text")
    kind = "struct<at:int,out:array<string>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")).cast(kind)
    shown = lambda s: F.when(s["removed"], "").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))

    def step(a: Column, s: Column) -> Column:
        inside = F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out")).cast(kind)
        more = F.concat(a["out"], F.array(F.substring(own, a["at"] + 1, s["start"] - a["at"]), shown(s)))
        return F.when(s["start"] < a["at"], inside).otherwise(F.struct(s["end"].alias("at"), more.alias("out")).cast(kind))

    made = F.aggregate("all", zero, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substring(own, a["at"] + 1, F.length(own))))
    return from_rows(joined, docs, text=F.when(F.col("all").isNotNull(), made).otherwise(own))
