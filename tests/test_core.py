import random
import re
import tracemalloc
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import minhash, text
from corpusloom.operators import dedup, filters, graph, standardize, tokens
from corpusloom.plans.queries import oracle_sql, queries
from corpusloom.scratch import Scratch
from corpusloom.sources import io


def one(spark, value, use):
    return spark.createDataFrame([(value,)], "t string").select(use(F.col("t"))).first()[0]


@pytest.mark.parametrize(("given", "wanted"), [("Ｈｅｌｌｏ，World!", "hello world "), ("foo_bar  baz", "foo bar baz"), ("A\tB\nC", "a b c"), (None, None)])
def test_normalize(spark, given, wanted):
    assert one(spark, given, text.normalize) == wanted


def test_normalize_splits_ideographs(spark):
    assert one(spark, "中文，测试ab", lambda t: text.normalize(t, split_ideographs=True)) == "中 文 测 试ab"


def test_hash_and_tokens(spark):
    assert one(spark, "hello", text.hash32) == 499578026
    assert one(spark, " a  b ", text.tokens) == ["", "a", "", "b", ""]
    assert one(spark, "", text.tokens) == [""]


def test_signatures(spark):
    rows = spark.createDataFrame([(1, "a b c d e f"), (2, "a b"), (3, "one")], "doc_id long, text string")
    got = {r["uid"]: list(r["signature"][:4]) for r in dedup.signatures(rows, dedup.DedupConfig()).collect()}
    assert got == {1: [1325523712, 3030624178, 1937760049, 1549906655], 2: [481794548, 3190356802, 2304375400, 645836949], 3: [2**32 - 1] * 4}


def test_signatures_hold_a_slice_of_a_batch_at_a_time():
    """One batch of 6 MB of texts and a long one: its hashes never exist at once, and signatures are those of single texts."""
    texts = [" ".join(f"w{(i * 7919 + j) % 100003}" for j in range(400)) for i in range(2500)] + [None, "", "long text " * 150_000, "a b c d e f"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["uid", "text"])
    args = (8, 5, 2, False, True, False)
    tracemalloc.start()
    try:
        sizes = [b.num_rows for b in minhash.signed_batches(iter([batch]), *args)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(sizes) == len(texts) and len(sizes) > 6 and peak < 32e6
    some = [0, 1234, 2499, 2500, 2501, 2502, 2503]
    whole = pa.Table.from_batches(minhash.signed_batches(iter([batch]), *args)).to_pylist()
    assert [r["uid"] for r in whole] == list(range(len(texts)))
    assert [whole[i] for i in some] == [{"uid": i, "signature": next(minhash.signed_batches(iter([batch.slice(i, 1)]), *args)).column(1)[0].as_py()} for i in some]


def test_normalize_sends_only_texts_that_can_change(spark):
    stable = [chr(i) for i in [*range(128), *range(0xC0, 0x100)]]
    assert all(unicodedata.normalize("NFKC", a + b) == a + b for a in stable for b in stable)
    given = [None, "", "Plain", "Größe É×÷", "e\u0301", "\u00e9\u0323", "Ａ\u00b2", "\ufb03", "½ \u00a0x", "İ", "\U0001d400b"]
    rows = spark.createDataFrame(list(enumerate(given)), "i int, t string").select("i", F.lower("t").alias("lower"), text.normalize(F.col("t")).alias("t")).coalesce(1)
    for r in rows.collect():
        assert r["t"] == (None if r["lower"] is None else re.sub(text.PYTHON_SEPARATORS, " ", unicodedata.normalize("NFKC", r["lower"])))
    sent = pa.array([None] * 5 + ["ｆ" * 400_000, None, "ｘ", "a"])
    assert list(text.slices(sent)) == [(0, 5), (5, 1), (6, 3)] and list(text.slices(sent[:0])) == []
    assert text.nfkc_array(sent).to_pylist() == [None] * 5 + ["f" * 400_000, None, "x", "a"]


def test_band_parameters():
    assert minhash.band_parameters(0.7, 256) == (25, 10)
    assert minhash.band_parameters(0.85, 128) == (8, 16)


@pytest.mark.parametrize(("selector", "wanted"), [('{"line_id":[3,1,9,1]}', "l3\nl1\nl1"), ('{"line_id":[true,2]}', "l1\nl2"), ('{"line_id":["1",2]}', "l2"), ("[1]", ""), ("{bad", ""), ('{"line_id":[]}', ""), ('{"line_id":"12"}', ""), (None, "")])
def test_body_lines(spark, selector, wanted):
    row = spark.createDataFrame([("l1\nl2\nl3", selector)], "t string, s string")
    assert row.select(text.body_lines(F.col("t"), F.col("s"))).first()[0] == wanted


def test_lengths_and_numbers(spark):
    assert one(spark, " a b\tc\n", text.stripped_length) == 3
    assert one(spark, "　a　b　", text.stripped_length) == 3
    assert one(spark, "a\rb\r", text.stripped_length) == 3
    assert one(spark, "a\n", text.line_count) == 2
    assert [text.human(n) for n in (999, 1234, 2_500_000)] == ["999", "1.23K", "2.50M"]


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100)] + [(i + 1, i) for i in range(1000, 1030)] + [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)]
    group = {x: x for e in edges for x in e}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        group[b] = a
    frame = spark.createDataFrame(edges, "src long, dst long")
    got = {r["vid"]: r["component"] for r in graph.connected_components(frame, Scratch(spark, "t")).collect()}
    assert got == {x: root(x) for x in group if sum(root(y) == root(x) for y in group) > 1}
    assert graph.connected_components(frame.limit(0), Scratch(spark, "t")).count() == 0


def test_near_dedup_partitions(spark):
    words = [f"w{i}" for i in range(60)]
    rows = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words)), (3, " ".join(words) + " x"), (4, "other words entirely here now"), (5, None)], "doc_id long, text string")
    found = dedup.near_dedup(rows.where("text is not null"), dedup.DedupConfig(num_perm=32, b=16, r=2), Scratch(spark, "t"))
    assert sorted(r["doc_id"] for r in found.result.collect()) == [1, 4]
    assert [r["doc_id"] for r in found.dup.collect()] == [3]
    assert dedup.duplicate_rate(rows.limit(0), found.dup.limit(0)).first()["rate"] is None


def test_registered_near_dedup_by_the_defaults(spark, tmp_path):
    """Texts that share two thirds of their shingles or fewer are different documents; brute force over all pairs."""
    rng = random.Random(5)
    texts = {}
    for k in range(60):
        words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        cut = rng.randrange(100, 160)
        texts |= {3 * k: " ".join(words), 3 * k + 1: " ".join([*words[:cut], *(f"w{rng.randrange(10**6)}" for _ in range(200 - cut))]), 3 * k + 2: " ".join([*words, "tail"])}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    grams = {i: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for i, t in texts.items()}
    alike = {(a, b) for a in texts for b in texts if a < b and len(grams[a] & grams[b]) >= 0.85 * len(grams[a] | grams[b])}
    found = queries()
    assert {r[0] for r in found["near_dedup_dropped_8x16"](spark, str(tmp_path)).collect()} == {b for _, b in alike}
    assert {r[0] for r in found["near_dedup_kept_8x16"](spark, str(tmp_path)).collect()} == set(texts) - {b for _, b in alike}
    assert {(r["component"], r["vid"]) for r in found["wcc_components_8x16"](spark, str(tmp_path)).collect() if r["vid"] > r["component"]} == alike
    assert found["duplicate_rate_8x16"](spark, str(tmp_path)).first()["num_dup"] == len(alike)
    assert found["minhash_signature_8x16"](spark, str(tmp_path)).count() == 128 * len(texts)


def test_registered_queries_apply_nfkc(spark, tmp_path):
    """Copies that differ in form only: full-width letters, a ligature, decomposed marks."""
    words = [f"wörd{i}" for i in range(40)]
    plain = " ".join(["office", *words])
    wide = " ".join(["o\ufb03ce", *words[:-1], "".join(chr(ord(c) + 0xFEE0) if c.isascii() else c for c in words[-1])])
    apart = " ".join(["office", *(unicodedata.normalize("NFD", w) for w in words)])
    spark.createDataFrame([(1, plain), (2, wide), (3, apart)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries()
    for end in ("", "_8x16"):
        assert sorted(r[0] for r in found[f"near_dedup_dropped{end}"](spark, str(tmp_path)).collect()) == [2, 3]
    for name in ("token_arrays", "shingles", "shingle_hash32"):
        assert len({tuple(r)[1:] for r in found[name](spark, str(tmp_path)).collect()}) == 1
    assert found["candidate_edges"](spark, str(tmp_path)).count() == 2


def test_standardize(spark):
    raw = spark.createDataFrame([("hello", 7, "u", None, "w")], "text string, n long, url string, previous_word_count long, warcinfo string")
    row = standardize.adapt(raw, "dclm", F.col("n")).first()
    assert row["meta"]["others"] == {"previous_word_count": "None", "url": "u", "warcinfo": "w"}
    assert spark.range(1).select(standardize.doc_id("fineweb", F.lit(7), F.lit("hello"))).first()[0] == "4e7f587409ad3d90d2cb35479017b55c2af9dc4fc5650a65779fc680ddca064d"
    with pytest.raises(ValueError):
        standardize.adapt(raw, "fineweb", F.col("n"))
    with pytest.raises(Exception, match="empty text"):
        standardize.adapt(raw.withColumn("text", F.lit("")), "dclm", F.col("n")).collect()
    assert standardize.adapter_for("stack_edu-C") == "dolma3_mix_code"


@pytest.mark.parametrize("name", standardize.ADAPTERS)
def test_registered_standardize_keeps_empty_and_null_texts(spark, tmp_path, name):
    duckdb = pytest.importorskip("duckdb")
    spark.createDataFrame([(1, "a text of more than ten characters", "en", "s1", 34), (2, "", "de", "s2", 0), (3, None, "fr", "s3", 0), (4, " \n", "en", "s1", 2)], "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    base = duckdb.connect()
    for table in ("documents", "labels"):
        base.sql(f"create view {table} as from read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    got = [tuple(r) for r in queries()[f"standardize_{name}"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(base.sql(oracle_sql()[f"standardize_{name}"]).fetchall(), key=str)
    assert len(got) == 4


def test_partitions():
    assert [io.partitions_for(5), io.partitions_for(0, 1, 3 * 2**20 + 1), io.partitions_for(0, 1, 0), io.partitions_for(-1, rows=10), io.partitions_for()] == [5, 4, None, 1, None]


def test_filters_and_report(spark):
    rows = spark.createDataFrame([("a" * 300,), ("short",), ("",), (None,)], "text string")
    assert filters.clean(rows).count() == 1
    scored = filters.clean(rows, filters.model_score(lambda: lambda ts: [0.1 for _ in ts]))
    assert scored.count() == 0
    found = tokens.report(rows, {}, sample_n=1)
    assert (found["total_docs"], found["details"]["total_tokens"]) == (4, 2)
    assert io.resolve_text_column(["id", "raw_content"]) == "raw_content"
