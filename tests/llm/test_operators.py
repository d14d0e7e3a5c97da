import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import decontamination, disclosure, language_id, line_dedup, ngram_join, piece_sampling, quality_model, quality_rules, revisits, token_files
from corpusloom.scratch import Scratch

LONG = " ".join(f"wörd{i}" for i in range(400))
TEXTS = ["", None, "a", "The end. The end.\nmail bob.x@mail.example.com or +1 (555) 555-8469, ip 10.0.0.300 and 10.0.0.30", LONG, LONG + " tail", "card 4111 1111 1111 1111 and 1234 5678 9012", "漢字 ▁ 🎉\r\n\t x", "İ ǅ don't A*B %%% <|endoftext|>."]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, s long, kind string, rank long"


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and clashing names."""
    rows = [(i, t, "en" if i % 2 else None, None if i == 3 else "src0", 1, 1, "x", None) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[4], (None, "null id", None, None, None, None, None, None)], SCHEMA)


def test_token_files(spark, docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = token_files.read_token_files(token_files.write_token_files(docs, Scratch(spark, "t"), path)).orderBy("start").collect()
    tokenizer = token_files.WordEncoder(path, 1).tokenizer
    ordered = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: -1 if r[0] is None else r[0])
    start = 0
    assert len(rows) == len(ordered)
    for row, (doc, text) in zip(rows, ordered, strict=True):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        assert (row["doc_id"], row["start"], row["n_tokens"], row["ids_crc32"]) == (doc, start, len(ids), zlib.crc32(ids))
        start += len(ids)
    assert token_files.read_token_files(token_files.write_token_files(docs.limit(0), Scratch(spark, "t"), path)).count() == 0


def test_pieces_are_lossless_and_reproducible(docs):
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = piece_sampling.encode_decode(docs, model).collect()
    assert all(r["lossless"] for r in rows) and len(rows) == docs.count()
    again = piece_sampling.encode_decode(docs.repartition(3), model).collect()
    assert sorted((r["doc_id"] or -1, r["ids_crc32"]) for r in rows) == sorted((r["doc_id"] or -1, r["ids_crc32"]) for r in again)


def test_no_piece_crosses_a_border():
    """Runs of spaces and marks are drawn as the whole text's lattice has it: counted by sums over all its segmentations."""
    s = piece_sampling.PieceSampler(public_tokenizers.path("piece_bpe_32k.model"))
    for text in ("f(x), (y). Wait... end", "  if x:\n    y = [1.5, '.'],  ../a", "a,b.c , d  . ▁,"):
        assert "".join(s.units(text)) == "▁" + text.replace("▁", piece_sampling._MARK).replace(" ", "▁")
        at, borders = 0, set()
        for u in s.units(text):
            borders.add(at := at + len(u))
        whole = "".join(s.units(text))
        assert not [p for p in s.weights for k in borders for a in range(max(0, k - len(p) + 1), k) if whole.startswith(p, a) and a + len(p) > k]
    text, n = "x),  y", 40_000
    got = [tuple(ids) for _, ids in s.encode(list(range(n)), [text] * n)]
    names = {i: p for p, (i, _) in s.weights.items()}
    whole = "▁x),▁▁y"

    def ways(at):
        return [((), 1.0)] if at == len(whole) else [((s.weights[p][0], *rest), s.weights[p][1] * w) for j in range(at + 1, len(whole) + 1) if (p := whole[at:j]) in s.weights for rest, w in ways(j)]

    want = dict(ways(0))
    total = sum(want.values())
    assert {"),", "▁▁"} <= {names[i] for ids in want for i in ids}
    for ids, w in want.items():
        assert abs(got.count(ids) / n - w / total) < 0.012


def test_lattices_filled_at_once_equal_those_filled_one_by_one():
    """Units of any length and script, also characters without a piece, cache resets and units over CACHE_CHARS."""
    rng, model = np.random.default_rng(5), public_tokenizers.path("piece_bpe_32k.model")
    alphabet = list("etaoinshr  ..,,(){}'\"▁\n\t\x00éßжя中語\U0001f600\U0010ffff") + ["the", " of", "ing", "..."]
    texts = ["".join(rng.choice(alphabet, n)) for n in (0, 1, 2, 5, 40, 300, 3000)] + ["x" * 200, "ab" * 50 + " a"]
    s = piece_sampling.PieceSampler(model)
    plain = piece_sampling.PieceSampler(model)
    plain._learn = lambda new: [plain._add(u) for u in new]
    keys = list(range(len(texts)))
    for _ in range(2):
        got = [(t, ids.tolist()) for t, ids in s.encode(keys, texts)]
        assert got == [(t, ids.tolist()) for t, ids in plain.encode(keys, texts)]
        assert all(s.decode(np.array(ids)) == texts[t] for t, ids in got)
        s.reset()
    whole = "▁the,▁(of)..▁中"
    ends, numbers = s._find(whole)
    names = list(s.weights)
    found = [(int(e), names[k]) for e, k in zip(ends, numbers, strict=True)]
    assert found == [(e, whole[b:e]) for e in range(1, len(whole) + 1) for b in range(e) if whole[b:e] in s.weights]


def test_piece_posterior():
    """Sampled segmentations of a unit occur as often as their weights say."""
    s = piece_sampling.PieceSampler(public_tokenizers.path("piece_bpe_32k.model"))
    unit, n = "▁the", 20_000
    ids, counts = s.sample([unit] * n, piece_sampling.mix(np.arange(n, dtype=np.uint64)))
    seen, at = {}, 0
    for c in counts:
        key = tuple(ids[at : at + c])
        seen[key] = seen.get(key, 0) + 1 / n
        at += c

    def ways(rest):
        if not rest:
            yield (), 1.0
        for k in range(1, len(rest) + 1):
            if rest[:k] in s.weights:
                i, w = s.weights[rest[:k]]
                yield from (((i, *tail), w * v) for tail, v in ways(rest[k:]))

    exact = dict(ways(unit))
    total = sum(exact.values())
    assert set(seen) <= set(exact)
    assert all(abs(seen.get(k, 0) - v / total) < 0.02 for k, v in exact.items())


def test_quality_rules(spark, docs):
    rows = quality_rules.judge(docs, Scratch(spark, "t")).collect()
    assert len(rows) == docs.count()
    assert quality_rules.measure("a b c a b c\nx\nx\n\n") == (8, 8, 0, 1, 6)
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["n_words"] < 50)
    assert quality_rules.judge(docs.limit(0), Scratch(spark, "t")).count() == 0


def test_fences_of_groups_against_sql(spark, monkeypatch):
    """250 documents in each of three groups, more than MIN_GROUP, and a small group that takes its language's fences."""
    import duckdb

    rng = np.random.default_rng(6)
    rows = []
    for i in range(790):
        words = ["".join(rng.choice(list("abcdefg"), rng.integers(2, 5 + 3 * (i % 3)))) for _ in range(rng.integers(55, 80))]
        if rng.random() < 0.15:
            words = [w + "#" * rng.integers(1, 9) if rng.random() < 0.5 else "long" * 9 for w in words]
        rows.append((i, " ".join(words) + ("\nsame\nsame" if rng.random() < 0.1 else ""), "en" if i % 3 else "fr", f"s{i % 3}" if i < 750 else "tiny"))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = quality_rules.judge(frame, Scratch(spark, "t")).toPandas().sort_values("doc_id").reset_index(drop=True)
    documents = frame.toPandas()  # noqa: F841  read by the SQL
    want = duckdb.sql(quality_rules.oracle()).df().sort_values("doc_id").reset_index(drop=True)
    assert 0 < (~got["kept"]).sum() < 700
    assert got.astype(str).equals(want[got.columns].astype(str))


def test_quality_model(spark, docs):
    good = [" ".join(f"w{(i * 7 + j * j) % 997}" for j in range(60)) for i in range(300)]
    bad = [" ".join(["spam"] * (40 + i % 9)) for i in range(300)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 300), 0) for i in range(600)], "doc_id long, quality int, toxic int")
    found = quality_model.score_documents(rows, labels).where("held_out").collect()
    assert np.mean([r["predicted"] == (r["doc_id"] < 300) for r in found]) > 0.95
    plain = quality_model.score_documents(docs, labels.limit(0)).collect()
    assert {r["score"] for r in plain} == {0.5} and len(plain) == docs.count()


def test_language_model_is_a_distribution():
    grams, n = np.unique(language_id.gram_codes(b"the cat sat on the mat, the hat"), return_counts=True)
    m = language_id.LanguageModel({"en": (grams.astype(np.int64), n.astype(float)), "xx": (np.array([0x61]), np.array([3.0]))})
    weights = np.ones(m.size)
    weights[-1] = 256 - (m.size - 1)
    for _, table in m.trees:
        assert np.allclose((2.0 ** -table.reshape(-1, m.size).astype(float) * weights).sum(1), 1, atol=1e-4)
    long = "the cat " * 50_000
    assert np.allclose(m.code_lengths([long.encode()])[0, 0], m._sums([long.encode()])[0, 0])
    assert m.predict(["the mat", "123", ""])[0] == ["en", "und", "und"]


def test_code_lengths_against_brute_force():
    """Escape method C with exclusion, byte by byte from the counts."""
    rng = np.random.default_rng(1)
    trained = [bytes(rng.choice(np.frombuffer(b"abcde \xc3", np.uint8), 400)), bytes(rng.choice(np.frombuffer(b"abxyz ", np.uint8), 300))]
    counts = {}
    for lang, t in zip(("aa", "bb"), trained, strict=True):
        grams, n = np.unique(language_id.gram_codes(t), return_counts=True)
        counts[lang] = (grams.astype(np.int64), n.astype(float))
    m = language_id.LanguageModel(counts)

    def bits(t, text):
        pad, total = b"\0\0\0" + t, 0.0
        for i in range(len(text)):
            before, b = (b"\0\0\0" + text)[i : i + 3], text[i]

            def p(k, out, before=before):
                """Probability of each byte by the k last bytes, over those not in out."""
                if k < 0:
                    return {x: 1 / 256 for x in range(256)}
                seen = {}
                for j in range(3, len(pad)):
                    if pad[j - k : j] == before[3 - k :]:
                        seen[pad[j]] = seen.get(pad[j], 0) + 1
                lower = p(k - 1, out)
                if not seen:
                    return lower
                n, d = sum(seen.values()), len(seen)
                left = sum(v for x, v in lower.items() if x not in seen)
                return {x: seen[x] / (n + d) if x in seen else d / (n + d) * lower[x] / left for x in range(256)}

            total -= np.log2(p(3, set())[b])
        return total

    text = bytes(rng.choice(np.frombuffer(b"abcdexyz q\xff", np.uint8), 40))
    assert np.allclose(m.code_lengths([text])[0], [bits(t, text) for t in trained], rtol=1e-4)


def test_many_languages_and_numbers_that_are_no_letters():
    rng = np.random.default_rng(1)
    counts = {}
    for k in range(40):
        grams, n = np.unique(language_id.gram_codes(bytes(rng.integers(0, 256, 3000, dtype=np.uint8))), return_counts=True)
        counts[f"l{k:02}"] = (grams.astype(np.int64), n.astype(float))
    m = language_id.LanguageModel(counts)
    assert m.nbytes() < 1.5 * language_id.MODEL_BYTES
    assert m.predict(["²½①Ⅷ 12", "a²"])[0][0] == "und" and m.predict(["a²"])[0][0] != "und"


def test_language_id_of_long_repeated_and_no_rows(spark):
    texts = ["the cat sat on the mat " * 30_000, "le chat dort sur le lit " * 3, "the cat sat", "le chat dort", "", None]
    frame = spark.createDataFrame([(i, t, ("en", "fr")[i % 2]) for i, t in enumerate([*texts, *texts])], "doc_id long, text string, lang string")
    got = {(r["doc_id"] % 6, r["lang_pred"]) for r in language_id.predict_languages(frame, Scratch(spark, "t")).collect()}
    assert got == {(0, "en"), (1, "fr"), (2, "en"), (3, "fr"), (4, "und"), (5, "und")}
    assert language_id.predict_languages(frame.limit(0), Scratch(spark, "t")).count() == 0


def test_language_id(spark, docs):
    rows = language_id.predict_languages(docs, Scratch(spark, "t")).collect()
    assert len(rows) == docs.count()
    assert all(r["lang_pred"] == "und" for r in rows if r["doc_id"] in (0, 1))


def components(texts):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    group[i] = group[j] = min(group[i], group[j])
    return sets, group


def test_regions_are_split_into_cells_and_windows_spare_pairs():
    """Clusters of sets at distances below 1 from each other: Voronoi splits, replication at borders and windows all act, and the links are exact."""
    rng = np.random.default_rng(2)
    done = {"splits": 0, "replicated": 0, "spared": 0}
    for _ in range(6):
        sets, base = [], rng.integers(0, 2**63, 40, dtype=np.uint64)
        for _ in range(5):
            center = np.concatenate([base[:4], rng.integers(0, 2**63, 56, dtype=np.uint64)])
            for _ in range(8):
                sets.append(np.unique(np.concatenate([center[rng.random(60) > rng.random() * 0.3], rng.integers(0, 2**63, rng.integers(0, 12), dtype=np.uint64)])))
        r = ngram_join.Region(np.arange(len(sets)), sets)
        r.join(np.arange(len(sets)))
        for name in done:
            done[name] += r.done[name]
        group = list(range(len(sets)))

        def root(i, group=group):
            while group[i] != i:
                i = group[i]
            return i

        for i, a in enumerate(sets):
            for j in range(i):
                both = len(np.intersect1d(a, sets[j]))
                if 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                    x, y = sorted((root(i), root(j)))
                    group[y] = x
        by_id = np.argsort(r.ids)
        found = r.roots()
        assert [[root(i) == root(j) for j in range(i)] for i in range(len(sets))] == [[found[by_id[i]] == found[by_id[j]] for j in range(i)] for i in range(len(sets))]
    assert min(done.values()) > 0, done


def test_packed_columns_come_back():
    rng = np.random.default_rng(0)
    columns = [rng.integers(0, 2**63, 77).astype("u8"), rng.integers(0, 2**31, 77).astype("u4"), rng.integers(-9, 9, 77)]
    assert all((a == b).all() for a, b in zip(columns, ngram_join.unpack(ngram_join.pack(*columns), 77, "u8", "u4", "i8"), strict=True))


def test_heavy_region_is_split_by_pivots_of_all_executors(spark, monkeypatch):
    """Near copies in four clusters that share shingles: too heavy for a task, met by pivots, cells and, where these don't part, blocks."""
    monkeypatch.setattr(ngram_join, "REGION_SHINGLES", 600)
    monkeypatch.setattr(ngram_join, "BROADCAST_BYTES", 10_000)
    rng = np.random.default_rng(4)
    common = [f"c{i}" for i in range(9)]
    texts = []
    for k in range(4):
        words = [*common, *(f"k{k}w{i}" for i in range(70))]
        for _ in range(25):
            own = [w if rng.random() > 0.004 else f"x{rng.integers(10**9)}" for w in words]
            texts.append(" ".join(own))
    sets, group = components(texts)
    scratch = Scratch(spark, "t")
    rows = {r["doc_id"]: r for r in ngram_join.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), scratch).collect()}
    assert [rows[i]["component_id"] for i in range(len(texts))] == group
    assert spark.read.parquet(scratch.path("measured-0-0")).count() > 5


@pytest.mark.parametrize("limits", [{}, {"REGION_SHINGLES": 200, "CELL_DOCS": 2, "CELL_PIVOTS": 3, "BROADCAST_IDS": 0, "BUCKET_POSTINGS": 300, "PACKED_DOCS": 4}])
def test_ngram_join(spark, docs, limits, monkeypatch):
    for name, value in limits.items():
        monkeypatch.setattr(ngram_join, name, value)
    words = [f"w{i}" for i in range(120)]
    texts = [*TEXTS, " ".join(words), " ".join(words[:110]), " ".join([*words[:60], "x", *words[60:]]), " ".join(words[:60]), "one two", "One TWO", " ".join(words[5:])]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets, group = components(texts)
    rows = {r["doc_id"]: r for r in ngram_join.near_duplicates(frame, Scratch(spark, "t")).collect()}
    assert [(rows[i]["n_shingles"], rows[i]["component_id"]) for i in range(len(texts))] == [(len(s), g) for s, g in zip(sets, group, strict=True)]
    if not limits:
        got = {(r["doc_id"], r["component_id"]) for r in ngram_join.near_duplicates(docs, Scratch(spark, "t")).collect()}
        assert {(None, None), (4, 4), (5, 4), (0, 0)} <= got and len(got) == docs.count() - 1  # a repeated row; a null id links with nothing
        assert ngram_join.near_duplicates(docs.limit(0), Scratch(spark, "t")).count() == 0


def test_sketches_lose_no_link():
    """Sets of 1 to 300 shingles, copies that differ by a few: pairs that link are tied by their sketches whatever the sizes of these, strangers aren't."""
    rng = np.random.default_rng(5)
    sets = []
    for n in [1, 2, 5, 9, 16, 30, 32, 33, 40, 63, 64, 65, 120, 128, 140, 256, 300]:
        own = rng.integers(0, 2**63, n, dtype=np.uint64)
        for gone in (0.0, 0.05, 0.1, 0.2):
            sets.append(np.unique(np.concatenate([own[rng.random(n) >= gone], rng.integers(0, 2**63, int(n * gone * 0.5), dtype=np.uint64), own[:1]])))
    n = np.array([len(s) for s in sets])
    bitmaps = ngram_join.sketches(np.concatenate(sets), n)
    assert all(2 * k <= 8 * len(b) <= max(64, 4 * k) for k, b in zip(n.tolist(), bitmaps, strict=True))
    group = list(range(len(sets)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a, b in ngram_join.may_link(list(range(len(sets))), n.tolist(), bitmaps):
        x, y = sorted((root(a), root(b)))
        assert x != y  # a forest
        group[y] = x
    linked = straddle = 0
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(np.intersect1d(a, sets[j]))
            if 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                linked, straddle = linked + 1, straddle + (len(bitmaps[i]) != len(bitmaps[j]))
                assert root(i) == root(j)
            assert both or root(i) != root(j)
    assert linked > 50 and straddle


@pytest.mark.parametrize("limits", [{}, {"SKETCHED": 0.0002, "SKETCH_BLOCKS": 100}, {"SKETCHED_PAIRS": 0.0005, "SKETCH_BLOCKS": 100, "BROADCAST_IDS": 0}, {"SKETCHED": 0.0002, "SKETCH_BLOCKS": 1}])
def test_a_set_travels_once(spark, monkeypatch, limits):
    """Documents of two passages each, on a grid, so that they meet others in several regions, and near copies of some: only what may link travels, and once."""
    for name, value in limits.items():
        monkeypatch.setattr(ngram_join, name, value)
    shipped, join_regions = [], ngram_join.join_regions
    monkeypatch.setattr(ngram_join, "join_regions", lambda regions, keys: shipped.extend(r["member"] for r in regions.select("member").collect()) or join_regions(regions, keys))
    passage = lambda name: [f"{name}w{i}" for i in range(25)]
    texts = [[*passage(f"a{i}"), *(f"o{i}x{j}w{k}" for k in range(25)), *passage(f"b{j}")] for i in range(6) for j in range(6)]
    texts += [[*w[:40], "new", *w[41:]] for w in texts[:8]]
    texts = [" ".join(w) for w in texts]
    sets, group = components(texts)
    scratch = Scratch(spark, "t")
    rows = {r["doc_id"]: r for r in ngram_join.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), scratch).collect()}
    assert [(rows[i]["n_shingles"], rows[i]["component_id"]) for i in range(len(texts))] == [(len(s), g) for s, g in zip(sets, group, strict=True)]
    assert sum(g != i for i, g in enumerate(group)) == 8
    if limits.get("SKETCH_BLOCKS") == 1:  # parts beyond the bounds of sketches travel as they are
        assert len(shipped) > len(set(shipped)) > 16
    else:
        assert len(shipped) == len(set(shipped)) == 16
    if limits:
        blocks = [r["blocks"] for r in spark.read.parquet(scratch.path("blocks")).collect()]
        assert max(blocks) > 2


def test_decontamination(spark, docs):
    item = " ".join(f"q{i}" for i in range(20))
    items = spark.createDataFrame([(1, item), (2, "two words"), (3, None), (4, "..."), (1, item)], "item_id long, text string")
    texts = [f"{LONG} {item}, {LONG}", " ".join(item.split()[:18]), " ".join(item.split()[:10]), "has TWO, words in it", None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["n_item"], r["n_shared"]) for r in decontamination.contaminated(frame, items, Scratch(spark, "t")).collect()}
    assert got == {(0, 1, 16, 16), (1, 1, 16, 14), (3, 2, 1, 1)}
    assert decontamination.decontaminate(docs, items, Scratch(spark, "t")).columns == docs.columns
    assert decontamination.contaminated(docs, items.limit(0), Scratch(spark, "t")).count() == 0


def test_decontamination_finds_nearly_all_and_founds_no_pairs_on_a_common_passage(spark):
    """Random items of 5 to 60 words, each with 0.8 of its shingles or just less in documents; and 40 items and 60 documents that share a passage."""
    rng = np.random.default_rng(3)
    word = lambda: f"z{rng.integers(10**9)}"
    items = [[word() for _ in range(rng.integers(5, 60))] for _ in range(60)]
    docs, want = [], set()
    for i, item in enumerate(items):
        for part in (1.0, 0.85, 0.7):
            kept = item[: max(5, round(len(item) * part))]
            if 100 * (len(kept) - 4) >= 80 * (len(item) - 4):
                want.add((len(docs), i))
            docs.append([*(word() for _ in range(300)), *kept, *(word() for _ in range(300))])
    common = [word() for _ in range(12)]
    items += [[*common, *(word() for _ in range(30))] for _ in range(40)]
    docs += [[*(word() for _ in range(50)), *common] for _ in range(60)]
    frame, known = (spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(x)], f"{n} long, text string") for x, n in ((docs, "doc_id"), (items, "item_id")))
    scratch = Scratch(spark, "t")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(frame, known, scratch).collect()}
    assert got <= want and len(got) >= 0.99 * len(want)
    assert spark.read.parquet(scratch.path("candidates")).where("doc_id >= 180").count() == 0


def test_decontamination_finds_items_of_one_shingle_in_long_documents(spark):
    items = [" ".join(f"k{i}x{j}" for j in range(5)) for i in range(20)]
    frame = spark.createDataFrame([(i, f"{LONG} {item} {LONG}") for i, item in enumerate(items)], "doc_id long, text string")
    known = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["n_item"], r["n_shared"]) for r in decontamination.contaminated(frame, known, Scratch(spark, "t")).collect()}
    assert got == {(i, i, 1, 1) for i in range(20)}


#: Names that the operators use for columns of their own.
HELPERS = ["gone", "g_id", "gone_id", "gone_hash", "lines", "lines__", "text_hash", "text_hash__", "id", "hash", "row", "n", "all", "s_id", "s_hash", "shares", "gone_lines", "n_pieces", "lossless", "piece_ids", "poster", "uid", "component_id", "kept", "score"]


@pytest.mark.parametrize("run", [
    lambda d, i, s: line_dedup.dedup_lines(d, s), lambda d, i, s: line_dedup.drop_lines(d, s), lambda d, i, s: line_dedup.drop_lines(d.drop("n_chars"), s), lambda d, i, s: decontamination.decontaminate(d, i, s),
    lambda d, i, s: ngram_join.keep_one(d, s), lambda d, i, s: disclosure.sanitise(d, s), lambda d, i, s: piece_sampling.tokenise(d, public_tokenizers.path("piece_bpe_32k.model")), lambda d, i, s: quality_model.keep_good(d, d.selectExpr("doc_id", "1 as quality")),
])
def test_columns_of_any_name_are_kept(spark, docs, run):
    wide = docs.select("*", *(F.lit(f"own {c}").alias(c) for c in HELPERS))
    items = spark.createDataFrame([(1, "two words")], "item_id long, text string")
    for frame in (wide, wide.limit(0)):
        out = run(frame, items, Scratch(spark, "t"))
        kept = [c for c in HELPERS if c not in {"gone_lines", "n_pieces", "lossless", "piece_ids"}]
        assert set(kept) <= set(out.columns) and len(out.columns) == len(set(out.columns))
        assert out.where(" or ".join(f"`{c}` <> 'own {c}'" for c in kept)).count() == 0


def test_line_dedup(spark, docs):
    a, b, c = ("x" * 200, "y" * 90, "z" * 90)
    texts = [f"{a}\n{b}\n{c}", f"{a}\nown\n{b}", f"new\n{b}\n\n{c}\nend", f"{b}", None, "", f"{a}\n{a}"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["gone_lines"]) for r in line_dedup.dedup_lines(frame, Scratch(spark, "t")).collect()}
    assert got == {0: (texts[0], 0), 1: (f"own\n{b}", 1), 2: ("new\n\nend", 2), 3: (b, 0), 4: (None, 0), 5: ("", 0), 6: ("", 2)}
    assert line_dedup.drop_lines(docs, Scratch(spark, "t")).columns == docs.columns
    assert line_dedup.dedup_lines(docs.limit(0), Scratch(spark, "t")).count() == 0


def test_disclosure(spark, docs):
    rows = {r["doc_id"]: r for r in disclosure.digest(docs.where("doc_id is not null").distinct(), Scratch(spark, "t")).collect()}
    for i, t in enumerate(TEXTS):
        assert rows[i]["base_sha256"] == brute.base_sha256(t or "")
    near = [f"filler{i} secretname wrote bob@mail.example.com about {w}" for i, w in enumerate(("plums", "pears"))]
    frame = spark.createDataFrame(list(enumerate([*near, *(f"filler{i} wrote about other things {i}" for i in range(9, 60))])), "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in disclosure.sanitise(frame, Scratch(spark, "t")).collect()}
    assert "secretname" not in clean[0] and "[EMAIL]" in clean[0] and "filler0" in clean[0]
    assert clean[2] == frame.where("doc_id = 2").first()["text"]


def test_disclosure_of_an_entity_in_one_text(spark):
    texts = ["write to onlyname at solo@mail.example.com or to the others", *(f"write to the others at home or at {i}" for i in range(60))]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in disclosure.sanitise(frame, Scratch(spark, "t")).collect()}
    assert clean[0] == "write to [TERM] at [EMAIL] or to the others"
    assert [clean[i] for i in range(1, 61)] == texts[1:]


def test_disclosure_far_from_the_entity(spark):
    common = " ".join(["the others write home again"] * 12)
    texts = [f"Farname: {common} solo@mail.example.com {common} FARNAME", *(f"{common} {i}" for i in range(60))]
    frame = spark.createDataFrame([*enumerate(texts), (61, texts[0])], "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in disclosure.sanitise(frame, Scratch(spark, "t")).collect()}
    assert clean[0] == clean[61] == f"[TERM]: {common} [EMAIL] {common} [TERM]"
    assert [clean[i] for i in range(1, 61)] == texts[1:]


@pytest.mark.parametrize("seed", range(2))
def test_disclosure_against_brute_force(spark, seed):
    """Terms of random texts, some copied, with entities in one text or several."""
    rng = np.random.default_rng(seed)
    texts = [" ".join([*(f"w{k}" for k in rng.zipf(1.4, 30)), *(f"u{k}@mail.example.com" for k in rng.zipf(1.6, rng.integers(0, 3)))]) for _ in range(150)]
    texts += texts[:9]
    got = {r["doc_id"]: r["spans"] for r in disclosure.digest(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), Scratch(spark, "t")).collect()}
    assert got == {i: brute.disclosed(texts, t) for i, t in enumerate(texts)}
    assert sum("term" in x for x in got.values()) > 20


@pytest.mark.parametrize("bits", [16, 2])
def test_revisits(spark, bits, monkeypatch):
    monkeypatch.setattr(revisits, "DIGIT_BITS", bits)
    rows = [
        (1, 10, "http://www.A.com:80/p/?utm_x=1#f", "response", '"e1"', None, {"ETag": '"e1"', "Content-Length": "5", "age": "0", "Age": "1"}),
        (2, 20, "https://a.com/p", "revisit", 'W/"e1"', None, {"age": "9", "content-length": "0"}),
        (3, 20, "https://a.com/p", "response", '"e2"', None, None),
        (4, 30, "https://a.com/p", "revisit", '"e1"', None, None),
        (5, 5, "https://a.com/p", "revisit", '"e1"', None, None),
        (6, 40, None, "revisit", '"e1"', None, None),
        (7, None, "https://a.com/p", "revisit", '"e1"', None, None),
        (8, 50, "https://a.com/p", "revisit", None, None, None),
    ]
    frame = spark.createDataFrame(rows, "record_id long, ts long, url string, kind string, etag string, last_modified string, headers map<string,string>")
    got = {r["record_id"]: (r["response_id"], r["status"], r["headers"]) for r in revisits.resolve(frame, Scratch(spark, "t")).collect()}
    assert got[2] == (1, "resolved", {"etag": '"e1"', "content-length": "5", "age": "9"})
    assert {k: v[:2] for k, v in got.items() if k != 2} == {4: (3, "mismatch"), 5: (None, "no_response"), 6: (None, "no_response"), 7: (None, "no_response"), 8: (3, "no_validator")}


def test_revisits_by_last_modified(spark):
    rows = [(1, 1, "http://a.com/p", "response", None, "Mon", None), (2, 2, "http://a.com/p", "revisit", None, "Mon", None), (3, 2, "http://a.com/p", "revisit", None, "Tue", None), (4, 2, "http://a.com/p", "revisit", '"e"', "Mon", None)]
    frame = spark.createDataFrame(rows, "record_id long, ts long, url string, kind string, etag string, last_modified string, headers map<string,string>")
    got = {r["record_id"]: r["status"] for r in revisits.resolve(frame, Scratch(spark, "t")).collect()}
    assert got == {2: "resolved", 3: "mismatch", 4: "no_validator"}  # an entity tag that only the revisit has can't be checked, and takes precedence


@pytest.mark.parametrize("bits", [16, 3])
def test_revisits_against_brute_force(spark, bits, monkeypatch):
    """Random captures with ties, repeated rows and times on both sides of zero."""
    monkeypatch.setattr(revisits, "DIGIT_BITS", bits)
    rng = np.random.default_rng(5)
    spread = [int(t) for t in rng.integers(-300, 300, 240)]
    if bits == 16:
        spread[:4] = [-(2**63), 2**63 - 1, 0, -1]
    rows = [(i, t, f"http://h.com/{rng.integers(4)}", "response" if rng.integers(2) else "revisit", str(rng.integers(2)), None, None) for i, t in enumerate(spread)]
    rows += rows[:20]
    frame = spark.createDataFrame(rows, "record_id long, ts long, url string, kind string, etag string, last_modified string, headers map<string,string>").withColumn("extra", revisits.F.lit(1))
    want = []
    for i, ts, url, kind, etag, *_ in rows:
        if kind == "revisit":
            full = max(((r[1], r[0], r[4]) for r in rows if r[2] == url and r[3] == "response" and r[1] < ts), default=None)
            want.append((i, full and full[1], "no_response" if full is None else "resolved" if full[2] == etag else "mismatch"))
    got = [(r["record_id"], r["response_id"], r["status"]) for r in revisits.resolve(frame, Scratch(spark, "t")).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert revisits.resolve(frame.limit(0), Scratch(spark, "t")).count() == 0
