"""Operator 7: language identification by prediction by partial matching.

For each language a tree of byte contexts of up to ``ORDER`` bytes is frozen from training text. The probability of a
byte is that of its longest known context with escape method C and exclusion: a context seen n times with d different
followers gives a follower seen c times c / (n + d), and passes d / (n + d) on to the next shorter context, renormalised
without those followers; below the empty context all 256 bytes are alike. Since the counts are frozen, the exact code
length of every byte after every kept context is tabulated once, and a text's code length in a language is a sum of table
entries, taken in vectorised form over whole texts. The prediction is the language of the shortest code; score is its
posterior under equal priors.

The classifier is fitted on a bounded sample: per language about ``SAMPLE_DOCS`` documents of the smallest hashes
(all, if it has fewer), whole texts. Per language the ``CONTEXTS`` most frequent contexts of each order above 1 are kept, or fewer
if there are so many languages that the model would exceed about ``MODEL_BYTES``; bytes after others are coded by their longest kept
suffix. One index of all contexts serves all languages, each of which has a row of code lengths for every context in it.

Defined cases: ``und`` and score 0 for null texts and texts without a letter, and for all if there's nothing to learn from;
ties go to the language first in order; null doc_ids are predicted and not held out; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.texts import bounded_batches, forget, id_and_text, rows_of
from corpusloom.scratch import Scratch

ORDER, SAMPLE_DOCS, CONTEXTS, MODEL_BYTES = 3, 1000, 8192, 400_000_000
#: Bytes scored at a time.
BLOCK = 1 << 18
_WORDLIKE = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Superscripts, fractions and number forms match the pattern too, but are none."""
    return any(m[0].isalpha() for m in _WORDLIKE.finditer(text))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def gram_codes(text: bytes) -> np.ndarray:
    """Each byte with the three before it (zeros before the text) as an unsigned 32-bit number."""
    a = np.frombuffer(b"\0" * ORDER + text, np.uint8).astype(np.uint32)
    return (a[:-3] << 24) | (a[1:-2] << 16) | (a[2:-1] << 8) | a[3:]


def gram_counts(sample: DataFrame) -> DataFrame:
    """lang, gram, n of a frame of (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by = defaultdict(list)
            for lang, text in rows_of(batch, "lang", "text"):
                by[lang].append(gram_codes(text.encode()))
            for lang, parts in by.items():
                grams, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(grams), pa.string()), "gram": pa.array(grams.astype(np.int64)), "n": pa.array(n.astype(np.int64))})

    return sample.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class ContextTree:
    """Code lengths in bits under one language's frozen counts, by kept contexts of each order."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, letters: np.ndarray, most: int):
        """letters: maps a byte to its index in the alphabet of all languages; the last index stands for bytes seen in none.
        most: contexts kept of each order above 1, the most frequent ones whose suffix is kept."""
        size = int(letters.max()) + 1
        spare = 256 - (size - 1)  # bytes that the last index stands for
        idx = [letters[(grams >> s) & 255].astype(np.int64) for s in (24, 16, 8, 0)]
        lower = np.full((1, size), 1 / 256.0)
        rows = np.zeros(1, np.int64)  # of each context of the next shorter order, its row in lower
        self.size, self.tables, self.keys = size, [], []
        for k in range(ORDER + 1):
            key = np.zeros(len(grams), np.int64)
            for j in range(k):
                key = key * size + idx[3 - k + j]
            contexts, inverse = np.unique(key, return_inverse=True)
            seen = np.bincount(inverse, n, len(contexts))
            kept = np.flatnonzero(np.isin(contexts % size ** (k - 1), rows)) if k else np.arange(len(contexts))
            if k > 1 and len(kept) > most:
                kept = np.sort(kept[np.argsort(-seen[kept], kind="stable")[:most]])
            place = np.full(len(contexts), -1)
            place[kept] = np.arange(len(kept))
            use = place[inverse] >= 0
            count = np.zeros((len(kept), size))
            np.add.at(count, (place[inverse[use]], idx[3][use]), n[use])
            contexts = contexts[kept]
            below = lower[np.searchsorted(rows, contexts % size ** (k - 1))] if k else np.repeat(lower, len(kept), axis=0)
            met = count > 0
            weight = np.ones(size)
            weight[-1] = spare  # the last index stands for so many bytes
            total, kinds = count.sum(1, keepdims=True), met.sum(1, keepdims=True)
            left = np.where(met, 0, below * weight).sum(1, keepdims=True)
            table = np.where(met, count / (total + kinds), kinds / (total + kinds) * below / np.maximum(left, 1e-12))
            lower, rows = table, contexts
            self.tables.append(table)
            self.keys.append(contexts)
        self.bits = -np.log2(np.maximum(np.concatenate(self.tables), 1e-30)).astype(np.float32)

    def rows_of(self, contexts: np.ndarray) -> np.ndarray:
        """Of contexts of the full order the row of the longest kept suffix."""
        out, first = np.zeros(len(contexts), np.int32), 0
        for k, keys in enumerate(self.keys):
            suffix = contexts % self.size**k
            at = np.minimum(np.searchsorted(keys, suffix), max(len(keys) - 1, 0))
            found = keys[at] == suffix if len(keys) else np.zeros(len(contexts), bool)
            out[found] = first + at[found]
            first += len(keys)
        return out


class LanguageModel:
    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = sorted(counts)
        found = np.zeros(256, bool)
        for grams, _ in counts.values():
            for s in (0, 8, 16, 24):
                found[(grams >> s) & 255] = True
        self.letters = np.full(256, int(found.sum()), np.int16)
        self.letters[found] = np.arange(found.sum())
        self.size = size = int(found.sum()) + 1
        # a language has rows of tables and, for every context in the index, a row's number
        most = min(CONTEXTS, max(1, MODEL_BYTES // (4 * max(1, len(counts)) * (2 * size + len(counts)))))
        trees = [ContextTree(*counts[lang], self.letters.astype(np.int64), most) for lang in self.langs]
        # shorter contexts come first, as those of the full order that begin with the last index, which no text has there
        full = np.unique(np.concatenate([t.keys[ORDER] for t in trees])) if trees else np.zeros(0, np.int64)
        shorter = (size - 1) * size ** (ORDER - 1) + np.arange(size ** (ORDER - 1))
        self.index = np.tile(np.arange(size ** (ORDER - 1), dtype=np.int32), size)
        self.index[full] = size ** (ORDER - 1) + np.arange(len(full), dtype=np.int32)
        self.trees = [(np.concatenate([t.rows_of(shorter), t.rows_of(full)]), t.bits.ravel()) for t in trees]

    def nbytes(self) -> int:
        return self.index.nbytes + sum(a.nbytes + b.nbytes for a, b in self.trees)

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text in each language."""
        out = np.zeros((len(texts), len(self.langs)))
        i = 0
        while i < len(texts):
            j, total = i, 0
            while j < len(texts) and (j == i or total + len(texts[j]) < BLOCK):
                total += len(texts[j])
                j += 1
            if j == i + 1 and len(texts[i]) > BLOCK:  # a long text by blocks, each with the bytes before it
                for a in range(0, len(texts[i]), BLOCK):
                    out[i] += self._sums([texts[i][a : a + BLOCK]], texts[i][max(0, a - ORDER) : a])[0]
            else:
                out[i:j] = self._sums(texts[i:j])
            i = j
        return out

    def _sums(self, texts: list[bytes], before: bytes = b"") -> np.ndarray:
        gap = (b"\0" * ORDER + before)[-ORDER:]
        joined = self.letters[np.frombuffer(gap + (b"\0" * ORDER).join(texts), np.uint8)].astype(np.int32)
        context = self.index[(joined[:-3] * self.size + joined[1:-2]) * self.size + joined[2:-1]]
        symbol = joined[3:]
        lengths = np.array([len(t) for t in texts])
        starts = np.concatenate(([0], np.cumsum(lengths + ORDER)[:-1]))
        bounds = np.stack([starts, starts + lengths], 1).ravel()
        out = np.zeros((len(texts), len(self.langs)))
        for k, (place, table) in enumerate(self.trees):
            bits = np.append(table[place[context] * self.size + symbol], np.float32(0)).astype(np.float64)
            sums = np.add.reduceat(bits, np.minimum(bounds, len(bits) - 1))[::2]
            out[:, k] = np.where(lengths > 0, sums, 0)
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        if not self.langs:
            return ["und"] * len(texts), [0.0] * len(texts)
        bits = self.code_lengths([t.encode() for t in texts])
        best = bits.argmin(1)
        posterior = 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
        spoken = [has_letter(t) for t in texts]
        return [self.langs[b] if s else "und" for b, s in zip(best, spoken, strict=True)], [float(p) if s else 0.0 for p, s in zip(posterior, spoken, strict=True)]


def train(docs: DataFrame, scratch: Scratch) -> LanguageModel:
    """The frozen model of the learnable documents of ``docs``."""
    bounded_batches(docs.sparkSession)
    learned = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text").where("lang is not null and text is not null").where(~held_out())
    sizes = {r["lang"]: r["n"] for r in learned.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row a language
    if not sizes:
        return LanguageModel({})
    share = F.element_at(F.create_map(*(F.lit(v) for k, n in sizes.items() for v in (k, min(1.0, SAMPLE_DOCS / n)))), F.col("lang"))
    sample = learned.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30)).select("lang", "text")
    counts = scratch.save(gram_counts(sample), "grams").toPandas()
    return LanguageModel({lang: (g["gram"].to_numpy(np.int64), g["n"].to_numpy(float)) for lang, g in counts.groupby("lang")})


def predict_languages(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    spark = docs.sparkSession
    model = train(docs, scratch)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            pred, score = shared.value.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "lang_pred": pa.array(pred, pa.string()), "score": pa.array(score, pa.float64())})

    found = id_and_text(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
