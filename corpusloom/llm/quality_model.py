"""Operator 3: quality classifier, a generalised additive model with pairwise interactions.

Each feature is binned by quantiles; cyclic boosting visits the features in turn and each time adds a shrunken shallow
tree on that feature alone to the feature's lookup table. Then the pairs of features whose grid explains most of what is
left get tables of their own, boosted by trees of one cut on either axis. The score is the logistic of the sum of table
entries: vectorised additions of bins.

The model is fitted on the driver on at most ``SAMPLE_ROWS`` labelled rows (those of the smallest hash of doc_id): numbers
only, under 5 MB. Tables hold at most features * ``BINS`` + ``PAIRS`` * ``PAIR_BINS`` ** 2 numbers.

Defined cases: null text counts as empty, and an empty text has all-zero features and a score like any other; a document
with contradictory labels isn't learned from; without labels every score is 0.5; null doc_ids are scored and count as not
held out; repeated rows are scored alike; other columns, lang and source among them, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.quality_rules import SYMBOLS
from corpusloom.llm.texts import bounded_batches, forget, id_and_text, rows_of, words_of

SAMPLE_ROWS, BINS, PAIR_BINS, PAIRS = 20_000, 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, LEAF_ROWS, RIDGE = 120, 60, 0.1, 10, 1.0
FEATURES = ["chars", "words", "word_length", "symbols", "repeats", "dup_lines", "distinct", "twins", "capitals", "digits", "marks", "line_words", "short_words"]


def features(text: str) -> list[float]:
    words = words_of(text)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    windows = set(zip(words, words[1:], words[2:], strict=False))
    chars = sum(map(len, words))
    return [
        float(np.log1p(len(text))), float(np.log1p(n)), chars / n, sum(map(text.count, SYMBOLS)) / n, 1 - len(windows) / (n - 2) if n > 2 else 0.0,
        1 - len(set(lines)) / len(lines), len(set(words)) / n, sum(map(str.__eq__, words, words[1:])) / n, sum(map(str.isupper, words)) / n,
        sum(map(text.count, "0123456789")) / chars, (text.count(".") + text.count(",") + text.count("?") + text.count("!")) / n, n / len(lines), sum(len(w) < 4 for w in words) / n,
    ]


def feature_table(docs: DataFrame) -> DataFrame:
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            got = [features(t) for (t,) in rows_of(batch, "text")]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0)} | {f: pa.array([g[i] for g in got], pa.float64()) for i, f in enumerate(FEATURES)})

    return id_and_text(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES))


@dataclass
class AdditiveModel:
    """Lookup tables over bins of features and of pairs of features."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)])

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        if not self.edges:
            return out
        b = self.bins(x)
        for j, t in enumerate(self.tables):
            out += t[b[j]]
        for (i, j), g in zip(self.pairs, self.grids, strict=True):
            out += g[self.coarse[i][b[i]], self.coarse[j][b[j]]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _best_cut(g: np.ndarray, h: np.ndarray, n: np.ndarray, lo: int, hi: int) -> tuple[float, int]:
    """Gain and place of the best cut of bins lo..hi."""
    cg, ch, cn = (np.cumsum(v[lo:hi]) for v in (g, h, n))
    left, right = slice(None, -1), -1
    ok = (cn[left] >= LEAF_ROWS) & (cn[right] - cn[left] >= LEAF_ROWS)
    if not ok.any():
        return 0.0, lo
    gain = cg[left] ** 2 / (ch[left] + RIDGE) + (cg[right] - cg[left]) ** 2 / (ch[right] - ch[left] + RIDGE) - cg[right] ** 2 / (ch[right] + RIDGE)
    k = int(np.argmax(np.where(ok, gain, -1)))
    return float(gain[k]), lo + k + 1


def _shallow_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Leaf values over the bins of one feature."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        gain, cut, k = max((*_best_cut(g, h, n, *p), i) for i, p in enumerate(parts))
        if gain <= 1e-9:
            break
        lo, hi = parts.pop(k)
        parts += [(lo, cut), (cut, hi)]
    out = np.zeros(len(g))
    for lo, hi in parts:
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + RIDGE)
    return out


def _cross_cut(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree with one cut on either axis of a grid."""
    cg, ch, cn = (v.cumsum(0).cumsum(1) for v in (g, h, n))
    parts = [(c[:-1, :-1], c[:-1, -1:] - c[:-1, :-1], c[-1:, :-1] - c[:-1, :-1], c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + c[:-1, :-1]) for c in (cg, ch, cn)]
    ok = np.all([q >= LEAF_ROWS for q in parts[2]], axis=0)
    gain = sum(a**2 / (b + RIDGE) for a, b in zip(parts[0], parts[1], strict=True)) - cg[-1, -1] ** 2 / (ch[-1, -1] + RIDGE)
    out = np.zeros(g.shape)
    if not ok.any():
        return 0.0, out
    r, c = np.unravel_index(int(np.argmax(np.where(ok, gain, -1))), ok.shape)
    for rows in (slice(0, r + 1), slice(r + 1, None)):
        for cols in (slice(0, c + 1), slice(c + 1, None)):
            out[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + RIDGE)
    return float(gain[r, c]), out


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting of the tables of single features, then of pairs."""
    m = AdditiveModel(base=float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))))
    if len(y) < 4 * LEAF_ROWS or not 0 < y.sum() < len(y):
        return m
    for j in range(x.shape[1]):
        m.edges.append(np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])))
    b, k = m.bins(x), [len(e) + 1 for e in m.edges]
    m.tables = [np.zeros(n) for n in k]
    m.coarse = [np.arange(n) * min(PAIR_BINS, n) // n for n in k]
    total = np.full(len(y), m.base)
    counts = [np.bincount(b[j], minlength=k[j]) for j in range(len(k))]
    for _ in range(ROUNDS):
        for j in range(len(k)):
            p = 1 / (1 + np.exp(-total))
            step = RATE * _shallow_tree(np.bincount(b[j], y - p, k[j]), np.bincount(b[j], p * (1 - p), k[j]), counts[j])
            m.tables[j] += step
            total += step[b[j]]

    def grid(i: int, j: int, p: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
        ni, nj = m.coarse[i][-1] + 1, m.coarse[j][-1] + 1
        at = m.coarse[i][b[i]] * nj + m.coarse[j][b[j]]
        return at, tuple(np.bincount(at, w, ni * nj).reshape(ni, nj) for w in (y - p, p * (1 - p), np.ones(len(y))))

    p = 1 / (1 + np.exp(-total))
    ranked = sorted(((_cross_cut(*grid(i, j, p)[1])[0], i, j) for i, j in combinations(range(len(k)), 2) if k[i] > 1 and k[j] > 1), reverse=True)
    m.pairs = [(i, j) for gain, i, j in ranked[:PAIRS] if gain > 0]
    m.grids = [np.zeros((m.coarse[i][-1] + 1, m.coarse[j][-1] + 1)) for i, j in m.pairs]
    for _ in range(PAIR_ROUNDS):
        for q, (i, j) in enumerate(m.pairs):
            p = 1 / (1 + np.exp(-total))
            at, stats = grid(i, j, p)
            step = RATE * _cross_cut(*stats)[1]
            m.grids[q] += step
            total += step.ravel()[at]
    return m


def held_out() -> Column:
    """Whether a row's label may not be learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> AdditiveModel:
    """The model of a bounded sample of labelled rows; features are taken of these only."""
    one = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most").drop("most")
    texts = id_and_text(docs).where(~held_out())
    sample = texts.select("doc_id").join(one, "doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    rows = feature_table(texts.join(F.broadcast(sample.select("doc_id")), "doc_id", "left_semi")).join(F.broadcast(sample), "doc_id")
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", *FEATURES).limit(SAMPLE_ROWS).select(*FEATURES, "quality").toPandas()
    return fit(rows[FEATURES].to_numpy(float).reshape(-1, len(FEATURES)), rows["quality"].to_numpy(float))


def scored(docs: DataFrame, model: AdditiveModel, keep: bool) -> DataFrame:
    """doc_id and score of every document; or, to keep, the documents that score 0.5 or more, with all their columns."""
    bounded_batches(docs.sparkSession)
    position = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            score = model.score(np.array([features(t or "") for t in batch.column(position).to_pylist()]).reshape(-1, len(FEATURES)))
            yield batch.filter(pa.array(score >= 0.5)) if keep else pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "score": pa.array(score, pa.float64())})

    return docs.mapInArrow(run, docs.schema if keep else "doc_id long, score double")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    rows = scored(id_and_text(docs), train(docs, labels), keep=False)
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, with all their columns."""
    return scored(docs, train(docs, labels), keep=True)
