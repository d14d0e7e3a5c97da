"""MinHash signatures and locality-sensitive bands."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import PYTHON_SEPARATORS, PYTHON_SEPARATORS_SPLIT, slices

SEED, PRIME, TOP = 42, 2**61 - 1, 2**32 - 1


@lru_cache
def hash_family(num_perm: int, seed: int = SEED) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """Multipliers and offsets, drawn in turn from a seeded generator."""
    draw = np.random.RandomState(seed).randint
    pairs = [(int(draw(1, PRIME, dtype=np.uint64)), int(draw(0, PRIME, dtype=np.uint64))) for _ in range(num_perm)]
    return tuple(a for a, _ in pairs), tuple(b for _, b in pairs)


def least_values(hashes: np.ndarray, sizes: np.ndarray, num_perm: int) -> np.ndarray:
    """A row for each set of 32-bit hashes (one after another): the least value of every permutation; all ones of 32 bits for an empty set.

    Unsigned 64-bit products wrap, which Spark's arithmetic doesn't. The remainder by 2 ** 61 - 1 comes from shifts: what a
    subtraction too many wraps to is greater than what it's taken from.
    """
    a, b = (np.array(x, np.uint64) for x in hash_family(num_perm))
    out = np.full((len(sizes), num_perm), TOP, np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        begin = np.cumsum(sizes[full]) - sizes[full]
        for k in range(num_perm):
            x = hashes * a[k] + b[k]
            x = (x & np.uint64(PRIME)) + (x >> np.uint64(61))
            out[full, k] = np.minimum.reduceat(np.minimum(x, x - np.uint64(PRIME)) & np.uint64(TOP), begin)
    return out


def _batch(uid: pa.Array, values: np.ndarray) -> pa.RecordBatch:
    n, num_perm = values.shape
    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * num_perm), pa.array(values.astype(np.int64).ravel()))
    return pa.RecordBatch.from_arrays([uid, lists], names=["uid", "signature"])


def signatures(hashed: DataFrame, num_perm: int = 128) -> DataFrame:
    """(uid, signature) from (uid, array of 32-bit hashes); a null array counts as empty. A plan node of its own, so that Spark can't draw it into other expressions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            sizes = np.array([0 if n is None else n for n in lists.value_lengths().to_pylist()], np.int64)
            yield _batch(batch.column(0), least_values(lists.flatten().to_numpy(zero_copy_only=False).astype(np.uint64), sizes, num_perm))

    return hashed.mapInArrow(run, "uid long, signature array<long>")


def text_signatures(texts: DataFrame, num_perm: int, ngram: int, min_length: int, split_ideographs: bool, unicode_form: bool, isolate_short: bool) -> DataFrame:
    """(uid, signature) from (uid, lower-cased text) in one Arrow node: separators, tokens, distinct shingles, hashes, least values.

    A null text has no shingle and all ones of 32 bits; with ``isolate_short`` texts without a shingle are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return signed_batches(batches, num_perm, ngram, min_length, split_ideographs, unicode_form, isolate_short)

    return texts.mapInArrow(run, "uid long, signature array<long>")


def signed_batches(batches: Iterator[pa.RecordBatch], num_perm: int, ngram: int, min_length: int, split_ideographs: bool, unicode_form: bool, isolate_short: bool) -> Iterator[pa.RecordBatch]:
    """What a task of ``text_signatures`` does. Strings and hashes are made of a slice of bounded bytes at a time, as batches can hold 10,000 texts."""
    separators, non_word = re.compile(PYTHON_SEPARATORS_SPLIT if split_ideographs else PYTHON_SEPARATORS), re.compile(r"\W")

    def hashes(t: str | None) -> list[int]:
        if t is None:
            return []
        content = separators.sub(" ", unicodedata.normalize("NFKC", t) if unicode_form and not t.isascii() else t)
        words = non_word.split(content)
        if len(words) < min_length:
            return []
        grams = {" ".join(words[i : i + ngram]) for i in range(max(1, len(words) - ngram + 1))}
        return [int.from_bytes(hashlib.sha1(g.lower().encode("utf-8", "replace"), usedforsecurity=False).digest()[:4], "little") for g in grams]

    for batch in batches:
        for begin, n in slices(batch.column(1)):
            part = batch.slice(begin, n)
            found = [np.array(hashes(t), np.uint64) for t in part.column(1).to_pylist()]
            sizes = np.array([len(x) for x in found], np.int64)
            out = _batch(part.column(0), least_values(np.concatenate(found), sizes, num_perm))
            yield out.filter(pa.array(sizes > 0)) if isolate_short else out


def bands(signature_: str, b: int, r: int) -> Column:
    """An array of (band, key)."""
    return F.array(*(F.struct(F.lit(i).alias("band"), F.slice(signature_, i * r + 1, r).alias("key")) for i in range(b)))


def band_parameters(threshold: float, num_perm: int, weight_fp: float = 0.5, weight_fn: float = 0.5) -> tuple[int, int]:
    """Bands and rows that minimise the weighted areas of false positives below the threshold and false negatives above it."""

    def area(b: int, r: int, lo: float, hi: float, missed: bool) -> float:
        x = np.linspace(lo, hi, 1025)
        y = (1 - x**r) ** b
        y = y if missed else 1 - y
        return float((hi - lo) / 3072 * (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum()))

    choices = ((b, r) for b in range(1, num_perm + 1) for r in range(1, num_perm // b + 1))
    return min(choices, key=lambda c: weight_fp * area(*c, 0.0, threshold, False) + weight_fn * area(*c, threshold, 1.0, True))
