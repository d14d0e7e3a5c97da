"""Operator 8: exact Jaccard join of documents on word 5-shingles by pivots, regions and triangle-inequality windows.

Jaccard distance is a metric, but almost all documents are at distance exactly 1 from almost all others. Voronoi cells
around a few global pivots are then ties: the window d(x, p) <= d(x, nearest) + 2 * 0.2 holds for every pivot, and every
document is replicated to every cell (the README has figures). So pivots are elected where distances below 1 can be: in any
order common to all, two linked documents share a shingle among their first n - ceil(0.8 n) + 1, and k of them among the
first n - ceil(0.8 n) + k. Each such shingle's posting list, cut where sizes differ by more than the threshold allows, elects its
smallest document as pivot, and its members enter the pivot's region; a document on the border of several regions is
replicated to each. A document too few of whose first shingles are in a list with others can link with nothing and is spared
the rest. Every linked pair thus meets in a region.

Documents meet in several regions, and most of those that do don't link. So it's sketches that go to every region: bitmaps of 2 to
4 bits a shingle, which bound an intersection from above and hence spare no linked pair. Pairs that they leave are tied, over all
regions, and what is connected so is a region anew: a set travels once, with those that it may link with, in however many regions it
was. Regions with too many sketches for a task are parted by sizes that can link, and what is still too heavy is dealt to pairs of
blocks; only beyond a bound on these copies do sets travel to such a part.

Inside, a region is joined recursively: members without enough shingles in common with the rest leave; pivots split the rest
into Voronoi cells, with members replicated to all cells within the window of 2 * (1 - threshold); small cells are joined pivot
by pivot with windows on the distances to earlier pivots. All tests of links are exact, in integers. A region too heavy for a
task is split in the same way by all executors: distances to its pivots, links with them, cells by the same window. Members
that can only link with what they're connected to already leave before. Only what pivots can't part is dealt to pairs of blocks.

Postings travel as packed blocks, one for each part of a task and bucket of shingles. The common order puts shingles that are
frequent in a bounded sample last; the sample affects the cost, not the result. Lists of frequent shingles would be hot: they
are never gathered, each elects its pivots by size class in partial minima, which are broadcast (at most ``FREQUENT_MOST``
shingles). Shingles are compared by 64-bit hashes, whole sets are named by 128 bits; equal sets of a task post once.

Defined cases: documents without words, or null, have no shingles and are linked with nothing; with fewer than five words the
whole sequence is the one shingle; equal sets count once and carry their links over to all their documents; a doc_id with
several texts links with whatever one of them links with; rows of null doc_id are kept, link with nothing and have a null
component; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.piece_sampling import mix
from corpusloom.llm.texts import bounded_batches, forget, id_and_text, rows_of
from corpusloom.operators.graph import connected_components
from corpusloom.scratch import Scratch

SHINGLE, NUM, DEN = 5, 80, 100
WINDOW = 1 - NUM / DEN
#: Sample for the common order: about so many documents; a shingle is frequent from that share of them on; at most so many shingles.
SAMPLE_DOCS, FREQUENT_SHARE, FREQUENT_MOST = 3000, 0.003, 50_000
#: Postings of a bucket, about, and documents whose postings are packed together.
BUCKET_POSTINGS, PACKED_DOCS = 1_000_000, 2048
#: Shingles that one task takes of a region, documents below which a cell isn't split, pivots of a split, splits of a heavy region.
REGION_SHINGLES, CELL_DOCS, CELL_PIVOTS, HEAVY_SPLITS = 1_000_000, 8, 8, 3
#: Ids that may be broadcast (8 bytes each), beyond which the join shuffles; bytes of pivots' sets that are broadcast at a time.
BROADCAST_IDS, BROADCAST_BYTES = 1_000_000, 64_000_000
#: Sketches are compared in a task up to so many times REGION_SHINGLES of their sets, and so many times members * shingles (a bound of the pairs' work), beyond that
#: in pairs of blocks, up to so many blocks.
SKETCHED, SKETCHED_PAIRS, SKETCH_BLOCKS = 16, 40_000, 16
_K = np.uint64(0x9E3779B97F4A7C15)
_KINDS = {"document": 0, "postings": 1, "frequent": 2, "leaders": 3}
_SIGNED = "kind int, uid long, doc_id long, n long, name_a long, name_b long, poster long, bucket int, block binary, sketch binary"


class WordHashes(dict):
    """64-bit hashes of words, kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh64_intdigest(word)
        if len(self) < 100_000 and len(word) < 64:
            self[word] = value
        return value


def shingle_sets(texts: list[str], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct hashes of each whole text's shingles one after another, how many each has).

    bytes.lower() and bytes.split() know just A-Z, space and U+0009 to U+000D.
    """
    words = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
    size = np.fromiter(map(len, words), np.int64, len(words))
    w = np.fromiter(map(hashes.__getitem__, chain.from_iterable(words)), np.uint64, int(size.sum()))
    count = np.where(size >= SHINGLE, size - SHINGLE + 1, np.minimum(size, 1))
    begin = np.cumsum(count) - count
    s = np.empty(int(count.sum()), np.uint64)
    few = np.flatnonzero((size > 0) & (size < SHINGLE))
    one = np.zeros(len(s), bool)
    one[begin[few]] = True
    if len(w) >= SHINGLE:
        last = len(w) - SHINGLE + 1
        h = np.full(last, SHINGLE, np.uint64)
        for k in range(SHINGLE):
            h = h * _K + w[k : last + k]
        owner = np.repeat(np.arange(len(words)), size)
        s[~one] = h[owner[:last] == owner[SHINGLE - 1 :]]
    first = np.cumsum(size) - size
    for i in few:
        h = np.full(1, size[i], np.uint64)
        for x in w[first[i] : first[i] + size[i]]:
            h = h * _K + x
        s[begin[i]] = h[0]
    s = mix(s)
    for a, b in zip(begin.tolist(), (begin + count).tolist(), strict=True):
        s[a:b].sort()
    owner = np.repeat(np.arange(len(words)), count)
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])
    return s[new], np.bincount(owner[new], minlength=len(words))


def least_shared(n: np.ndarray) -> np.ndarray:
    """Shared shingles that the prefixes of two linked sets of size ``n`` must have at least."""
    return -(-n // 5)


def first_shared(n: np.ndarray) -> np.ndarray:
    """A set of n shares one of its first so many shingles with each that it links with."""
    return n - -(-NUM * n // DEN) + 1


def prefix_size(n: np.ndarray) -> np.ndarray:
    """The k-th shingle that a set of n shares with a linked one is among its first n - ceil(0.8 n) + k."""
    return first_shared(n) - 1 + least_shared(n)


def size_class(n: np.ndarray) -> np.ndarray:
    """Sizes of linked sets lie in the same class or in neighbouring ones; from 1 on."""
    return (np.log(n) / np.log(DEN / NUM) + 1e-9).astype(np.int64) + 1


def set_names(s: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit names of sets that lie one after another, as two signed numbers each."""
    a, b = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n)
    if len(full):
        begin = (np.cumsum(n) - n)[full]
        a[full] = np.add.reduceat(mix(s ^ _K), begin) + n[full].astype(np.uint64)
        b[full] = np.bitwise_xor.reduceat(mix(s + _K), begin)
    return mix(a + _K).view(np.int64), mix(b ^ (a * _K)).view(np.int64)


def sketches(s: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Bitmaps of sets that lie one after another: 2 to 4 bits a shingle, a power of two and 64 at least. Half a bitmap laid over the other is that of half the size."""
    bits = 1 << np.maximum(6, np.ceil(np.log2(2 * np.maximum(n, 1))).astype(np.int64))
    begin = np.cumsum(bits) - bits
    plane = np.zeros(int(bits.sum()), bool)
    plane[np.repeat(begin, n) + (s & np.repeat(bits - 1, n).astype(np.uint64)).astype(np.int64)] = True
    packed = np.packbits(plane, bitorder="little").tobytes()
    return [packed[a : a + b] for a, b in zip((begin >> 3).tolist(), (bits >> 3).tolist(), strict=True)]


def may_link(ids: list[int], n: list[int], bitmaps: list[bytes]) -> list[tuple[int, int]]:
    """A forest of all pairs that can link by their sketches: shingles whose bits the other set hasn't are not in it."""
    order = np.lexsort((ids, n))
    name, size = np.array(ids, np.int64)[order], np.array(n, np.int64)[order]
    words = np.array([len(b) >> 3 for b in bitmaps], np.int64)[order]
    upto = np.searchsorted(size, DEN * size // NUM, side="right")  # sets of that size are in sketches of the same size or twice that
    group, links = np.arange(len(name)), []
    for width in np.unique(words):
        lo, hi = np.searchsorted(words, width), np.searchsorted(words, width, side="right")
        last = int(upto[hi - 1])
        rows = np.frombuffer(b"".join(bitmaps[i] for i in order[lo:hi]), np.uint64).reshape(-1, width)
        if last > hi:
            double = np.frombuffer(b"".join(bitmaps[i] for i in order[hi:last]), np.uint64).reshape(-1, 2, width)
            rows = np.concatenate([rows, double[:, 0] | double[:, 1]])
        for i in range(lo, hi):
            x = np.arange(i + 1, upto[i])
            x = x[group[x] != group[i]]
            if not len(x):
                continue
            own, others = rows[i - lo], rows[x - lo]
            both = np.bitwise_count(own & others).sum(1, dtype=np.int64)
            one, other = int(np.bitwise_count(own).sum(dtype=np.int64)), np.bitwise_count(others).sum(1, dtype=np.int64)
            shared = np.minimum(size[i] - one + both, size[x] - other + both)
            for j in x[DEN * shared >= NUM * (size[i] + size[x] - shared)].tolist():
                if group[i] != group[j]:
                    group[group == group[j]] = group[i]
                    links.append((int(name[i]), int(name[j])))
    return links


class Frequent:
    """Sorted hashes of shingles that are frequent in a bounded sample, and the mean size of sets in it."""

    def __init__(self, hashes: np.ndarray, mean: float = 0.0):
        self.hashes, self.mean = np.sort(hashes), mean
        self.table = np.zeros(1 << 20, bool)
        self.table[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def places(self, s: np.ndarray) -> np.ndarray:
        """Of each shingle its place among the frequent ones, or -1."""
        out = np.full(len(s), -1, np.int64)
        maybe = np.flatnonzero(self.table[(s >> np.uint64(44)).astype(np.int64)])
        at = np.searchsorted(self.hashes, s[maybe])
        found = at < len(self.hashes)
        found[found] = self.hashes[at[found]] == s[maybe[found]]
        out[maybe[found]] = at[found]
        return out


def frequent_shingles(docs: DataFrame, total: int) -> Frequent:
    share = min(1.0, SAMPLE_DOCS / max(total, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        hashes = WordHashes()
        for batch in batches:
            s, n = shingle_sets(batch.column(0).to_pylist(), hashes)
            names, counts = np.unique(s, return_counts=True)
            yield pa.RecordBatch.from_pydict({"s": pa.array(np.append(names.view(np.int64), 0)), "n": pa.array(np.append(counts, n.sum())), "docs": pa.array(np.append(np.zeros(len(names), np.int64), len(n)))})

    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30)).select("text").distinct()
    counted = sample.mapInArrow(run, "s long, n long, docs long").groupBy("s", (F.col("docs") > 0).alias("all")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    often = F.col("n") >= max(4.0, FREQUENT_SHARE * SAMPLE_DOCS)
    rows = counted.where(F.col("all") | often).orderBy(F.desc("all"), F.desc("n"), "s").limit(FREQUENT_MOST).toPandas()
    whole = rows[rows["all"]]
    return Frequent(rows[~rows["all"]]["s"].to_numpy(np.int64).view(np.uint64), float(whole["n"].sum() / max(1, whole["docs"].sum())))


def pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length, by planes of bytes, compressed."""
    planes = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns)
    return pa.compress(planes, codec="zstd", asbytes=True)


def unpack(block: bytes, n: int, *types: str) -> list[np.ndarray]:
    kinds = [np.dtype(t) for t in types]
    flat = np.frombuffer(pa.decompress(block, n * sum(k.itemsize for k in kinds), codec="zstd"), np.uint8)
    out, at = [], 0
    for k in kinds:
        out.append(np.ascontiguousarray(flat[at : at + n * k.itemsize].reshape(k.itemsize, n).T).view(k).ravel())
        at += n * k.itemsize
    return out


class Leaders:
    """The least (size, uid) of each key seen, and how many there are."""

    def __init__(self):
        self.rows = np.zeros((4, 0), np.int64)  # key, size, uid, count

    def add(self, keys: np.ndarray, n: np.ndarray, uid: np.ndarray) -> None:
        rows = np.concatenate([self.rows, np.stack([keys, n, uid, np.ones(len(keys), np.int64)])], axis=1)
        rows = rows[:, np.lexsort((rows[2], rows[1], rows[0]))]
        first = np.flatnonzero(np.concatenate(([True], rows[0, 1:] != rows[0, :-1]))) if rows.shape[1] else np.zeros(0, np.int64)
        counts = np.add.reduceat(rows[3], first) if len(first) else first
        self.rows = rows[:, first]
        self.rows[3] = counts


def _rows(**columns: np.ndarray | list) -> pa.RecordBatch:
    """A batch of ``_SIGNED``; columns not given are null."""
    n = len(next(iter(columns.values())))
    types = {"kind": pa.int32(), "bucket": pa.int32(), "block": pa.binary(), "sketch": pa.binary()}
    names = [c.split()[0] for c in _SIGNED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[c], types.get(c, pa.int64())) if c in columns else pa.nulls(n, types.get(c, pa.int64())) for c in names], names=names)


class Poster:
    """Postings of a task's documents, packed by buckets."""

    def __init__(self, frequent: Frequent, buckets: int):
        self.frequent, self.buckets, self.leaders = frequent, buckets, Leaders()
        self.held: list[tuple[np.ndarray, ...]] = []
        self.base = self.docs = 0

    def add(self, uid: np.ndarray, s: np.ndarray, n: np.ndarray) -> None:
        """Sets of documents of ascending uid, one after another."""
        if not len(n):
            return
        owner = np.repeat(np.arange(len(n)), n)
        place = self.frequent.places(s)
        late = place >= 0
        order = np.argsort((2 * owner + late).astype(np.int16 if len(n) < 1 << 14 else np.int64), kind="stable")
        rank = np.arange(len(s)) - np.repeat(np.cumsum(n) - n, n)
        keep = rank < prefix_size(n)[owner]
        early = rank < first_shared(n)[owner]
        chosen = order[keep]
        if not self.docs:
            self.base = int(uid[0])
        self.held.append((s[chosen], (uid - self.base)[owner[keep]].astype(np.uint32), (2 * n[owner[keep]] + early[keep]).astype(np.uint32), place[chosen]))
        self.docs += len(n)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.docs:
            return
        s, at, size, place = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self.held, self.docs = [], 0
        late = place >= 0
        if late.any():
            where, own, n = place[late], at[late], size[late]
            key = where * 256 + size_class(n >> 1)
            self.leaders.add(np.concatenate([key, key - 1]), np.tile((n >> 1).astype(np.int64), 2), np.tile(self.base + own.astype(np.int64), 2))
            yield _rows(kind=[_KINDS["frequent"]], uid=[self.base], n=[len(own)], block=[pack(where.astype(np.uint32), own, n)])
        s, at, size = s[~late], at[~late], size[~late]
        bucket = (mix(s ^ _K) % np.uint64(self.buckets)).astype(np.int32)
        order = np.lexsort((s, bucket))
        s, at, size, bucket = s[order], at[order], size[order], bucket[order]
        first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(s) else np.zeros(0, np.int64)
        bounds = np.append(first, len(s)).tolist()
        blocks = [pack(np.diff(s[a:b], prepend=np.uint64(0)), at[a:b], size[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
        if blocks:
            yield _rows(kind=[_KINDS["postings"]] * len(blocks), uid=[self.base] * len(blocks), n=np.diff(bounds), bucket=bucket[first], block=blocks)

    def end(self) -> Iterator[pa.RecordBatch]:
        yield from self.flush()
        if n := self.leaders.rows.shape[1]:
            yield _rows(kind=[_KINDS["leaders"]], n=[n], block=[pack(*self.leaders.rows)])


def signatures(texts: DataFrame, frequent: Frequent, buckets: int) -> DataFrame:
    """Rows of ``_SIGNED``. Of each document: uid, n (shingles), its set's name, poster, the first of the task with the same set, and the sketch of a poster.

    Blocks of postings have the uid from which theirs count, and n postings.
    """
    shared = texts.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        hashes, poster, seen = WordHashes(), Poster(shared.value, buckets), {}
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            s, n = shingle_sets(batch.column(1).to_pylist(), hashes)
            a, b = set_names(s, n)
            own = np.arange(uid, uid + len(n))
            uid += len(n)
            able = (n > 0) & ~np.asarray(batch.column(0).is_null())
            leader = [seen.setdefault(name, i) if ok else i for name, i, ok in zip(zip(a.tolist(), b.tolist(), strict=True), own.tolist(), able.tolist(), strict=True)]
            posts = able & (np.array(leader, np.int64) == own)
            poster.add(own[posts], s[np.repeat(posts, n)], n[posts])
            sketched = np.full(len(n), None)
            sketched[posts] = sketches(s[np.repeat(posts, n)], n[posts])
            yield _rows(kind=[_KINDS["document"]] * len(n), uid=own, doc_id=batch.column(0), n=n, name_a=a, name_b=b, poster=leader, sketch=sketched)
            if poster.docs >= PACKED_DOCS:
                yield from poster.flush()
        yield from poster.end()

    return texts.mapInArrow(run, _SIGNED)


_PAIRS = "pivot long, member long, n long, k long, early boolean"


def _rows_of_pairs(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["pivot", "member", "n", "k", "early"])


def _pairs(pivot: np.ndarray, member: np.ndarray, n: np.ndarray, k: np.ndarray, early: np.ndarray) -> pa.RecordBatch:
    """Rows of ``_PAIRS``, summed by (pivot, member)."""
    order = np.lexsort((member, pivot))
    pivot, member = pivot[order], member[order]
    new = np.flatnonzero(np.concatenate(([True], (pivot[1:] != pivot[:-1]) | (member[1:] != member[:-1]))))
    return _rows_of_pairs(pivot[new], member[new], n[order][new], np.add.reduceat(k[order], new), np.logical_or.reduceat(early[order], new))


def stretches(s: np.ndarray, uid: np.ndarray, n: np.ndarray, early: np.ndarray) -> pa.RecordBatch | None:
    """Posting lists are cut where the size jumps by more than the threshold allows; of each stretch of two or more, the smallest set is the pivot.

    A row for each shingle and member: Spark's partial aggregation sums them."""
    order = np.argsort(s)
    both = s[order][1:] == s[order][:-1]
    order = order[np.concatenate(([False], both)) | np.concatenate((both, [False]))]
    if not len(order):
        return None
    order = order[np.lexsort((uid[order], n[order], s[order]))]
    s, uid, n, early = s[order], uid[order], n[order], early[order]
    start = np.ones(len(s), bool)
    start[1:] = (s[1:] != s[:-1]) | (NUM * n[1:] > DEN * n[:-1])
    lead = np.maximum.accumulate(np.where(start, np.arange(len(s)), 0))
    second = ~start & np.concatenate(([False], start[:-1]))
    if not second.any():
        return None
    of, member = np.concatenate([lead[~start], lead[second]]), np.concatenate([np.flatnonzero(~start), lead[second]])
    return _rows_of_pairs(uid[of], uid[member], n[member], np.ones(len(of), np.int64), early[member])


def elect(signed: DataFrame, buckets: int) -> DataFrame:
    """(pivot, member, n, k, early) of the lists that aren't frequent, bucket by bucket.

    k: shingles by which the member is in the pivot's stretches; early: whether by one of its first n - ceil(0.8 n) + 1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def end() -> Iterator[pa.RecordBatch]:
            if held and (found := stretches(*(np.concatenate(x) for x in zip(*held, strict=True)))) is not None:
                yield found

        for batch in batches:
            for bucket, base, n, block in rows_of(batch, "bucket", "uid", "n", "block"):
                if bucket != now:
                    yield from end()
                    now, held = bucket, []
                s, at, size = unpack(block, n, "u8", "u4", "u4")
                held.append((np.cumsum(s, dtype=np.uint64), base + at.astype(np.int64), (size >> 1).astype(np.int64), (size & 1).astype(bool)))
        yield from end()

    blocks = signed.where(F.col("kind") == _KINDS["postings"]).select("bucket", "uid", "n", "block")
    return blocks.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(run, _PAIRS)


def elect_frequent(signed: DataFrame) -> DataFrame:
    """The same of frequent shingles, by classes of size: every document looks up the leaders of its class and the one below."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, block in rows_of(batch, "n", "block"):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in unpack(block, n, "i8", "i8", "i8", "i8")], names=["key", "n", "uid", "count"])

    parts = signed.where(F.col("kind") == _KINDS["leaders"]).select("n", "block").mapInArrow(partial, "key long, n long, uid long, count long")
    led = parts.groupBy("key").agg(F.min(F.struct("n", "uid")).alias("least"), F.sum("count").alias("count")).where(F.col("count") > 1)
    led = led.select("key", F.col("least.uid").alias("uid")).toPandas().sort_values("key")  # at most FREQUENT_MOST shingles, in a few classes each
    shared = signed.sparkSession.sparkContext.broadcast((led["key"].to_numpy(np.int64), led["uid"].to_numpy(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, pivots = shared.value
        for batch in batches if len(keys) else ():
            for base, n, block in rows_of(batch, "uid", "n", "block"):
                place, at, size = unpack(block, n, "u4", "u4", "u4")
                key, member, size = place.astype(np.int64) * 256 + size_class(size >> 1), base + at.astype(np.int64), size.astype(np.int64)
                found, parts = np.zeros(n, bool), []
                for below in (0, 1):
                    i = np.minimum(np.searchsorted(keys, key - below), len(keys) - 1)
                    hit = keys[i] == key - below
                    parts.append((pivots[i[hit]], member[hit], size[hit] >> 1, (~found[hit]).astype(np.int64), (size[hit] & 1).astype(bool)))  # a shingle counts once
                    found |= hit
                parts = [np.concatenate(x) for x in zip(*parts, strict=True)]
                if len(parts[0]):
                    yield _pairs(*parts)

    return signed.where(F.col("kind") == _KINDS["frequent"]).select("uid", "n", "block").mapInArrow(run, _PAIRS)


def few(df: DataFrame, n: int) -> DataFrame:
    """For a join: broadcast if its ``n`` rows may be."""
    return F.broadcast(df) if n <= BROADCAST_IDS else df


def regions_of(signed: DataFrame, moved: DataFrame, buckets: int, scratch: Scratch) -> DataFrame:
    """(pivot, member, n) of the regions with two members or more that can link at all. moved: (poster, rep) of sets that several tasks posted."""
    pairs = elect(signed, buckets).unionByName(elect_frequent(signed))
    elected = pairs.groupBy("pivot", "member").agg(F.max("n").alias("n"), F.sum("k").alias("k"), F.max("early").alias("early"))
    if n := moved.count():
        for c in ("pivot", "member"):
            elected = elected.join(few(moved, n), F.col(c) == F.col("poster"), "left").withColumn(c, F.coalesce("rep", c)).drop("poster", "rep")
        elected = elected.groupBy("pivot", "member").agg(F.max("n").alias("n"), F.max("k").alias("k"), F.max("early").alias("early"))
    elected = scratch.save(elected, "elected")
    partner = F.ceil(F.col("n") * NUM / DEN)  # the smallest set that it can link with
    able = elected.groupBy("member").agg(F.sum("k").alias("k"), F.max("n").alias("n")).where(F.col("k") >= F.ceil(partner / 5)).select("member")
    placed = scratch.save(elected.where("early").join(able, "member", "left_semi").select("pivot", "member", "n"), "placed")
    # a table on its own: a region of very many members is a skewed join that can be split
    full = scratch.save(placed.groupBy("pivot").agg(F.count("*").alias("members")).where("members > 1").select("pivot"), "full")
    return placed.join(few(full, full.count()), "pivot", "left_semi")


def tied_regions(regions: DataFrame, signed: DataFrame, scratch: Scratch) -> DataFrame:
    """(pivot, member, n) with members that may link by their sketches, each in one region; parts of regions that are too heavy for sketches are kept."""
    keys = ["pivot", "slot", "a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, links = None, [], []
        for batch in batches:
            for *key, member, n, sketch in rows_of(batch, *keys, "member", "n", "sketch"):
                if key != now:
                    if held:
                        links += may_link(*zip(*held, strict=True))
                    now, held = key, []
                    if len(links) > 10_000:
                        yield _links(links)
                        links = []
                held.append((member, n, sketch))
        if held:
            links += may_link(*zip(*held, strict=True))
        yield _links(links)

    sums = F.count("*").alias("members"), F.sum("n").alias("weight")
    load = F.greatest(F.col("weight") / float(SKETCHED * REGION_SHINGLES), F.sqrt(F.col("members") * (F.col("weight") / float(SKETCHED_PAIRS * REGION_SHINGLES))))
    large = scratch.save(regions.groupBy("pivot").agg(*sums).where(load > 1).select("pivot"), "large")
    n, none, kept = large.count(), F.lit(0).cast("long"), None
    if n:
        # a size class and the next one hold all that a set of the class links with
        size = F.floor(F.log("n") / float(np.log(DEN / NUM)) + 1e-9) + 1
        sized = regions.join(few(large, n), "pivot", "left_semi").withColumn("slot", F.explode(F.array(size, size - 1)))
        plan = sized.groupBy("pivot", "slot").agg(*sums).where("members > 1").select("pivot", "slot", F.when(load > 1, F.ceil(2 * load)).otherwise(1).alias("blocks"))
        plan = scratch.save(plan, "blocks")
        sized = sized.join(few(plan, plan.count()), ["pivot", "slot"])
        dealt = sized.where(F.col("blocks") <= SKETCH_BLOCKS).withColumn("own", F.pmod(F.xxhash64("member"), "blocks")).withColumn("other", F.explode(F.sequence(none, F.col("blocks") - 1)))
        light = regions.join(few(large, n), "pivot", "left_anti").select("pivot", none.alias("slot"), none.alias("a"), none.alias("b"), "member", "n")
        light = scratch.save(light.unionByName(dealt.select("pivot", "slot", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "member", "n")), "dealt")
        if plan.where(F.col("blocks") > SKETCH_BLOCKS).limit(1).count():
            kept = sized.where(F.col("blocks") > SKETCH_BLOCKS).select(F.xxhash64("pivot", "slot").alias("pivot"), "member", "n")
    else:
        light = regions.select("pivot", none.alias("slot"), none.alias("a"), none.alias("b"), "member", "n")
    bitmaps = signed.where(F.col("sketch").isNotNull()).select(F.col("uid").alias("member"), "sketch")
    placed = few(light, light.count()).join(bitmaps, "member").select(*keys, "member", "n", "sketch")
    tied = scratch.save(placed.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "src long, dst long"), "tied")
    components = connected_components(tied, scratch, "ties")
    sizes = light.select("member", "n").distinct()
    joined = components.join(sizes, F.col("vid") == F.col("member")).select(F.col("component").alias("pivot"), "member", "n")
    return scratch.save(joined.unionByName(kept) if kept is not None else joined, "regions")


def sets_of(texts: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """uid and sorted set (unsigned 64-bit, as bytes) of documents (uid, doc_id, name_a, name_b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            s, size = shingle_sets(batch.column(0).to_pylist(), hashes)
            a, b = set_names(s, size)
            right = (a == batch.column(2).to_numpy()) & (b == batch.column(3).to_numpy())  # a doc_id may have other texts
            bounds = np.concatenate(([0], np.cumsum(size)))
            yield pa.RecordBatch.from_arrays([batch.column(1).filter(pa.array(right)), pa.array([s[bounds[i] : bounds[i + 1]].tobytes() for i in np.flatnonzero(right)], pa.binary())], names=["uid", "set"])

    return texts.join(few(wanted, n), "doc_id").select("text", "uid", "name_a", "name_b").mapInArrow(run, "uid long, set binary")


class Region:
    """Documents joined within a task; links are kept as a forest. done counts Voronoi splits, members replicated by the window, and pairs that windows spared."""

    def __init__(self, ids: np.ndarray, sets: list[np.ndarray]):
        order = np.lexsort((ids, [len(s) for s in sets]))
        self.ids = ids[order]
        sets = [sets[i] for i in order]
        self.n = np.array([len(s) for s in sets], np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.n)))
        _, self.shingle, self.df = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_inverse=True, return_counts=True)
        self.mark = np.zeros(len(self.df), bool)
        self.group = np.arange(len(ids))
        self.links: list[tuple[int, int]] = []
        self.done: Counter[str] = Counter()

    def root(self, i: int) -> int:
        while self.group[i] != i:
            self.group[i] = self.group[self.group[i]]
            i = self.group[i]
        return i

    def roots(self) -> np.ndarray:
        g = self.group
        while (g[g] != g).any():
            g = g[g]
        self.group = g
        return g

    def items(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(shingles of the members one after another, where each begins)."""
        n = self.n[members]
        begin = np.cumsum(n) - n
        return self.shingle[np.arange(n.sum()) - np.repeat(begin, n) + np.repeat(self.first[members], n)], begin

    def shared(self, pivot: int, members: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of the pivot with members."""
        own = self.shingle[self.first[pivot] : self.first[pivot + 1]]
        self.mark[own] = True
        items, begin = self.items(members)
        out = np.add.reduceat(self.mark[items], begin, dtype=np.int64)
        self.mark[own] = False
        return out

    def distances(self, pivot: int, members: np.ndarray) -> np.ndarray:
        """To the pivot; links found on the way are kept."""
        shared = self.shared(pivot, members)
        union = self.n[pivot] + self.n[members] - shared
        for x in members[(DEN * shared >= NUM * union) & (members != pivot)]:
            a, b = self.root(pivot), self.root(int(x))
            if a != b:
                self.group[max(a, b)] = min(a, b)
                self.links.append((pivot, int(x)))
        return 1 - shared / union

    def settle(self) -> np.ndarray:
        """Members that have enough shingles in common with others to link with one, after all others have left."""
        members, df = np.flatnonzero(self.n > 0), self.df.copy()
        while len(members):
            items, begin = self.items(members)
            common = np.add.reduceat(df[items] > 1, begin, dtype=np.int64)
            out = DEN * common < NUM * self.n[members]
            if not out.any():
                break
            gone, _ = self.items(members[out])
            np.subtract.at(df, gone, 1)
            members = members[~out]
        return members

    def join(self, members: np.ndarray, depth: int = 0) -> None:
        if len(members) > CELL_DOCS and depth < 12:
            pivots, d = [members[0]], []
            while True:  # each next pivot is the member farthest from those before
                d.append(self.distances(int(pivots[-1]), members))
                nearest = np.min(d, axis=0)
                if len(np.unique(self.roots()[members])) == 1:
                    return  # all are linked already
                if len(pivots) == CELL_PIVOTS or nearest.max() <= 0:
                    break
                pivots.append(members[int(nearest.argmax())])
            cells = [members[row <= nearest + 2 * WINDOW + 1e-9] for row in d]
            # a cell holds its own members and, from others, those within the window
            home = np.argmin(d, axis=0)
            parts = [(c, int((home == k).sum())) for k, c in enumerate(cells)]
            if sum(len(c) for c, own in parts if own) <= 2 * len(members) and max(len(c) for c, own in parts if own) <= 0.7 * len(members):
                self.done.update(splits=1, replicated=sum(len(c) - own for c, own in parts if own))
                for c, own in parts:
                    if own and len(c) > 1:
                        self.join(c, depth + 1)
                return
        self.by_pivots(members)

    def by_pivots(self, members: np.ndarray) -> None:
        """Every member in turn is the pivot for larger ones; distances to earlier pivots give windows."""
        known = np.zeros((0, len(members)))
        for k, q in enumerate(members[:-1]):
            later = np.arange(k + 1, len(members))
            x = members[later]
            later = later[(NUM * self.n[x] <= DEN * self.n[q]) & (self.roots()[x] != self.root(int(q)))]
            if len(known) and len(later):
                near = ~(np.abs(known[:, later] - known[:, k : k + 1]) > WINDOW + 1e-9).any(0)  # an unknown distance spares nothing
                self.done.update(spared=int((~near).sum()))
                later = later[near]
            if len(later):
                d = self.distances(int(q), members[later])
                if len(later) > 1 and len(known) < CELL_PIVOTS:
                    row = np.full((1, len(members)), np.nan)
                    row[0, later], row[0, k] = d, 0
                    known = np.concatenate([known, row])


def solve(ids: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links of a region as a forest of (node, node)."""
    r = Region(ids, sets)
    r.join(r.settle())
    return [(int(r.ids[a]), int(r.ids[b])) for a, b in r.links]


def _links(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], names=["src", "dst"])


def join_regions(regions: DataFrame, keys: list[str]) -> DataFrame:
    """(src, dst) of the links within each group of rows (keys, member, set), a group at a time."""
    width = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, links = None, {}, []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for key, member, content in zip(zip(*columns[:width], strict=True), columns[width], columns[width + 1], strict=True):
                if key != now:
                    if len(held) > 1:
                        links += solve(np.array(list(held), np.int64), list(held.values()))
                    now, held = key, {}
                    if len(links) > 10_000:
                        yield _links(links)
                        links = []
                held[member] = np.frombuffer(content, np.uint64)
        if len(held) > 1:
            links += solve(np.array(list(held), np.int64), list(held.values()))
        yield _links(links)

    dealt = regions.select(*keys, "member", "set").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "src long, dst long")


def intersection(a: np.ndarray, b: np.ndarray) -> int:
    """Of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum()) if len(a) else 0


def in_waves(rows: DataFrame, key: str, weight: str) -> Iterator[tuple[DataFrame, Callable[[DataFrame], DataFrame]]]:
    """Parts of ``rows`` whose ``weight`` sums to about BROADCAST_BYTES, each with a filter of other frames to the same keys."""
    waves = int((rows.agg(F.sum(weight)).first()[0] or 0) // BROADCAST_BYTES) + 1
    for w in range(waves):
        part = lambda df, w=w: df.where(F.pmod(F.xxhash64(key), F.lit(waves)) == w) if waves > 1 else df
        yield part(rows), part


def split_heavy(heavy: DataFrame, scratch: Scratch, depth: int = 0) -> DataFrame:
    """(src, dst) of the links within regions (region, member, n, set) that are too heavy for a task.

    By a few pivots of each region, its members' distances to them and one pass over these: links with pivots; members that are
    connected to all that windows let them link with leave; the others go to their cells, as new regions, if cells are smaller.
    """
    slot = F.pmod(F.xxhash64("member", F.lit(depth)), F.lit(CELL_PIVOTS))
    chosen = heavy.groupBy("region", slot.alias("slot")).agg(F.min_by("member", F.struct(F.xxhash64("member", F.lit(-depth - 1)), "member")).alias("member"))
    centers = scratch.save(heavy.join(chosen.select("region", "member"), ["region", "member"]).select("region", "member", "set", F.octet_length("set").alias("bytes")), f"centers-{depth}")
    links = rest = None
    for wave, (own, part) in enumerate(in_waves(centers, "region", "bytes")):
        by_region: dict[int, list[tuple[int, np.ndarray]]] = {}
        for r in own.toLocalIterator():  # bounded by BROADCAST_BYTES
            by_region.setdefault(r["region"], []).append((r["member"], np.frombuffer(bytes(r["set"]), np.uint64)))
        shared = heavy.sparkSession.sparkContext.broadcast(by_region)

        def measure(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                near, distances = [], []
                for region, content in rows_of(batch, "region", "set"):
                    s, mask, d = np.frombuffer(content, np.uint64), 0, []
                    for j, (_, c) in enumerate(shared.value[region]):
                        both = intersection(s, c)
                        union = len(s) + len(c) - both
                        mask |= (DEN * both >= NUM * union) << j
                        d.append(1 - both / union)
                    near.append(mask)
                    distances.append(d)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.int64()), pa.array(distances, pa.list_(pa.float64()))], names=[*batch.schema.names, "near", "distance"])

        measured = part(heavy).select("region", "member", "n", "set").mapInArrow(measure, "region long, member long, n long, set binary, near long, distance array<double>")
        measured = scratch.save(measured, f"measured-{depth}-{wave}")
        parted = connected_pivots(measured, {r: len(c) for r, c in by_region.items()})
        named = {r: [m for m, _ in c] for r, c in by_region.items()}
        shared_parts = heavy.sparkSession.sparkContext.broadcast((named, parted))

        def tie(batches: Iterator[pa.RecordBatch], shared=shared_parts) -> Iterator[pa.RecordBatch]:
            named, _ = shared.value
            for batch in batches:
                yield _links([(named[r][j], m) for r, m, near in rows_of(batch, "region", "member", "near") for j in range(near.bit_length()) if near >> j & 1 and named[r][j] != m])

        def stay(batches: Iterator[pa.RecordBatch], shared=shared_parts) -> Iterator[pa.RecordBatch]:
            _, parted = shared.value
            for batch in batches:
                keep, cells = [], []
                for region, near, d in rows_of(batch, "region", "near", "distance"):
                    part_of, reach = parted[region]
                    d, others = np.array(d), reach.get(part_of.get(near, -1))
                    keep.append(others is not None and bool((d >= others[0] - WINDOW - 1e-9).all() and (d <= others[1] + WINDOW + 1e-9).all()))
                    cells.append(np.flatnonzero(d <= d.min() + 2 * WINDOW + 1e-9))
                names = ["region", "member", "n", "set"]
                out = pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in names), pa.array(cells, pa.list_(pa.int32()))], names=[*names, "cells"])
                yield out.filter(pa.array(keep, pa.bool_()))

        near = measured.select("region", "member", "near").mapInArrow(tie, "src long, dst long")
        left = scratch.save(measured.mapInArrow(stay, "region long, member long, n long, set binary, cells array<int>"), f"left-{depth}-{wave}")
        links = near if links is None else links.unionByName(near)
        rest = left if rest is None else rest.unionByName(left)
    each = rest.select("region", "n", F.size("cells").alias("copies"), F.explode("cells").alias("cell"))
    cells = each.groupBy("region", "cell").agg(F.count("*").alias("members"), F.sum("n").alias("weight"))
    total = rest.groupBy("region").agg(F.count("*").alias("all"), F.sum("n").alias("all_weight"))
    judged = cells.join(total, "region").groupBy("region").agg((F.max("members") <= 0.7 * F.first("all")).alias("smaller"), (F.sum("members") <= 2 * F.first("all")).alias("few"), F.first("all_weight").alias("all_weight"))
    split = F.col("smaller") & F.col("few") & F.lit(depth + 1 < HEAVY_SPLITS) & (F.col("all_weight") > REGION_SHINGLES)
    plan = scratch.save(judged.select("region", split.alias("split"), F.ceil(2 * F.col("all_weight") / REGION_SHINGLES).cast("int").alias("blocks")), f"plan-{depth}")
    planned = rest.join(few(plan, plan.count()), "region")
    # what cells can't part is dealt to pairs of blocks, so that every pair meets in a task of bounded size
    whole = planned.where(~F.col("split")).withColumn("blocks", F.when(F.col("blocks") <= 2, 1).otherwise(F.col("blocks")))
    whole = whole.withColumn("own", F.pmod(F.xxhash64("member"), F.col("blocks").cast("long")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    links = links.unionByName(join_regions(whole.select("region", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "member", "set"), ["region", "a", "b"]))
    if plan.where("split").limit(1).count():
        dealt = planned.where("split").select("region", "member", "n", "set", F.explode("cells").alias("cell")).select(F.xxhash64("region", "cell").alias("region"), "member", "n", "set")
        links = links.unionByName(join_weighed(scratch.save(dealt, f"cells-{depth}"), scratch, depth + 1))
    return links


def connected_pivots(measured: DataFrame, sizes: dict[int, int]) -> dict[int, tuple[dict[int, int], dict[int, tuple[np.ndarray, np.ndarray]]]]:
    """By region: of each set of pivots that a member is linked with, the part that they're connected to; of each part (-1: none),
    the least and greatest distances to every pivot of the members that it could be joined with by another link. At most 2 ** CELL_PIVOTS rows a region."""
    ends = [f(F.get("distance", F.lit(j))).alias(f"{name}{j}") for j in range(CELL_PIVOTS) for name, f in (("lo", F.min), ("hi", F.max))]
    rows = measured.groupBy("region", "near").agg(F.count("*").alias("members"), *ends).toPandas()
    out = {}
    for region, own in rows.groupby("region"):
        group = list(range(CELL_PIVOTS))

        def root(i: int, group=group) -> int:
            while group[i] != i:
                i = group[i]
            return i

        for mask in own["near"]:
            bits = [j for j in range(CELL_PIVOTS) if mask >> j & 1]
            for j in bits[1:]:
                a, b = sorted((root(bits[0]), root(j)))
                group[b] = a
        part_of = {int(mask): root((int(mask) & -int(mask)).bit_length() - 1) if mask else -1 for mask in own["near"]}
        parts, k = own["near"].map(part_of), sizes[region]
        reach = {}
        for p in set(part_of.values()):
            others = own[(parts != p) | (p == -1)]
            if len(others) and (p != -1 or others["members"].sum() > 1):
                reach[p] = (others[[f"lo{j}" for j in range(k)]].min().to_numpy(float), others[[f"hi{j}" for j in range(k)]].max().to_numpy(float))
        out[region] = (part_of, reach)
    return out


def join_weighed(placed: DataFrame, scratch: Scratch, depth: int = 0) -> DataFrame:
    """(src, dst) of the links within regions (region, member, n, set), heavy ones by split_heavy."""
    weights = placed.groupBy("region").agg(F.sum("n").alias("weight")).where(F.col("weight") > REGION_SHINGLES).select("region")
    heavy = scratch.save(weights, f"heavy-{depth}")
    n = heavy.count()
    if not n:
        return join_regions(placed, ["region"])
    light = join_regions(placed.join(few(heavy, n), "region", "left_anti"), ["region"])
    return light.unionByName(split_heavy(scratch.save(placed.join(few(heavy, n), "region", "left_semi"), f"weighty-{depth}"), scratch, depth))


def near_duplicates(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) of every row of ``docs``."""
    bounded_batches(docs.sparkSession)
    texts = id_and_text(docs)
    known = texts.where("doc_id is not null")
    total = known.count()
    frequent = frequent_shingles(known, total)
    buckets = int(total * 0.4 * max(frequent.mean, 1.0)) // BUCKET_POSTINGS + 1
    signed = scratch.save(signatures(texts, frequent, buckets), "signed")
    rows = signed.where(F.col("kind") == _KINDS["document"]).select("uid", "doc_id", "n", "name_a", "name_b", "poster")
    posters = rows.where("n > 0 and doc_id is not null")
    named = posters.groupBy("name_a", "name_b", "poster").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    equal = named.groupBy("name_a", "name_b").agg(F.min("poster").alias("rep"), F.min("least").alias("least"), F.sum("copies").alias("copies")).where("copies > 1").drop("copies")
    same = scratch.save(named.select("name_a", "name_b", "poster").join(equal, ["name_a", "name_b"]).select("poster", "rep", "least"), "same")
    moved = same.where("poster <> rep").select("poster", "rep")
    regions = tied_regions(regions_of(signed, moved, buckets, scratch), signed, scratch)
    scratch.release()
    members = regions.select(F.col("member").alias("uid")).distinct()
    wanted = scratch.save(rows.join(members, "uid", "left_semi").select("uid", "doc_id", "name_a", "name_b"), "wanted")
    again = posters.groupBy("doc_id").agg(F.min("poster").alias("lo"), F.max("poster").alias("hi"), F.count("*").alias("rows")).where("rows > 1")
    again = scratch.save(again.select("doc_id", "lo", "hi"), "again")
    sets = sets_of(known, wanted, wanted.count()).withColumnRenamed("uid", "member")
    if again.limit(1).count():  # repeated rows
        sets = sets.dropDuplicates(["member"])
    placed = few(regions, regions.count()).withColumnRenamed("pivot", "region").join(sets, "member")
    heavy = regions.groupBy("pivot").agg(F.sum("n").alias("weight")).where(F.col("weight") > REGION_SHINGLES).limit(1).count()
    links = join_weighed(scratch.save(placed, "shipped"), scratch) if heavy else join_regions(placed, ["region"])
    several = again.where("lo < hi").select("doc_id", "lo")
    if n := several.count():  # the texts of one id belong together
        links = links.unionByName(posters.join(few(several, n), "doc_id").select(F.col("poster").alias("src"), F.col("lo").alias("dst")).distinct())
        links = links.unionByName(moved.select(F.col("poster").alias("src"), F.col("rep").alias("dst")))
    links = scratch.save(links, "links")
    scratch.release()
    components = scratch.save(connected_components(links, scratch), "labels")
    n = components.count()
    least = rows.join(few(components, n), F.col("uid") == F.col("vid")).select("vid", "component", "doc_id")
    least = least.join(same.select("poster", "least"), F.col("vid") == F.col("poster"), "left").select("vid", "component", F.coalesce("least", "doc_id").alias("least"))
    joined = scratch.save(least.groupBy("component").agg(F.min("least").alias("component_id")), "named")
    labels = components.join(joined, "component").select("vid", "component_id")
    copied = same.join(labels, F.col("rep") == F.col("vid"), "left").select("poster", F.coalesce("component_id", "least").alias("component_id"))
    alone = labels.join(same.select("poster"), F.col("vid") == F.col("poster"), "left_anti").select(F.col("vid").alias("poster"), "component_id")
    labels = scratch.save(copied.unionByName(alone), "found")
    out = rows.join(few(labels, labels.count()), "poster", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The document that names its component, of each component, with all its columns."""
    gone = scratch.save(near_duplicates(docs, scratch).where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    return docs.join(few(gone, gone.count()), "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def oracle() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') w from documents),
s as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') s from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) i from d where len(w) > 0)),
n as (select doc_id, count(*) n from s group by 1),
p as (select a.doc_id x, b.doc_id y, count(*) k from s a join s b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
l as (select x, y from p join n a on a.doc_id = x join n b on b.doc_id = y where 100 * k >= 80 * (a.n + b.n - k)),
r as (select doc_id, doc_id c from d union select r.doc_id, l.y from r join l on r.c = l.x)
select d.doc_id, coalesce(n.n, 0)::bigint n_shingles, min(r.c)::bigint component_id from d left join n using (doc_id) join r using (doc_id) group by all"""
