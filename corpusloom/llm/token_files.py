"""Operator 1: token IDs in flat binary files with 64-bit document offsets.

Format of a shard (little-endian):

* ``shard-NNNNN.bin``: the ids of its documents one after another, as unsigned 16-bit integers if the vocabulary and
  the end id fit, else unsigned 32-bit;
* ``shard-NNNNN.idx``: ``n + 1`` signed 64-bit offsets within the shard, then ``n`` signed 64-bit document ids
  (the smallest 64-bit integer stands for a null id).

Shards are ranges of doc_id in ascending order. The manifest (Parquet, one row a shard) holds each shard's base, the
prefix sum of the id counts of the shards before it; global offset = base + offset within the shard. Readers map the
files into memory and never load a whole shard.

Defined cases: a null text counts as empty; an empty document holds just its end id; rows of equal doc_id follow one another,
ordered by their text's hash; null ids come first; an empty table gives an empty manifest; other columns are ignored.
A task writes to a name of its own attempt and then renames it, so that a repeated task replaces the same bytes.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.texts import bounded_batches, id_and_text, kept_by_worker, rows_of, words_of
from corpusloom.scratch import Scratch

NULL_ID = -(2**63)
#: Entries a worker keeps of its cache of words; longer words aren't kept.
CACHE_WORDS, CACHE_CHARS = 600_000, 48

_PLAIN = re.compile("[a-zß-öø-ÿ]+")
#: A stop or comma that ends a word and follows something other than a plain letter or digit: it may be one token with it.
_JOINED = re.compile(r"[^a-zß-öø-ÿ0-9][.,](?:[\x20\x09-\x0D]|$)")
#: How the tokenizer cuts a printable ASCII word (fixed by its file).
_ASCII = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_UNUSUAL = re.compile("[^\x00-\xff]")


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """Ids of whole texts from a tokenizer whose pieces never cross white space and which drops it.

    The library encodes each distinct word once and the ids of a text are those of its words in turn. This is exact for
    tokenizers that normalise character by character within words and split at white space, as word_bpe_49k does; the
    tests hold it against encoding whole texts.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u2") if max(self.tokenizer.get_vocab_size() - 1, end_id) < 2**16 else np.dtype("<u4")
        self.letters = byte_letters()
        self.cache: dict[str, bytes] = {}

    def _pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.dtype.itemsize == 2 else 'I'}", *ids)

    def _piece(self, piece: str) -> bytes:
        return self._pack([t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))])

    def _learn(self, words: set[str], into: dict[str, bytes]) -> None:
        rest = []
        for w in words:
            if _PLAIN.fullmatch(w):  # one run of lower-case letters is one piece for the model
                into[w] = self._piece(w)
            elif w.isascii() and w.isprintable() and "<|" not in w and len(w) <= CACHE_CHARS:
                parts = _ASCII.findall(w.lower())
                if len(parts) == 1 and parts[0] != w:
                    into[w] = self._piece(parts[0])
                    continue
                for p in parts:
                    if p not in into:
                        into[p] = self._piece(p)
                into[w] = b"".join(map(into.__getitem__, parts))
            else:
                rest.append(w)
        for i in range(0, len(rest), 1000):
            for w, e in zip(part := rest[i : i + 1000], self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                into[w] = self._pack(e.ids)

    @staticmethod
    def words(text: str) -> list[str]:
        """Words such that their ids one after another are the text's; a final stop or comma is a word of its own where that's safe."""
        if not _UNUSUAL.search(text):
            lower = text.lower()
            if not _JOINED.search(lower) and "<|" not in lower:
                for mark in ".,":
                    lower = lower.replace(f"{mark} ", f" {mark} ").replace(f"{mark}\n", f" {mark} ")
                return words_of(lower)
        return words_of(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        split = [self.words(t) for t in texts]
        new = set().union(*split).difference(self.cache)
        long = {w for w in new if len(w) > CACHE_CHARS}
        self._learn(new - long, self.cache)
        if not long:
            return [b"".join(map(self.cache.__getitem__, ws)) for ws in split]
        extra: dict[str, bytes] = {}
        self._learn(long, extra)
        return [b"".join(extra[w] if w in extra else self.cache[w] for w in ws) for ws in split]


def encoder_of(path: str, end_id: int) -> WordEncoder:
    """One for each worker process, until it works for another operator: its tokenizer and cache serve all tasks that the process runs."""
    return kept_by_worker(("tokens", path, end_id), lambda: WordEncoder(path, end_id))


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def write_token_files(docs: DataFrame, scratch: Scratch, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Encode ``docs`` into token files and return the manifest: shard, path, n_docs, n_ids, base_ids, base_docs, width."""
    spark = docs.sparkSession
    bounded_batches(spark)
    root = scratch.path("tokens")

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, encoder = TaskContext.get().partitionId(), encoder_of(tokenizer, end_id)
        end = np.array([end_id], encoder.dtype).tobytes()
        fs, top = _open(root)
        path, temp = f"{top}/shard-{number:05d}", f"{top}/tmp-{uuid.uuid4().hex}"
        lengths, ids = [], []
        out = None
        for batch in batches:
            part = list(rows_of(batch, "doc_id", "text"))
            for i in range(0, len(part), 64):
                if out is None:
                    fs.create_dir(top, recursive=True)
                    out = fs.open_output_stream(f"{temp}.bin")
                for (doc, _), got in zip(part[i : i + 64], encoder.encode([t for _, t in part[i : i + 64]]), strict=True):
                    out.write(got)
                    out.write(end)
                    lengths.append(len(got) // encoder.dtype.itemsize + 1)
                    ids.append(NULL_ID if doc is None else doc)
        if out is None:
            return
        out.close()
        offsets = np.zeros(len(lengths) + 1, "<i8")
        np.cumsum(lengths, out=offsets[1:])
        with fs.open_output_stream(f"{temp}.idx") as index:
            index.write(offsets.tobytes())
            index.write(np.array(ids, "<i8").tobytes())
        for ending in (".bin", ".idx"):
            fs.move(f"{temp}{ending}", f"{path}{ending}")
        yield pa.RecordBatch.from_pydict({"shard": pa.array([number], pa.int32()), "path": [f"{root}/shard-{number:05d}"], "n_docs": pa.array([len(ids)], pa.int64()), "n_ids": pa.array([int(offsets[-1])], pa.int64()), "width": pa.array([encoder.dtype.itemsize], pa.int32())})

    keyed = id_and_text(docs).withColumn("tie", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    written = scratch.save(ordered.select("doc_id", "text").mapInArrow(shard, "shard int, path string, n_docs long, n_ids long, width int"), "shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    based = written.withColumn("base_ids", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).withColumn("base_docs", F.coalesce(F.sum("n_docs").over(before), F.lit(0)))
    return scratch.save(based, "manifest")


class TokenShard:
    """A shard mapped into memory (or read by ranges where the store can't be mapped)."""

    def __init__(self, path: str, n_docs: int, width: int):
        fs, top = _open(path)
        self.dtype = np.dtype(f"<u{width}")
        local = isinstance(fs, pafs.LocalFileSystem)
        with (pa.memory_map(f"{top}.idx") if local else fs.open_input_file(f"{top}.idx")) as f:
            head = np.frombuffer(f.read(), "<i8")
        self.offsets, self.doc_ids = head[: n_docs + 1], head[n_docs + 1 :]
        self.file = pa.memory_map(f"{top}.bin") if local else fs.open_input_file(f"{top}.bin")

    def ids(self, i: int) -> np.ndarray:
        """Ids of the shard's document ``i``."""
        a, b = int(self.offsets[i]), int(self.offsets[i + 1])
        return np.frombuffer(self.file.read_at((b - a) * self.dtype.itemsize, a * self.dtype.itemsize), self.dtype)


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32, shard."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, path, n, width, base in rows_of(batch, "shard", "path", "n_docs", "width", "base_ids"):
                shard = TokenShard(path, n, width)
                for i in range(0, n, 4096):
                    k = range(i, min(n, i + 4096))
                    docs = [int(shard.doc_ids[j]) for j in k]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array([None if d == NULL_ID else d for d in docs], pa.int64()),
                        "start": pa.array([base + int(shard.offsets[j]) for j in k], pa.int64()),
                        "n_tokens": pa.array([int(shard.offsets[j + 1] - shard.offsets[j]) for j in k], pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(shard.ids(j).astype("<u4")) for j in k], pa.int64()),
                        "shard": pa.array([number] * len(k), pa.int32()),
                    })

    spark: SparkSession = manifest.sparkSession
    spread = manifest.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "shard")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard int")
