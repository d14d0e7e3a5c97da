"""Operator 9: sampled SentencePiece encoding by forward filtering and backward sampling, and lossless decoding.

A text is escaped as SentencePiece does (a space becomes U+2581, one is put in front) and falls into units: a space and the word
after it, a line break, a stop or comma. There's no border between two characters that lie side by side in a piece, as in runs of spaces or
``),``: no piece crosses a border, so the lattice over all segmentations is a chain of unit lattices. A piece of rank r weighs (r + 2) ** -ALPHA;
a character without a piece is spelt in byte pieces. Forward filtering runs once for each distinct unit and leaves, for every
position, the cumulative posterior of the pieces that end there. Backward sampling then walks all units of many texts at
once from their ends. Its random numbers come from a counter-based generator keyed by the document's id, the unit's
position and the step, so that a repeated or moved task gives the same segmentation.

Decoding concatenates the pieces' bytes; it gives back every text exactly, U+2581 itself being spelt in bytes.

Defined cases: a null text counts as empty and has no pieces; a null doc_id has key 0; repeated rows get equal
segmentations; texts are processed in blocks whatever their length; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.texts import bounded_batches, id_and_text, kept_by_worker

ALPHA, SEED = 1.0, 20_240_229
#: Units whose lattices a worker keeps, and their bytes; units sampled at once, the longest unit that is kept, and units whose lattices are filled at once.
CACHE_UNITS, CACHE_BYTES, BLOCK_UNITS, CACHE_CHARS, LATTICE_UNITS = 300_000, 160_000_000, 60_000, 40, 8_192
_MARK, _CUT = "\ud800", "\ud801"  # can't occur in a text: U+2581 itself, and a border of units
_BYTE = re.compile("<0x([0-9A-F]{2})>")


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(key: np.ndarray, step: int) -> np.ndarray:
    """A number in [0, 1) for each key at a step."""
    return (mix(key + np.uint64(((step + 1) * 0x9E3779B97F4A7C15) % 2**64)) >> np.uint64(11)) * 2.0**-53


def _by_value(x: np.ndarray) -> list[np.ndarray]:
    """The places of each value of ``x``, from the least value to the greatest."""
    return np.split(order := np.argsort(x, kind="stable"), np.flatnonzero(np.diff(x[order])) + 1)


class Growing:
    """A NumPy array that grows by doubling."""

    def __init__(self, dtype: str):
        self.a, self.n = np.zeros(1 << 12, dtype), 0

    def extend(self, values: np.ndarray | list) -> None:
        need = self.n + len(values)
        if need > len(self.a):
            grown = np.empty(max(need, 2 * len(self.a)), self.a.dtype)  # memory beyond n isn't touched before it's used
            grown[: self.n] = self.a[: self.n]
            self.a = grown
        self.a[self.n : need] = values
        self.n = need

    def view(self) -> np.ndarray:
        return self.a[: self.n]


class PieceSampler:
    """Lattices are kept as states (positions of a unit) whose incoming edges lie together, each with its cumulative posterior."""

    def __init__(self, model: str, alpha: float = ALPHA):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.weights: dict[str, tuple[int, float]] = {}
        self.byte_ids = [0] * 256
        self.bytes: list[bytes] = []
        self.line_pieces = False
        joined: dict[str, set[str]] = {c: set() for c in "▁.,\n"}  # what pieces have before these
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if m := _BYTE.fullmatch(piece) if sp.is_byte(i) else None:
                self.byte_ids[int(m[1], 16)] = i
                self.bytes.append(bytes([int(m[1], 16)]))
                continue
            self.bytes.append(b"" if sp.is_control(i) or sp.is_unknown(i) else piece.replace("▁", " ").encode())
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                continue
            for a, b in zip(piece, piece[1:]):
                if b in joined:
                    joined[b].add(a)
            self.line_pieces |= "\n" in piece
            self.weights[piece] = (i, (max(0.0, -sp.get_score(i)) + 2) ** -alpha)
        self.before_space = sorted(joined["▁"])
        kept = [f"(?<=[{''.join(map(re.escape, sorted(joined[c])))}]{_CUT})(?=[{c}])" for c in ".," if joined[c]]
        self.no_border = re.compile(f"{_CUT}(?:{'|'.join(kept)})") if kept else None
        self.longest = max(map(len, self.weights))
        if self.longest > 0xFF:
            raise ValueError("a piece has over 255 characters")
        self.byte_weight = (sp.get_piece_size() + 2.0) ** -alpha
        self.decode_table = np.array(self.bytes, object)
        self.single = {p for p in self.weights if len(p) == 1}
        self._index()
        self.reset()

    def _index(self) -> None:
        """A tree of the pieces' characters in one array: a node's child by a class of characters is at the node's base plus the class.

        A base is drawn until all of a node's children fall on free places, nodes of many children first; ``owner`` tells whose a place is.
        """
        names = list(self.weights)
        self.piece_id = np.array([self.weights[p][0] for p in names], np.int32)
        self.piece_weight = np.array([self.weights[p][1] for p in names])
        self.piece_size = np.array([len(p) for p in names], np.int64)
        classes = {c: k for k, c in enumerate(sorted(set().union(*names)), 1)}  # 0 is for characters that no piece has
        self.char_class = np.zeros(0x110000, np.int32)
        self.char_class[[ord(c) for c in classes]] = range(1, len(classes) + 1)
        children: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        for k, p in enumerate(names):
            node = 0
            for c in p:
                if (child := children[node].get(classes[c])) is None:
                    child = children[node][classes[c]] = len(children)
                    children.append({})
                node = child
            ends[node] = k
        room, draw = 8 * len(children), random.Random(0).randrange
        bases, place, taken = [0] * len(children), [0] * len(children), bytearray(room + len(classes) + 1)
        for node in sorted(range(len(children)), key=lambda n: -len(children[n])):
            if not (below := children[node]):
                break
            base = draw(1, room)
            while any(taken[base + c] for c in below):
                base = draw(1, room)
            bases[node] = base
            for c, child in below.items():
                place[child], taken[base + c] = base + c, 1
        self.base, self.owner, self.number = np.zeros(len(taken), np.int32), np.full(len(taken), -1, np.int32), np.full(len(taken), -1, np.int32)
        self.base[place] = bases
        for node, below in enumerate(children):
            self.owner[[place[child] for child in below.values()]] = place[node]
        for node, k in ends.items():
            self.number[place[node]] = k

    def _find(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(end, number) of all pieces in ``text``, in order of their ends, the longest first."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        classes = np.concatenate((self.char_class[codes], np.zeros(self.longest, np.int32)))
        at, node, found = np.arange(len(codes)), np.zeros(len(codes), np.int32), []
        for size in range(1, self.longest + 1):
            child = self.base[node] + classes[at + (size - 1)]
            on = np.flatnonzero(self.owner[child] == node)
            at, node = at[on], child[on]
            number = self.number[node]
            hit = np.flatnonzero(number >= 0)
            found.append((at[hit] + size) << 32 | (0xFF - size) << 24 | number[hit])
        key = np.sort(np.concatenate(found))
        return key >> 32, key & 0xFFFFFF

    def reset(self) -> None:
        self.known: dict[str, int] = {}
        self.end, self.size, self.room = Growing("i4"), Growing("i4"), Growing("i4")  # by unit: last state, characters, most pieces
        self.first, self.cum, self.prev, self.piece = Growing("i4"), Growing("f4"), Growing("i4"), Growing("i4")

    def nbytes(self) -> int:
        """About so many bytes of lattices and names of units."""
        return 120 * len(self.known) + sum(g.n * g.a.itemsize for g in (self.end, self.size, self.room, self.first, self.cum, self.prev, self.piece))

    def units(self, text: str) -> list[str]:
        if not text:
            return []
        text = f" {text.replace('▁', _MARK)}".replace(" ", "▁").replace(".", f"{_CUT}.").replace(",", f"{_CUT},")
        if self.no_border:
            text = self.no_border.sub("", text)
        text = text.replace("▁", f"{_CUT}▁")
        for c in self.before_space:
            text = text.replace(*((f"▁{_CUT}", "▁") if c == "▁" else (f"{c}{_CUT}▁", f"{c}▁")))
        if not self.line_pieces:
            text = text.replace("\n", f"{_CUT}\n{_CUT}")
        return [u for u in text.split(_CUT) if u]

    def _append(self, sizes: np.ndarray, state: np.ndarray, cum: np.ndarray, prev: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Add units of so many states whose edges are in order of state (counted over these units); their first states."""
        base, edges = self.first.n, self.cum.n
        starts = np.cumsum(sizes) - sizes
        per_state = np.bincount(state, minlength=int(sizes.sum()))
        self.first.extend(edges + np.cumsum(per_state) - per_state)
        self.cum.extend(cum)
        self.prev.extend(base + prev)
        self.piece.extend(piece)
        return base + starts

    def _add_alike(self, units: list[str]) -> None:
        """Forward-filter units all of whose characters are pieces, all at once: a state is a place in the joined units, borders included."""
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        starts = np.cumsum(sizes + 1) - (sizes + 1)
        state, number = self._find(_CUT.join(units))
        prev, weight = state - self.piece_size[number], self.piece_weight[number]
        states = int(starts[-1] + sizes[-1]) + 1
        forward = np.zeros(states)
        forward[starts] = 1
        place = (np.arange(states) - np.repeat(starts, sizes + 1))[state].astype(np.int16)
        for edges in _by_value(place):
            weight[edges] *= forward[prev[edges]]
            np.add.at(forward, state[edges], weight[edges])
        per_state = np.bincount(state, minlength=states)
        first = np.cumsum(per_state) - per_state
        for edges in _by_value((np.arange(len(state)) - first[state]).astype(np.int16))[1:]:
            weight[edges] += weight[edges - 1]
        posterior = weight / weight[(first + per_state - 1)[state]]
        bases = self._append(sizes + 1, state, posterior, prev, self.piece_id[number])
        self._name(units, bases + sizes, sizes, sizes)

    def _name(self, units: list[str], ends: np.ndarray, sizes: np.ndarray, room: np.ndarray) -> None:
        self.known.update(zip(units, range(self.end.n, self.end.n + len(units)), strict=True))
        for array, values in ((self.end, ends), (self.size, sizes), (self.room, room)):
            array.extend(values)

    def _add(self, unit: str) -> None:
        """Forward-filter one unit of any length and characters."""
        n, get, longest = len(unit), self.weights.get, self.longest
        # position i is state i; states inside a character spelt in bytes come after those
        forward = [0.0] * (n + 1)
        forward[0] = 1.0
        into: list[list[tuple[int, int, float]]] = [[] for _ in range(n + 1)]
        extra: list[tuple[int, int]] = []  # (previous state, piece) of the states inside characters
        for i in range(n):
            f = forward[i]
            if f < 1e-150:  # lift what is still to be read
                for j in range(i, min(n, i + longest) + 1):
                    forward[j] /= f
                    into[j] = [(a, b, w / f) for a, b, w in into[j]]
                f = forward[i]
            found = False
            for j in range(i + 1, min(n, i + longest) + 1):
                if (p := get(unit[i:j])) is not None:
                    w = f * p[1]
                    forward[j] += w
                    into[j].append((i, p[0], w))
                    found |= j == i + 1
            if not found:
                raw = ("▁" if unit[i] == _MARK else unit[i]).encode()
                prev = i
                for b in raw[:-1]:
                    extra.append((prev, self.byte_ids[b]))
                    prev = n + len(extra)
                w = f * self.byte_weight ** len(raw)
                forward[i + 1] += w
                into[i + 1].append((prev, self.byte_ids[raw[-1]], w))
        state, cums, prevs, pieces = [], [], [], []
        for j in range(1, n + 1):
            total, cum, last = sum(w for _, _, w in into[j]) or 1.0, 0.0, len(into[j]) - 1
            for k, (i, piece, w) in enumerate(into[j]):
                cum += w
                state.append(j)
                cums.append(1.0 if k == last else cum / total)
                prevs.append(i)
                pieces.append(piece)
        for k, (i, piece) in enumerate(extra):
            state.append(n + k + 1)
            cums.append(1.0)
            prevs.append(i)
            pieces.append(piece)
        base = self._append(np.array([n + 1 + len(extra)]), np.array(state), np.array(cums), np.array(prevs), np.array(pieces))
        self._name([unit], base + n, np.array([n]), np.array([n + len(extra)]))

    def _learn(self, new: set[str]) -> None:
        """Lattices of units that aren't known yet."""
        plain = [u for u in new if self.single.issuperset(u)]
        for u in new.difference(plain):
            self._add(u)
        for i in range(0, len(plain), LATTICE_UNITS):
            self._add_alike(plain[i : i + LATTICE_UNITS])

    def sample(self, units: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pieces of the units one after another, how many each has)."""
        if len(self.known) > CACHE_UNITS or self.nbytes() > CACHE_BYTES:
            self.reset()
        known = self.known
        unit = np.fromiter(map(known.get, units, repeat(-1)), np.int64, len(units))
        unknown = np.flatnonzero(unit < 0)
        missing = [units[i] for i in unknown.tolist()]
        new = set(missing)
        long = {u for u in new if len(u) > CACHE_CHARS}
        self._learn(new - long)
        kept = [(array, array.n) for array in (self.end, self.size, self.room, self.first, self.cum, self.prev, self.piece)]
        for u in long:
            self._add(u)
        unit[unknown] = np.fromiter(map(known.__getitem__, missing), np.int64, len(missing))
        state, room = self.end.view()[unit], self.room.view()[unit].astype(np.int64)
        stop = state - self.size.view()[unit]
        slot = np.cumsum(room) - 1  # where a unit's last piece goes
        buffer = np.full(int(room.sum()), -1, np.int32)
        first, cum, prev, piece = self.first.view(), self.cum.view(), self.prev.view(), self.piece.view()
        n = 0
        while len(state):
            draw = uniform(keys, n)
            edge = first[state]
            behind = np.flatnonzero(cum[edge] <= draw)
            while len(behind):  # on to the first edge whose cumulative posterior exceeds the draw
                edge[behind] += 1
                behind = behind[cum[edge[behind]] <= draw[behind]]
            buffer[slot - n] = piece[edge]
            state = prev[edge]
            on = state != stop
            if not on.all():
                state, stop, slot, keys = state[on], stop[on], slot[on], keys[on]
            n += 1
        used = buffer >= 0
        counts = np.add.reduceat(used, np.cumsum(room) - room, dtype=np.int64) if len(units) else np.zeros(0, np.int64)
        for u in long:  # long units aren't kept
            del known[u]
        for array, n in kept if long else ():
            array.n = n
        return buffer[used], counts

    def encode(self, keys: list[int], texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
        """(index of the text, ids of its next block) with every text's blocks in order."""
        pending: list[str] = []
        seeds: list[np.ndarray] = []
        spans: list[tuple[int, int]] = []

        def flush() -> Iterator[tuple[int, np.ndarray]]:
            ids, counts = self.sample(pending, np.concatenate(seeds))
            bounds, at = np.concatenate(([0], np.cumsum(counts))), 0
            for t, m in spans:
                yield t, ids[bounds[at] : bounds[at + m]]
                at += m

        for t, (key, text) in enumerate(zip(keys, texts, strict=True)):
            seed = mix(np.array([(key ^ SEED) % 2**64], np.uint64))
            units = self.units(text)
            for a in range(0, len(units), BLOCK_UNITS):
                part = units[a : a + BLOCK_UNITS]
                pending += part
                seeds.append(mix(seed + np.arange(a, a + len(part), dtype=np.uint64)))
                spans.append((t, len(part)))
                if len(pending) >= BLOCK_UNITS:
                    yield from flush()
                    pending, seeds, spans = [], [], []
        if pending:
            yield from flush()

    def decode(self, ids: np.ndarray) -> str:
        """The text of a whole segmentation."""
        return b"".join(self.decode_table[ids].tolist()).decode()[1:]


def sampler(model: str, alpha: float = ALPHA) -> PieceSampler:
    """One for each worker process, until it works for another operator."""
    return kept_by_worker(("pieces", model, alpha), lambda: PieceSampler(model, alpha))


def encode_decode(docs: DataFrame, model: str, alpha: float = ALPHA) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 (of little-endian unsigned 32-bit ids), lossless (decoded text equals the text) and decoded."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sampler(model, alpha)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            parts: list[list[np.ndarray]] = [[] for _ in texts]
            for t, ids in s.encode([k or 0 for k in keys], texts):
                parts[t].append(ids)
            ids = [np.concatenate(p) if p else np.zeros(0, np.int32) for p in parts]
            decoded = [s.decode(x) for x in ids]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "n_pieces": pa.array([len(x) for x in ids], pa.int64()), "ids_crc32": pa.array([zlib.crc32(x.astype("<u4")) for x in ids], pa.int64()),
                "lossless": pa.array([d == t for d, t in zip(decoded, texts, strict=True)], pa.bool_()), "decoded": pa.array(decoded, pa.string()),
            })

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, lossless boolean, decoded string")


def tokenise(docs: DataFrame, model: str, alpha: float = ALPHA) -> DataFrame:
    """Documents with their decoded text, n_pieces, lossless and the sampled ids (piece_ids); columns of these three names are replaced."""
    bounded_batches(docs.sparkSession)
    names = docs.columns
    schema = docs.select(*(F.col(f"`{c}`") for c in names if c not in {"piece_ids", "n_pieces", "lossless"})).schema
    at = {c: i for i, c in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sampler(model, alpha)
        for batch in batches:
            keys, texts = batch.column(at["doc_id"]).to_pylist(), [t or "" for t in batch.column(at["text"]).to_pylist()]
            parts: list[list[np.ndarray]] = [[] for _ in texts]
            for t, ids in s.encode([k or 0 for k in keys], texts):
                parts[t].append(ids)
            ids = [np.concatenate(p) if p else np.zeros(0, np.int32) for p in parts]
            decoded = [s.decode(x) for x in ids]
            columns = {f.name: batch.column(at[f.name]) for f in schema} | {"text": pa.array(decoded, pa.string())}
            yield pa.RecordBatch.from_pydict(columns | {"n_pieces": pa.array([len(x) for x in ids], pa.int64()), "lossless": pa.array([d == t for d, t in zip(decoded, texts, strict=True)], pa.bool_()), "piece_ids": pa.array(ids, pa.list_(pa.int32()))})

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return docs.mapInArrow(run, f"{out}, n_pieces long, lossless boolean, piece_ids array<int>")
