"""SentencePiece encoding and decoding with exact N-best segmentations.

Pieces and scores come from a SentencePiece model file, whose path is a parameter. A text gets a
leading space (as the models' own encoder does), spaces become part of the pieces, and a character
that no piece holds falls back to its bytes. The score of a segmentation is the sum of the scores
of its pieces; each character that falls back costs ``FALLBACK`` below the lowest score.

No piece crosses from another character to a space, and none holds a line break, so the lattice of a
text is a chain of small lattices, one for each unit (spaces with the characters up to the next).
Units are cut from a batch of texts, and the distinct ones are segmented side by side with NumPy:

* forward Viterbi gives the best score f(p) up to every position p;
* backward Viterbi gives, with f, the gap between a unit's best and second-best segmentation.

The N best segmentations of a text differ from the best one only in the N - 1 units of least gap
(others would already be behind N better ones). On these units a backward A* search runs from the
end of the piece lattice: f(p) is the exact score of the best way to complete a suffix, so
segmentations come off the queue in order of score and no dead end is expanded. The alternatives of
the units are combined best-first into the N best of the text.

Null text: null ids. Empty text: no ids. Decoding gives back every text exactly.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from obslake.llm import textbatch as tb
from obslake.llm.tables import Carried

NBEST = 4
#: Longer units, which are rare, are searched one by one.
LONG = 200
FALLBACK = 10.0
MARK = "▁"
SPACE, BREAK = 0x20, 0x0A
NONE = -1e18
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 20


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """Pieces of a model as bytes, with spaces for the model's space marks."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of: list[bytes] = []
        self.score: list[float] = []
        self.byte_id = np.zeros(256, dtype=np.int32)
        found: dict[bytes, int] = {}
        for i in range(model.get_piece_size()):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(text[3:5], 16)
                self.byte_id[value] = i
                held = bytes([value])
            elif model.is_control(i) or model.is_unknown(i):
                held = b""
            else:
                held = text.replace(MARK, " ").encode()
                if b" " in held.lstrip(b" ") or b"\n" in held:
                    raise ValueError(f"piece {i} crosses a border between units: {text!r}")
                found.setdefault(held, i)
            self.bytes_of.append(held)
            self.score.append(float(model.get_score(i)))
        used = [self.score[i] for i in found.values()]
        self.fallback = min(used) - FALLBACK
        self.found = found
        self.longest = max(map(len, found))
        keys = np.array([_hash_of(held) for held in found], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(list(found.values()), dtype=np.int32)[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        self.scores = np.array(self.score)[self.ids]
        self.maybe = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.maybe[(self.keys * _MULTIPLIER) >> np.uint64(64 - _FILTER_BITS)] = True

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """Index into ``ids`` of each hash, -1 for those that are no piece."""
        out = np.full(len(keys), -1, dtype=np.int32)
        likely = np.flatnonzero(self.maybe[(keys * _MULTIPLIER) >> np.uint64(64 - _FILTER_BITS)])
        asked = keys[likely]
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        hit = self.keys[at] == asked
        out[likely[hit]] = at[hit]
        return out

    def decode(self, ids: list[int]) -> str | None:
        """The text of the ids of a whole text."""
        if ids is None:
            return None
        return b"".join(map(self.bytes_of.__getitem__, ids))[1:].decode()


_BYTE_VALUE = np.random.Generator(np.random.PCG64(99)).integers(0, 2**64, 256, dtype=np.uint64)
_STEP = np.uint64(0xD1342543DE82EF95)


def _hash_of(held: bytes) -> int:
    value = 0
    for byte in held:
        value = (value * int(_STEP) + int(_BYTE_VALUE[byte])) % 2**64
    return value


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the units of texts that each begin with the added space."""
    if len(data) == 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    space, line = data == SPACE, data == BREAK
    cut = np.zeros(len(data), dtype=bool)
    cut[1:] = (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
    cut[offsets[:-1]] = True
    starts = np.flatnonzero(cut)
    return starts, np.append(starts[1:], len(data))


class Lattices:
    """Piece lattices of units of equal length in bytes: all edges, Viterbi scores and gaps."""

    def __init__(self, pieces: Pieces, rows: np.ndarray):
        self.pieces, self.rows = pieces, rows
        n, size = rows.shape
        values = _BYTE_VALUE[rows]
        begins = (rows & 0xC0) != 0x80  # a character begins here
        self.edges: dict[tuple[int, int], np.ndarray] = {}  # (start, end) -> index of piece, -1, -2: fallback
        self.forward = np.full((size + 1, n), NONE)
        self.forward[0] = 0.0
        self.last = np.zeros((size + 1, n), dtype=np.int32)  # length of the best last piece
        hashes = np.zeros((size, n), dtype=np.uint64)  # of the bytes from each start to the current end
        for end in range(1, size + 1):
            low = max(0, end - pieces.longest)
            hashes[low:end] *= _STEP
            hashes[low:end] += values[:, end - 1]
            keys = hashes[low:end]
            at = pieces.look_up(keys.ravel()).reshape(keys.shape)
            whole = np.ones(n, dtype=bool) if end == size else begins[:, end]
            best, length = self.forward[end], self.last[end]
            for start in range(low, end):  # the longest piece first
                found = at[start - low]
                if end - start <= 4:
                    # a character without a piece of its own falls back to its bytes
                    char = begins[:, start] & whole & (begins[:, start:end].sum(axis=1) == 1)
                    found = np.where(char & (found < 0), -2, found)
                if not (found != -1).any():
                    continue
                self.edges[start, end] = found
                total = np.where(found != -1, self.forward[start] + self._score(found), NONE)
                better = total > best
                best[better] = total[better]
                length[better] = end - start

    def _score(self, found: np.ndarray) -> np.ndarray:
        return np.where(found >= 0, self.pieces.scores[np.maximum(found, 0)], self.pieces.fallback)

    def gaps(self) -> np.ndarray:
        """Best score less second-best score of each unit; infinite where there is one segmentation."""
        size, n = self.rows.shape[1], self.rows.shape[0]
        backward = np.full((size + 1, n), NONE)
        backward[size] = 0.0
        on_best = np.zeros((size + 1, n), dtype=bool)
        on_best[size] = True
        every = np.arange(n)
        for end in range(size, 0, -1):
            at = np.flatnonzero(on_best[end])
            on_best[end - self.last[end, at], at] = True
        for start, end in sorted(self.edges, reverse=True):
            found = self.edges[start, end]
            total = np.where(found != -1, backward[end] + self._score(found), NONE)
            backward[start] = np.maximum(backward[start], total)
        second = np.full(n, NONE)
        for (start, end), found in self.edges.items():
            best_edge = on_best[end] & (self.last[end] == end - start)
            through = np.where((found != -1) & ~best_edge, self.forward[start] + self._score(found) + backward[end], NONE)
            second = np.maximum(second, through)
        return np.where(second > NONE / 2, self.forward[size, every] - second, np.inf)

    def best_ids(self) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the best segmentation from the last to the first, -1 where none; how many)."""
        n, size = self.rows.shape
        out = np.full((size, n), -1, dtype=np.int32)
        position = np.full(n, size)
        for start, end in sorted(self.edges, key=lambda e: (-e[1], e[0])):
            on = np.flatnonzero((position == end) & (self.last[end] == end - start))
            if len(on) == 0:
                continue
            found = self.edges[start, end][on]
            piece, fell = found >= 0, found == -2
            out[start, on[piece]] = self.pieces.ids[found[piece]]
            for k in range(start, end):
                out[k, on[fell]] = self.pieces.byte_id[self.rows[on[fell], k]]
            position[on] = start
        return out, (out >= 0).sum(axis=0)


def a_star(pieces: Pieces, unit: bytes, count: int) -> list[tuple[float, tuple[int, ...]]]:
    """The ``count`` best segmentations (score, ids) of a unit, in order of score."""
    size = len(unit)
    begins = [(b & 0xC0) != 0x80 for b in unit] + [True]
    into: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in range(size + 1)]
    forward = [NONE] * (size + 1)
    forward[0] = 0.0
    for end in range(1, size + 1):
        for start in range(max(0, end - pieces.longest), end):
            held = unit[start:end]
            i = pieces.found.get(held)
            if i is not None:
                into[end].append((start, pieces.score[i], (i,)))
            elif begins[start] and begins[end] and sum(begins[start:end]) == 1:
                into[end].append((start, pieces.fallback, tuple(int(pieces.byte_id[b]) for b in held)))
        for start, score, _ in into[end]:
            forward[end] = max(forward[end], forward[start] + score)
    results: list[tuple[float, tuple[int, ...]]] = []
    queue = [(-forward[size], 0, size, 0.0, None)]
    made = 0
    while queue and len(results) < count:
        _, _, position, done, path = heapq.heappop(queue)
        if position == 0:
            ids: list[int] = []
            while path is not None:
                ids.extend(path[0])
                path = path[1]
            results.append((done, tuple(ids)))
            continue
        for start, score, ids in into[position]:
            if forward[start] > NONE / 2:
                made += 1
                # of equal ones the newest first, which is the furthest: ties must not widen the search
                heapq.heappush(queue, (-(forward[start] + score + done), -made, start, score + done, (ids, path)))
    return results


def combine(alternatives: list[list[float]], count: int) -> list[tuple[float, tuple[int, ...]]]:
    """The ``count`` best choices (score, option of each unit) of one option per unit, best first."""
    first = tuple([0] * len(alternatives))
    queue = [(-sum(a[0] for a in alternatives), first)]
    seen, results = {first}, []
    while queue and len(results) < count:
        minus, chosen = heapq.heappop(queue)
        results.append((-minus, chosen))
        for i, options in enumerate(alternatives):
            if chosen[i] + 1 < len(options):
                further = (*chosen[:i], chosen[i] + 1, *chosen[i + 1:])
                if further not in seen:
                    seen.add(further)
                    score = -minus - options[chosen[i]] + options[chosen[i] + 1]
                    heapq.heappush(queue, (-score, further))
    return results


class Encoder:
    """Encodes batches of texts; lives in a task."""

    #: Units with their segmentations that a task remembers.
    REMEMBERED = 20_000

    def __init__(self, path: str, nbest: int = NBEST):
        self.pieces, self.nbest = Pieces(path), nbest
        self.known: dict[bytes, list] = {}

    def segment(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Of units: (ids of all, where each one's begin, best scores, gaps)."""
        n, lengths = len(starts), ends - starts
        counts, scores, gaps = np.zeros(n, dtype=np.int64), np.zeros(n), np.zeros(n)
        parts = []
        for k in np.flatnonzero(lengths > LONG).tolist():
            found = a_star(self.pieces, data[starts[k]:ends[k]].tobytes(), 2)
            counts[k], scores[k] = len(found[0][1]), found[0][0]
            gaps[k] = found[0][0] - found[1][0] if len(found) > 1 else np.inf
            parts.append((np.array([k]), np.array(found[0][1], dtype=np.int32)[:, None]))
        for size in np.unique(lengths[lengths <= LONG]).tolist():
            every = np.flatnonzero(lengths == size)
            step = max(1, 400_000 // size)
            for low in range(0, len(every), step):
                which = every[low:low + step]
                lattices = Lattices(self.pieces, data[starts[which][:, None] + np.arange(size)])
                ids, counts[which] = lattices.best_ids()
                scores[which], gaps[which] = lattices.forward[size], lattices.gaps()
                parts.append((which, ids))
        begin = np.cumsum(counts) - counts
        flat = np.zeros(int(counts.sum()), dtype=np.int32)
        for which, ids in parts:
            held = ids.T
            place = np.cumsum(held >= 0, axis=1) - 1 + begin[which][:, None]
            flat[place[held >= 0]] = held[held >= 0]
        return flat, begin, counts, scores, gaps

    def encode(self, texts: pa.Array):
        """(offsets, ids, best score, N-best scores, N-best ids' changes) of each text."""
        raw, at = tb.utf8(texts)
        sizes = np.diff(at)
        sizes = sizes + (sizes > 0)
        offsets = np.append(0, np.cumsum(sizes))
        full = sizes > 0
        data = np.full(int(offsets[-1]), SPACE, dtype=np.uint8)
        added = np.zeros(len(data), dtype=bool)
        added[offsets[:-1][full]] = True
        data[~added] = raw
        kept = offsets[np.append(full, True)]
        starts, ends = units(data, kept)
        hashes = tb.mix(tb.segment_hashes(data, starts, ends) ^ (tb.segment_hashes(data, starts, ends, 1) << np.uint64(1)))
        _, first, unit = np.unique(hashes, return_index=True, return_inverse=True)
        flat, begin, counts, scores, gaps = self.segment(data, starts[first], ends[first])
        cut = np.searchsorted(starts, offsets)
        per_unit = counts[unit]
        reach = np.append(0, np.cumsum(per_unit))
        place = np.arange(reach[-1]) - np.repeat(reach[:-1] - begin[unit], per_unit)
        ids = flat[place]
        best = np.append(0.0, np.cumsum(scores[unit]))
        return ids, reach[cut], best[cut[1:]] - best[cut[:-1]], self._alternatives(
            data, starts, ends, cut, unit, gaps)

    def _options(self, held: bytes) -> list[tuple[float, tuple[int, ...]]]:
        found = self.known.get(held)
        if found is None:
            if len(self.known) >= self.REMEMBERED:
                self.known.clear()
            found = self.known[held] = a_star(self.pieces, held, self.nbest)
        return found

    def _alternatives(self, data, starts, ends, cut, unit, gaps) -> list[list[tuple[float, dict]]]:
        """Per text the N best: (loss against the best, {unit of the text: ids})."""
        out, gap_of = [], gaps[unit]
        for i in range(len(cut) - 1):
            own = gap_of[cut[i]:cut[i + 1]]
            few = self.nbest - 1
            if len(own) > few > 0:
                bound = np.partition(own, few - 1)[few - 1]
                near = np.flatnonzero(own <= bound)[:len(own)]
                near = near[np.argsort(own[near], kind="stable")][:few]
            else:
                near = np.arange(len(own) if few else 0)
            near = np.sort(near[np.isfinite(own[near])])
            options = [self._options(data[starts[cut[i] + u]:ends[cut[i] + u]].tobytes()) for u in near.tolist()]
            losses = [[o[0] - held[0][0] for o in held] for held in options]
            out.append([(score, {int(u): options[k][c][1] for k, (u, c) in enumerate(zip(near, chosen)) if c})
                        for score, chosen in combine(losses, self.nbest)] if len(own) else [])
        return out


COUNTS = "_n_ids long, _scores array<double>, _round_trip boolean"
DIGEST = f"_ids_sha256 string, {COUNTS}"
RESULT = f"_ids array<int>, _changes array<array<struct<unit:int,ids:array<int>>>>, {COUNTS}"
_CHANGES = pa.list_(pa.list_(pa.struct([("unit", pa.int32()), ("ids", pa.list_(pa.int32()))])))


def _encode(path: str, nbest: int, digest: bool, names: list[str]):
    def run(batches):
        encoder = Encoder(path, nbest)
        for batch in tb.pieces(batches, "text", tb.CHUNK):
            texts = tb.column_of(batch, "text")
            ids, cut, best, others = encoder.encode(texts)
            at, valid = cut.tolist(), texts.is_valid().to_pylist()
            same, hashed = [], []
            for i, text in enumerate(texts.to_pylist()):
                own = ids[at[i]:at[i + 1]]
                same.append(None if text is None else text == encoder.pieces.decode(own.tolist()))
                if digest:
                    hashed.append(None if text is None else hashlib.sha256(own.tobytes()).hexdigest())
            scores = [[best[i] + loss for loss, _ in o] if valid[i] else None for i, o in enumerate(others)]
            if digest:
                held = [pa.array(hashed, pa.string())]
            else:
                changes = [[[{"unit": u, "ids": list(x)} for u, x in sorted(change.items())] for _, change in o]
                           if valid[i] else None for i, o in enumerate(others)]
                held = [pa.ListArray.from_arrays(
                    pa.array(cut, pa.int32()), pa.array(ids, pa.int32()), mask=pa.array([not v for v in valid])),
                    pa.array(changes, _CHANGES)]
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), batch.column("text"), *held, pa.array(np.diff(cut), pa.int64()),
                pa.array(scores, pa.list_(pa.float64())), pa.array(same, pa.bool_())], names=names)
    return run


def encode(
    documents: DataFrame, model_path: str | None = None, nbest: int = NBEST, digest: bool = False,
) -> DataFrame:
    """Every column and, per text: _ids of the best segmentation and _changes, for each of the N best
    the units whose pieces differ from the best (``digest``: only _ids_sha256, of the ids as 32-bit
    little-endian numbers), _n_ids, _scores of the N best, and _round_trip (decoding gives the text)."""
    carried = Carried(documents, StructType.fromDDL(DIGEST if digest else RESULT))
    run = _encode(model_path or default_model(), nbest, digest, carried.schema.fieldNames())
    return carried.unpack(documents.select(carried.row, "text").mapInArrow(run, carried.schema))
