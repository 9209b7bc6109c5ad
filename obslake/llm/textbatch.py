"""Words, lines and fingerprints of a batch of texts, as NumPy arrays over their UTF-8 bytes.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, which is what ``bytes.split()``
gives. A null text is an empty text. Fingerprints are polynomial hashes over a table of random byte
values, finalised by a mixing step; two lanes with different tables make a 128-bit fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes of text that are hashed at a time; the work arrays are some 40 times as large.
CHUNK = 1 << 20
LANES = 2

_random = np.random.Generator(np.random.PCG64(20240517))
_BYTES = _random.integers(0, 2**64, (LANES, 256), dtype=np.uint64)
_BASE = [0x9E3779B97F4A7C15 | 5, 0xD1342543DE82EF95 | 5]
_WORD_BASE = [np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)]
_powers: dict[tuple[int, bool], np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(lane: int, inverse: bool, size: int) -> np.ndarray:
    """base^0 .. base^(size-1) modulo 2^64, or of its inverse."""
    have = _powers.get((lane, inverse))
    if have is None or len(have) < size:
        base = pow(_BASE[lane], -1, 2**64) if inverse else _BASE[lane]
        have = np.full(max(size, CHUNK + 1), base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[lane, inverse] = have
    return have[:size]


def utf8(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a column of texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.cast(pa.large_string()).combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.chunk(0)
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def segments(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the maximal runs of true bytes, which end with their text at the latest."""
    if len(inside) == 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begin, end = offsets[:-1], offsets[1:]
    begin, end = begin[begin < len(inside)], end[end > 0] - 1
    first[begin], last[end] = inside[begin], inside[end]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def owner(offsets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The text to which each position belongs."""
    return np.searchsorted(offsets, starts, side="right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text) of all words."""
    starts, ends = segments(~SPACE[data], offsets)
    return starts, ends, owner(offsets, starts)


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
    """Fingerprints of byte ranges, which are in order and do not overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        low = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, low + CHUNK, side="right")))
        high = ends[j - 1]
        size = int(high - low)
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(_BYTES[lane][data[low:high]] * _power(lane, False, size), out=sums[1:])
        a, b = starts[i:j] - low, ends[i:j] - low
        out[i:j] = (sums[b] - sums[a]) * _power(lane, True, size + 1)[a]
        i = j
    return mix(out + (ends - starts).astype(np.uint64))


def window_hashes(hashes: np.ndarray, size: int, lane: int = 0) -> np.ndarray:
    """Fingerprint of every ``size`` consecutive hashes, over text borders too."""
    count = max(0, len(hashes) - size + 1)
    out = np.zeros(count, dtype=np.uint64)
    for k in range(size):
        out *= _WORD_BASE[lane]
        out += hashes[k:k + count]
    return mix(out)


def whole_windows(text_of_word: np.ndarray, size: int) -> np.ndarray:
    """Which windows lie in one text."""
    count = max(0, len(text_of_word) - size + 1)
    return text_of_word[:count] == text_of_word[size - 1:size - 1 + count]


def pieces(batches: Iterator[pa.RecordBatch], column: str, size: int = 2 * CHUNK) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each have about ``size`` bytes; a longer text stands alone."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        reach = np.cumsum(lengths)
        start = 0
        while start < batch.num_rows:
            before = reach[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(reach, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def column_of(batch: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    held = batch.column(name)
    return held.combine_chunks() if isinstance(held, pa.ChunkedArray) else held


def packed(values: np.ndarray) -> bytes:
    """Numbers, compressed as planes of bytes: small numbers leave most planes empty."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return pa.Codec("zstd", 1).compress(planes.tobytes(), asbytes=True)


def unpacked(data: bytes, count: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = pa.Codec("zstd").decompress(data, count * width, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, count).T).view(kind).ravel()
