"""Substring dedup: a count-min prefilter, then an exact grouping of the windows it leaves.

1. Documents are dealt into blocks of about ``block_bytes`` of text. Each block hashes its windows
   and sends, for every row of the count-min sketch, the sorted counters it has touched to the
   segments of the sketch (delta coded, so about a byte and a half each). A segment adds up what
   the blocks sent and answers one bit per counter: whether the sum is two or more. Counters only
   ever overestimate, so no repeated window is lost. The sketch is as wide as the corpus needs and
   lies in segments of fixed size; no task and no broadcast ever holds it whole.
2. A block sends the 96-bit fingerprints of the windows whose counters are all repeated to exact
   groups, with the least document id that holds them in the block. The group answers one bit:
   whether a smaller document id holds the same window.
3. The block removes the words that answered windows cover.

A window repeated within a block is sent once, so a passage that a third of all documents share
costs each block one entry. The documents are shuffled once; the three passes reuse the exchange.

Null text: no words. Null doc_id: counts as larger than every id. Rows with equal doc_id are the
same document. Texts of fewer words than a window lose nothing. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.llm import textbatch as tb

WINDOW = 13
BLOCK_BYTES = 4 << 20
#: Counters of a segment of the sketch, one byte each while it is merged.
SEGMENT_BITS = 25
ROWS = 2
#: Windows that one exact group is sized for.
GROUP_WINDOWS = 4_000_000
LAST = np.iinfo(np.int64).max

MESSAGE = "part long, block long, count long, payload binary, memo boolean"
ANSWER = "block long, part long, bits binary, memo boolean"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
_SALT = [np.uint64(0), np.uint64(0x2545F4914F6CDD1D)]


class _Block:
    """The windows of a block of documents."""

    def __init__(self, table: pa.Table, window: int):
        # Shuffled rows of a block arrive in no promised order, and the passes that read a block
        # twice number its windows alike only if the rows are put in one order first: by id, then
        # by text. Rows equal in both are the same document, so their order among them is moot.
        if table.num_rows > 1:
            table = table.take(pc.sort_indices(
                table.select(["doc_id", "text"]),
                sort_keys=[("doc_id", "ascending"), ("text", "ascending")], null_placement="at_end"))
        self.ids = tb.column_of(table, "doc_id")
        self.key = self.ids.fill_null(LAST).to_numpy(zero_copy_only=False)
        self.data, self.offsets = tb.utf8(table.column("text"))
        starts, ends, self.text = tb.words(self.data, self.offsets)
        whole = tb.whole_windows(self.text, window)
        self.at = np.flatnonzero(whole)
        lanes = []
        for lane in range(tb.LANES):
            of_word = tb.segment_hashes(self.data, starts, ends, lane)
            lanes.append(tb.window_hashes(of_word, window, lane)[self.at])
        self.a, self.b = lanes[0], lanes[1].astype(np.uint32)

    def counters(self, row: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sorted counters, how often touched, place of each window's counter)."""
        hashes = tb.mix(self.a + _SALT[row]) if row else self.a
        return np.unique(hashes >> np.uint64(64 - bits), return_inverse=True, return_counts=True)

    def entries(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(order of the chosen windows, which of them start a new fingerprint, group of each)."""
        a, b = self.a[chosen], self.b[chosen]
        order = np.lexsort((self.key[self.text[self.at[chosen]]], b, a))
        a, b = a[order], b[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        return order, new, np.cumsum(new) - 1


def _messages(parts, block, counts, payloads, memo):
    return pa.table({
        "part": pa.array(parts, pa.int64()), "block": pa.array([block] * len(parts), pa.int64()),
        "count": pa.array(counts, pa.int64()), "payload": pa.array(payloads, pa.binary()),
        "memo": pa.array(memo, pa.bool_())})


def _cut(values: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """(parts, borders) of sorted numbers that are dealt by their high bits."""
    part = (values >> np.uint64(shift)).astype(np.int64)
    parts, first = np.unique(part, return_index=True)
    return parts, np.append(first, len(values))


def _sketch(window: int, bits: int, segment_bits: int):
    """Sketch of a block: per segment, deltas of its counters, doubled, odd if touched again."""
    def run(key, table):
        block = _Block(table, window)
        parts, counts, payloads = [], [], []
        for row in range(ROWS):
            touched, _, often = block.counters(row, bits)
            found, cut = _cut(touched, segment_bits)
            for part, low, high in zip(found.tolist(), cut[:-1].tolist(), cut[1:].tolist()):
                steps = np.diff(touched[low:high], prepend=np.uint64(part << segment_bits))
                coded = (steps.astype(np.uint32) << np.uint32(1)) | (often[low:high] > 1)
                parts.append(part * ROWS + row)
                counts.append(high - low)
                payloads.append(tb.packed(coded.astype(np.uint32)))
        return _messages(parts, key[0].as_py(), counts, payloads, [False] * len(parts))
    return run


def _merge_sketches(segment_bits: int):
    """Add up the sketches of all blocks in a segment, and tell each which counters are repeated."""
    def run(key, table):
        sums = np.zeros(1 << segment_bits, dtype=np.uint8)
        counts = table.column("count").to_pylist()
        payloads = table.column("payload")

        def counters(i):
            coded = tb.unpacked(payloads[i].as_buffer(), counts[i], np.uint32)
            return np.cumsum(coded >> np.uint32(1), dtype=np.int64), (coded & np.uint32(1)).astype(np.uint8)

        for i in range(table.num_rows):
            at, again = counters(i)
            sums[at] = np.minimum(sums[at] + 1 + again, 2)
        bits = [np.packbits(sums[counters(i)[0]] > 1).tobytes() for i in range(table.num_rows)]
        return pa.table({
            "block": table.column("block"), "part": pa.array([key[0].as_py()] * len(bits), pa.int64()),
            "bits": pa.array(bits, pa.binary()), "memo": pa.array([False] * len(bits), pa.bool_())})
    return run


def _bits(answers: pa.Table, part: int, count: int, of: dict) -> np.ndarray:
    raw = np.frombuffer(answers.column("bits")[of[part]].as_buffer(), np.uint8)
    return np.unpackbits(raw, count=count).astype(bool)


def _ask(window: int, bits: int, segment_bits: int, groups: int):
    """Fingerprints of the windows that the sketch leaves, and a note of which they are."""
    def run(key, table, answers):
        if table.num_rows == 0:
            return _messages([], 0, [], [], [])
        number, block = key[0].as_py(), _Block(table, window)
        of = {p: i for i, p in enumerate(answers.column("part").to_pylist())}
        left = np.ones(len(block.at), dtype=bool)
        for row in range(ROWS):
            touched, place, _ = block.counters(row, bits)
            repeated = np.zeros(len(touched), dtype=bool)
            found, cut = _cut(touched, segment_bits)
            for part, low, high in zip(found.tolist(), cut[:-1].tolist(), cut[1:].tolist()):
                repeated[low:high] = _bits(answers, part * ROWS + row, high - low, of)
            left &= repeated[place]
        chosen = np.flatnonzero(left)
        order, new, _ = block.entries(chosen)
        picked = chosen[order[new]]
        a, b, ids = block.a[picked], block.b[picked], block.key[block.text[block.at[picked]]]
        part = _group_of(a, groups)
        cut = np.searchsorted(part, np.arange(groups + 1))
        parts, counts, payloads = [], [], []
        for p in np.flatnonzero(np.diff(cut)).tolist():
            low, high = cut[p], cut[p + 1]
            parts.append(p)
            counts.append(int(high - low))
            payloads.append(_fingerprints(a[low:high], b[low:high], ids[low:high]))
        parts.append(number % groups)
        counts.append(len(left))
        payloads.append(np.packbits(left).tobytes())
        return _messages(parts, number, counts, payloads, [False] * (len(parts) - 1) + [True])
    return run


def _group_of(a: np.ndarray, groups: int) -> np.ndarray:
    """Exact group of each fingerprint; sorted fingerprints have sorted groups."""
    return ((a >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)


def _fingerprints(a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> bytes:
    low = int(ids.min())
    with np.errstate(over="ignore"):
        head = np.array([low], dtype=np.int64).tobytes()
        near = tb.packed(ids - np.int64(low))
    return head + len(near).to_bytes(8, "little") + near + tb.packed(np.diff(a, prepend=np.uint64(0))) + b.tobytes()


def _read_fingerprints(raw: bytes, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = np.frombuffer(raw[:8], np.int64)[0]
    size = int.from_bytes(raw[8:16], "little")
    ids = tb.unpacked(raw[16:16 + size], count, np.int64) + low
    b = np.frombuffer(raw[len(raw) - 4 * count:], np.uint32)
    a = np.cumsum(tb.unpacked(raw[16 + size:len(raw) - 4 * count], count, np.uint64))
    return a, b, ids


def _group_exactly(key, table):
    """One bit per fingerprint of each block: whether another block has it in a smaller document."""
    memo = table.column("memo").to_pylist()
    counts, payloads = table.column("count").to_pylist(), table.column("payload")
    blocks, bits = table.column("block").to_pylist(), [None] * table.num_rows
    asked = [i for i in range(table.num_rows) if not memo[i]]
    for i in range(table.num_rows):
        if memo[i]:
            bits[i] = payloads[i].as_py()
    if asked:
        read = [_read_fingerprints(payloads[i].as_py(), counts[i]) for i in asked]
        a, b, ids = (np.concatenate([r[k] for r in read]) for k in range(3))
        del read
        order = np.lexsort((ids, b, a))
        a, b, ids = a[order], b[order], ids[order]
        new = np.ones(len(a), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        least = ids[np.flatnonzero(new)][np.cumsum(new) - 1]
        earlier = np.empty(len(a), dtype=bool)
        earlier[order] = least < ids
        cut = np.cumsum([0, *(counts[i] for i in asked)])
        for k, i in enumerate(asked):
            bits[i] = np.packbits(earlier[cut[k]:cut[k + 1]]).tobytes()
    return pa.table({
        "block": pa.array(blocks, pa.int64()), "part": table.column("part"),
        "bits": pa.array(bits, pa.binary()), "memo": table.column("memo")})


def _remove(window: int, groups: int, keep_text: bool):
    def run(key, table, answers):
        block = _Block(table, window)
        covered = np.zeros(len(block.text) + 1, dtype=np.int64)
        memo = answers.column("memo").to_pylist()
        part_of = answers.column("part").to_pylist()
        of = {p: i for i, p in enumerate(part_of) if not memo[i]}
        if table.num_rows and True in memo:
            raw = np.frombuffer(answers.column("bits")[memo.index(True)].as_buffer(), np.uint8)
            chosen = np.flatnonzero(np.unpackbits(raw, count=len(block.at)))
            order, new, group = block.entries(chosen)
            picked = chosen[order[new]]
            cut = np.searchsorted(_group_of(block.a[picked], groups), np.arange(groups + 1))
            earlier = np.zeros(len(picked), dtype=bool)
            for p in np.flatnonzero(np.diff(cut)).tolist():
                earlier[cut[p]:cut[p + 1]] = _bits(answers, p, int(cut[p + 1] - cut[p]), of)
            least = block.key[block.text[block.at[picked]]]
            windows = chosen[order]
            repeat = earlier[group] | (least[group] < block.key[block.text[block.at[windows]]])
            begin = block.at[windows[repeat]]
            np.add.at(covered, begin, 1)
            np.add.at(covered, begin + window, -1)
        gone = np.cumsum(covered[:-1]) > 0
        cut = np.searchsorted(block.text, np.arange(table.num_rows + 1))
        removed = np.concatenate([[0], np.cumsum(gone)])
        n_words, n_removed = np.diff(cut), np.diff(removed[cut])
        raw, offsets, kept = block.data.tobytes(), block.offsets.tolist(), []
        for i in range(table.num_rows):
            held = raw[offsets[i]:offsets[i + 1]].split()
            if n_removed[i]:
                held = compress(held, (~gone[cut[i]:cut[i + 1]]).tolist())
            kept.append(b" ".join(held))
        columns = {
            "doc_id": block.ids, "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64())}
        if keep_text:
            columns["text"] = pa.array([k.decode() for k in kept], pa.string())
        else:
            columns["kept_sha256"] = pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())
        return pa.table(columns)
    return run


def remove_repeated_windows(
    documents: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
    segment_bits: int = SEGMENT_BITS, group_windows: int = GROUP_WINDOWS, keep_text: bool = True,
) -> DataFrame:
    """Remove every word covered by a window that also starts in a document with a smaller id.

    Returns doc_id, n_words, n_removed and the kept words joined by one space (``text``), or with
    ``keep_text=False`` their SHA-256. Windows are judged on the input.
    """
    size = documents.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, ceil(size / block_bytes))
    # a word takes five to six bytes with its space: counters for at least four times the windows
    expected = max(1, size // 6)
    bits = max(8, (4 * expected).bit_length())
    segment_bits = min(segment_bits, bits)
    groups = max(1, ceil(expected / group_windows))
    schema = RESULT.replace("kept_sha256", "text") if keep_text else RESULT
    dealt = documents.select(
        F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(blocks)).alias("block"),
        F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = dealt.groupBy("block")
    sketches = texts.applyInArrow(_sketch(window, bits, segment_bits), MESSAGE)
    repeated = sketches.groupBy("part").applyInArrow(_merge_sketches(segment_bits), ANSWER)
    asked = texts.cogroup(repeated.groupBy("block")).applyInArrow(
        _ask(window, bits, segment_bits, groups), MESSAGE)
    answered = asked.groupBy("part").applyInArrow(_group_exactly, ANSWER)
    return texts.cogroup(answered.groupBy("block")).applyInArrow(
        _remove(window, groups, keep_text), schema)
