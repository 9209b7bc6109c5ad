"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of labelled text. A document is
parsed into the longest phrases that occur in a language's sample: the automaton is followed as far
as it goes, then a new phrase begins. The language that needs the fewest phrases per character
wins; equal counts go to the language that sorts first. The sample is bounded by ``SAMPLE_DOCUMENTS``
and ``SAMPLE_CHARACTERS`` per language; everything else reads whole texts.

Texts are lower-cased, other characters than letters become one space. Long texts are cut into
lines of ``CHUNK`` characters that are parsed side by side, one column of characters at a time, in
all languages at once; each cut adds at most one phrase, for every language alike.

score is 1 - phrases of the winner / phrases of the runner-up (1 if there is one language only).
Null text or text without letters: ``und``, score 0. No labelled text at all: every text is ``und``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obslake.llm import textbatch as tb
from obslake.llm.tables import Carried

SAMPLE_DOCUMENTS = 200
SAMPLE_CHARACTERS = 30_000
#: Letters kept of one sampled document, so that a sample is drawn from many.
SAMPLE_OF_ONE = 1_000
CHUNK = 512
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"


def fold(doc_id) -> F.Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def symbols(text: str) -> np.ndarray:
    """Code points of the lower-cased text with other characters than letters as single spaces."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _letters()[np.minimum(points, 0x10FFFF)]
    points = np.where(letters, points, np.uint32(32))
    keep = letters.copy()
    keep[1:] |= letters[:-1]  # of several spaces the first stays
    return points[keep]


_held: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _held:
        _held.append(np.array([chr(i).isalpha() for i in range(0x110000)], dtype=bool))
    return _held[0]


def suffix_automaton(text: list[int], alphabet: int) -> np.ndarray:
    """Transitions (states x alphabet) of the suffix automaton of a text; -1 where there is none."""
    following = np.full((2 * len(text) + 1, alphabet), -1, dtype=np.int32)
    length, link = [0], [-1]
    last = 0
    for symbol in text:
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and following[p, symbol] < 0:
            following[p, symbol] = new
            p = link[p]
        if p >= 0:
            q = int(following[p, symbol])
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                following[copy] = following[q]
                while p >= 0 and following[p, symbol] == q:
                    following[p, symbol] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return following[:len(length)]


class Model:
    """Suffix automata of all languages over one alphabet, as one table of transitions."""

    def __init__(self, samples: dict[str, np.ndarray]):
        self.languages = sorted(samples)
        self.alphabet = np.unique(np.concatenate([*samples.values(), np.array([32], dtype=np.uint32)]))
        size = len(self.alphabet) + 1  # the last symbol stands for all others and leads nowhere
        tables, self.roots, at = [], [], 0
        for language in self.languages:
            table = suffix_automaton(np.searchsorted(self.alphabet, samples[language]).tolist(), size)
            table[table >= 0] += at
            tables.append(table)
            self.roots.append(at)
            at += len(table)
        self.following = np.concatenate(tables) if tables else np.zeros((0, size), dtype=np.int32)

    def encode(self, points: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[place] == points, place, len(self.alphabet)).astype(np.int32)

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Number of phrases of each encoded text in each language (texts x languages)."""
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        chunks = -(-lengths // CHUNK)
        owner = np.repeat(np.arange(len(texts)), chunks)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        begin = np.repeat(np.cumsum(lengths) - lengths, chunks) + number * CHUNK
        size = np.minimum(lengths[owner] - number * CHUNK, CHUNK)
        order = np.argsort(-size, kind="stable")
        owner, begin, size = owner[order], begin[order], size[order]
        data = np.concatenate([*texts, np.zeros(CHUNK, dtype=np.int32)])
        width, flat = self.following.shape[1], self.following.ravel()
        roots = np.array(self.roots, dtype=np.int32)[:, None]
        states = np.repeat(roots, len(owner), axis=1)
        counts = np.zeros(states.shape, dtype=np.int32)
        alive = np.searchsorted(-size, -np.arange(1, CHUNK + 1), side="right")
        for step in range(int(size.max(initial=0))):
            n = alive[step]
            symbol = data[begin[:n] + step]
            now = flat[states[:, :n] * width + symbol]
            ended = now < 0
            counts[:, :n] += ended
            again = np.broadcast_to(flat[roots * width + symbol], now.shape)
            states[:, :n] = np.where(ended, np.maximum(again, roots), now)
        counts += 1  # the phrase that the end of the line cuts off
        out = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        for i in range(len(self.languages)):
            out[:, i] = np.bincount(owner, weights=counts[i], minlength=len(texts))
        return out


def fit(labelled: DataFrame, documents: int = SAMPLE_DOCUMENTS, characters: int = SAMPLE_CHARACTERS,
        of_one: int = SAMPLE_OF_ONE) -> Model:
    """Model from (doc_id, text, lang): per language the first ``documents`` distinct ids in an order of
    hashes, ``of_one`` letters of each, ``characters`` in all.

    The ids are chosen first, without reading any text; a repeated id counts once, by the least of its
    pieces. The piece of a document is a window of ``2 * of_one`` characters of its letters (other
    characters as single spaces) at an offset that the hash of its id picks anywhere in the whole
    text, of which ``of_one`` symbols are kept. Only bounded samples reach the driver.
    """
    keyed = labelled.where(F.col("lang").isNotNull())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = keyed.select("lang", "doc_id").distinct().withColumn("_n", F.row_number().over(order)).where(
        F.col("_n") <= documents).select("lang", "doc_id", F.col("_n").alias("n"))
    # only the chosen rows are read: letters with single spaces between runs, a window of them anywhere
    letters = F.regexp_replace(F.coalesce("text", F.lit("")), r"[^\p{L}]+", " ")
    width = 2 * of_one
    offset = F.pmod(F.xxhash64("doc_id"), F.greatest(F.length("_letters") - width, F.lit(0)) + 1)
    rows = keyed.join(F.broadcast(chosen), ["lang", "doc_id"]).select("lang", "doc_id", "n", letters.alias("_letters"))
    rows = rows.select("lang", "doc_id", "n", F.substring("_letters", (offset + 1).cast("int"), width).alias("text"))
    rows = rows.groupBy("lang", "doc_id", "n").agg(F.min("text").alias("text")).collect()
    samples: dict[str, list] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["n"])):
        held = samples.setdefault(row["lang"], [])
        if sum(map(len, held)) < characters:
            held.append(np.append(symbols(row["text"])[:of_one], np.uint32(32)))
    return Model({lang: np.concatenate(held)[:characters] for lang, held in samples.items()
                  if any(len(h) > 1 for h in held)})


RESULT = StructType().add("_lang_pred", "string").add("_score", "double")


def _predict(model):
    def run(batches):
        own = model.value
        for batch in tb.pieces(batches, "text", tb.CHUNK):
            texts = [own.encode(symbols(t or "")) for t in tb.column_of(batch, "text").to_pylist()]
            has_letters = tb.column_of(batch, "letters").to_numpy(zero_copy_only=False).astype(bool)
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if own.languages and len(texts):
                counts = own.phrases(texts)
                best = counts.argmin(axis=1)
                ordered = np.sort(counts, axis=1)
                rest = ordered[:, 1] if counts.shape[1] > 1 else np.full(len(texts), np.inf)
                share = 1 - ordered[:, 0] / np.maximum(rest, 1)
                known = has_letters & (np.array([len(t) for t in texts]) > 0)
                score = np.where(known, np.clip(share, 0, 1), 0.0)
                lang = [own.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("text"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=["row", "text", *RESULT.fieldNames()])
    return run


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """Every column, _lang_pred and _score."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    carried = Carried(documents, RESULT)
    has_letters = F.coalesce(F.regexp_like("text", F.lit(r"\p{L}")), F.lit(False)).alias("letters")
    return carried.unpack(documents.select(carried.row, "text", has_letters).mapInArrow(
        _predict(shared), carried.schema))


def identify(documents: DataFrame) -> DataFrame:
    """Predict every document with a model learned from those outside the held-out fold."""
    model = fit(documents.where(fold(F.col("doc_id")) != HELD_OUT))
    return predict(documents, model)
