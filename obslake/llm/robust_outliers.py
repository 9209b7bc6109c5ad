"""Quality rules by robust multivariate outliers.

Every text gets statistics, these are transformed, and per language and source a minimum-covariance-
determinant estimate tells the usual vectors from the others: documents whose squared Mahalanobis
distance passes a chi-square quantile are rejected.

The estimate is found by concentration steps over all documents that pass the base rule: start from
medians and median absolute deviations, keep the three quarters of least distance, take their mean
and covariance, and repeat. Each step is one aggregation with partial sums (and a mergeable quantile
sketch for the limit of the three quarters), so a source with a third of all rows sends a row per task.
The covariance is scaled so that the median distance is that of a normal distribution, and
``TOLERANCE`` squared is added to its diagonal, so that a statistic that hardly varies (no symbols at
all, say) does not reject whoever has a little of it.

Groups of fewer than ``SMALLEST`` documents use the estimate of their language, or else of all
documents. Null language or source is a group like any other.

Null or empty text: no words, so the base rule fails it. Rows with equal doc_id are rows of their own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.llm import textbatch as tb
from obslake.session import materialise

FEWEST_WORDS = 50
MOST_REPEATED_PERCENT = 50
#: Transformed statistics, and how far apart two documents may be in each without being unlike.
TOLERANCE = {"f_words": 0.3, "f_length": 0.08, "f_symbols": 0.1, "f_lines": 0.2, "f_repeats": 0.12}
FEATURES = list(TOLERANCE)
SHARE = 0.75
STEPS = 4
SMALLEST = 60
#: Upper normal quantile of the cut-off (about one in a million), and of the median.
CUT, MEDIAN = 4.75, 0.0
ACCURACY = 10_000
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True

STATISTICS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
              "n_lines long")


def chi_square(quantile: float, freedom: int = len(FEATURES)) -> float:
    """Chi-square quantile from a normal one, by the cube-root transformation."""
    step = 2 / (9 * freedom)
    return freedom * (1 - step + quantile * step**0.5) ** 3


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which entries occur more than once."""
    _, place, count = np.unique(keys, return_inverse=True, return_counts=True)
    return count[place] > 1


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """Counts of each text, over its bytes."""
    data, offsets = tb.utf8(texts)
    n = len(offsets) - 1
    total = lambda flags: np.diff(np.append(0, np.cumsum(flags))[offsets])
    starts, ends, text = tb.words(data, offsets)
    hashes = tb.segment_hashes(data, starts, ends)
    begins = (data & 0xC0) != 0x80
    of_text = tb.mix(np.arange(n, dtype=np.uint64))

    whole = tb.whole_windows(text, 3)
    at = np.flatnonzero(whole)
    again = at[repeated(tb.window_hashes(hashes, 3)[at] ^ of_text[text[at]])]
    covered = np.zeros(len(starts), dtype=bool)
    for k in range(3):
        covered[again + k] = True

    breaks = np.flatnonzero(data == 10)
    line_starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    line_ends = np.sort(np.concatenate([breaks, offsets[1:]]))
    lines = np.diff(np.searchsorted(breaks, offsets)) + 1
    line_text = np.repeat(np.arange(n), lines)
    worded = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_keys = tb.segment_hashes(data, line_starts, line_ends) ^ of_text[line_text]
    line_keys, line_text = line_keys[worded], line_text[worded]
    _, first = np.unique(line_keys, return_index=True)  # the first of equal ones
    later = np.ones(len(line_keys), dtype=bool)
    later[first] = False
    return {
        "n_words": np.bincount(text, minlength=n),
        "word_chars": total(begins & ~tb.SPACE[data]),
        "n_symbols": total(_SYMBOL[data]),
        "n_dup_lines": np.bincount(line_text[later], minlength=n),
        "n_repeat_words": np.bincount(text[covered], minlength=n),
        "n_lines": np.where(np.diff(offsets) > 0, lines, 0),
    }


def _measure(columns):
    def run(batches):
        for batch in tb.pieces(batches, "text"):
            found = statistics(tb.column_of(batch, "text"))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), *(pa.array(v, pa.int64()) for v in found.values())],
                names=[*columns, *found])
    return run


def measured(documents: DataFrame) -> DataFrame:
    """(doc_id, lang, source), the statistics, whether the base rule fails, and transformed statistics."""
    kept = ["doc_id", "lang", "source"]
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                              F.col("lang").cast("string").alias("lang"),
                              F.col("source").cast("string").alias("source"), "text")
    rows = source.mapInArrow(_measure(kept), f"doc_id long, lang string, source string, {STATISTICS}")
    words = F.greatest("n_words", F.lit(1))
    return rows.withColumn("base_failed", (F.col("n_words") < FEWEST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))).withColumns({
            "f_words": F.log1p("n_words"),
            "f_length": F.log(F.greatest("word_chars", F.lit(1)) / words),
            "f_symbols": F.sqrt(F.col("n_symbols") / words),
            "f_lines": F.sqrt(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))),
            "f_repeats": F.sqrt(F.col("n_repeat_words") / words),
        })


_PAIRS = [(i, j) for i in range(len(FEATURES)) for j in range(i, len(FEATURES))]
_MODEL = ", ".join([*(f"m{i} double" for i in range(len(FEATURES))), *(f"p{i}_{j} double" for i, j in _PAIRS)])


def _distance():
    """Squared Mahalanobis distance from the columns of a model."""
    off = [F.col(f) - F.col(f"m{i}") for i, f in enumerate(FEATURES)]
    total = F.lit(0.0)
    for i, j in _PAIRS:
        total = total + (1.0 if i == j else 2.0) * F.col(f"p{i}_{j}") * off[i] * off[j]
    return total


def _start(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Medians and scaled median absolute deviations as a first model."""
    medians = rows.groupBy(*keys).agg(*[
        F.percentile_approx(f, 0.5, ACCURACY).alias(f"m{i}") for i, f in enumerate(FEATURES)])
    medians = materialise(medians, "medians")
    spread = _with_model(rows, medians, keys).groupBy(*keys).agg(*[
        F.percentile_approx(F.abs(F.col(f) - F.col(f"m{i}")), 0.5, ACCURACY).alias(f"d{i}")
        for i, f in enumerate(FEATURES)])
    precision = {
        f"p{i}_{j}": 1 / ((1.4826 * F.col(f"d{i}")) ** 2 + TOLERANCE[FEATURES[i]] ** 2) if i == j else F.lit(0.0)
        for i, j in _PAIRS}
    model = _with_model(medians, spread, keys).withColumns(precision)
    return materialise(model.select(*keys, *[f"m{i}" for i in range(len(FEATURES))], *precision), "model")


def _with_model(rows: DataFrame, model: DataFrame, keys: list[str]) -> DataFrame:
    """Join to the model of each row's group; a null key is a key."""
    renamed = model.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in model.columns if c not in keys])
    on = F.lit(True)
    for key in keys:
        on = on & F.col(key).eqNullSafe(F.col(f"_{key}"))
    return rows.join(renamed, on).drop(*[f"_{k}" for k in keys])


def _invert(keys: list[str]):
    """Covariances from sums, and their inverses, of a batch of groups."""
    size = len(FEATURES)

    def run(batches):
        for sums in batches:
            n = sums["n"].to_numpy()
            mean = np.stack([sums[f"s{i}"].to_numpy() / n for i in range(size)], axis=1)
            cov = np.empty((len(n), size, size))
            for i, j in _PAIRS:
                cov[:, i, j] = cov[:, j, i] = sums[f"s{i}_{j}"].to_numpy() / n - mean[:, i] * mean[:, j]
            # the scale at which the median distance is that of a normal distribution
            cov *= np.maximum(sums["median"].to_numpy(), 1e-12)[:, None, None] / chi_square(MEDIAN)
            cov[:, range(size), range(size)] += np.array(list(TOLERANCE.values())) ** 2
            inverse = np.linalg.inv(cov)
            out = {k: sums[k] for k in keys}
            out |= {f"m{i}": mean[:, i] for i in range(size)}
            out |= {f"p{i}_{j}": inverse[:, i, j] for i, j in _PAIRS}
            yield pd.DataFrame(out)
    return run


def concentrate(rows: DataFrame, model: DataFrame, keys: list[str], scaled: bool) -> DataFrame:
    """One concentration step: mean and covariance of the nearest three quarters of each group."""
    near = _with_model(rows, model, keys).withColumn("_d", _distance())
    limits = near.groupBy(*keys).agg(
        F.percentile_approx("_d", F.array(F.lit(0.5), F.lit(SHARE)), ACCURACY).alias("_q"))
    limits = limits.select(*keys, F.col("_q")[0].alias("median"), F.col("_q")[1].alias("limit"))
    inside = _with_model(near, limits, keys).where(F.col("_d") <= F.col("limit"))
    median = F.max("median") if scaled else F.lit(chi_square(MEDIAN))
    sums = inside.groupBy(*keys).agg(
        F.count("*").alias("n"), median.alias("median"),
        *[F.sum(f).alias(f"s{i}") for i, f in enumerate(FEATURES)],
        *[F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"s{i}_{j}") for i, j in _PAIRS])
    return materialise(sums.mapInPandas(_invert(keys), ", ".join([*(f"{k} string" for k in keys), _MODEL])), "model")


def estimate(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Minimum-covariance-determinant model of each group: keys, means m*, inverse covariance p*."""
    model = _start(rows, keys)
    for step in range(STEPS):
        model = concentrate(rows, model, keys, scaled=step == STEPS - 1)
    return model


def judge(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance."""
    rows = materialise(measured(documents), "statistics")
    sizes = rows.where(~F.col("base_failed")).groupBy("lang", "source").agg(F.count("*").alias("n"))
    of_lang = sizes.groupBy("lang").agg(F.sum("n").alias("n_lang"))
    keyed = _with_model(sizes, of_lang, ["lang"])
    # the group that a language and source is judged in: its own, its language, or all
    groups = materialise(rows.select("lang", "source").distinct(), "groups")
    left = groups.alias("g").join(keyed.alias("k"), F.col("g.lang").eqNullSafe(F.col("k.lang")) & F.col(
        "g.source").eqNullSafe(F.col("k.source")), "left").join(
        of_lang.select(F.col("lang").alias("_l"), F.col("n_lang").alias("_n")), F.col("g.lang").eqNullSafe(F.col("_l")), "left")
    level = F.when(F.col("n") >= SMALLEST, 2).when(F.col("_n") >= SMALLEST, 1).otherwise(0)
    levels = materialise(left.select("g.lang", "g.source", level.alias("level")), "levels")
    fitted = materialise(_with_model(rows, levels, ["lang", "source"]), "levelled")
    passed = fitted.where(~F.col("base_failed"))
    used = {r["level"] for r in levels.select("level").distinct().collect()}
    out = []
    for number, keys in ((2, ["lang", "source"]), (1, ["lang"]), (0, [])):
        if number not in used:
            continue
        asked = fitted.where(F.col("level") == number)
        # a coarser group is estimated from all its documents, those of large sources too
        model = estimate(passed.where(F.col("level") == 2) if number == 2 else passed, keys)
        renamed = model.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in model.columns if c not in keys])
        on = F.lit(True)
        for key in keys:
            on = on & F.col(key).eqNullSafe(F.col(f"_{key}"))
        out.append(asked.join(renamed, on, "left").withColumn("distance", _distance()).select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= chi_square(CUT))).alias("kept"),
            "distance"))
    result = out[0] if out else fitted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance"))
    for more in out[1:]:
        result = result.unionByName(more)
    return result
