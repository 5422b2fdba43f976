"""Quality rules: text statistics and a trained classifier against fixed thresholds.

The classifier is a logistic regression over hashed word and character n-gram frequencies, trained
here on labelled rows and calibrated on others that it did not see (Platt's sigmoid).  Texts are
scored whole, in Arrow batches.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import WordHashes, mix

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\v\f\r"
BITS = 15  # buckets of each kind of n-gram: 2**BITS
SAMPLE_PER_CLASS = 800  # labelled rows of either class at most, the ones of smallest hash
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_QUALITY = 0.3  # calibrated probability from which a text is kept
CHUNK = 1 << 20


@dataclass
class Model:
    weights: np.ndarray  # word buckets, then character buckets
    bias: float
    slope: float  # of the calibration
    shift: float


def word_buckets(words: np.ndarray) -> np.ndarray:
    """Buckets of all words and pairs of words."""
    pairs = mix(words[:-1] * np.uint64(3) + words[1:])
    return (np.concatenate([mix(words), pairs]) >> np.uint64(64 - BITS)).astype(np.int64)


def char_buckets(raw: np.ndarray) -> np.ndarray:
    """Buckets of all runs of three bytes of the text."""
    x = raw.astype(np.uint32)
    grams = x[:-2] << np.uint32(16) | x[1:-1] << np.uint32(8) | x[2:]
    return ((grams * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)


def features(text: str, words: list[bytes], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Sparse frequencies of a whole text: (buckets, values); either kind adds up to 1."""
    counts = np.zeros(2 << BITS)
    w = word_buckets(hashes.array(words))
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    if len(w):
        counts[: 1 << BITS] = np.bincount(w, minlength=1 << BITS) / len(w)
    total = max(len(raw) - 2, 1)
    for lo in range(0, max(len(raw) - 2, 0), CHUNK):
        c = char_buckets(raw[lo: lo + CHUNK + 2])
        counts[1 << BITS:] += np.bincount(c, minlength=1 << BITS) / total
    at = np.flatnonzero(counts)
    return at.astype(np.int32), counts[at].astype(np.float32)


def score(model: Model, text: str, words: list[bytes], hashes: WordHashes) -> float:
    """Calibrated probability that the whole text is of good quality."""
    z, w = model.bias, word_buckets(hashes.array(words))
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    if len(w):
        z += model.weights[w].mean()
    for lo in range(0, max(len(raw) - 2, 0), CHUNK):
        c = char_buckets(raw[lo: lo + CHUNK + 2])
        z += model.weights[(1 << BITS) + c].sum() / max(len(raw) - 2, 1)
    return float(1 / (1 + np.exp(-np.clip(model.slope * z + model.shift, -50, 50))))


def statistics(text: str, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    chars = len(text) - sum(map(text.count, WHITE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    repeats = 0
    if len(words) > 3:
        seen: dict[bytes, int] = {}
        ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
        pair = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)[1]
        _, which, count = np.unique(pair[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)
        begins = np.concatenate([count[which] > 1, [False, False]])
        inside = begins.copy()
        inside[1:] |= begins[:-1]
        inside[2:] |= begins[:-2]
        repeats = int(inside.sum())
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeats


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          per_class: int = SAMPLE_PER_CLASS) -> Model | None:
    """Fits the classifier on at most ``per_class`` labelled rows of each class (the sample bound).

    Two thirds of the sample fit the weights, one third the calibration.  Returns None if the labels
    hold no row of one of the classes: there is then no verdict.
    """
    marked = labels.where(F.col(label).isin(0, 1)).select(key, F.col(label).cast("int").alias("label"))
    few = functools.reduce(DataFrame.unionAll, [
        marked.where(F.col("label") == c).orderBy(F.xxhash64(key), key).limit(per_class) for c in (0, 1)])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            rows = [features(t, t.encode("utf-8").split(), hashes) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([a.tobytes() for a, _ in rows], pa.binary()),
                 pa.array([v.tobytes() for _, v in rows], pa.binary())], names=["label", "at", "value"])

    # The sample is at most 2 * per_class rows, so it may be broadcast.
    rows = (docs.where(F.col(text).isNotNull()).select(key, text).join(F.broadcast(few), key).select("label", text, key)
            .mapInArrow(task, "label int, at binary, value binary").collect())
    rows = sorted((r.label, r.at, r.value) for r in rows)
    if len({r[0] for r in rows}) < 2:
        return None
    held = np.arange(len(rows)) % 3 == 2
    y = np.array([r[0] for r in rows], float)
    at = [np.frombuffer(r[1], np.int32) for r in rows]
    value = [np.frombuffer(r[2], np.float32).astype(float) for r in rows]
    own = np.flatnonzero(~held)
    weights, bias = _fit([at[i] for i in own], [value[i] for i in own], y[own])
    z = np.array([bias + float(weights[a] @ v) for a, v in zip(at, value)])
    rest = held if len(set(y[held])) == 2 else ~held
    slope, shift = _calibrate(z[rest], y[rest])
    return Model(weights, bias, slope, shift)


def _fit(at, value, y, steps: int = 80, rate: float = 1.0, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression by full-batch AdaGrad; both classes weigh the same."""
    row = np.repeat(np.arange(len(at)), [len(a) for a in at])
    column, x = np.concatenate(at), np.concatenate(value)
    share = np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1))
    w, b, sum_w, sum_b = np.zeros(2 << BITS), 0.0, np.full(2 << BITS, 1e-12), 1e-12
    for _ in range(steps):
        z = np.bincount(row, weights=w[column] * x, minlength=len(at)) + b
        error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) * share
        g = np.bincount(column, weights=error[row] * x, minlength=len(w)) + decay * w
        gb = error.sum()
        sum_w += g * g
        sum_b += gb * gb
        w -= rate * g / np.sqrt(sum_w)
        b -= 0.1 * rate * gb / np.sqrt(sum_b)
    return w, b


def _calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt scaling: the sigmoid of ``slope * z + shift`` that fits the rows held out (Newton's method)."""
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    center, scale = float(z.mean()), float(z.std()) or 1.0
    u, a, c = (z - center) / scale, 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * u + c, -50, 50)))
        s = p * (1 - p) + 1e-9
        g = np.array([((p - t) * u).sum() + 1e-3 * a, (p - t).sum()])
        h = np.array([[(s * u * u).sum() + 1e-3, (s * u).sum()], [(s * u).sum(), s.sum()]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2 / max(abs(step).max(), 1e-9))
        a, c = a - step[0], c - step[1]
    return a / scale, c - a * center / scale


def judge(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text",
          min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT,
          min_quality: float = MIN_QUALITY) -> DataFrame:
    """Statistics, ``quality`` (calibrated probability) and ``kept`` for every row.

    A null or empty text has no words and fails the base rules.  Without a model (no usable labels)
    quality is null and the base rules alone decide.  Repeated rows and null keys are judged like
    any other; extra columns are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, hashes = shared.value, WordHashes()
        for batch in batches:
            rows = []
            for t in batch.column(1):
                t = t.as_py() or ""
                words = t.encode("utf-8").split()
                n, chars, symbols, dup, repeats = statistics(t, words)
                failed = n < min_words or 100 * repeats > max_repeat_percent * n
                quality = score(own, t, words, hashes) if own is not None else None
                rows.append((n, chars, symbols, dup, repeats, failed, quality,
                             not failed and (quality is None or quality >= min_quality)))
            columns = list(zip(*rows)) or [()] * 8
            types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))],
                names=[key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "quality", "kept"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        task, f"`{key}` {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
              "n_repeat_words long, base_failed boolean, quality double, kept boolean")


def keep_good(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text", **rules) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is kept: the verdict is made beside each row, without a join."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    least, most, low = (rules.get("min_words", MIN_WORDS), rules.get("max_repeat_percent", MAX_REPEAT_PERCENT),
                        rules.get("min_quality", MIN_QUALITY))

    @F.pandas_udf("boolean")
    def kept(texts: pd.Series) -> pd.Series:
        own, hashes, out = shared.value, WordHashes(), []
        for t in texts:
            t = t or ""
            words = t.encode("utf-8").split()
            n, _, _, _, repeats = statistics(t, words)
            out.append(not (n < least or 100 * repeats > most * n)
                       and (own is None or score(own, t, words, hashes) >= low))
        return pd.Series(out, dtype=bool)

    return docs.where(kept(F.col(text)))
