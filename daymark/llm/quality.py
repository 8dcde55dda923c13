"""Text quality by a factorisation machine.

Features are the lower-cased words, hashed to buckets, each occurrence with
the value 1/sqrt(words), and structure statistics and lengths of the text,
standardised.  Every feature has a weight and a short factor vector, a pair of
features interacts by the product of their vectors, and the sum over all pairs
is found in linear time: half of (sum of v x) squared less the sum of (v x)
squared, by factor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from daymark.llm.words import pieces, shingle_sets, utf8, word_hashes, word_spans

BUCKET_BITS = 13
FACTORS = 6
_CLASSES = [
    np.arange(65, 91),  # capitals
    np.arange(97, 123),
    np.arange(48, 58),
    np.arange(128, 256),
    np.array([0x20]),
    np.array([0x0A]),
    np.frombuffer(b".,;:'\"()-", np.uint8),
    np.frombuffer(b"!?", np.uint8),
    np.frombuffer(b"#$%&*+/<=>@\\^_`{|}~[]", np.uint8),
]


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Structure statistics (one row per text), word buckets of all texts in a
    row, and the n+1 offsets of the texts in them."""
    raw, off = utf8(texts)
    size = np.diff(off)
    n = len(size)
    kind = np.full(256, len(_CLASSES), dtype=np.int64)
    for i, chars in enumerate(_CLASSES):
        kind[chars] = i
    text = np.repeat(np.arange(n), size)
    width = len(_CLASSES) + 1
    share = np.bincount(text * width + kind[raw], minlength=n * width).reshape(n, width) / np.maximum(size, 1)[:, None]
    start, end, at = word_spans(raw, off)
    words = word_hashes(raw, start, end)
    n_words = np.diff(at)
    some = np.maximum(n_words, 1)
    of = np.repeat(np.arange(n), n_words)
    length = (end - start).astype(float)
    mean = np.bincount(of, length, minlength=n) / some
    spread = np.sqrt(np.maximum(0, np.bincount(of, length**2, minlength=n) / some - mean**2))
    last, first = kind[raw[end - 1]], kind[raw[start]]
    ends = lambda k: np.bincount(of, last == k, minlength=n) / some
    order = np.lexsort((words, of))
    fresh = np.ones(len(words), dtype=bool)
    fresh[1:] = (words[order][1:] != words[order][:-1]) | (of[order][1:] != of[order][:-1])
    distinct = np.bincount(of[order][fresh], minlength=n) / some
    _, shingles = shingle_sets(texts)
    fresh_runs = np.diff(shingles) / np.maximum(n_words - 4, 1)
    stats = np.column_stack(
        [share, np.log1p(size), np.log1p(n_words), mean, spread, ends(7), ends(8), ends(6), np.bincount(of, first == 0, minlength=n) / some,
         np.bincount(of, (first == 8) & (end - start == 1), minlength=n) / some, distinct, np.minimum(fresh_runs, 1.0)]
    )
    return stats, (words >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), at


@dataclass(frozen=True)
class FactorisationMachine:
    """Word buckets first, then structure statistics: bias, weights, factor vectors."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray

    def _sums(self, stats: np.ndarray, buckets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        n_words = np.diff(at)
        x = 1 / np.sqrt(np.maximum(n_words, 1))
        z = np.clip((stats - self.centre) / self.scale, -5, 5)
        split = 1 << BUCKET_BITS
        linear = self.bias + z @ self.weights[split:] + x * _segment_sums(self.weights[buckets], at)
        v = self.factors[buckets]
        sums = z @ self.factors[split:] + x[:, None] * _segment_sums(v, at)
        squares = (z**2) @ (self.factors[split:] ** 2) + (x**2)[:, None] * _segment_sums(v * v, at)
        return linear + 0.5 * (sums**2 - squares).sum(axis=1), sums, z, x

    def score(self, texts: pa.Array) -> np.ndarray:
        y = self._sums(*features(texts))[0]
        return 1 / (1 + np.exp(-np.clip(y, -30, 30)))


def _segment_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[at[1:]] - total[at[:-1]]


def fit_quality(sample: DataFrame, *, epochs: int = 12, rate: float = 0.05, seed: int = 7) -> FactorisationMachine:
    """Fit on (text, label) rows, a bounded sample.

    The features are made by the tasks that read the sample; the driver gets
    the statistics and word buckets of its rows.  With rows of one class only,
    the score is that class's share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in pieces(batch.column(0)):
                stats, buckets, at = features(batch.column(0).slice(lo, hi - lo))
                words = pa.array([buckets[a:b].astype("<u2").tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(list(stats), pa.list_(pa.float64())), words, batch.column(1).slice(lo, hi - lo)], ["stats", "words", "label"])

    rows = sample.select("text", "label").mapInArrow(run, "stats array<double>, words binary, label int").collect()
    rows.sort(key=lambda r: (r["words"], r["stats"], r["label"]))
    rng = np.random.default_rng(seed)
    n_stats, split = len(_CLASSES) + 12, 1 << BUCKET_BITS
    label = np.array([r["label"] for r in rows], dtype=float)
    stats = np.array([r["stats"] for r in rows]).reshape(len(rows), n_stats)
    centre = stats.mean(axis=0) if len(rows) else np.zeros(n_stats)
    scale = np.maximum(stats.std(axis=0), 1e-3) if len(rows) else np.ones(n_stats)
    share = (label.sum() + 0.5) / (len(rows) + 1)
    model = FactorisationMachine(
        float(np.log(share / (1 - share))), np.zeros(split + n_stats), rng.normal(0, 0.02, (split + n_stats, FACTORS)), centre, scale
    )
    if not 0 < label.sum() < len(rows):
        return FactorisationMachine(model.bias, model.weights, model.factors * 0, centre, scale)
    words = [np.frombuffer(r["words"], "<u2").astype(np.int64) for r in rows]
    w, v, bias = model.weights, model.factors, model.bias
    gw, gv, gb = np.full_like(w, 1e-2), np.full_like(v, 1e-2), 1e-2
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(rows), 128):
            some = order[lo : lo + 128]
            buckets = np.concatenate([words[i] for i in some])
            at = np.concatenate([[0], np.cumsum([len(words[i]) for i in some])])
            model = FactorisationMachine(bias, w, v, centre, scale)
            y, sums, z, x = model._sums(stats[some], buckets, at)
            error = (1 / (1 + np.exp(-np.clip(y, -30, 30))) - label[some]) / len(some)
            per_word = np.repeat(error * x, np.diff(at))
            dw = np.bincount(buckets, per_word, minlength=split + n_stats)
            dw[split:] += z.T @ error
            squares = np.bincount(buckets, np.repeat(error * x * x, np.diff(at)), minlength=split + n_stats)
            squares[split:] += (z * z).T @ error
            own = np.repeat(np.arange(len(some)), np.diff(at))
            dv = np.column_stack([np.bincount(buckets, per_word * sums[own, f], minlength=split + n_stats) for f in range(FACTORS)])
            dv[split:] += z.T @ (error[:, None] * sums)
            dv -= v * squares[:, None]
            dw += 1e-5 * w
            dv += 1e-4 * v
            gw += dw**2
            gv += dv**2
            gb += error.sum() ** 2
            w, v, bias = w - rate * dw / np.sqrt(gw), v - rate * dv / np.sqrt(gv), bias - rate * error.sum() / np.sqrt(gb)
    return FactorisationMachine(float(bias), w, v, centre, scale)


def score_quality(docs: DataFrame, model: FactorisationMachine, *, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns of ``docs`` plus ``score_col``, 0 to 1: higher is likelier good.

    Whole texts of any length are scored, in the task that reads them, equal texts and so
    repeated rows alike; null and empty texts by the statistics of an empty text.  An input column named like
    ``score_col`` is replaced; an empty table gives an empty one.  The model has
    a fixed number of buckets, so its broadcast does not grow.
    """
    kept = docs.drop(score_col)
    schema = T.StructType([*kept.schema.fields, T.StructField(score_col, T.DoubleType(), False)])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in pieces(batch.column(text_col), 2 << 20):
                block = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*block.columns, pa.array(shared.value.score(block.column(text_col)))], [*block.schema.names, score_col])

    return kept.mapInArrow(run, schema)


__all__ = ["FactorisationMachine", "features", "fit_quality", "score_quality"]
