"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: look-alike letters, accents, invisible characters and
digits or signs that stand for letters; i, l and 1 become one letter; what is
no letter separates words.  Entries are whole words or word beginnings.  The
matches of each entry, less those inside exception phrases, count per 100
words of the text; the entries' weights and a logistic curve turn that into a
score.

Lexicon, exceptions and weights are learned from a bounded sample of labelled
rows: an entry is a word or word beginning that toxic documents hold far more
often than others, its weight comes from a logistic regression.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.llm.worker import kept_for_stage

# Letters that look like Latin ones (after lower-casing and
# taking accents off), and signs and digits that stand for letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "н": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o",
    "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "ԝ": "w", "х": "x", "у": "y",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "ı": "i", "ɩ": "i", "ɡ": "g", "ɑ": "a", "ɔ": "o", "ø": "o", "ł": "l", "đ": "d", "ħ": "h", "ŧ": "t", "æ": "ae", "œ": "oe",
}
STAND_INS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i", "€": "e"}
INVISIBLE = "­​‌‍⁠﻿"

PREFIXES = range(4, 9)
_FOLD = {ord(k): v for k, v in LOOK_ALIKES.items()} | {ord(c): None for c in INVISIBLE} | {ord("l"): "i"}
_FOLD |= {c: None for c in range(0x300, 0x370)}
_FOLD[ord("ł")] = _FOLD[ord("ӏ")] = "i"
_STAND = str.maketrans(STAND_INS)
_SIGNS = "".join(re.escape(c) for c in STAND_INS)
#: A stand-in between letters, or a digit that a word begins or ends with.
_INSIDE = re.compile(rf"(?<=[^\W\d_])[{_SIGNS}]+(?=[^\W\d_])|(?<![^\W_])[013457](?=[^\W\d_])|(?<=[^\W\d_])[013457]+(?![^\W_])")
_BREAK = re.compile(r"[\W\d_]+")


def fold(text: str) -> str:
    """Folded words of a text, each with a space before and after it."""
    text = unicodedata.normalize("NFKD", text.lower()).translate(_FOLD)
    text = _INSIDE.sub(lambda m: m[0].translate(_STAND), text)
    return _BREAK.sub(" ", f" {text} ")


@dataclass(frozen=True)
class ToxicityModel:
    """Entries (" word " or " beginning") with weights, exception phrases
    (" two words "), and the score of a text without a match:
    score = logistic(bias + sum of weight * sqrt(matches per 100 words))."""

    entries: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...]
    bias: float


class Matcher:
    def __init__(self, model: ToxicityModel) -> None:
        import ahocorasick

        self.model = model
        self.weights = [w for _, w in model.entries]
        self.automaton = ahocorasick.Automaton()
        for phrase in model.exceptions:
            self.automaton.add_word(phrase, (len(phrase), None))
        for i, (entry, _) in enumerate(model.entries):
            self.automaton.add_word(entry, (len(entry), i))
        self.any = bool(model.entries)
        if self.any:
            self.automaton.make_automaton()

    def hits(self, folded: str) -> dict[int, int]:
        """Start of each matched word -> number of the longest entry there."""
        found: dict[int, int] = {}
        if not self.any:
            return found
        excepted: list[tuple[int, int]] = []
        for end, (size, entry) in self.automaton.iter(folded):
            start = end + 1 - size
            if entry is None:
                excepted.append((start, end))
            else:
                found[start] = entry
        for a, b in excepted:
            for start in [s for s in found if a <= s < b]:
                del found[start]
        return found

    def matches(self, text: str | None) -> tuple[Counter, int]:
        """How often each entry matches, and the number of words."""
        if not text:
            return Counter(), 0
        folded = fold(text)
        return Counter(self.hits(folded).values()), folded.count(" ") - 1

    def score(self, text: str | None) -> float:
        held, n = self.matches(text)
        z = self.model.bias + sum(self.weights[e] * math.sqrt(100 * c / max(n, 1)) for e, c in held.items())
        return 1 / (1 + math.exp(-min(max(z, -30.0), 30.0)))


def _entries(folded: str) -> Counter:
    """Words and word beginnings with the weight log2(1 + times) in the text, and the
    words' weights in all under the empty string: a word that a text repeats often
    counts for little more than one it has a few times, in texts of any length."""
    times: Counter = Counter()
    for w, n in Counter(folded.split()).items():
        times[f" {w} "] = n
        for k in PREFIXES:
            if len(w) < k:
                break
            times[" " + w[:k]] += n
    weights = Counter({e: math.log2(1 + n) for e, n in times.items()})
    weights[""] = sum(v for e, v in weights.items() if e[-1] == " ")
    return weights


def _phrases(folded: str, found: Iterable[int]) -> set[str]:
    """The matched words with the word before and with the word after them."""
    out = set()
    for start in found:
        end = folded.index(" ", start + 1)
        before, after = folded.rfind(" ", 0, start), folded.find(" ", end + 1)
        if before >= 0:
            out.add(folded[before : end + 1])
        if after >= 0:
            out.add(folded[start : after + 1])
    return out


def _gain(p: float, n: float, pos: float, neg: float) -> float:
    """G statistic of p of the weight pos of toxic and n of the weight neg of other documents."""
    total, g = p + n, 0.0
    for seen, size in ((p, pos), (n, neg)):
        expected = total * size / (pos + neg)
        g += 2 * seen * np.log(seen / expected) if seen else 0.0
    return float(g)


def _counts(sample: DataFrame, items) -> DataFrame:
    """Sums over the sample of what ``items`` makes of a text: a set, or a weight by item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.update(items(text))
                if len(held) > 500_000:
                    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([float(v) for v in held.values()])], ["item", "n"])
                    held.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([float(v) for v in held.values()], pa.float64())], ["item", "n"])

    # Rounded, as sums of doubles depend on the order of the tasks.
    return sample.select("text").mapInArrow(run, "item string, n double").groupBy("item").agg(F.round(F.sum("n"), 6).alias("n"))


def _fit_weights(x: np.ndarray, label: np.ndarray) -> tuple[float, np.ndarray]:
    """Ridge logistic regression by Newton steps; entries that turn negative are left at 0."""
    x = np.column_stack([np.ones(len(x)), x])
    used = np.ones(x.shape[1], dtype=bool)
    while True:
        b, some = np.zeros(used.sum()), x[:, used]
        ridge = np.diag([1e-3, *np.full(used.sum() - 1, 0.3)])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(some @ b, -30, 30)))
            w = np.maximum(p * (1 - p), 1e-6)
            step = np.linalg.solve(some.T @ (w[:, None] * some) + ridge, some.T @ (label - p) - ridge @ b)
            b = b + np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-6:
                break
        if (b[1:] >= 0).all():
            full = np.zeros(x.shape[1])
            full[used] = b
            return float(full[0]), full[1:]
        used[np.flatnonzero(used)[1:][b[1:] < 0]] = False


def fit_toxicity(sample: DataFrame, *, min_gain: float = 25.0, min_matches: float = 6.0, exceptions: tuple[str, ...] = ()) -> ToxicityModel:
    """Learn a model from (text, label) rows, a bounded sample.

    ``exceptions`` are phrases of the user's; phrases of two words that hold an
    entry and occur in five or more other documents, but in no toxic one, are
    added.  Whole texts of any length count.  Without rows of both classes there is no entry
    and every score is the share of label 1.
    """
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    if not pos or not neg:
        share = (pos + 0.1) / (pos + neg + 1.0)
        return ToxicityModel((), exceptions, float(np.log(share / (1 - share))))
    toxic, other = sample.where("label = 1"), sample.where("label = 0")
    # Bounded by the sample: entries that toxic documents hold several times.
    held = {r["item"]: r["n"] for r in _counts(toxic, lambda t: _entries(fold(t))).where(F.col("n") >= min_matches).collect()}
    wanted = frozenset(held)
    also = {r["item"]: r["n"] for r in _counts(other, lambda t: {e: n for e, n in _entries(fold(t)).items() if e in wanted}).collect()}
    pos, neg = max(1.0, held.pop("", 0.0)), max(1.0, also.pop("", 0.0))
    gain = {e: _gain(p, also.get(e, 0), pos, neg) for e, p in held.items() if p / pos > 2 * also.get(e, 0) / neg}
    # Of entries that begin alike, the one that tells most; the longest of those that tell the same.
    kept: list[str] = []
    begins: set[str] = set()
    taken: set[str] = set()
    for e in sorted((e for e in gain if gain[e] >= min_gain), key=lambda e: (-round(gain[e], 6), -len(e), e)):
        starts = {e[:k] for k in range(PREFIXES[0] + 1, len(e) + 1)}
        if e not in begins and not starts & taken:
            kept.append(e)
            taken.add(e)
            begins |= starts
    model_only = ToxicityModel(tuple((e, 1.0) for e in kept), (), 0.0)

    def phrases(text: str) -> set[str]:
        folded = fold(text)
        return _phrases(folded, _matcher(model_only).hits(folded))

    harmless = {r["item"] for r in _counts(other, phrases).where("n >= 5").collect()}
    if harmless:
        harmless -= {r["item"] for r in _counts(toxic, phrases).collect()}
    excepted = tuple(sorted({*(fold(x) for x in exceptions), *harmless}))
    model = ToxicityModel(model_only.entries, excepted, 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [_matcher(model).matches(t) for t in batch.column(0).to_pylist()]
            lists = [pa.array([f(c) for c, _ in held], pa.list_(pa.int32())) for f in (list, lambda c: list(c.values()))]
            yield pa.RecordBatch.from_arrays([*lists, pa.array([n for _, n in held], pa.int32()), batch.column(1)], ["entry", "times", "words", "label"])

    rows = sample.select("text", "label").mapInArrow(run, "entry array<int>, times array<int>, words int, label int").collect()
    rows.sort(key=lambda r: (r["label"], r["words"], r["entry"], r["times"]))
    x = np.zeros((len(rows), len(kept)))
    for i, r in enumerate(rows):
        x[i, r["entry"]] = np.sqrt(100 * np.array(r["times"], dtype=float) / max(r["words"], 1))
    bias, weights = _fit_weights(x, np.array([r["label"] for r in rows], dtype=float))
    return ToxicityModel(tuple((e, float(w)) for e, w in zip(kept, weights)), excepted, bias)


def _matcher(model: ToxicityModel) -> Matcher:
    return kept_for_stage(("toxicity", model), lambda: Matcher(model))


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns of ``docs`` plus ``score_col``, 0 to 1: higher is likelier toxic.

    Whole texts of any length are scored, in the task that reads them; equal texts, and so
    repeated rows, alike.  Null and empty texts have the score of a text without a match.  An input column named like
    ``score_col`` is replaced; an empty table gives an empty one.
    """
    kept = docs.drop(score_col)
    schema = T.StructType([*kept.schema.fields, T.StructField(score_col, T.DoubleType(), False)])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                block = batch.slice(lo, 1000)
                scores = [matcher.score(t) for t in block.column(text_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*block.columns, pa.array(scores, pa.float64())], [*block.schema.names, score_col])

    return kept.mapInArrow(run, schema)


__all__ = ["ToxicityModel", "fit_toxicity", "fold", "score_toxicity"]
