"""Language of texts, word by word, by a linear-chain conditional random field.

A text is the sequence of its words (runs of letters, lower-cased).  A word
scores every language by the byte triples in it, its first one to three and
last one to four bytes, and the lexicons of the languages it is found
in.  Transitions between languages are learned together with these weights
from sequences in which runs of words of different languages follow each
other, as in code-switched text.  Forward-backward gives every word the
probability of each language given the whole text; a text's language is the one
with the largest sum.

Whole texts are labelled in the task that reads them, all words of a block of
texts at once: sequences are cut into runs of ``BLOCK`` words, whose transfer
matrices are found side by side and chained.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.llm.words import mix64, pieces, utf8
from daymark.llm.worker import free_other_stages

UNDETERMINED = "und"
BLOCK = 64
_TRIPLES = 1 << 16
_AFFIX = 1 << 14
_FIRST, _LAST = (1, 2, 3), (1, 2, 3, 4)
_BASES = np.cumsum([0, _TRIPLES] + [_AFFIX] * (len(_FIRST) + len(_LAST)))
_U = np.uint64
_rng = np.random.default_rng(20250117)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
#: Bytes of a word beyond this place are hashed as a set.
_PLACE = _rng.integers(1, 2**62, 64, dtype=np.uint64) * _U(2) + _U(1)
_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = True
_LETTER[128:] = True


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, first and end byte of every word, and the n+1 word offsets of the texts.

    Two- and three-byte punctuation (U+0080 to U+00BF but for the letters there,
    U+2000 to U+203F) parts words, every other character outside ASCII belongs to them.
    """
    raw, off = utf8(pc.utf8_lower(texts))
    inside = _LETTER[raw]
    if len(raw) > 2:
        two = (raw[:-1] == 0xC2) & ~np.isin(raw[1:], (0xAA, 0xB5, 0xBA))
        three = (raw[:-2] == 0xE2) & (raw[1:-1] == 0x80)
        for k, found, width in ((2, two, len(raw) - 1), (3, three, len(raw) - 2)):
            at = np.flatnonzero(found[:width])
            for j in range(k):
                inside[at + j] = False
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = off[1:-1][(off[1:-1] < len(raw)) & (off[1:-1] > 0)]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return raw, start, end, np.searchsorted(start, off)


@dataclass(frozen=True)
class Words:
    """Features of words: buckets of single features, and the buckets of the byte triples of all words in a row."""

    affix: np.ndarray
    gram: np.ndarray
    gram_at: np.ndarray
    keys: np.ndarray

    def take(self, some: np.ndarray) -> Words:
        sizes = np.diff(self.gram_at)[some]
        at = np.concatenate([[0], np.cumsum(sizes)])
        gram = self.gram[np.repeat(self.gram_at[some] - at[:-1], sizes) + np.arange(at[-1])]
        return Words(self.affix[some], gram, at, self.keys[some])


def features(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> Words:
    n, size = len(start), end - start
    at = np.concatenate([[0], np.cumsum(size)])
    place = np.arange(at[-1]) - np.repeat(at[:-1], size)
    byte = raw[np.repeat(start, size) + place].astype(np.int32)
    keys = np.zeros(n, dtype=np.uint64)
    if n:
        keys = mix64(np.add.reduceat(_BYTE[byte] * _PLACE[np.minimum(place, len(_PLACE) - 1)], at[:-1]) + size.astype(np.uint64))
    # Byte 0 stands before and behind a word, so it has as many triples as bytes.
    marked = np.zeros(at[-1] + 2 * n, dtype=np.int32)
    middle = np.arange(at[-1]) + 2 * np.repeat(np.arange(n), size) + 1
    marked[middle] = byte
    gram = ((marked[middle - 1] * 0x4D51 + byte * 0x1F35 + marked[middle + 1] * 0x61) >> 2) & (_TRIPLES - 1)
    affix = np.zeros((n, len(_FIRST) + len(_LAST)), dtype=np.int32)
    for column, (count, back) in enumerate([*((k, False) for k in _FIRST), *((k, True) for k in _LAST)]):
        code = np.zeros(n, dtype=np.int64)
        for j in range(count):
            inside = size > j
            code = code * 0x10F + np.where(inside, raw[np.where(inside, end - 1 - j if back else start + j, 0)] if len(raw) else 0, 0)
        affix[:, column] = _BASES[1 + column] + (code * 0x9E3779B1 >> 13) % _AFFIX
    return Words(affix, gram, at, keys)


@dataclass(frozen=True)
class LanguageModel:
    """Sorted language names, feature weights, lexicons (ascending word hashes with a
    row of memberships each) and their weights, and the chain's start and transitions."""

    languages: tuple[str, ...]
    weights: np.ndarray
    lexicon: np.ndarray
    member: np.ndarray
    lexicon_weights: np.ndarray
    start: np.ndarray
    transitions: np.ndarray

    def memberships(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.lexicon):
            return np.zeros((len(keys), len(self.languages)), dtype=np.float32)
        at = np.minimum(np.searchsorted(self.lexicon, keys), len(self.lexicon) - 1)
        return self.member[at] * (self.lexicon[at] == keys)[:, None]

    def emissions(self, words: Words) -> np.ndarray:
        """The score of every word in every language."""
        n = len(words.keys)
        out = self.memberships(words.keys) @ self.lexicon_weights
        for column in range(words.affix.shape[1]):
            out += self.weights[words.affix[:, column]]
        if n:
            out += np.add.reduceat(self.weights[words.gram], words.gram_at[:-1], axis=0) * _share(words)[:, None]
        return out

    def marginals(self, words: Words, at: np.ndarray) -> np.ndarray:
        """Probabilities of the languages for every word; texts have the word offsets ``at``."""
        return _marginals(self.emissions(words).astype(np.float64), at, self.start, self.transitions)


def _share(words: Words) -> np.ndarray:
    return (4.0 / np.sqrt(np.diff(words.gram_at))).astype(np.float32)


def _unit(x: np.ndarray, axes) -> np.ndarray:
    return x / np.maximum(x.sum(axis=axes, keepdims=True), 1e-300)


def _marginals(scores: np.ndarray, at: np.ndarray, start: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Forward-backward over sequences laid in a row."""
    n, k = scores.shape
    if not n:
        return scores
    lift = np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -60))
    move = np.exp(transitions - transitions.max())
    sizes = np.diff(at)
    blocks = -(-sizes // BLOCK)
    first_block = np.concatenate([[0], np.cumsum(blocks)])
    m = int(first_block[-1])
    text = np.repeat(np.arange(len(sizes)), blocks)
    order = np.arange(m) - first_block[text]
    begin = at[text] + order * BLOCK
    length = np.minimum(at[text + 1] - begin, BLOCK)
    index = np.minimum(begin[:, None] + np.arange(BLOCK), n - 1)
    e = lift[index]
    alive = np.arange(BLOCK) < length[:, None]
    head = (order == 0)[:, None]
    # The step into a text's first word has the start scores in place of transitions.
    entry = np.exp(start - start.max())
    # The transfer of each block, from the state before it to that of its last word.
    through = _unit(np.where(head[:, :, None], entry, move) * e[:, 0][:, None, :], (1, 2))
    for t in range(1, BLOCK):
        on = slice(None) if alive[:, t].all() else np.flatnonzero(alive[:, t])
        through[on] = _unit((through[on] @ move) * e[on, t][:, None, :], (1, 2))
    # States before each block and evidence after it, chained over the blocks of a text.
    before, after = np.empty((m, k)), np.ones((m, k))
    now = np.full((len(sizes), k), 1.0 / k)
    by_rank = np.argsort(-blocks, kind="stable")
    counts = -np.sort(-blocks)
    for j in range(int(blocks.max(initial=0))):
        own = by_rank[: np.searchsorted(-counts, -j, "left")]
        b = first_block[own] + j
        before[b] = now[own]
        now[own] = _unit(np.einsum("ij,ijk->ik", now[own], through[b]), 1)
    later = np.ones((len(sizes), k))
    for j in range(int(blocks.max(initial=0)) - 1, -1, -1):
        own = by_rank[: np.searchsorted(-counts, -j, "left")]
        b = first_block[own] + j
        after[b] = later[own]
        later[own] = _unit(np.einsum("ijk,ik->ij", through[b], later[own]), 1)
    forward = np.empty((m, BLOCK, k))
    state = forward[:, 0] = _unit(np.where(head, entry, before @ move) * e[:, 0], 1)
    for t in range(1, BLOCK):
        state = forward[:, t] = np.where(alive[:, t, None], _unit((state @ move) * e[:, t], 1), state)
    out = np.empty((n, k))
    beta = after
    for t in range(BLOCK - 1, -1, -1):
        on = alive[:, t]
        out[begin[on] + t] = _unit(forward[on, t] * beta[on], 1)
        beta = np.where(on[:, None], _unit((e[:, t] * beta) @ move.T, 1), beta)
    return out


def language_sample(docs: DataFrame, usable: Column, *, max_rows: int = 200, max_chars: int = 20_000, max_languages: int = 64) -> DataFrame:
    """(text, lang) of a bounded sample to learn from.

    Of each language the ``max_rows`` usable ids with the smallest hashes, one row each
    (the least text of several), of at most ``max_chars`` characters; if there are more
    than ``max_languages`` languages, those with the most ids.  An id with several
    languages counts for the least of them.  Only ids are shuffled.
    """
    known = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    ids = known.groupBy("doc_id").agg(F.min("lang").alias("lang"))
    taken = ids.withColumns({"__hash": F.xxhash64("doc_id"), "__part": F.pmod(F.xxhash64("doc_id"), F.lit(64))})
    # First within 64 parts of each language, so that no task sees a common language as a whole.
    for by in (["lang", "__part"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy("__hash", "doc_id"))
        taken = taken.withColumn("__at", place).where(F.col("__at") <= max_rows).drop("__at")
    taken = taken.select("doc_id", "lang")
    largest = ids.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).select("lang")
    # At most max_rows * max_languages ids.
    taken = F.broadcast(taken.join(F.broadcast(largest), "lang"))
    short = known.where(F.length("text") <= max_chars).select("doc_id", "lang", "text")
    return short.join(taken, ["doc_id", "lang"]).groupBy("doc_id").agg(F.min("text").alias("text"), F.first("lang").alias("lang")).select("text", "lang")


def _deal(rng: np.random.Generator, text_of: np.ndarray, length: int) -> np.ndarray:
    """All words in runs of 4 to 40 of one text, the runs in random order."""
    n = len(text_of)
    cut = np.unique(np.concatenate([[0], np.cumsum(rng.integers(4, 41, n // 4 + 1)), np.flatnonzero(np.diff(text_of)) + 1]))
    cut = cut[cut < n]
    size = np.diff(np.append(cut, n))
    order = rng.permutation(len(cut))
    at = np.concatenate([[0], np.cumsum(size[order])])
    dealt = np.repeat(cut[order] - at[:-1], size[order]) + np.arange(n)
    return np.append(dealt, np.full(-n % length, -1))


def fit_language(sample: DataFrame, *, epochs: int = 6, rate: float = 0.3, min_rows: int = 3, seed: int = 11) -> LanguageModel:
    """Fit on (text, lang) rows, a bounded sample, all of whose words are used.

    A language's lexicon has the words of at least ``min_rows`` of its rows.  Without rows there is no
    language, with rows of one language that one is always found.
    """
    rows = sorted((r["text"], r["lang"]) for r in sample.select("text", "lang").collect())
    names = tuple(sorted({lang for _, lang in rows}))
    k, rng = len(names), np.random.default_rng(seed)
    number = {name: i for i, name in enumerate(names)}
    raw, start, end, at = words_of(pa.array([t for t, _ in rows], pa.large_string()))
    words = features(raw, start, end)
    text_of = np.repeat(np.arange(len(rows)), np.diff(at))
    gold = np.array([number[lang] for _, lang in rows], dtype=np.int64)[text_of]
    member = np.zeros((0, k), dtype=np.float32)
    lexicon = np.zeros(0, dtype=np.uint64)
    if len(text_of):
        seen = np.unique(np.rec.fromarrays([words.keys, text_of], names="key,text"))
        of = np.array([number[lang] for _, lang in rows])[seen["text"]]
        lexicon, code = np.unique(seen["key"], return_inverse=True)
        counts = np.bincount(code * k + of, minlength=len(lexicon) * k).reshape(-1, k)
        kept = (counts >= min_rows).any(axis=1)
        lexicon, member = lexicon[kept], (counts[kept] >= min_rows).astype(np.float32)
    w = np.zeros((int(_BASES[-1]), k), dtype=np.float32)
    lex, first, move = np.zeros((k, k)), np.zeros(k), np.zeros((k, k))
    model = LanguageModel(names, w, lexicon, member, lex, first, move)
    if k < 2 or not len(text_of):
        return model
    gw, gl, gf, gm = (np.full_like(x, 1e-9) for x in (w, lex, first, move))
    length, batch = 64, 256
    for _ in range(epochs):
        dealt = _deal(rng, text_of, length).reshape(-1, length)
        dealt = dealt[rng.permutation(len(dealt))]
        for lo in range(0, len(dealt), batch):
            flat = dealt[lo : lo + batch].ravel()
            real = flat >= 0
            some = flat[real]
            own = np.cumsum(real.reshape(-1, length).sum(axis=1))
            offsets = np.concatenate([[0], own])
            part = words.take(some)
            model = LanguageModel(names, w, lexicon, member, lex, first, move)
            scores = model.emissions(part).astype(np.float64)
            p, pair, head = _expected(scores, offsets, first, move)
            y = gold[some]
            error = p.copy()
            error[np.arange(len(y)), y] -= 1
            inner = np.ones(len(y), dtype=bool)
            inner[offsets[:-1]] = False
            told = np.bincount(y[np.flatnonzero(inner) - 1] * k + y[inner], minlength=k * k).reshape(k, k)
            dm = pair - told
            df = head - np.bincount(y[offsets[:-1]], minlength=k)
            dl = model.memberships(part.keys).T.astype(np.float64) @ error
            dw = np.zeros_like(w)
            scaled = error * _share(part)[:, None]
            of_gram = np.repeat(np.arange(len(y)), np.diff(part.gram_at))
            for s in range(k):
                dw[:, s] = np.bincount(part.gram, scaled[of_gram, s], minlength=len(w))
                for column in range(part.affix.shape[1]):
                    dw[:, s] += np.bincount(part.affix[:, column], error[:, s], minlength=len(w))
            scale = 1.0 / len(y)
            for x, g, d in ((w, gw, dw), (lex, gl, dl), (first, gf, df), (move, gm, dm)):
                d = d * scale + 1e-6 * x
                g += d * d
                x -= rate * d / np.sqrt(g)
    return LanguageModel(names, w, lexicon, member, lex, first, move)


def _expected(scores: np.ndarray, at: np.ndarray, start: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals, expected transitions and expected first states of short sequences."""
    n, k = scores.shape
    size = np.diff(at)
    width = int(size.max())
    index = np.minimum(at[:-1, None] + np.arange(width), n - 1)
    alive = np.arange(width) < size[:, None]
    e = np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -60))[index]
    step = np.exp(move - move.max())
    forward = np.empty((len(size), width, k))
    forward[:, 0] = _unit(np.exp(start - start.max()) * e[:, 0], 1)
    for t in range(1, width):
        forward[:, t] = np.where(alive[:, t, None], _unit((forward[:, t - 1] @ step) * e[:, t], 1), forward[:, t - 1])
    p, pair, beta = np.empty((n, k)), np.zeros((k, k)), np.ones((len(size), k))
    for t in range(width - 1, -1, -1):
        on = alive[:, t]
        p[at[:-1][on] + t] = _unit(forward[on, t] * beta[on], 1)
        weighted = e[:, t] * beta
        if t:
            both = forward[on, t - 1][:, :, None] * step * weighted[on][:, None, :]
            pair += _unit(both, (1, 2)).sum(axis=0)
        beta = np.where(on[:, None], _unit(weighted @ step.T, 1), beta)
    return p, pair, p[at[:-1]].sum(axis=0)


def _block_bytes(model: LanguageModel) -> int:
    """Blocks of text for which the transfer matrices stay small."""
    return max(1 << 15, (1 << 20) * 16 // max(16, len(model.languages) ** 2))


def label_texts(texts: pa.Array, model: LanguageModel) -> tuple[list[str], np.ndarray, list[list[dict]]]:
    """Language, its share of the words, and the runs of words of one language, for every text."""
    raw, start, end, at = words_of(texts)
    n, k = len(texts), len(model.languages)
    letter = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
    if not k:
        return [UNDETERMINED] * n, np.zeros(n), [[] for _ in range(n)]
    p = model.marginals(features(raw, start, end), at)
    filled = np.flatnonzero(np.diff(at))
    share = np.zeros((n, k))
    if len(filled):
        # Rounded, so that a text's score does not depend on the texts beside it.
        share[filled] = np.round(np.add.reduceat(p, at[filled], axis=0) / np.diff(at)[filled, None], 9)
    best = share.argmax(axis=1)
    found = letter & (np.diff(at) > 0)
    score = np.where(found, np.clip(share[np.arange(n), best], 0, 1), 0.0)
    names = [model.languages[b] if f else UNDETERMINED for b, f in zip(best.tolist(), found.tolist())]
    label = p.argmax(axis=1)
    fresh = np.ones(len(label), dtype=bool)
    fresh[1:] = label[1:] != label[:-1]
    inner = at[1:-1]
    fresh[inner[inner < len(label)]] = True
    runs: list[list[dict]] = [[] for _ in range(n)]
    heads = np.flatnonzero(fresh)
    text = np.searchsorted(at, heads, "right") - 1
    for i, (h, stop) in zip(text.tolist(), zip(heads.tolist(), np.append(heads[1:], len(label)).tolist())):
        if found[i]:
            runs[i].append({"lang": model.languages[int(label[h])], "first_word": h - int(at[i]), "words": stop - h})
    return names, score, runs


def label_documents(docs: DataFrame, model: LanguageModel, *, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score", runs_col: str | None = None) -> DataFrame:
    """All columns of ``docs`` plus the language and its score, and with ``runs_col`` the
    runs of words of one language: array of (lang, first_word from 0, words).

    Whole texts of any length are labelled.  The score is the mean probability of the
    language over the words.  Null texts and those without a letter are ``und`` with score
    0 and no runs, as are all texts if nothing was learned; ties go to the first name.
    Equal texts, and so repeated rows, get equal results; input columns named like the results are replaced;
    an empty table gives an empty one.  The model's size does not depend on the table.
    """
    own = [lang_col, score_col, *([runs_col] if runs_col else [])]
    kept = docs.drop(*own)
    run_type = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("first_word", T.LongType()), T.StructField("words", T.LongType())]))
    fields = [T.StructField(lang_col, T.StringType()), T.StructField(score_col, T.DoubleType())]
    schema = T.StructType([*kept.schema.fields, *fields, *([T.StructField(runs_col, run_type)] if runs_col else [])])
    arrow = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("words", pa.int64())]))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_other_stages()
        model = shared.value
        for batch in batches:
            for lo, hi in pieces(batch.column(text_col), _block_bytes(model)):
                block = batch.slice(lo, hi - lo)
                names, score, runs = label_texts(block.column(text_col), model)
                extra = [pa.array(names, pa.string()), pa.array(score), *([pa.array(runs, arrow)] if runs_col else [])]
                yield pa.RecordBatch.from_arrays([*block.columns, *extra], [*block.schema.names, *own])

    return kept.mapInArrow(run, schema)


__all__ = ["LanguageModel", "features", "fit_language", "label_documents", "label_texts", "language_sample", "words_of"]
