"""Substring deduplication by sliding spans of sentences.

A sentence ends at a word that ends in ``. ! ?``, at a line break, or after 16
words.  From every sentence starts one span: the shortest run of two or more
consecutive sentences with at least ``min_words`` words.  A span depends on
its own words only, so a passage that occurs again brings the same spans.
With ``local_cuts`` quotes and brackets may follow a stop, other scripts' stops
count too, and instead of after 16 words a long sentence is cut where the hash
of two words is the least of those within ``WINDOW`` words on both sides: equal
passages are cut alike, whatever stands before them, but for their first and
last words up to a cut.  With ``both_sides`` the shortest such run that ends on
each sentence is a span too.  The spans within a passage of two or more
sentences and ``min_words`` words then cover all of it: its last sentences, too
short to start a run, lie in the one that ends on the last of them.
Spans are hashed and joined over all documents; all occurrences but the first
(by document id, then place) are marked, and sentences that a marked span
covers are removed.

Counting moves hashes only; a hash that a third of all documents share is
counted with partial sums, and its places are salted for the joins.  Spans are made again for it rather than written; the places of
those that repeat are.  Texts move once, to meet their marks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.llm.words import _BASE, _BASE_INV, _powers, mix64, pieces, utf8, word_hashes, word_spans
from daymark.llm.worker import free_other_stages
from daymark.session import shared_dir

MAX_SENTENCE = 16
_END = np.zeros(256, dtype=bool)
_END[[ord(c) for c in ".!?"]] = True
WINDOW = 4
HOT_SHARE = 1024
SALTS = 64
_STOPS = [c.encode() for c in ".!?。．！？؟۔।…"]
_CLOSERS = [c.encode() for c in "\"')]}»”’」』）"]
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def _ends_in(raw: np.ndarray, start: np.ndarray, end: np.ndarray, marks: list[bytes]) -> np.ndarray:
    """Length of the mark that each word ends in, 0 for none."""
    size = np.zeros(len(end), dtype=np.int64)
    for mark in marks:
        fits = np.flatnonzero((end - start >= len(mark)) & (raw[end - 1] == mark[-1]))
        for i, byte in enumerate(mark[:-1]):
            fits = fits[raw[end[fits] - len(mark) + i] == byte]
        size[fits] = len(mark)
    return size


def _stopped(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether each word ends in a stop, with or without closing quotes and brackets behind it."""
    end, left = end.copy(), np.arange(len(end))
    while len(left):
        size = _ends_in(raw, start[left], end[left], _CLOSERS)
        left, size = left[size > 0], size[size > 0]
        end[left] -= size
        left = left[end[left] > start[left]]
    # A word of closers only is no stop.
    return (_ends_in(raw, start, np.maximum(end, start + 1), _STOPS) > 0) & (end > start)


def _local_cuts(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words with the least pair hash within ``WINDOW`` words, none of which starts a sentence.

    Equal hashes so near come from words that repeat; of these, cuts are
    ``WINDOW`` + 1 words or more apart, which is a whole number of periods.
    """
    n, w = len(words), WINDOW
    if n <= 2 * w:
        return np.zeros(0, dtype=np.int64)
    pairs = mix64(words * _PAIR + np.append(words[1:], np.uint64(0)))
    least = pairs[: n - 2 * w].copy()
    for i in range(1, 2 * w + 1):
        np.minimum(least, pairs[i : n - 2 * w + i], out=least)
    begun = np.concatenate([[0], np.cumsum(first)])
    at = np.arange(w, n - w)
    cuts = at[(pairs[w : n - w] == least) & (begun[at + w + 1] == begun[at - w + 1])]
    near = np.diff(cuts, prepend=-w - 1) <= w
    keep, last, places = ~near, 0, cuts.tolist()
    for i in np.flatnonzero(near).tolist():
        if not near[i - 1]:
            last = places[i - 1]
        if places[i] - last > w:
            keep[i], last = True, places[i]
    return cuts[keep]


def sentences(raw: np.ndarray, off: np.ndarray, *, local_cuts: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First words of the sentences (and the number of words), the n+1 sentence
    offsets of the texts, first bytes and word hashes of all words."""
    start, end, at = word_spans(raw, off)
    n = len(start)
    if not n:
        return np.zeros(1, np.int64), np.zeros(len(off), np.int64), start, np.zeros(0, np.uint64)
    lines = np.concatenate([[0], np.cumsum(raw == 0x0A)])
    first = np.zeros(n, dtype=bool)
    first[at[:-1][np.diff(at) > 0]] = True
    words = word_hashes(raw, start, end)
    stopped = _stopped(raw, start, end) if local_cuts else _END[raw[end - 1]]
    first[1:] |= stopped[:-1] | (lines[start[1:]] > lines[end[:-1]])
    if local_cuts:
        first[_local_cuts(words, first)] = True
    else:
        begun = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        first |= (np.arange(n) - begun) % MAX_SENTENCE == 0
    heads = np.flatnonzero(first)
    return np.append(heads, n), np.searchsorted(heads, at), start, words


def spans(
    heads: np.ndarray, at: np.ndarray, words: np.ndarray, min_words: int, *, both_sides: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, first sentence in the text, number of sentences and hash of every span."""
    n = len(heads) - 1
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    stop = np.maximum(np.searchsorted(heads, heads[:n] + min_words), np.arange(n) + 2)
    good = stop <= at[text + 1] if n else np.zeros(0, bool)
    first, stop = np.flatnonzero(good), stop[good]
    if both_sides and n:
        last = np.arange(1, n + 1)
        begin = np.minimum(np.searchsorted(heads, heads[1:] - min_words, "right") - 1, last - 2)
        good = begin >= at[text]
        both = np.unique(np.concatenate([first * (n + 1) + stop, begin[good] * (n + 1) + last[good]]))
        first, stop = both // (n + 1), both % (n + 1)
    text = text[first]
    a, b = heads[first], heads[stop]
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * _powers(_BASE, len(words)), out=sums[1:])
    hashed = mix64((sums[b] - sums[a]) * _powers(_BASE_INV, len(words) + 1)[a] + (b - a).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return text, first - at[text], stop - first, hashed.view(np.int64)


def repeated_spans(docs: DataFrame, *, min_words: int = 20, local_cuts: bool = False, both_sides: bool = False) -> DataFrame:
    """(doc_id, th, marks): for each document that has any, the spans that occurred
    before, as packed pairs of first sentence and number of sentences."""
    spark = docs.sparkSession

    def made(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        heads, at, _, words = sentences(*utf8(texts), local_cuts=local_cuts)
        return spans(heads, at, words, min_words, both_sides=both_sides)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_other_stages()
        for batch in batches:
            for lo, hi in pieces(batch.column(0)):
                hashed, n = np.unique(made(batch.column(0).slice(lo, hi - lo))[3], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(hashed), pa.array(n.astype(np.int64))], ["span", "n"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_other_stages()
        for batch in batches:
            for lo, hi in pieces(batch.column(2)):
                block = batch.slice(lo, hi - lo)
                text, first, size, hashed = made(block.column(2))
                rows = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashed), block.column(0).take(rows), block.column(1).take(rows), pa.array((first.astype(np.int64) << 24) + size)], ["span", "doc_id", "th", "place"]
                )

    path = shared_dir(spark, "spans")
    counted = docs.select("text").mapInArrow(count, "span long, n long").groupBy("span").agg(F.sum("n").alias("n")).where("n > 1")
    counted.write.parquet(f"{path}/several")
    several = spark.read.parquet(f"{path}/several")
    # A span with a thousandth or more of all places is dealt over SALTS tasks; there are at most HOT_SHARE of them.
    total = several.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(several.where(F.col("n") * HOT_SHARE > total).select(F.col("span").alias("__hot")))
    salts = F.when(F.col("__hot").isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted = lambda spans: spans.join(hot, F.col("span") == F.col("__hot"), "left").withColumn("salt", F.explode(salts)).drop("__hot")
    own_salt = F.when(F.col("__hot").isNotNull(), F.pmod(F.xxhash64("th", "place"), F.lit(SALTS))).otherwise(0).cast("int")
    schema = T.StructType([T.StructField("span", T.LongType()), docs.schema["doc_id"], T.StructField("th", T.LongType()), T.StructField("place", T.LongType())])
    places = docs.mapInArrow(place, schema).join(hot, F.col("span") == F.col("__hot"), "left").withColumn("salt", own_salt).drop("__hot")
    places.join(salted(several.select("span")), ["span", "salt"]).write.parquet(f"{path}/found")
    found = spark.read.parquet(f"{path}/found")
    origin = F.struct("doc_id", "th", "place")
    firsts = found.groupBy("span").agg(F.min(origin).alias("first"), F.max(origin).alias("last")).where("first <> last").select("span", "first")
    later = found.join(salted(firsts), ["span", "salt"]).where(origin != F.col("first"))
    return later.groupBy("doc_id", "th").agg(F.collect_set("place").alias("marks"))


def remove_repeated_passages(
    docs: DataFrame, *, min_words: int = 20, local_cuts: bool = False, both_sides: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All columns of ``docs`` with the text less its repeated sentences, plus
    n_sentences, n_removed and removed (arrays of first sentence and number).

    Words compare in lower case (A-Z), white space between them does not count.
    A sentence that stays keeps its bytes and the white space behind it; a text
    from which nothing goes stays as it is.  Null texts stay null, empty ones
    empty; rows equal in id and text are one document and lose the same
    sentences; a passage that a text repeats stays at its first place there;
    input columns with the names of the new ones are replaced.
    """
    new = ["n_sentences", "n_removed", "removed"]
    kept = docs.drop(*new)
    keyed = kept.withColumn("__th", F.xxhash64(text_col))
    texts = keyed.select(F.col(id_col).alias("doc_id"), F.col("__th").alias("th"), F.coalesce(text_col, F.lit("")).alias("text"))
    marks = repeated_spans(texts, min_words=min_words, local_cuts=local_cuts, both_sides=both_sides)
    k, m = keyed.alias("k"), marks.alias("m")
    met = k.join(m, F.col(f"k.{id_col}").eqNullSafe(F.col("m.doc_id")) & (F.col("k.__th") == F.col("m.th")), "left")
    met = met.select(*[F.col(f"k.`{c}`") for c in kept.columns], F.col("m.marks").alias("__marks"))
    removed = T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("size", T.IntegerType())]))
    schema = T.StructType([*kept.schema.fields, T.StructField("n_sentences", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("removed", removed)])
    names = kept.columns
    at_text = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in pieces(batch.column(at_text)):
                block = batch.slice(lo, hi - lo)
                raw, off = utf8(block.column(at_text))
                heads, at, start, _ = sentences(raw, off, local_cuts=local_cuts)
                texts, all_marks = block.column(at_text).to_pylist(), block.column(len(names)).to_pylist()
                gone, lists = np.zeros(hi - lo, np.int64), []
                for row, own in enumerate(all_marks):
                    lists.append([])
                    if not own:
                        continue
                    n = int(at[row + 1] - at[row])
                    depth = np.zeros(n + 1, dtype=np.int64)
                    places = np.array(own, dtype=np.int64)
                    np.add.at(depth, places >> 24, 1)
                    np.add.at(depth, np.minimum((places >> 24) + (places & 0xFFFFFF), n), -1)
                    stays = np.cumsum(depth)[:n] == 0
                    # Bytes of each sentence, up to the next one; the first has what stands before it.
                    cuts = [int(off[row]), *start[heads[at[row] + 1 : at[row + 1]]].tolist(), int(off[row + 1])]
                    texts[row] = b"".join([raw[cuts[i] : cuts[i + 1]].tobytes() for i in np.flatnonzero(stays)]).decode()
                    gone[row] = n - int(stays.sum())
                    edges = np.flatnonzero(np.diff(np.concatenate([[1], stays, [1]])))
                    lists[-1] = [{"first": int(a), "size": int(b - a)} for a, b in zip(edges[::2], edges[1::2])]
                columns = [*block.columns[:at_text], pa.array(texts, pa.string()), *block.columns[at_text + 1 : len(names)]]
                more = [pa.array(np.diff(at).astype(np.int64)), pa.array(gone), pa.array(lists, pa.list_(pa.struct([("first", pa.int32()), ("size", pa.int32())])))]
                yield pa.RecordBatch.from_arrays([*columns, *more], [*names, *new])

    return met.mapInArrow(run, schema)


__all__ = ["remove_repeated_passages", "repeated_spans", "sentences", "spans"]
