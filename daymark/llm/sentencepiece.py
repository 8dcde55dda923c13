"""SentencePiece encoding by a Viterbi pass over a trie of distinct words.

A text is normalised as the model says (mark in front, spaces to marks) and
cut into marked words, which no piece of the model crosses.  The distinct
words of a block are sorted, so that walking them in order is a depth-first
walk of their trie: the forward cells of the common prefix with the previous
word are kept, only the cells below the branch are computed anew.

* Unigram models: a cell holds the best score of its prefix and the piece
  that ends it.
* BPE models: pieces have merge priorities, not additive scores.  A cell holds
  the one piece that ends the BPE encoding of its prefix: a piece may follow
  another one only if BPE leaves that pair of pieces unmerged, all other
  transitions score minus infinity.  A sequence of pieces is the BPE encoding
  exactly when all its neighbours are such pairs, so the ids equal those of
  the sentencepiece library.

Encoding reads each document once, in the task that scanned it: there is no
shuffle, and memory is bounded by a block of text and a bounded cache of words.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from daymark.llm.units import UnitCache
from daymark.llm.words import pieces as row_blocks
from daymark.llm.worker import kept_for_stage

MARK = "▁"
_RUNS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


@dataclass(frozen=True)
class PieceModel:
    """What a task needs of a model file: pieces by id, and how to normalise."""

    kind: str  # "bpe" or "unigram"
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    types: tuple[int, ...]  # 1 normal, 2 unknown, 3 control, 4 user, 5 unused, 6 byte
    dummy_prefix: bool
    unk_surface: str


def load_model(path: str) -> PieceModel:
    """Read a model file on the driver; the tables (one entry per id) go to tasks.

    Models with user-defined symbols, white space as a suffix, removal of
    extra white space, a character map, pieces over several words or no byte
    fallback are refused: encoding them needs other rules than the ones above.
    """
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    trainer, norm = proto.trainer_spec, proto.normalizer_spec
    kind = {1: "unigram", 2: "bpe"}.get(trainer.model_type)
    if kind is None or norm.precompiled_charsmap or norm.remove_extra_whitespaces:
        raise ValueError(f"{path}: only unigram and BPE models without text rewriting are supported")
    if trainer.treat_whitespace_as_suffix or not norm.escape_whitespaces or any(p.type == 4 for p in proto.pieces):
        raise ValueError(f"{path}: marks at word ends and user-defined symbols are not supported")
    if any(MARK in p.piece.lstrip(MARK) or "\n" in p.piece for p in proto.pieces if p.type == 1):
        raise ValueError(f"{path}: it has pieces that cross words or lines")
    if sum(p.type == 6 for p in proto.pieces) != 256:
        raise ValueError(f"{path}: only models with byte fallback are supported")
    return PieceModel(
        kind,
        tuple(p.piece for p in proto.pieces),
        tuple(p.score for p in proto.pieces),
        tuple(p.type for p in proto.pieces),
        norm.add_dummy_prefix,
        trainer.unk_surface,
    )


class Encoder:
    """Encodes and decodes texts; one per Python worker and model."""

    def __init__(self, model: PieceModel) -> None:
        m = self.model = model
        normal = [(p, i) for i, (p, t) in enumerate(zip(m.pieces, m.types)) if t in (1, 5)]
        self.ids = dict(normal)
        self.score = {p: m.scores[i] for p, i in normal}
        self.longest = max((len(p) for p in self.ids), default=1)
        self.bytes = [m.pieces.index(f"<0x{b:02X}>") for b in range(256)]
        self.unk_score = min((m.scores[i] for _, i in normal), default=0.0) - 10.0
        self.pairs: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bool] = {}
        self.cache = UnitCache(self.encode_units)
        # For decoding: what each id spells, and which ids need their neighbours.
        surface = [p.replace(MARK, " ").encode() if t in (1, 5) else b"" for p, t in zip(m.pieces, m.types)]
        self.needs_care = np.array([t not in (1, 5) for t in m.types])
        for b, i in enumerate(self.bytes):
            surface[i] = bytes([b])
            self.needs_care[i] = b >= 0x80
        self.marked = np.array([t in (1, 5) and p.startswith(MARK) for p, t in zip(m.pieces, m.types)])
        self.spelled = np.frombuffer(b"".join(surface), np.uint8)
        self.spelled_at = np.concatenate([[0], np.cumsum([len(x) for x in surface])])

    def merge(self, text: str) -> list[str]:
        """BPE by its definition: best-scored neighbours merge first, then the leftmost."""
        n, score = len(text), self.score
        parts: list[str | None] = list(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (s := score.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-s, i, parts[i] + parts[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i]
            # An entry is out of date if one of its parts has merged meanwhile.
            if parts[i] is None or j >= n or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p is not None]

    def stays(self, left: str, right: str) -> bool:
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > 300_000:
                self.pairs.clear()
            known = self.pairs[key] = self.merge(left + right) == [left, right]
        return known

    def reached(self, piece: str) -> bool:
        known = self.whole.get(piece)
        if known is None:
            known = self.whole[piece] = len(piece) == 1 or self.merge(piece) == [piece]
        return known

    def bpe_cells(self, word: str, cells: list, shared: int) -> None:
        """Extend ``cells`` (one per prefix: start and text of its last piece)."""
        ids, longest = self.ids, self.longest
        del cells[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            for start in range(max(0, end - longest), end):
                piece = word[start:end]
                if piece in ids or start == end - 1:
                    if not self.reached(piece):
                        continue
                    if start == 0 or self.stays(cells[start][1], piece):
                        cells.append((start, piece))
                        break
            else:
                raise ValueError(f"no BPE encoding of {word!r}")

    def unigram_cells(self, word: str, cells: list, shared: int) -> None:
        """Extend ``cells``: start and text of the last piece, best score."""
        score, longest = self.score, self.longest
        del cells[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            best = None
            for start in range(max(0, end - longest), end):
                piece = word[start:end]
                s = score.get(piece)
                if s is None and start == end - 1:
                    s = self.unk_score
                if s is not None and (best is None or cells[start][2] + s > best[2]):
                    best = (start, piece, cells[start][2] + s)
            cells.append(best)

    def learn(self, words: Iterable[str]) -> dict[str, np.ndarray]:
        """Ids of distinct words, found in sorted order: a depth-first walk of their trie."""
        known = {}
        extend = self.bpe_cells if self.model.kind == "bpe" else self.unigram_cells
        previous, cells = "", [(0, "", 0.0)]
        for word in sorted(words):
            if self.model.kind == "bpe" and word.startswith(MARK * 2):
                # Pieces of marks alone tie in priority; they are merged by definition.
                chain = self.merge(word)
            else:
                shared, most = 0, min(len(previous), len(word))
                while shared < most and previous[shared] == word[shared]:
                    shared += 1
                extend(word, cells, shared)
                previous, chain, end = word, [], len(word)
                while end:
                    chain.append(cells[end][1])
                    end = cells[end][0]
                chain.reverse()
            ids: list[int] = []
            for piece in chain:
                own = self.ids.get(piece)
                ids += [own] if own is not None else [self.bytes[b] for b in piece.encode()]
            known[word] = np.array(ids, dtype=np.int32)
        return known

    def words(self, text: str) -> list[str]:
        """The marked words of a text; joined, they are the normalised text."""
        prefix = MARK if self.model.dummy_prefix and text else ""
        lines = (prefix + text.replace(" ", MARK)).split("\n")
        return [w for i, line in enumerate(lines) for w in _RUNS.findall("\n" * (i > 0) + line)]

    def encode_units(self, units: list[bytes], plain: np.ndarray) -> list[np.ndarray]:
        """Ids of single marked words (plain) or of whole texts."""
        prefix = MARK if self.model.dummy_prefix else ""
        rows = []
        for unit, is_word in zip(units, plain):
            text = unit.decode()
            if not is_word:
                rows.append(self.words(text))
            elif text[0] == " ":
                rows.append([MARK + text[1:]])
            else:
                rows.append([text if text[0] == "\n" else prefix + text])
        known = self.learn({w for row in rows for w in row})
        return [known[row[0]] if len(row) == 1 else np.concatenate([known[w] for w in row]) for row in rows]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All piece ids of the texts in a row, and the n+1 offsets of the texts in them."""
        return self.cache.encode(texts)

    def decode_all(self, ids: np.ndarray, off: np.ndarray) -> list[str]:
        """The text of each list of ids."""
        begin = self.spelled_at[ids]
        size = self.spelled_at[ids + 1] - begin
        stop = np.cumsum(size)
        data = self.spelled[np.repeat(begin - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)].tobytes()
        at = np.concatenate([[0], stop])[off]
        care = np.concatenate([[0], np.cumsum(self.needs_care[ids])])[off]
        out = []
        for row in range(len(off) - 1):
            if care[row + 1] > care[row]:
                out.append(self.decode(ids[off[row] : off[row + 1]].tolist()))
                continue
            drop = self.model.dummy_prefix and off[row + 1] > off[row] and bool(self.marked[ids[off[row]]])
            out.append(data[at[row] + drop : at[row + 1]].decode())
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids: bytes joined as UTF-8, marks to spaces, the prefix mark dropped."""
        m, out, raw, first = self.model, [], bytearray(), True
        for i in ids:
            kind, piece = m.types[i], m.pieces[i]
            if kind == 6:
                raw.append(int(piece[3:5], 16))
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
                first = False
            if kind == 3:
                continue
            if kind == 2:
                piece = m.unk_surface
            elif first and m.dummy_prefix and piece.startswith(MARK):
                piece = piece[1:]
            first = False
            out.append(piece)
        out.append(raw.decode("utf-8", "replace"))
        return "".join(out).replace(MARK, " ")


def _encoder(model: PieceModel) -> Encoder:
    """The worker's encoder for a model, kept over the tasks of a stage."""
    return kept_for_stage(("sentencepiece", model), lambda: Encoder(model))


def encode_documents(
    docs: DataFrame, model: PieceModel, *, text_col: str = "text", ids_col: str = "piece_ids", decoded_col: str | None = None
) -> DataFrame:
    """All columns of ``docs`` plus ``ids_col``: the piece ids of each whole text.

    With ``decoded_col``, also the text that these ids spell, from the same task.

    Null and empty texts get an empty list, repeated rows each get their own
    list, an empty table gives an empty table, an input column named like
    a new one is replaced.
    """
    new = [ids_col, *([decoded_col] if decoded_col else [])]
    kept = docs.drop(*new)
    schema = T.StructType([*kept.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType(), False), False)])
    if decoded_col:
        schema = schema.add(decoded_col, T.StringType(), False)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            for lo, hi in row_blocks(batch.column(text_col)):
                block = batch.slice(lo, hi - lo)
                ids, off = encoder.encode(block.column(text_col))
                lists = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids))
                more = [lists, pa.array(encoder.decode_all(ids, off), pa.string())] if decoded_col else [lists]
                yield pa.RecordBatch.from_arrays([*block.columns, *more], [*block.schema.names, *new])

    return kept.mapInArrow(run, schema)


def decode_documents(
    docs: DataFrame, model: PieceModel, *, ids_col: str = "piece_ids", out_col: str = "decoded"
) -> DataFrame:
    """All columns of ``docs`` plus ``out_col``: the text that the ids spell.

    A null list gives an empty text; an input column named like ``out_col`` is
    replaced.
    """
    kept = docs.drop(out_col)
    schema = T.StructType([*kept.schema.fields, T.StructField(out_col, T.StringType(), False)])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                block = batch.slice(lo, 500)
                lists = block.column(ids_col)
                ids = lists.flatten().to_numpy(zero_copy_only=False)
                sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                texts = encoder.decode_all(ids, np.concatenate([[0], np.cumsum(sizes)]))
                yield pa.RecordBatch.from_arrays([*block.columns, pa.array(texts, pa.string())], [*block.schema.names, out_col])

    return kept.mapInArrow(run, schema)


__all__ = ["PieceModel", "Encoder", "load_model", "encode_documents", "decode_documents"]
