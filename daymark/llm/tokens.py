"""Token ids in Parquet files made for selective reads.

``write_token_files`` range-partitions documents by id, encodes every whole
text in the task that writes it and stores one row per document: its ids as a
list column (dictionary or delta encoded), the number of ids, and where they
start within the file's part.  Row groups and pages are kept small enough for
the page index to be useful.  A manifest holds each part's first id position,
so a start over the whole corpus is one addition: no pass over the ids is
needed to find or to skip a document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daymark.llm.units import UnitCache
from daymark.llm.words import pieces as row_blocks
from daymark.llm.worker import kept_for_stage


class TextEncoder:
    """The tokenizer's ids of whole texts, through a cache of their words.

    The tokenizer must cut words as byte-level BPE does: a boundary lies
    before every space between two non-space characters, before a line
    break between two such characters, and between a letter and a stop behind it, whatever
    stands around them.  So a
    plain text may be cut there and its units encoded apart, or many units in a
    row; other texts are encoded whole, and so are those that hold the string of
    an added token.  ``special_as_text`` makes such strings ordinary text; by default they get
    the added token's id, as the library does.
    """

    def __init__(self, tokenizer_json: str, special_as_text: bool = False) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = special_as_text
        self.added = [] if special_as_text else sorted({t.content for t in self.tokenizer.get_added_tokens_decoder().values()})
        # Byte-level tokens spell each byte of the text as one character.
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.token_bytes = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for token, i in vocab.items():
            self.token_bytes[i] = len(token)
        self.cache = UnitCache(self.encode_units, stops=True)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.int32)

    def encode_units(self, units: list[bytes], plain: np.ndarray) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(units)
        spaced = [i for i, u in enumerate(units) if u[0] in b" \n" and plain[i]]
        for lo in range(0, len(spaced), 5000):
            some = spaced[lo : lo + 5000]
            ids = self._ids(b"".join([units[i] for i in some]).decode())
            # Token lengths tell where each unit's ids end.
            ends = np.searchsorted(np.cumsum(self.token_bytes[ids]), np.cumsum([len(units[i]) for i in some])) + 1
            for i, own in zip(some, np.split(ids, ends[:-1])):
                out[i] = own
        return [own if own is not None else self._ids(unit.decode()) for own, unit in zip(out, units)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the n+1 offsets of the texts in them."""
        held = np.zeros(len(texts), dtype=bool)
        for token in self.added:
            held |= pc.fill_null(pc.match_substring(texts, token), False).to_numpy(zero_copy_only=False)
        if not held.any():
            return self.cache.encode(texts)
        ids, off = self.cache.encode(pc.if_else(pa.array(held), pa.scalar("", texts.type), texts))
        rows = np.split(ids, off[1:-1])
        for i in np.flatnonzero(held):
            rows[i] = self._ids(texts[int(i)].as_py())
        return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])


def _encoder(tokenizer_json: str, special_as_text: bool) -> TextEncoder:
    return kept_for_stage(("tokens", tokenizer_json, special_as_text), lambda: TextEncoder(tokenizer_json, special_as_text))


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_file: str,
    *,
    end_id: int = 0,
    special_as_text: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
    encoding: str = "dictionary",
    row_group_bytes: int = 16 << 20,
    page_bytes: int = 256 << 10,
    page_rows: int = 1000,
) -> None:
    """Write ``path``/data and ``path``/manifest for all rows of ``docs``.

    Rows are in ascending ``id_col`` order over the parts and within them (a
    null id first; rows that share an id in an order fixed by their text).  A
    null or empty text has just the end id; texts of any length are encoded whole; an
    empty table gives readable files without rows; other columns are ignored.  ``encoding`` is
    "dictionary" or "delta".  ``special_as_text`` is that of ``TextEncoder``.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding {encoding!r}")
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        encoder = _encoder(shared.value, special_as_text)
        for batch in batches:
            for lo, hi in row_blocks(batch.column(1)):
                ids, off = encoder.encode(batch.column(1).slice(lo, hi - lo))
                ids = np.insert(ids, off[1:], end_id)
                off = off + np.arange(hi - lo + 1)
                lists = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(hi - lo, part, np.int32)), batch.column(0).slice(lo, hi - lo), pa.array(at + off[:-1]), pa.array(np.diff(off)), lists],
                    ["part", id_col, "start_in_part", "n_tokens", "ids"],
                )
                at += int(off[-1])

    id_type = docs.schema[id_col].dataType.simpleString()
    encoded = (
        docs.select(id_col, text_col)
        .repartitionByRange(F.col(id_col))
        .sortWithinPartitions(F.col(id_col), F.xxhash64(text_col))
        .mapInArrow(run, f"part int, `{id_col}` {id_type}, start_in_part long, n_tokens long, ids array<int>")
    )
    (
        encoded.write.mode("overwrite")
        .option("compression", "zstd")
        .option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
        .option("parquet.writer.version", "PARQUET_2_0" if encoding == "delta" else "PARQUET_1_0")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.page.row.count.limit", page_rows)
        .parquet(f"{path}/data")
    )
    # One row per part; the window's single task sees only those.
    parts = spark.read.parquet(f"{path}/data").groupBy("part").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_part_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts.withColumn("base", F.coalesce(F.sum("n_part_tokens").over(before), F.lit(0))).write.mode("overwrite").parquet(f"{path}/manifest")


def read_token_files(spark: SparkSession, path: str, *, columns: tuple[str, ...] = ("doc_id", "start", "n_tokens", "ids")) -> DataFrame:
    """The written rows; filters on the id and reads without ``ids`` reach the Parquet scan.

    The manifest has one row per part, so broadcasting it is bounded by the
    number of files.
    """
    data = spark.read.parquet(f"{path}/data")
    bases = F.broadcast(spark.read.parquet(f"{path}/manifest").select("part", "base"))
    return data.join(bases, "part").withColumn("start", F.col("base") + F.col("start_in_part")).select(*columns)


def ids_crc32(tokens: DataFrame, *, ids_col: str = "ids", out_col: str = "ids_crc32") -> DataFrame:
    """Replace ``ids_col`` by the unsigned crc32 of its ids as little-endian 32-bit integers."""
    others = [c for c in tokens.columns if c not in (ids_col, out_col)]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema.fields if f.name in others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(ids_col)
            values = lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False).tobytes()
            off = lists.offsets.to_numpy()
            sums = [zlib.crc32(values[4 * a : 4 * b]) for a, b in zip(off[:-1], off[1:])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(sums, pa.int64())], [*others, out_col])

    return tokens.select(*others, ids_col).mapInArrow(run, f"{schema}, {out_col} long")


__all__ = ["TextEncoder", "write_token_files", "read_token_files", "ids_crc32"]
