"""A filter of 64-bit keys: rows that certainly lack a key are told before they are moved.

The filter is a table of bit chunks, made by Spark and broadcast: a key has two
bits in one chunk.  It holds at most ``MAX_CHUNKS`` chunks (8 MB).  Rows that
may have a key must still meet the keys themselves; with too many keys for the
chunks more rows do, and results stay the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BITS = 1 << 16
BITS_A_KEY = 16
MAX_CHUNKS = 1024
_SEED = 7919


def key_filter(keys: DataFrame) -> DataFrame:
    """(chunk, words): the filter of the only column of ``keys``, a long."""
    spark = keys.sparkSession
    wanted = -(-keys.count() * BITS_A_KEY // CHUNK_BITS)
    chunks = min(MAX_CHUNKS, 1 << max(0, wanted - 1).bit_length())
    # Every chunk has all its words, so that a word's place is its number.
    bare = spark.range(chunks * CHUNK_BITS // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    h = F.xxhash64(F.col(keys.columns[0]), F.lit(_SEED))
    at = keys.select(F.explode(F.array(*[_chunk(h, chunks) * CHUNK_BITS + b for b in _bits(h)])).alias("at"))
    one = F.expr("shiftleft(1L, int(at & 63))")
    words = bare.union(at.select(F.shiftright("at", 6), one)).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return words.groupBy(F.expr(f"word div {CHUNK_BITS // 64}").alias("chunk")).agg(F.sort_array(F.collect_list(F.struct("word", "bits")))["bits"].alias("words"))


def _chunk(h: Column, chunks: int) -> Column:
    return F.shiftrightunsigned(h, 32) % F.lit(chunks)


def _bits(h: Column) -> list[Column]:
    return [h.bitwiseAND(F.lit(CHUNK_BITS - 1)), F.shiftrightunsigned(h, 16).bitwiseAND(F.lit(CHUNK_BITS - 1))]


def split(rows: DataFrame, key: Column, held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be in the filter ``held``, those whose key is not); a null key is not.

    ``held`` is one that was written and is read here.
    """
    chunks = held.count()
    h = F.xxhash64("__key", F.lit(_SEED))
    word = lambda b: F.get("words", F.shiftright(b, 6).cast("int"))
    bit = lambda b: F.call_function("shiftright", word(b), b.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1
    first, second = _bits(h)
    met = (F.col("chunk") == _chunk(h, chunks)) & bit(first) & bit(second) & F.col("__key").isNotNull()
    keyed = rows.withColumn("__key", key)
    return tuple(keyed.join(F.broadcast(held), met, how).drop("__key") for how in ("left_semi", "left_anti"))  # type: ignore[return-value]


__all__ = ["key_filter", "split"]
