"""Sharding by histogram sort: near-equal bytes per shard after one exchange.

The sort key of a row is 64 bits: 40 of its text's hash, 24 of its id's hash,
so equal texts lie together and a hot text still can be divided.  Splitters
are found by counting: each turn takes the exact bytes below candidate keys
(probes) over all partitions and narrows every splitter's bracket to the two
probes around its target, until the bracket holds no more than the tolerance.
Then each row's part is known and the rows move once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.session import shared_dir

FIRST_PROBES = 4096
NEXT_PROBES = 256
#: Probes of one turn, whatever the number of splitters looked for (two a splitter at least).
MAX_PROBES = 1 << 18
_LOW, _HIGH = -(2**63), 2**63 - 1


def sort_key(text: str, ident: str) -> Column:
    """High 40 bits from the text, low 24 from the id."""
    mask = (1 << 24) - 1
    return F.xxhash64(F.coalesce(F.col(text), F.lit(""))).bitwiseAND(F.lit(~mask)).bitwiseOR(F.xxhash64(F.col(ident)).bitwiseAND(F.lit(mask)))


def _bytes_between(rows: DataFrame, probes: np.ndarray) -> np.ndarray:
    """Exact bytes below the first probe, between neighbours, and from the last on."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(probes) + 1, dtype=np.int64)
        for x in frames:
            np.add.at(total, np.searchsorted(probes, x["sort_key"].to_numpy(), "right"), x["size"].to_numpy())
        some = np.flatnonzero(total)
        yield pd.DataFrame({"bin": some, "bytes": total[some]})

    counted = rows.select("sort_key", "size").mapInPandas(run, "bin long, bytes long").groupBy("bin").agg(F.sum("bytes").alias("bytes"))
    out = np.zeros(len(probes) + 1, dtype=np.int64)
    for r in counted.collect():  # at most one row per probe
        out[r["bin"]] = r["bytes"]
    return out


def _spread(lo: int, hi: int, n: int) -> list[int]:
    """Up to n keys evenly over lo < key <= hi, hi among them."""
    return sorted({lo + (hi - lo) * i // n for i in range(1, n + 1)} - {lo})


def find_splitters(rows: DataFrame, targets: list[float], tolerance: list[float]) -> list[int]:
    """Keys k so that the bytes of rows with a key below k come within the
    tolerance of the target, or as near as whole keys allow."""
    total = None
    # Per splitter: lower key and the bytes below it, upper key and the bytes below that.
    brackets: list[tuple[int, int, int, int]] = []
    while True:
        if total is None:
            probes = np.array(_spread(_LOW, _HIGH, FIRST_PROBES), dtype=np.int64)
        else:
            open_ = [b for b, t in zip(brackets, tolerance) if b[2] - b[0] > 1 and b[3] - b[1] > t]
            if not open_:
                break
            apart = set(open_)
            each = max(2, min(NEXT_PROBES, MAX_PROBES // len(apart)))
            keys = {k for b in apart for k in _spread(b[0], b[2], each)} | {b[0] for b in apart}
            probes = np.array(sorted(keys), dtype=np.int64)
        below = np.cumsum(_bytes_between(rows, probes))
        if total is None:
            total = int(below[-1])
            brackets = [(_LOW, 0, _HIGH, total)] * len(targets)
        found = list(zip(probes.tolist(), below.tolist()))
        for i, target in enumerate(targets):
            lo, lo_bytes, hi, hi_bytes = brackets[i]
            at = int(np.searchsorted(below[:-1], target, "right"))
            if at and found[at - 1][0] >= lo:
                lo, lo_bytes = found[at - 1]
            if at < len(found) and found[at][0] <= hi:
                hi, hi_bytes = found[at]
            brackets[i] = (lo, lo_bytes, hi, hi_bytes)
    return [hi if hi_bytes - t < t - lo_bytes else lo for (lo, lo_bytes, hi, hi_bytes), t in zip(brackets, targets)]


def shard_documents(
    docs: DataFrame,
    n_shards: int = 8,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    tolerance: float = 0.001,
    part_bytes: int = 256 << 20,
) -> DataFrame:
    """All columns of ``docs`` plus size, text_crc32, shard and slot.

    Size is the UTF-8 bytes of the text (null: none) plus 1.  Shards are 0 to
    n_shards - 1 in key order, their bytes within ``tolerance`` of a shard's
    share or a row of the mean; slots are 0, 1, ... in each.  Equal texts stay
    in one shard unless a splitter must divide them to keep the shards equal.
    A shard is exchanged as several parts of about ``part_bytes``.  Texts are hashed whole,
    whatever their length; a null id is one like others.  Rows equal
    in id and text take neighbouring slots; an empty table gives an empty one;
    input columns with the names of the new ones are replaced.
    """
    spark = docs.sparkSession
    new = ["size", "text_crc32", "shard", "slot"]
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.drop(*new, "sort_key").withColumns(
        {"size": (F.octet_length(text) + 1).cast("long"), "text_crc32": F.crc32(text.cast("binary")), "sort_key": sort_key(text_col, id_col)}
    )
    path = shared_dir(spark, "shard-keys")
    keyed.select("sort_key", "size").write.parquet(path)
    slim = spark.read.parquet(path)
    total = slim.agg(F.sum("size")).first()[0] or 0
    per_shard = max(1, -(-total // (n_shards * part_bytes)))
    n_parts = n_shards * per_shard
    share = total / n_shards
    targets = [total * i / n_parts for i in range(1, n_parts)]
    limits = [share * tolerance if i % per_shard == 0 else share / per_shard / 4 for i in range(1, n_parts)]
    splitters = np.array(find_splitters(slim, targets, limits) if total else [], dtype=np.int64)

    @F.pandas_udf("int")
    def part_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splitters, key.to_numpy(), "right").astype(np.int32))

    counts = {r["part"]: r["count"] for r in slim.groupBy(part_of("sort_key").alias("part")).count().collect()}  # one row per part
    before = []
    for part in range(n_parts):
        at = 0 if part % per_shard == 0 else before[-1] + counts.get(part - 1, 0)
        before.append(at)
    moved = keyed.withColumn("__part", part_of("sort_key")).repartitionById(n_parts, F.col("__part")).sortWithinPartitions("sort_key", id_col, "text_crc32", "size")
    in_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    first_slots = np.array(before, dtype=np.int64)

    @F.pandas_udf("long")
    def first_slot(part: pd.Series) -> pd.Series:
        return pd.Series(first_slots[part.to_numpy()])

    return moved.withColumn("slot", in_part).withColumns(
        {"shard": F.floor(F.col("__part") / per_shard).cast("int"), "slot": F.col("slot") + first_slot("__part")}
    ).drop("__part", "sort_key")


__all__ = ["find_splitters", "shard_documents", "sort_key"]
