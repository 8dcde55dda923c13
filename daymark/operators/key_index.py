"""Uniqueness of a key over all ingests, without reading old rows.

An index kept in the snapshot store has one row per key and file: (bucket of
the key's hash, key, file, ingest, rows), appended by every run in its commit.
Before it stands a Bloom filter, also a table: bitmaps of 32,768 bits, of which
every key sets ``HASHES``.  New keys are joined with the bitmaps their bits lie
in; only keys whose bits are all set can have occurred before, and only the
buckets of such keys are read from the index.  Index rows of file versions that
were replaced meanwhile do not count.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.sinks.snapshots import SnapshotStore, Transaction
from daymark.sources.files import join_uri

HASHES = 3
SLOT_BITS = 32_768
FILTER_PARTS = 16
RULE = "unique over all files"


@dataclass(frozen=True)
class Breaches:
    """``keys``: each key in more than one row, with its rows in new and in earlier files;
    ``earlier``: (key, source_file, rows) of the earlier ones."""

    table: str
    column: str
    keys: DataFrame
    earlier: DataFrame

    def violations(self, rows: DataFrame, columns: Sequence[str]) -> DataFrame:
        """Quarantine records: every new row of such a key as JSON, and for rows of earlier files
        the key, the file and how many there are."""
        named = [F.lit(self.table).alias("table_name"), F.lit(RULE).alias("rule")]
        keys = self.keys.select(F.col("key").alias("__key"))
        new = rows.join(keys, F.col(self.column).cast("string").eqNullSafe(F.col("__key")), "left_semi")
        new = new.select(*named, F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("row_json"))
        old = F.struct(F.col("key").alias(self.column), "source_file", "rows")
        return new.unionByName(self.earlier.select(*named, F.to_json(old, {"ignoreNullFields": "false"}).alias("row_json")))


class KeyIndex:
    """The index of one column; ``bits`` (a power of two, some 16 per key expected) and
    ``buckets`` are fixed for a store."""

    def __init__(self, store: SnapshotStore, table: str, column: str, *, bits: int = 1 << 27, buckets: int = 64) -> None:
        self.store, self.table, self.column, self.bits, self.buckets = store, table, column, bits, buckets
        self.index, self.filter = f"index_{table}_{column}", f"filter_{table}_{column}"
        self.index_schema = T.StructType([
            T.StructField("bucket", T.IntegerType()), T.StructField("key", T.StringType()), T.StructField("source_file", T.StringType()),
            T.StructField("ingest_id", T.StringType()), T.StructField("rows", T.LongType()),
        ])
        self.filter_schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("slot", T.LongType()), T.StructField("bitmap", T.BinaryType())])

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _bits(self, keys: DataFrame) -> DataFrame:
        """(key, hash number, slot, place in the slot's bitmap): HASHES rows per key."""
        place = F.pmod(F.xxhash64("key", "i"), F.lit(self.bits))
        each = keys.withColumn("i", F.explode(F.array(*[F.lit(i + 1) for i in range(HASHES)]))).withColumn("bit", place)
        return each.select("key", "i", F.floor(F.col("bit") / F.lit(SLOT_BITS)).cast("long").alias("slot"), F.pmod("bit", F.lit(SLOT_BITS)).alias("place"))

    def _keyed(self, rows: DataFrame, *more: str) -> DataFrame:
        return rows.select(F.col(self.column).cast("string").alias("key"), *more)

    def possible(self, keys: DataFrame, t: Transaction) -> DataFrame:
        """Of distinct ``keys`` those whose bits are all set in the filter of the commit before."""
        maps = self.store.read(self.filter, self.filter_schema, snapshot=t.base).select("slot", "bitmap")
        byte = F.conv(F.hex(F.expr("substring(bitmap, int(place div 8) + 1, 1)")), 16, 10).cast("int")
        is_set = byte.bitwiseAND(F.expr("shiftleft(1, int(place % 8))")) != 0
        hits = self._bits(keys).join(maps, "slot").where(is_set)
        return hits.groupBy("key").agg(F.count_distinct("i").alias("n")).where(F.col("n") == HASHES).select("key")

    def check(self, t: Transaction, rows: DataFrame, listing: DataFrame) -> Breaches:
        """Compare the keys of new ``rows`` with each other and with those of the earlier files
        that ``listing`` (source_file, ingest_id) still counts.  Null is a key like others."""
        work = join_uri(self.store.root, "work", t.folder, self.index)
        keys = self._keyed(rows).groupBy("key").agg(F.count(F.lit(1)).alias("new_rows"))
        maybe = self.possible(keys.select("key"), t).withColumn("bucket", self._bucket(F.col("key")))
        maybe.write.parquet(f"{work}/maybe")
        maybe = t.store.spark.read.parquet(f"{work}/maybe")
        # At most as many as there are buckets.
        buckets = [r["bucket"] for r in maybe.select("bucket").distinct().collect()]
        old = self.store.read(self.index, self.index_schema, buckets, t.base)
        m = maybe.select(F.col("key").alias("__key"), F.col("bucket").alias("__bucket"))
        found = old.join(m, (F.col("bucket") == F.col("__bucket")) & F.col("key").eqNullSafe(F.col("__key")), "left_semi")
        found.join(listing.select("source_file", "ingest_id"), ["source_file", "ingest_id"], "left_semi").write.parquet(f"{work}/earlier")
        earlier = t.store.spark.read.schema(self.index_schema).parquet(f"{work}/earlier").select("key", "source_file", "rows")
        sums = earlier.groupBy(F.col("key").alias("__key")).agg(F.sum("rows").alias("old_rows"))
        both = keys.join(sums, F.col("key").eqNullSafe(F.col("__key")), "left").select("key", "new_rows", F.coalesce("old_rows", F.lit(0)).alias("old_rows"))
        both.where("new_rows + old_rows > 1").write.parquet(f"{work}/keys")
        return Breaches(self.table, self.column, t.store.spark.read.parquet(f"{work}/keys"), earlier)

    def add(self, t: Transaction, rows: DataFrame) -> None:
        """Append the keys of new ``rows`` (with source_file, ingest_id) to index and filter."""
        own = self._keyed(rows, "source_file", "ingest_id")
        counted = own.groupBy("key", "source_file", "ingest_id").agg(F.count(F.lit(1)).alias("rows"))
        counted = counted.withColumn("bucket", self._bucket(F.col("key"))).select(*self.index_schema.fieldNames())
        t.write(self.index, counted, "bucket", append=True, tie_cols=("key",))
        maps = self._bits(own.select("key").distinct()).groupBy("slot").agg(F.bitmap_construct_agg("place").alias("bitmap"))
        t.write(self.filter, maps.select(F.pmod("slot", F.lit(FILTER_PARTS)).cast("int").alias("part"), "slot", "bitmap"), "part", append=True)


def compact_filter(t: Transaction, index: KeyIndex) -> None:
    """One bitmap per slot again, where several commits have added some."""
    maps = index.store.read(index.filter, index.filter_schema, snapshot=t.snapshot())
    t.write(index.filter, maps.groupBy("part", "slot").agg(F.bitmap_or_agg("bitmap").alias("bitmap")), "part")


__all__ = ["RULE", "Breaches", "KeyIndex", "compact_filter"]
