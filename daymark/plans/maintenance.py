"""Bronze upkeep: small ingests rewritten into sorted files, replaced ones removed.

A compaction is an ingest of its own.  Its rows in ``files`` carry the time of the
ingest they copy, and its id sorts behind every other, so for each raw file it
takes the place of exactly that version: a file ingested again meanwhile or later
still wins.  Readers see each file's rows from one place or the other, never
twice and never not at all, whenever the job stops.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.functions.temporal import day_of
from daymark.plans import bronze as B
from daymark.sinks.files import write_partitioned
from daymark.sources.files import join_uri

#: Sorts behind times and stream names, so that it wins where times are equal.
COMPACTED = "z-compact"


@dataclass(frozen=True)
class Compaction:
    ingest_id: str | None    # None: nothing to do
    files: int               # raw files whose rows were rewritten
    rows: int


def compact_bronze(spark: SparkSession, bronze_root: str, kind: str, *, max_rows: int = 5_000_000) -> Compaction:
    """Rewrite the current rows of all ingests of at most ``max_rows`` rows into one, its
    files sorted by day, corrupt lines included.  Fewer than two such ingests are left alone."""
    path = join_uri(bronze_root, kind)
    files = B.bronze_files(spark, bronze_root, kind).where("current")
    sizes = files.groupBy("ingest_id").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files")).where(F.col("rows") <= max_rows)
    # One row per small ingest.
    small = sizes.collect()
    if len(small) < 2:
        return Compaction(None, 0, 0)
    ids = [r["ingest_id"] for r in small]
    taken = files.where(F.col("ingest_id").isin(ids))
    rows = B.read_bronze(spark, bronze_root, kind).where(F.col("ingest_id").isin(ids))
    ingest_id = f"{COMPACTED}-{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    own = [f.name for f in B.DATA_SCHEMAS[kind].fields if f.name != "ingest_id"]
    day = day_of(B.DAY_COLUMNS[kind])
    # Ranges of (file date, day): few files per folder, each with few days.
    placed = rows.select(*own, day.alias("__day")).repartitionByRange("file_date", "__day", "source_file").sortWithinPartitions("file_date", "__day").drop("__day")
    res = write_partitioned(placed, join_uri(path, "data", f"ingest_id={ingest_id}"), ["file_date"], dynamic=False, layout="none")
    versions = taken.select("source_file", "ingested_at", F.coalesce("of_ingest", "ingest_id").alias("of_ingest"))
    B.list_ingest(spark, path, kind, ingest_id, versions)
    return Compaction(ingest_id, sum(r["files"] for r in small), res.rows or 0)


def removable_ingests(spark: SparkSession, bronze_root: str, kind: str, older_than: dt.timedelta) -> DataFrame:
    """Ingests of whose files none is current, the last of them replaced at least ``older_than`` ago."""
    files = B.bronze_files(spark, bronze_root, kind)
    limit = F.current_timestamp() - F.make_dt_interval(secs=F.lit(older_than.total_seconds()))
    return files.groupBy("ingest_id").agg(F.count_if("current").alias("n"), F.max("ingested_at").alias("at")).where((F.col("n") == 0) & (F.col("at") <= limit)).select("ingest_id")


def vacuum_bronze(spark: SparkSession, bronze_root: str, kind: str, *, older_than: dt.timedelta = dt.timedelta(days=7), keep: Iterable[str] = ()) -> list[str]:
    """Delete replaced ingests past the retention time; returns their ids.

    ``keep`` names ingests that something else still refers to: the committed listing of
    an incremental store, which takes rows back from the version it counted (unless a compaction
    holds them).  An ingest leaves ``files`` before its rows go, so readers never list a folder
    that is not there.
    """
    gone = sorted({r["ingest_id"] for r in removable_ingests(spark, bronze_root, kind, older_than).collect()} - set(keep))
    hadoop = spark._jvm.org.apache.hadoop.fs
    for ingest_id in gone:
        for part in ("files", "file_days", "data"):
            folder = hadoop.Path(join_uri(bronze_root, kind, part, f"ingest_id={ingest_id}"))
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return gone


__all__ = ["COMPACTED", "Compaction", "compact_bronze", "removable_ingests", "vacuum_bronze"]
