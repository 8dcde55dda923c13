"""Incremental raw → bronze ingest.

A file-source stream picks up raw files not seen before (the checkpoint
records which), ``trigger(availableNow=True)`` processes everything that is
there and stops, so the daily job can call it like a batch step.  The stream
carries the files' paths only; each micro-batch reads its files as the batch
form does, every one by its own header.  A micro-batch is one ingest of the
batch form, named after the query and the batch: a batch replayed after a failure
rewrites exactly its own folder, and batch readers see one bronze table, with no
streaming-sink metadata folder in the way.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from daymark.plans.bronze import DATA_SCHEMAS, read_raw, write_ingest
from daymark.sources.files import join_uri, raw_pattern

PATHS_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


@dataclass(frozen=True)
class StreamIngestResult:
    kind: str
    path: str
    batches: int
    rows: int


def _paths_stream(spark: SparkSession, raw_root: str, glob: str, max_files: int | None) -> DataFrame:
    """Paths of new files; their contents are not read."""
    reader = spark.readStream.format("binaryFile").schema(PATHS_SCHEMA).option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(raw_root).select("path")


def ingest_stream(
    spark: SparkSession,
    kind: str,
    raw_root: str,
    bronze_root: str,
    checkpoint: str | None = None,
    name_glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamIngestResult:
    """Ingest every raw ``kind`` file not yet seen, then stop."""
    if kind not in DATA_SCHEMAS:
        raise ValueError("kind must be 'orders' or 'events'")
    glob = name_glob or raw_pattern(kind, ext="csv" if kind == "orders" else "ndjson")
    path = join_uri(bronze_root, kind)
    ckpt = checkpoint or join_uri(bronze_root, "_checkpoints", kind)
    counts: list[int] = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        name = hashlib.sha256(ckpt.encode()).hexdigest()[:12]
        # One path per file of the micro-batch.
        files = sorted(r["path"] for r in batch.collect())
        res = write_ingest(read_raw(spark, kind, raw_root, files), path, kind, ingest_id=f"stream-{name}-{batch_id:09d}")
        counts.append(res.rows or 0)

    query = (
        _paths_stream(spark, raw_root, glob, max_files_per_trigger)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return StreamIngestResult(kind, path, len(counts), sum(counts))
