"""File sinks.

Every partitioned write sets ``partitionOverwriteMode=dynamic`` on the
writer, so rewriting one run date replaces only that date's folder.  Row
counts come from an ``Observation`` on the written DataFrame: no second
evaluation of the plan.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: How Spark names the folder of a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class WriteResult:
    path: str
    rows: int | None
    #: Folder names of the partition values written, where asked for.
    values: frozenset[str] | None = None


def _observed(df: DataFrame, count_rows: bool, values_of: str | None = None) -> tuple[DataFrame, Observation | None]:
    if not count_rows:
        return df, None
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    metrics = [F.count(F.lit(1)).alias("rows")]
    if values_of is not None:
        metrics.append(F.collect_set(F.coalesce(F.col(values_of).cast("string"), F.lit(NULL_PARTITION))).alias("values"))
    return df.observe(obs, *metrics), obs


def _rows(obs: Observation | None) -> int | None:
    return int(obs.get["rows"]) if obs is not None else None


def _values(obs: Observation | None) -> frozenset[str] | None:
    got = obs.get.get("values") if obs is not None else None
    return frozenset(got) if got is not None else None


def stringify_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast partition columns to STRING (a DATE reads back as DATE anyway)."""
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def rebalance(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """AQE-sized output partitions clustered by the partition columns.

    Each day lands in few files instead of one file per shuffle partition,
    and AQE splits a skewed day across tasks rather than writing it in one.
    """
    return df.hint("rebalance", *partition_cols)


def spread_partitions(df: DataFrame, partition_cols: Sequence[str], files_per_partition: int) -> DataFrame:
    """Cluster rows by partition value into ``files_per_partition`` buckets.

    The bucket is a hash of the whole row — deterministic, so a retried task
    writes the same rows — and a hot day is split over that many tasks
    instead of landing in one.
    """
    bucket = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_partition))
    return df.repartition(*[F.col(c) for c in partition_cols], bucket)


def cluster(
    df: DataFrame, partition_cols: Sequence[str], tie_cols: Sequence[str] = ()
) -> DataFrame:
    """Contiguous ranges of (partition value, tie columns), one range per task.

    Each small partition value becomes one file, and the values are written
    by ``spark.sql.shuffle.partitions`` tasks in parallel.  A range shuffle
    with a fixed count is neither merged into the upstream hash partitioning
    nor coalesced by AQE, so a backfill of thousands of small days does not
    collapse into one task writing every folder.  With ``tie_cols`` the
    sampled range bounds fall inside a large value in proportion to its rows,
    so a hot day is split over several tasks instead of one.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in (*partition_cols, *tie_cols)]
    return df.repartitionByRange(n, *keys)


LAYOUTS = ("balance", "cluster", "spread", "none")


def layout_for_write(
    df: DataFrame,
    partition_cols: Sequence[str],
    layout: str = "balance",
    files_per_partition: int | None = None,
    tie_cols: Sequence[str] = (),
) -> DataFrame:
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    if layout == "spread" or files_per_partition:
        return spread_partitions(df, partition_cols, files_per_partition or 1)
    if layout == "cluster":
        return cluster(df, partition_cols, tie_cols)
    if layout == "balance":
        return rebalance(df, partition_cols)
    return df


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    fmt: str = "parquet",
    dynamic: bool = True,
    header: bool = True,
    stringify: bool = False,
    files_per_partition: int | None = None,
    compression: str | None = None,
    count_rows: bool = True,
    layout: str = "balance",
    tie_cols: Sequence[str] = (),
    list_values: bool = False,
) -> WriteResult:
    """``partitionBy(cols).mode(overwrite)`` write (K1 CSV / K2 Parquet).

    With ``list_values`` the result names the values of the first partition column that were
    written (observed on the write; as many as there are folders).

    ``layout``: ``balance`` (AQE sizes files, splits a skewed value),
    ``cluster`` (range of values per task; with ``tie_cols`` a large value is
    split), ``spread`` (``files_per_partition`` hashed buckets per value) or
    ``none``.
    """
    out = stringify_columns(df, partition_cols) if stringify else df
    out = layout_for_write(out, partition_cols, layout, files_per_partition, tie_cols)
    out, obs = _observed(out, count_rows or list_values, partition_cols[0] if list_values else None)
    writer = (
        out.write.mode("overwrite")
        .partitionBy(*partition_cols)
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    )
    if fmt == "csv":
        writer = writer.option("header", header)
    if compression:
        writer = writer.option("compression", compression)
    writer.format(fmt).save(path)
    return WriteResult(path, _rows(obs), _values(obs))


def write_flat(
    df: DataFrame,
    path: str,
    fmt: str = "csv",
    header: bool = True,
    single_file: bool = False,
    mode: str = "overwrite",
    count_rows: bool = True,
) -> WriteResult:
    """Unpartitioned export (K3 CSV / K4 Parquet) written by the executors.

    ``single_file`` coalesces to one task; meant for small result tables.
    """
    out = df.coalesce(1) if single_file else df
    out, obs = _observed(out, count_rows)
    writer = out.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", header)
    writer.format(fmt).save(path)
    return WriteResult(path, _rows(obs))


def drop_partitions(spark, path: str, column: str, values: Sequence[dt.date], keep: Iterable[str]) -> list[str]:
    """Delete the folders of those ``values`` whose folder names are not in ``keep``.

    After a dynamic overwrite of a set of days ``keep`` has the days that the write produced; the
    others have no rows any more.  Folders are looked up one by one: as many as there
    are days in the run.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    dropped = []
    for value in sorted({v.isoformat() for v in values} - set(keep)):
        if fs.delete(hadoop.Path(f"{path.rstrip('/')}/{column}={value}"), True):
            dropped.append(value)
    return dropped


def read_back(
    spark, path: str, schema: T.StructType, fmt: str = "parquet", header: bool = True
) -> DataFrame:
    """Read a written table with its declared schema (partition values typed)."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", header).option("enforceSchema", False)
    return reader.format(fmt).load(path).select(*schema.fieldNames())
