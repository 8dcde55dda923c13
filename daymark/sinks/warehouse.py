"""Warehouse refresh and publishing.

* ``refresh_jdbc``: full refresh of a database table through Spark's JDBC
  writer (``truncate`` keeps the table definition).  Each task writes its
  own partition, so the refresh is not atomic across tasks; write a staging
  table and swap it in the database where atomicity matters.
* ``refresh_catalog_table``: full refresh of a catalog table whose files
  live at a shared path.
* ``staged_refresh``: the same, loaded beside the live table and switched to.
* ``publish``: copy result tables to a target location, one outcome per
  table, raising at the end if any table failed.
* ``publish_changes``: bring a snapshot store up to another one's last commit,
  copying only the partitions that differ.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.sinks.files import drop_partitions, write_flat, write_partitioned
from daymark.sinks.snapshots import SnapshotStore


class PublishError(RuntimeError):
    def __init__(self, failed: Mapping[str, str]):
        self.failed = dict(failed)
        super().__init__("publish failed for: " + ", ".join(sorted(self.failed)))


def as_text(df: DataFrame) -> DataFrame:
    """Every column as STRING (the warehouse keeps text columns)."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def refresh_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    text_columns: bool = True,
    num_partitions: int | None = None,
) -> None:
    out = as_text(df) if text_columns else df
    writer = out.write.mode("overwrite").option("truncate", True)
    if num_partitions:
        writer = writer.option("numPartitions", num_partitions)
    writer.jdbc(url, table, properties=dict(properties or {}))


def refresh_catalog_table(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    path: str,
    fmt: str = "parquet",
    text_columns: bool = False,
) -> DataFrame:
    """Overwrite ``table`` (files at ``path``) and return it as a DataFrame."""
    out = as_text(df) if text_columns else df
    out.write.mode("overwrite").format(fmt).option("path", path).saveAsTable(table)
    return spark.table(table)


@dataclass(frozen=True)
class PublishOutcome:
    table_name: str
    target: str
    rows_written: int | None
    ok: bool
    error: str | None = None


OUTCOME_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("target", T.StringType(), False),
    T.StructField("rows_written", T.LongType(), True),
    T.StructField("ok", T.BooleanType(), False),
    T.StructField("error", T.StringType(), True),
])


def publish(
    tables: Mapping[str, DataFrame],
    target_root: str,
    partition_cols: Mapping[str, str] | None = None,
    fmt: str = "parquet",
    raise_on_error: bool = True,
    layouts: Mapping[str, str | tuple[str, tuple[str, ...]]] | None = None,
    restated: Sequence[dt.date] | None = None,
) -> list[PublishOutcome]:
    """Write each table under ``target_root/<name>``; per-table outcome.

    ``layouts`` maps a table to a write layout, or (layout, tie columns).  The tables
    replace the published ones, days that are gone included; with ``restated`` they hold
    those days only, and a restated day without rows is deleted from the target.
    """
    outcomes = []
    for name, df in tables.items():
        target = f"{target_root.rstrip('/')}/{name}"
        try:
            part = (partition_cols or {}).get(name)
            if part:
                spec = (layouts or {}).get(name, "balance")
                layout, ties = (spec, ()) if isinstance(spec, str) else spec
                res = write_partitioned(
                    df, target, [part], fmt=fmt, layout=layout, tie_cols=ties,
                    dynamic=restated is not None, list_values=restated is not None,
                )
                if restated is not None:
                    drop_partitions(df.sparkSession, target, part, restated, res.values or ())
            else:
                res = write_flat(df, target, fmt=fmt)
            outcomes.append(PublishOutcome(name, target, res.rows, True))
        except Exception as exc:  # noqa: BLE001 - collected, raised below
            outcomes.append(PublishOutcome(name, target, None, False, str(exc)))
    failed = {o.table_name: o.error or "" for o in outcomes if not o.ok}
    if failed and raise_on_error:
        raise PublishError(failed)
    return outcomes


@dataclass(frozen=True)
class PublishedTable:
    """What an incremental publish did with one table."""

    table_name: str
    copied: tuple[str, ...]      # partitions written at the target
    removed: tuple[str, ...]     # partitions the source has no more
    unchanged: int
    rows_written: int


def publish_changes(source: SnapshotStore, target: SnapshotStore, schemas: Mapping[str, T.StructType]) -> list[PublishedTable]:
    """Make the target's tables equal to the source's last commit, with one commit.

    Partitions are compared by the digests both commits hold; only those that differ are
    read and written, those that the source has no more are dropped.  Nothing changes
    at the target unless all tables were written: a failure raises ``PublishError`` that names
    the tables that failed.
    """
    snapshot, t = source.current(), target.begin()
    done: list[PublishedTable] = []
    failed: dict[str, str] = {}
    for name, schema in schemas.items():
        new, old = snapshot.partitions(name), t.base.partitions(name)
        differ = sorted(v for v, p in new.items() if v not in old or old[v].digest != p.digest)
        removed = sorted(set(old) - set(new))
        written: dict = {}
        try:
            if differ or removed:
                df = source.read(name, schema, differ, snapshot)
                written = t.write(name, df, snapshot.columns[name] if name in snapshot.columns else t.base.columns[name], names=[*differ, *removed])
        except Exception as exc:  # noqa: BLE001 - collected, raised below
            failed[name] = str(exc)
            continue
        done.append(PublishedTable(name, tuple(differ), tuple(removed), len(new) - len(differ), sum(p.rows for p in written.values())))
    if failed:
        raise PublishError(failed)
    if any(p.copied or p.removed for p in done):
        t.commit({"source_version": snapshot.version})
    return done


def staged_refresh(spark: SparkSession, df: DataFrame, table: str, path: str, fmt: str = "parquet", text_columns: bool = False) -> int:
    """Full refresh of a catalog table that readers see at once: the rows are written to a new
    folder below ``path``, counted there, and the table's location is set to it.

    A refresh that stops earlier leaves the table as it was.  The folder it had before stays
    for readers at work; older ones are deleted.  Returns the rows loaded.
    """
    out = as_text(df) if text_columns else df
    folder = f"{path.rstrip('/')}/load-{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}"
    res = write_flat(out, folder, fmt=fmt)
    written = spark.read.schema(out.schema).format(fmt).load(folder).count()
    if written != res.rows:
        raise RuntimeError(f"{table}: {res.rows} rows were written, {written} are read")
    exists = spark.catalog.tableExists(table)
    if exists and spark.table(table).schema.simpleString() != out.schema.simpleString():
        spark.sql(f"DROP TABLE {table}")  # an external table: its files stay
        exists = False
    before = _location(spark, table) if exists else None
    if exists:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=folder, source=fmt, schema=out.schema)
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(hadoop.Path(path)):
        name = status.getPath().getName()
        if name.startswith("load-") and name not in (folder.rsplit("/", 1)[-1], (before or "").rstrip("/").rsplit("/", 1)[-1]):
            fs.delete(status.getPath(), True)
    return written


def _location(spark: SparkSession, table: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def outcomes_frame(spark: SparkSession, outcomes: list[PublishOutcome]) -> DataFrame:
    """Outcome records (one per table) as a DataFrame."""
    rows = [(o.table_name, o.target, o.rows_written, o.ok, o.error) for o in outcomes]
    return spark.createDataFrame(rows, OUTCOME_SCHEMA)
