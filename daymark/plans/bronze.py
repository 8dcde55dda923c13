"""Raw → bronze ingest.

Bronze has two tables per kind.  ``data`` is typed Parquet, appended by ingest:
one folder per ingest, split by ``file_date`` (the date a raw file carries in
its name or folder), written by the tasks that read the files, without a
shuffle.  ``files`` has one row per raw file and ingest: its path below the raw
root, its rows, and the range of days its rows have.  An ingest counts once its
``files`` rows are written, and of a file that was ingested again only the last
ingest counts, so a re-run replaces exactly what it reads.

The rows' own days decide what belongs to a run date; a file's day range only
tells which files can be left unread.  Lines that do not parse are kept in
``data`` with ``_corrupt_record`` set — raw input is parsed once — and readers
pick clean rows or the quarantine.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark import schemas as S
from daymark.functions.temporal import day_of, lookback_bounds, parse_run_date
from daymark.sinks.files import NULL_PARTITION, write_partitioned
from daymark.sources.csv import typed_orders
from daymark.sources.files import join_uri, raw_pattern, relative_name, with_provenance
from daymark.sources.listing import list_files, read_csv_layouts
from daymark.sources.ndjson import read_ndjson, typed_events, with_corrupt_column

DAY_COLUMNS = {"orders": "order_ts", "events": "ts"}
_PROVENANCE = [T.StructField("source_file", T.StringType()), T.StructField("ingest_id", T.StringType()), T.StructField("file_date", T.DateType())]
_CORRUPT = T.StructField(S.CORRUPT_COLUMN, T.StringType())
DATA_SCHEMAS = {
    "orders": T.StructType([*S.ORDERS.fields, _CORRUPT, *_PROVENANCE]),
    "events": T.StructType([*S.EVENTS.fields, T.StructField("props", T.StringType()), _CORRUPT, *_PROVENANCE]),
}
# of_ingest: the ingest whose rows a compaction copied.
FILES_SCHEMA = "source_file string, file_date date, rows long, corrupt long, first_day date, last_day date, ingested_at timestamp, of_ingest string, ingest_id string"
# Rows of each day in each data file (its path below the ingest's folder).
FILE_DAYS_SCHEMA = "source_file string, file_date date, data_file string, day date, rows long, corrupt long, ingest_id string"
# Superseded (file, ingest) pairs that may be shipped to every executor.
MAX_BROADCAST_FILES = 500_000


@dataclass(frozen=True)
class IngestResult:
    kind: str
    path: str
    rows: int | None
    ingest_id: str
    days: tuple[dt.date, ...] = ()    # the days that the ingested rows have
    corrupt: int = 0


def read_raw(spark: SparkSession, kind: str, raw_root: str, paths: Sequence[str]) -> DataFrame:
    """Typed rows with provenance of these raw files; corrupt lines keep ``_corrupt_record``.

    Order files are read by their own headers, whichever columns and order each has.
    """
    if kind == "orders":
        return typed_orders(read_csv_layouts(spark, paths, S.ORDERS_RAW, lambda df: with_provenance(df, raw_root)))
    if not paths:
        return typed_events(with_provenance(spark.createDataFrame([], with_corrupt_column(S.EVENTS_RAW)), raw_root))
    return typed_events(with_provenance(read_ndjson(spark, list(paths), S.EVENTS_RAW), raw_root))


def _matching(spark: SparkSession, raw_root: str, glob: str, allow_empty: bool) -> list[str]:
    """Paths of the raw files of a run: one per file."""
    paths = [r["path"] for r in list_files(spark, raw_root, glob).select("path").collect()]
    if not paths and not allow_empty:
        raise FileNotFoundError(f"no input file matches {glob} below {raw_root}")
    return paths


def raw_orders(
    spark: SparkSession,
    raw_root: str,
    run_date: str | dt.date | None = None,
    name_glob: str | None = None,
    allow_empty: bool = False,
) -> DataFrame:
    """Typed orders with provenance from every matching file under ``raw_root``."""
    glob = name_glob or raw_pattern("orders", run_date, "csv")
    return read_raw(spark, "orders", raw_root, _matching(spark, raw_root, glob, allow_empty))


def raw_events(
    spark: SparkSession,
    raw_root: str,
    run_date: str | dt.date | None = None,
    name_glob: str | None = None,
    allow_empty: bool = False,
) -> DataFrame:
    """Typed events with provenance; corrupt lines keep ``_corrupt_record``."""
    glob = name_glob or raw_pattern("events", run_date, "ndjson")
    raw = read_ndjson(
        spark, raw_root, S.EVENTS_RAW, recursive=True, name_glob=glob, allow_empty=allow_empty
    )
    return typed_events(with_provenance(raw, raw_root))


def write_ingest(df: DataFrame, path: str, kind: str, ingest_id: str | None = None) -> IngestResult:
    """Write one ingest: its rows, then one row per file.  The same id again
    replaces the ingest (a replayed micro-batch)."""
    spark = df.sparkSession
    ingest_id = ingest_id or f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    own = [f.name for f in DATA_SCHEMAS[kind].fields if f.name != "ingest_id"]
    data = join_uri(path, "data", f"ingest_id={ingest_id}")
    res = write_partitioned(df.select(*own), data, ["file_date"], dynamic=False, layout="none")
    corrupt, days = list_ingest(spark, path, kind, ingest_id)
    return IngestResult(kind, path, res.rows, ingest_id, tuple(sorted(days)), corrupt)


def list_ingest(spark: SparkSession, path: str, kind: str, ingest_id: str, versions: DataFrame | None = None) -> tuple[int, list[dt.date]]:
    """Make the written rows of an ingest count; returns its corrupt lines and its days.

    The rows are read once, to count them per raw file, data file and day; all else
    follows from that small table.  ``versions`` (source_file, ingested_at, of_ingest) gives a
    compaction the times of the ingests it copied, so that it takes their place and no later one's.
    """
    data = join_uri(path, "data", f"ingest_id={ingest_id}")
    written = spark.read.schema(DATA_SCHEMAS[kind]).parquet(data)
    clean = F.col(S.CORRUPT_COLUMN).isNull()
    day = F.when(clean, day_of(DAY_COLUMNS[kind])).alias("day")
    per_day = written.groupBy("source_file", "file_date", relative_name(data).alias("data_file"), day).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~clean).alias("corrupt")
    )
    days_path = join_uri(path, "file_days", f"ingest_id={ingest_id}")
    per_day.write.mode("overwrite").parquet(days_path)
    per_day = spark.read.schema(FILE_DAYS_SCHEMA).parquet(days_path)
    files = per_day.groupBy("source_file", "file_date").agg(
        F.sum("rows").alias("rows"), F.sum("corrupt").alias("corrupt"), F.min("day").alias("first_day"), F.max("day").alias("last_day")
    )
    if versions is None:
        files = files.withColumns({"ingested_at": F.current_timestamp(), "of_ingest": F.lit(None).cast("string")})
    else:
        own = versions.select(F.col("source_file").alias("__file"), "ingested_at", "of_ingest")
        files = files.join(own, F.col("source_file").eqNullSafe(F.col("__file"))).drop("__file")
    files.write.mode("overwrite").parquet(join_uri(path, "files", f"ingest_id={ingest_id}"))
    # One row per distinct day.
    days = per_day.groupBy("day").agg(F.sum("corrupt").alias("corrupt")).collect()
    return sum(r["corrupt"] for r in days), [r["day"] for r in days if r["day"]]


def ingest_orders(
    spark: SparkSession,
    raw_root: str,
    bronze_root: str,
    run_date: str | dt.date | None = None,
    name_glob: str | None = None,
    allow_empty: bool = False,
) -> IngestResult:
    df = raw_orders(spark, raw_root, run_date, name_glob, allow_empty)
    return write_ingest(df, join_uri(bronze_root, "orders"), "orders")


def ingest_events(
    spark: SparkSession,
    raw_root: str,
    bronze_root: str,
    run_date: str | dt.date | None = None,
    name_glob: str | None = None,
    allow_empty: bool = False,
) -> IngestResult:
    df = raw_events(spark, raw_root, run_date, name_glob, allow_empty)
    return write_ingest(df, join_uri(bronze_root, "events"), "events")


def bronze_files(spark: SparkSession, bronze_root: str, kind: str) -> DataFrame:
    """Every listed (file, ingest), and whether it is the file's last ingest."""
    try:
        files = spark.read.schema(FILES_SCHEMA).parquet(join_uri(bronze_root, kind, "files"))
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        files = spark.createDataFrame([], FILES_SCHEMA)
    last = files.groupBy("source_file").agg(F.max(F.struct("ingested_at", "ingest_id")).alias("last"))
    met = files.join(last.withColumnRenamed("source_file", "__file"), F.col("source_file").eqNullSafe(F.col("__file")))
    return met.select(*files.columns, (F.col("ingest_id") == F.col("last.ingest_id")).alias("current"))


def read_bronze(
    spark: SparkSession,
    bronze_root: str,
    kind: str,
    days: Sequence[dt.date] | None = None,
) -> DataFrame:
    """Rows of each file's last ingest, corrupt lines included.

    With ``days`` only data files that hold a clean row of one of them are opened.
    No ingest yet reads as no rows.
    """
    files = bronze_files(spark, bronze_root, kind)
    date = F.coalesce(F.col("file_date").cast("string"), F.lit(NULL_PARTITION)).alias("date")
    # One row per folder (ingest and file date).
    found = files.groupBy("ingest_id", date).agg(F.count_if("current").alias("met"), F.count_if(~F.col("current")).alias("replaced")).collect()
    base = join_uri(bronze_root, kind, "data")
    if days is None:
        places = [join_uri(base, f"ingest_id={r['ingest_id']}", f"file_date={r['date']}") for r in found if r["met"]]
    elif not days or not found:
        places = []
    else:
        per_day = spark.read.schema(FILE_DAYS_SCHEMA).parquet(join_uri(bronze_root, kind, "file_days")).where(F.col("day").isin(*days))
        own = files.where("current").select(F.col("source_file").alias("__file"), F.col("ingest_id").alias("__ingest"))
        met = per_day.join(own, F.col("source_file").eqNullSafe(F.col("__file")) & (F.col("ingest_id") == F.col("__ingest")), "left_semi")
        # One row per data file that is opened.
        places = [join_uri(base, f"ingest_id={r['ingest_id']}", r["data_file"]) for r in met.select("ingest_id", "data_file").distinct().collect()]
    schema = DATA_SCHEMAS[kind]
    if not places:
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).option("basePath", base).parquet(*sorted(places)).select(*schema.fieldNames())
    if any(r["met"] and r["replaced"] for r in found):
        replaced = files.where("NOT current").select(F.col("ingest_id").alias("__ingest"), F.col("source_file").alias("__file"))
        side = F.broadcast(replaced) if sum(r["replaced"] for r in found) <= MAX_BROADCAST_FILES else replaced
        same = (F.col("ingest_id") == F.col("__ingest")) & F.col("source_file").eqNullSafe(F.col("__file"))
        df = df.join(side, same, "left_anti")
    return df


def read_versions(spark: SparkSession, bronze_root: str, kind: str, versions: DataFrame, corrupt: bool = False) -> DataFrame:
    """Clean rows (with ``corrupt`` all rows) of the given (source_file, ingest_id, file_date,
    rows), wherever a compaction has put them: only the folders that hold them are listed, one
    per ingest and file date."""
    schema = DATA_SCHEMAS[kind]
    versions = versions.where("rows > 0").select("source_file", "ingest_id", "file_date")
    files = spark.read.schema(FILES_SCHEMA).parquet(join_uri(bronze_root, kind, "files"))
    moved = files.where("of_ingest IS NOT NULL").groupBy("source_file", F.col("of_ingest").alias("ingest_id")).agg(F.max("ingest_id").alias("__now"))
    versions = versions.join(moved, ["source_file", "ingest_id"], "left").select("source_file", F.coalesce("__now", "ingest_id").alias("ingest_id"), "file_date")
    folders = versions.select("ingest_id", F.coalesce(F.col("file_date").cast("string"), F.lit(NULL_PARTITION)).alias("date")).distinct().collect()
    if not folders:
        return spark.createDataFrame([], schema)
    base = join_uri(bronze_root, kind, "data")
    paths = [join_uri(base, f"ingest_id={r['ingest_id']}", f"file_date={r['date']}") for r in folders]
    df = spark.read.schema(schema).option("basePath", base).parquet(*sorted(paths))
    df = df if corrupt else df.where(F.col(S.CORRUPT_COLUMN).isNull())
    return df.join(versions.select("source_file", "ingest_id"), ["source_file", "ingest_id"], "left_semi").select(*schema.fieldNames())


def replaced_days(spark: SparkSession, bronze_root: str, kind: str, ingest_id: str) -> list[dt.date]:
    """Days of the rows that an ingest's files brought the last time before it: they
    lose those rows.  Only the replaced files are read; one row per day comes back."""
    files = spark.read.schema(FILES_SCHEMA).parquet(join_uri(bronze_root, kind, "files"))
    own = files.where(F.col("ingest_id") == ingest_id).select(F.col("source_file").alias("__file"), F.col("ingested_at").alias("__at"))
    earlier = files.join(own, F.col("source_file").eqNullSafe(F.col("__file")) & (F.col("ingested_at") < F.col("__at")))
    last = earlier.groupBy("source_file").agg(F.max(F.struct("ingested_at", "ingest_id", "file_date", "rows")).alias("v"))
    rows = read_versions(spark, bronze_root, kind, last.select("source_file", "v.ingest_id", "v.file_date", "v.rows"))
    days = rows.select(day_of(DAY_COLUMNS[kind]).alias("day")).distinct().where("day IS NOT NULL").collect()
    return sorted(r["day"] for r in days)


def _window(run_date: str | dt.date | None, days_back: int) -> list[dt.date] | None:
    day = parse_run_date(run_date)
    if day is None:
        return None
    first, last = lookback_bounds(day, days_back)
    return [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]


def read_bronze_orders(
    spark: SparkSession,
    bronze_root: str,
    run_date: str | dt.date | None = None,
    days_back: int = 1,
    days: Sequence[dt.date] | None = None,
) -> DataFrame:
    df = read_bronze(spark, bronze_root, "orders", days if days is not None else _window(run_date, days_back))
    return df.where(F.col(S.CORRUPT_COLUMN).isNull()).select(*S.ORDERS.fieldNames())


def read_bronze_events(
    spark: SparkSession,
    bronze_root: str,
    run_date: str | dt.date | None = None,
    days_back: int = 1,
    days: Sequence[dt.date] | None = None,
) -> DataFrame:
    df = read_bronze(spark, bronze_root, "events", days if days is not None else _window(run_date, days_back))
    return df.where(F.col(S.CORRUPT_COLUMN).isNull()).select(*S.EVENTS.fieldNames())


def read_bronze_quarantine(
    spark: SparkSession, bronze_root: str, kind: str = "events", ingest_ids: Sequence[str] | None = None
) -> DataFrame:
    """Lines that do not parse: table_name, rule, row_json (+ provenance)."""
    df = read_bronze(spark, bronze_root, kind)
    if ingest_ids is not None:
        df = df.where(F.col("ingest_id").isin(list(ingest_ids)))
    return df.where(F.col(S.CORRUPT_COLUMN).isNotNull()).select(
        F.lit(kind).alias("table_name"),
        F.lit("parse").alias("rule"),
        F.col(S.CORRUPT_COLUMN).alias("row_json"),
        "source_file",
        "file_date",
    )
