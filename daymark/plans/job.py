"""The daily job: ingest → quality gate → six silver tables → publish.

``run_daily_job`` is a library function: paths, run date and rules are
arguments, the session is the caller's.  Each stage appends a record
(stage, table, rows, seconds); row counts come from Observations on the
writes, never from a second pass.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.functions.money import MONEY_SCALE
from daymark.functions.temporal import lookback_bounds, on_days, parse_run_date
from daymark.operators import metrics as M
from daymark.operators import quality as DQ
from daymark.operators.joins import fits_broadcast
from daymark.plans import bronze as B
from daymark.plans.daily import WAREHOUSE_TABLES, MetricTable, build_metric_tables
from daymark.schemas import CORRUPT_COLUMN, OUTPUT_SCHEMAS
from daymark.sinks.files import WriteResult, drop_partitions, read_back, write_flat, write_partitioned
from daymark.sinks.warehouse import publish, staged_refresh
from daymark.sources.csv import read_users_csv
from daymark.sources.files import join_uri, normalise_uri, raw_window_pattern


@dataclass
class JobPaths:
    bronze: str
    silver: str
    users: str
    raw: str | None = None
    publish: str | None = None
    outputs: dict[str, str] = field(default_factory=dict)
    raw_orders: str | None = None
    raw_events: str | None = None
    export: str | None = None          # flat header-CSV copy of every table
    warehouse: str | None = None       # files of the warehouse tables
    database: str | None = None        # catalog database of the warehouse tables

    def __post_init__(self) -> None:
        for name in ("bronze", "silver", "users", "raw", "publish", "raw_orders", "raw_events", "export", "warehouse"):
            value = getattr(self, name)
            if value:
                setattr(self, name, normalise_uri(value))
        self.outputs = {name: normalise_uri(path) for name, path in self.outputs.items()}

    @property
    def orders_source(self) -> str | None:
        return self.raw_orders or self.raw

    @property
    def events_source(self) -> str | None:
        return self.raw_events or self.raw

    def output(self, name: str) -> str:
        return self.outputs.get(name) or join_uri(self.silver, name)


@dataclass
class StageRecord:
    run_id: str
    stage: str
    table_name: str
    run_date: dt.date | None
    rows: int | None
    seconds: float


STAGE_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("stage", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("run_date", T.DateType(), True),
    T.StructField("rows", T.LongType(), True),
    T.StructField("seconds", T.DoubleType(), False),
])


@dataclass
class JobResult:
    run_id: str
    run_date: dt.date | None
    quality: list[tuple[str, str, int]]
    outputs: dict[str, WriteResult]
    stages: list[StageRecord]

    def stages_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(s.run_id, s.stage, s.table_name, s.run_date, s.rows, s.seconds) for s in self.stages]
        return spark.createDataFrame(rows, STAGE_SCHEMA)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """users.csv (columns by its header) or a Parquet users table.

    Lines that do not parse have ``_corrupt_record`` set.
    """
    if path.endswith(".csv") or "*.csv" in path:
        return read_users_csv(spark, path, by_header=True, keep_corrupt=True).select("user_id", "channel", CORRUPT_COLUMN)
    return spark.read.parquet(path).select("user_id", "channel", F.lit(None).cast("string").alias(CORRUPT_COLUMN))


def write_metric_tables(
    tables: Mapping[str, MetricTable],
    paths: JobPaths,
    fmt: str = "parquet",
    files_per_partition: int | None = None,
) -> dict[str, WriteResult]:
    return {
        name: write_partitioned(
            t.df, paths.output(name), [t.partition_col], fmt=fmt,
            files_per_partition=files_per_partition, layout=t.layout, tie_cols=t.tie_cols,
        )
        for name, t in tables.items()
    }


def run_daily_job(
    spark: SparkSession,
    paths: JobPaths,
    run_date: str | dt.date | None = None,
    days_back: int = 1,
    rules: Sequence[DQ.Rule] = DQ.DEFAULT_RULES,
    silver_format: str = "parquet",
    late_days: int | None = None,
    allow_empty: bool = False,
    raw_orders_glob: str | None = None,
    raw_events_glob: str | None = None,
    do_publish: bool = False,
    reuse_intermediates: bool = True,
    max_parse_failures: int = 0,
    scale: int = MONEY_SCALE,
) -> JobResult:
    """Run the job for all of history, or for a run date.

    A run date reads the raw files dated in its window (and up to
    ``late_days`` later) and restates the window's days and every other day
    that a row in those files, or in the version of them read before, belongs to, from all
    files that hold rows of those days: a late row counts on its own day, whichever file
    brought it, and a corrected file takes back what it brought.
    Lines that do not parse go to quarantine; more than ``max_parse_failures``
    of them in the files this run read stop it at the gate.  Amounts count in
    units of ``scale`` decimal places.
    """
    run_id = uuid.uuid4().hex[:12]
    day = parse_run_date(run_date)
    stages: list[StageRecord] = []

    def record(stage: str, table: str, rows: int | None, t0: float) -> None:
        stages.append(StageRecord(run_id, stage, table, day, rows, round(time.time() - t0, 3)))

    # 1. raw → bronze.
    orders_glob, events_glob = raw_orders_glob, raw_events_glob
    days: set[dt.date] | None = None
    if day is not None:
        first, last = lookback_bounds(day, days_back)
        days = {first + dt.timedelta(days=i) for i in range((last - first).days + 1)}
        last = last + dt.timedelta(days=late_days or 0)
        orders_glob = orders_glob or raw_window_pattern("orders", first, last, "csv")
        events_glob = events_glob or raw_window_pattern("events", first, last, "ndjson")
    ingested: list[B.IngestResult] = []
    for kind, source, glob, ingest in (
        ("orders", paths.orders_source, orders_glob, B.ingest_orders),
        ("events", paths.events_source, events_glob, B.ingest_events),
    ):
        if source:
            t0 = time.time()
            ingested.append(ingest(spark, source, paths.bronze, None, glob, allow_empty))
            record("ingest", kind, ingested[-1].rows, t0)
    if days is not None:
        # Also the days that the files' earlier versions had rows of, and may have no more.
        replaced = [B.replaced_days(spark, paths.bronze, r.kind, r.ingest_id) for r in ingested]
        days = days.union(*[r.days for r in ingested], *replaced)

    restated = sorted(days) if days is not None else None
    orders = B.read_bronze_orders(spark, paths.bronze, days=restated)
    events = B.read_bronze_events(spark, paths.bronze, days=restated)
    if restated is not None:
        orders, events = orders.where(on_days("order_ts", restated)), events.where(on_days("ts", restated))
    # The users file is parsed once per run.
    users_copy = join_uri(paths.silver, "_work", f"run_id={run_id}", "users")
    source_users = read_users(spark, paths.users)
    source_users.write.mode("overwrite").parquet(users_copy)
    all_users = spark.read.schema(source_users.schema).parquet(users_copy)
    users = all_users.where(F.col(CORRUPT_COLUMN).isNull()).select("user_id", "channel")

    # 2. quality on the rows this run uses; violations go to quarantine, the
    #    gate stops the run before anything is written to silver.
    t0 = time.time()
    quarantine_path = join_uri(paths.silver, "_quality", "quarantine", f"run_id={run_id}")
    parse = [
        all_users.where(F.col(CORRUPT_COLUMN).isNotNull()).select(
            F.lit("users").alias("table_name"), F.lit("parse").alias("rule"),
            F.col(CORRUPT_COLUMN).alias("row_json"),
        )
    ]
    parse += [
        B.read_bronze_quarantine(spark, paths.bronze, r.kind, [r.ingest_id]).select("table_name", "rule", "row_json")
        for r in ingested if r.corrupt
    ]
    dq_tables = {"orders": orders, "events": events, "users": users}
    used = [r for r in rules if r.table in dq_tables]
    results = list
    if used:
        # One pass: the quarantine write also yields the per-rule counts.
        frame, results = DQ.observed_quarantine(dq_tables, used)
        parse.append(frame)
    frame = parse[0]
    for more in parse[1:]:
        frame = frame.unionByName(more)
    q = write_flat(frame, quarantine_path, fmt="parquet")
    record("quality", "quarantine", q.rows, t0)
    t0 = time.time()
    # One row per table.
    kept = spark.read.schema("table_name string, rule string, row_json string").parquet(quarantine_path)
    unparsed = {r["table_name"]: r["count"] for r in kept.where("rule = 'parse'").groupBy("table_name").count().collect()}
    checked = results()
    if sum(unparsed.values()) > max_parse_failures:
        checked = [*checked, *((table, "parse", n, n) for table, n in sorted(unparsed.items()))]
    checked = DQ.gate_results(checked, used)
    if used:
        record("quality", "gate", sum(n for _, _, n in checked), t0)

    # 3. the six silver tables, dynamic overwrite of the run's days only.
    users_small = fits_broadcast(users)   # measured once
    tables = build_metric_tables(orders, events, users, scale=scale, broadcast_users=users_small)
    outputs: dict[str, WriteResult] = {}

    def write(name: str, df: DataFrame) -> None:
        t = tables[name]
        t0 = time.time()
        outputs[name] = write_partitioned(
            df, paths.output(name), [t.partition_col], fmt=silver_format,
            layout=t.layout, tie_cols=t.tie_cols, dynamic=days is not None, list_values=days is not None,
        )
        if restated is not None:
            # A restated day that has no rows any more must not keep its old ones.
            drop_partitions(spark, paths.output(name), t.partition_col, restated, outputs[name].values or ())
        record("transform", name, outputs[name].rows, t0)

    if reuse_intermediates:
        # Orders are scanned twice (distinct orders per day; revenue per
        # buyer-day) and events once (distinct user-days).  The two
        # per-day-and-user results are written once as flat work tables —
        # lineage cut, few files — and the other tables, daily_orders' buyers
        # and revenue included, are derived from them instead of re-reading
        # the facts; no multi-distinct expand of the order rows.
        work = join_uri(paths.silver, "_work", f"run_id={run_id}")
        t0 = time.time()
        res = write_flat(M.revenue_by_day_user(orders, scale), join_uri(work, "revenue"), fmt="parquet")
        record("transform", "revenue_by_day_user", res.rows, t0)
        per_user = spark.read.parquet(join_uri(work, "revenue"))
        t0 = time.time()
        res = write_flat(M.active_user_days(events), join_uri(work, "pairs"), fmt="parquet")
        record("transform", "active_user_days", res.rows, t0)
        pairs = spark.read.parquet(join_uri(work, "pairs"))

        write(
            "daily_orders",
            M.daily_orders_from(M.distinct_orders_by_day(orders), per_user, scale),
        )
        dau = M.daily_active_users_from_pairs(pairs)
        buyers = M.buyers_from_revenue(per_user)
        write("daily_revenue", M.daily_revenue_from_minor(per_user, scale))
        write("daily_active_users", dau)
        write(
            "daily_active_users_by_channel",
            M.daily_active_users_by_channel_from_pairs(pairs, users, users_small),
        )
        write(
            "daily_revenue_by_channel",
            M.daily_revenue_by_channel(
                None, users, scale, broadcast_users=users_small, per_user_minor=per_user
            ),
        )
        write("daily_conversion", M.conversion_from(dau, buyers))
    else:
        for name, t in tables.items():
            write(name, t.df)

    # 4. flat CSV export of all six tables (written by the executors).
    if paths.export:
        for name in tables:
            t0 = time.time()
            written = read_back(spark, paths.output(name), OUTPUT_SCHEMAS[name], silver_format)
            res = write_flat(written, join_uri(paths.export, name), fmt="csv")
            record("export", name, res.rows, t0)

    # 5. full refresh of the six warehouse tables, under their names.
    if paths.warehouse:
        if paths.database:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{paths.database}`")
        for name in tables:
            t0 = time.time()
            table = WAREHOUSE_TABLES[name]
            whole = read_back(spark, paths.output(name), OUTPUT_SCHEMAS[name], silver_format)
            target = f"`{paths.database}`.{table}" if paths.database else table
            record("load", table, staged_refresh(spark, whole, target, join_uri(paths.warehouse, table)), t0)

    # 6. publish the written tables.
    if do_publish and paths.publish:
        t0 = time.time()
        written = {
            name: read_back(spark, paths.output(name), OUTPUT_SCHEMAS[name], silver_format)
            for name in tables
        }
        if restated is not None:
            # Only the days this run restated are copied again.
            written = {n: df.where(F.col(tables[n].partition_col).isin(restated)) for n, df in written.items()}
        parts = {n: t.partition_col for n, t in tables.items()}
        layouts = {n: (t.layout, t.tie_cols) for n, t in tables.items()}
        for o in publish(written, paths.publish, parts, fmt=silver_format, layouts=layouts, restated=restated):
            record("publish", o.table_name, o.rows_written, t0)

    result = JobResult(run_id, day, checked, outputs, stages)
    write_flat(
        result.stages_frame(spark),
        join_uri(paths.silver, "_job", "stage_metrics"),
        fmt="parquet",
        mode="append",
        count_rows=False,
    )
    return result
